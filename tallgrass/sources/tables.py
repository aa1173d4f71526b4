"""Sources bound to catalog tables.

``TableCatalog`` maps logical source names to qualified table names and serves
them to the marts in place of ``SourceCatalog``.  Binding checks everything at
once, before any job runs: every table exists, and holds every column of its
contract in a type that widens to the contract's (names match without regard to
case, further columns are left out).  All faults are reported together.

Tables derived from the sources are kept under a key of the names, schemas and
versions of the bound tables, so new data in a table gives new derived tables.
The version of a table is a digest of its files' names, sizes and times, summed
up by a Spark job (the listing does not pass the driver row by row).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.session import apply_session_settings, scratch_root
from tallgrass.sources.catalog import DerivedTables

_INTEGRAL = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaDisagreement(ValueError):
    """The bound tables do not satisfy their contracts; ``faults`` names every one."""

    def __init__(self, faults: list[str]):
        super().__init__(f"{len(faults)} fault(s): " + "; ".join(faults))
        self.faults = faults


def widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of ``have`` is one of ``want``."""
    if have == want:
        return True
    a, b = _INTEGRAL.get(type(have)), _INTEGRAL.get(type(want))
    if a and b:
        return a <= b
    if isinstance(want, T.DecimalType):
        whole = want.precision - want.scale
        if a:
            return a <= whole
        return isinstance(have, T.DecimalType) and have.scale <= want.scale and have.precision - have.scale <= whole
    if isinstance(want, T.DoubleType):
        return isinstance(have, T.FloatType) or bool(a and a <= 10)
    if isinstance(want, T.StringType):
        return isinstance(have, (T.StringType, T.CharType, T.VarcharType))
    return False


def agree(name: str, have: T.StructType, want: T.StructType) -> tuple[dict[str, str], list[str]]:
    """(contract column -> the table's column, faults)."""
    by_name: dict[str, list[T.StructField]] = {}
    for f in have.fields:
        by_name.setdefault(f.name.lower(), []).append(f)
    columns, faults = {}, []
    for f in want.fields:
        found = by_name.get(f.name.lower(), [])
        if len(found) != 1:
            faults.append(f"{name}.{f.name} is missing" if not found else f"{name}.{f.name} is there {len(found)} times")
        elif not widens(found[0].dataType, f.dataType):
            faults.append(f"{name}.{f.name} is {found[0].dataType.simpleString()}, not {f.dataType.simpleString()}")
        else:
            columns[f.name] = found[0].name
    return columns, faults


def table_details(spark: SparkSession, identifier: str) -> dict[str, str]:
    """What the catalog says of a table besides its columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier}").collect()
    keys = [r["col_name"] for r in rows]
    start = keys.index("# Detailed Table Information") + 1 if "# Detailed Table Information" in keys else len(keys)
    return {r["col_name"]: r["data_type"] for r in rows[start:] if r["col_name"]}


def table_version(spark: SparkSession, identifier: str) -> str:
    """Digest of schema, definition and files; it changes with the table's content."""
    details = table_details(spark, identifier)
    text = [spark.table(identifier).schema.json(), details.get("Provider", ""), details.get("View Text", "")]
    paths = [details["Location"]] if details.get("Location") else spark.table(identifier).inputFiles()
    if paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        seen = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
                         .alias("h")).first()
        text += [str(seen["n"]), str(seen["h"])]
    return hashlib.sha1("\n".join(text).encode()).hexdigest()


class TableCatalog(DerivedTables):
    """Logical source names served from catalog tables."""

    def __init__(self, spark: SparkSession, tables: dict[str, str], contract: dict[str, T.StructType]):
        apply_session_settings(spark)
        faults, frames, versions = [], {}, []
        for name, identifier in sorted(tables.items()):
            if name not in contract:
                faults.append(f"{name} has no contract")
            elif not spark.catalog.tableExists(identifier):
                faults.append(f"{name}: there is no table {identifier}")
            else:
                frame = spark.table(identifier)
                columns, wrong = agree(name, frame.schema, contract[name])
                faults += wrong
                if not wrong:
                    frames[name] = frame.select(*[
                        (F.col(f"`{columns[f.name]}`") if frame.schema[columns[f.name]].dataType == f.dataType
                         else F.col(f"`{columns[f.name]}`").cast(f.dataType)).alias(f.name) for f in contract[name].fields])
                    versions.append(f"{name} {identifier} {table_version(spark, identifier)}")
        if faults:
            raise SchemaDisagreement(faults)
        key = hashlib.sha1("\n".join(versions).encode()).hexdigest()[:16]
        super().__init__(spark, f"{scratch_root(spark)}/tallgrass_sources/tables/{key}")
        self.tables, self._bound = dict(tables), frames

    def __getattr__(self, item: str) -> DataFrame:
        bound = self.__dict__.get("_bound", {})
        if item in bound:
            return bound[item]
        raise AttributeError(f"no table is bound to {item}")


def register_external(spark: SparkSession, database: str, paths: dict[str, str], location: str) -> dict[str, str]:
    """Catalog tables over Parquet folders (name -> path); returns name -> identifier."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, path in paths.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet LOCATION '{path}'")
    return {name: f"{database}.{name}" for name in paths}
