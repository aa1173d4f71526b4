"""Hand-maintained lookup CSVs (A2, A3).

A lookup is ``<name>.csv`` (header row) with an optional pinned schema in
the warehouse's JSON form.  With a schema, every column is read as typed
there, so code-like columns (CIP ``44.0400``, FIPS ``05001``) stay text.
Without one the schema is inferred, which is offered but warned about.
"""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(), "INT64": T.LongType(), "INTEGER": T.LongType(), "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(), "NUMERIC": T.DecimalType(38, 9), "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
}


def schema_from_json(text: str) -> T.StructType:
    fields = json.loads(text)
    return T.StructType([
        T.StructField(f["name"], _TYPES[f.get("type", "STRING").upper()], f.get("mode", "NULLABLE") != "REQUIRED")
        for f in fields
    ])


def load_reference(spark: SparkSession, path: str, schema_json: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema_json is None:
        warnings.warn(f"{path}: no pinned schema; code-like columns may be read as numbers", stacklevel=2)
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema_from_json(schema_json)).csv(path)


# The pinned schema of the program-to-occupation lookup.
SOC2CIP_SCHEMA = [
    {"name": "CIP2020Title", "type": "STRING", "mode": "NULLABLE"},
    {"name": "PROGRAMID", "type": "STRING", "mode": "NULLABLE"},
    {"name": "OCCID", "type": "STRING", "mode": "NULLABLE"},
    {"name": "SOC2018Title", "type": "STRING", "mode": "NULLABLE"},
]

# A lookup derived from ``part``: program codes shaped like CIP codes.
SOC2CIP_FROM_PART = """
select concat('Program ', p_name) as CIP2020Title,
 concat(lpad(cast(10 + p_size % 40 as varchar(9)), 2, '0'), '.', lpad(cast((p_partkey * 7) % 10000 as varchar(9)), 4, '0'))
  as PROGRAMID,
 concat(cast(11 + p_size % 4 as varchar(9)), '-', cast(1011 + p_partkey % 7 as varchar(9))) as OCCID,
 concat('Occupation ', p_type) as SOC2018Title
from part"""
