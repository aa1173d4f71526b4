"""Sources bound to catalog tables: agreement at bind time, versions, derived tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.sources.tables import SchemaDisagreement, TableCatalog, register_external, table_version, widens

CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("rate", T.DoubleType()),
                         T.StructField("name", T.StringType())])


@pytest.fixture()
def tables(spark, scratch):
    def make(**frames):
        for name, df in frames.items():
            df.write.mode("append").parquet(f"{scratch}/data/{name}")
        base = "t" + scratch.rsplit("/", 1)[1][:12]
        return register_external(spark, base, {n: f"{scratch}/data/{n}" for n in frames}, f"{scratch}/db")
    return make


def test_names_and_types_agree_by_widening(spark, tables):
    ids = tables(a=spark.range(3).select(F.col("id").cast("int").alias("ID"), F.lit(1.5).cast("float").alias("Rate"),
                                         F.lit("x").alias("name"), F.lit(0).alias("extra")))
    got = TableCatalog(spark, ids, {"a": CONTRACT}).a
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in CONTRACT]
    assert sorted(tuple(r) for r in got.collect()) == [(i, 1.5, "x") for i in range(3)]


def test_all_faults_are_reported_together(spark, tables):
    ids = tables(a=spark.range(1).select("id", F.lit("1.5").alias("rate")), b=spark.range(1))
    ids["c"] = "nowhere.at_all"
    with pytest.raises(SchemaDisagreement) as e:
        TableCatalog(spark, ids, {"a": CONTRACT, "c": CONTRACT})
    assert e.value.faults == ["a.rate is string, not double", "a.name is missing", "b has no contract",
                              "c: there is no table nowhere.at_all"]


def test_unbound_names_raise(spark, tables):
    cat = TableCatalog(spark, tables(a=spark.range(1)), {"a": T.StructType([T.StructField("id", T.LongType())])})
    with pytest.raises(AttributeError, match="no table is bound to b"):
        cat.b


def test_new_data_gives_new_derived_tables(spark, tables, scratch):
    contract = {"a": T.StructType([T.StructField("id", T.LongType())])}
    ids = tables(a=spark.range(5))
    first = TableCatalog(spark, ids, contract)
    assert first.derived("n", lambda: first.a.groupBy().count()).first()[0] == 5
    again = TableCatalog(spark, ids, contract)
    assert again.root == first.root
    spark.range(5, 7).write.mode("append").parquet(f"{scratch}/data/a")
    spark.catalog.refreshTable(ids["a"])
    later = TableCatalog(spark, ids, contract)
    assert later.root != first.root
    assert later.derived("n", lambda: later.a.groupBy().count()).first()[0] == 7
    assert first.derived("n", lambda: None).first()[0] == 5


def test_views_have_versions_too(spark, tables):
    ids = tables(a=spark.range(4))
    spark.table(ids["a"]).filter("id > 1").createOrReplaceTempView("some_view")
    assert table_version(spark, "some_view") == table_version(spark, "some_view") != table_version(spark, ids["a"])


@pytest.mark.parametrize("have, want, ok", [
    ("int", "bigint", True), ("bigint", "int", False), ("float", "double", True), ("double", "float", False),
    ("int", "double", True), ("bigint", "double", False), ("int", "decimal(10,0)", True), ("int", "decimal(9,0)", False),
    ("decimal(8,2)", "decimal(10,3)", True), ("decimal(8,2)", "decimal(8,3)", False), ("date", "string", False),
    ("varchar(3)", "string", True), ("timestamp", "timestamp", True)])
def test_widening(have, want, ok):
    parse = T._parse_datatype_string if hasattr(T, "_parse_datatype_string") else T.DataType.fromDDL
    assert widens(parse(have), parse(want)) is ok


def test_a_mart_reads_through_tables_as_through_paths(spark, src, cfg):
    from tallgrass.plans.operator_queries import q_table_source
    from tallgrass.plans.postings import fact_skills
    by_table, by_path = q_table_source(src, cfg), fact_skills(src, cfg)
    assert by_table.exceptAll(by_path).isEmpty() and by_path.exceptAll(by_table).isEmpty()
    # filters still reach the scan
    assert "PushedFilters: [IsNotNull" in by_table._jdf.queryExecution().executedPlan().toString()
