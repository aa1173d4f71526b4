"""Role tables over all order lines: the texts Spark runs give the rows of the portable ones."""

import collections

import pytest

from tallgrass.session import scratch_root
from tallgrass.sources import roles
from tallgrass.sources.catalog import SourceCatalog

LINES = ("r_staffing", "r_occ", "r_ind", "r_hiresseps")

#: Nulls in keys and values, repeated keys, lines without an order or part, a customer without a nation.
TABLES = {
    "nation": ("n_nationkey int, n_name string, n_regionkey int",
               [(0, "N0", 0), (14, "N14", 0), (15, "N15", 1), (20, "N20", 1), (20, "N20", 1), (21, None, 1)]),
    "customer": ("c_custkey long, c_nationkey int", [(k, (0, 14, 15, 20, 21, None, 9)[k % 7]) for k in range(30)] + [(1, 14), (None, 0)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderdate date",
               [(k, k % 31 if k % 13 else None, f"{1992 + k % 5}-0{1 + k % 9}-11" if k % 17 else None) for k in range(120)] + [(7, 3, "1993-02-02")]),
    "part": ("p_partkey long, p_size int", [(k, k * 7 % 50 if k % 19 else None) for k in range(-5, 60)] + [(3, 11), (None, 4)]),
    "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_returnflag string, l_linestatus string",
                 [(k % 130, k % 67 - 6, k % 5 if k % 23 else None, k % 50 + 1.5 if k % 11 else None, k * 1.005 if k % 29 else None,
                   ("R", "A", "N", None)[k % 4], ("O", "F", None)[k % 3]) for k in range(900)]),
}


@pytest.fixture(scope="module")
def odd_lines(spark):
    root = f"{scratch_root(spark)}/odd_lines"
    for name, (schema, rows) in TABLES.items():
        text = schema.replace(" date", " string")
        df = spark.createDataFrame(rows, text)
        if "date" in schema:
            df = df.withColumn("o_orderdate", df["o_orderdate"].cast("date"))
        df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return root


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_line_tables_have_the_portable_rows(spark, odd_lines, monkeypatch):
    monkeypatch.setattr(roles, "DRIVER_TABLES", tuple(TABLES))
    own = spark.newSession()  # other tests keep their views
    src = SourceCatalog(own, odd_lines, "odd")
    built = {name: src.role(name) for name in LINES}
    for name in LINES:
        for table in TABLES:
            src.raw(table).createOrReplaceTempView(table)
        plain = own.sql(roles.ROLE_SQL[name])
        assert built[name].dtypes == plain.dtypes
        assert counted(built[name]) == counted(plain) and not plain.isEmpty()


@pytest.mark.parametrize("name", LINES)
def test_order_lines_are_joined_once_for_all_tables(name):
    assert "lineitem" not in roles.role_sql(name) and roles.SPARK_DEPENDS[name] == ("r_lines",)
    assert "lineitem" in roles.role_sql(name, "duckdb")  # the oracle's text stays


def exchanged(node):
    """The schemas of all shuffles of a plan."""
    out = [node.schema().simpleString()] if node.nodeName() == "Exchange" else []
    return out + [x for i in range(node.children().size()) for x in exchanged(node.children().apply(i))]


def test_completions_have_the_portable_rows_and_shuffle_no_text(spark, tmp_path):
    own = spark.newSession()
    rows = [(k % 37 if k % 19 else None, k % 67 - 6 if k % 23 else None, k % 5 if k % 13 else None, k % 8 if k % 17 else None,
             k % 50 + 1.5 if k % 11 else None, f"199{k % 7}-03-0{1 + k % 9}" if k % 29 else None) for k in range(900)]
    df = own.createDataFrame(rows * 2, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate string")
    df.withColumn("l_shipdate", df["l_shipdate"].cast("date")).createOrReplaceTempView("lineitem")
    ours, plain = own.sql(roles.role_sql("r_completions")), own.sql(roles.ROLE_SQL["r_completions"])
    assert ours.dtypes == plain.dtypes and counted(ours) == counted(plain) and not plain.isEmpty()
    shuffles = exchanged(ours._jdf.queryExecution().executedPlan().initialPlan())
    assert shuffles and not any("string" in x for x in shuffles)


def test_order_lines_shuffle_no_text(spark, odd_lines):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for table in TABLES:
        own.read.parquet(f"{odd_lines}/{table}.parquet").createOrReplaceTempView(table)
    plan = own.sql(roles.role_sql("r_lines"))._jdf.queryExecution().executedPlan().initialPlan()
    lines = [x for x in exchanged(plan) if "l_partkey" in x]
    assert len(lines) == 2 and not any("string" in x for x in lines)
