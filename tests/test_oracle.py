"""Every registered query against its DuckDB oracle at sf0.001
(row count, column names, order-insensitive value hash), the same
comparison the correctness gate makes at sf0.01."""

import duckdb
import pytest

import __spark_entry__ as E
from tallgrass.sources.roles import DRIVER_TABLES
from tools.compare_oracle import digest

from .conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_an_oracle_or_a_reason():
    # the training-data queries have tests of their own beside them
    without = sorted(set(QUERIES) - set(E.LLM_QUERIES) - set(ORACLE))
    assert without == []
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan  # JVM-side only
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows) == digest(o_cols, o_rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "LQ" in df.columns
