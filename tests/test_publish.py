"""Staged publish, pointer switch, limited runs, rollback, manifest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallgrass.operators.dataops import QualityCheckError, QualityConfig, conform, publishable, run_record
from tallgrass.sources.sinks import Warehouse, publish_cycle, record_no_change, rollback, run_batch


def frame(spark, n):
    return spark.range(n).select(F.col("id").alias("AREAID"), F.lit(2024).alias("YEAR"))


def test_publish_then_read(spark, scratch):
    wh = Warehouse(spark, scratch)
    r = publish_cycle(wh, frame(spark, 10), "t", QualityConfig())
    assert r.status == "success" and r.published and r.row_count == 10 and r.max_year == 2024
    assert wh.read("t").count() == 10
    runs = wh.manifest().collect()
    assert len(runs) == 1 and runs[0]["status"] == "success" and runs[0]["row_count"] == 10


def test_failed_check_leaves_published_table_alone(spark, scratch):
    wh = Warehouse(spark, scratch)
    publish_cycle(wh, frame(spark, 1000), "t", QualityConfig())
    with pytest.raises(QualityCheckError):
        publish_cycle(wh, frame(spark, 10), "t", QualityConfig())  # 99 % drift
    assert wh.read("t").count() == 1000
    statuses = sorted(r["status"] for r in wh.manifest().collect())
    assert statuses == ["failed", "success"]


def test_limited_run_never_publishes(spark, scratch):
    wh = Warehouse(spark, scratch)
    r = publish_cycle(wh, frame(spark, 100), "t", QualityConfig(), row_limit=5)
    assert r.status == "success_limited" and not r.published and r.row_count == 5
    with pytest.raises(FileNotFoundError):
        wh.read("t")
    with pytest.raises(ValueError):
        publish_cycle(wh, frame(spark, 100), "t", QualityConfig(), row_limit=0)


def test_rollback_restores_previous_run_and_is_repeatable(spark, scratch):
    wh = Warehouse(spark, scratch)
    first = publish_cycle(wh, frame(spark, 100), "t", QualityConfig())
    publish_cycle(wh, frame(spark, 110), "t", QualityConfig())
    assert wh.read("t").count() == 110
    assert rollback(wh, "t") == first.run_id
    assert wh.read("t").count() == 100
    assert rollback(wh, "t") == first.run_id  # same target again
    with pytest.raises(LookupError):
        rollback(wh, "never_published")


def test_batch_keeps_going_and_fails_at_the_end(spark, scratch):
    wh = Warehouse(spark, scratch)

    def boom():
        raise RuntimeError("query failed")

    with pytest.raises(RuntimeError, match="1 dataset"):
        run_batch(wh, {"a": lambda: frame(spark, 3), "b": boom}, QualityConfig())
    out = run_batch(wh, {"a": lambda: frame(spark, 3), "b": boom}, QualityConfig(), raise_at_end=False)
    assert {r["dataset"]: r["status"] for r in out.collect()} == {"a": "success", "b": "failed"}


def test_derived_datasets_read_what_their_base_has_written(spark, scratch):
    built = []

    def build(name, n=3):
        return lambda: built.append(name) or frame(spark, n)

    def boom():
        raise RuntimeError("query failed")

    def later(df):
        return df.withColumn("YEAR", F.col("YEAR") + 1)

    derived = {"a_later": ("a", later), "b_later": ("b", later), "c_later": ("c", later)}
    builders = {"a_later": build("a_later"), "b_later": build("b_later"), "a": build("a"), "b": boom, "c_later": build("c_later")}
    out = run_batch(Warehouse(spark, f"{scratch}/all"), builders, QualityConfig(), raise_at_end=False, derived=derived, parallelism=1)
    assert [(r["dataset"], r["status"]) for r in out.collect()] == [
        ("a_later", "success"), ("b_later", "success"), ("a", "success"), ("b", "failed"), ("c_later", "success")]
    # built once; the failed base and the one that is not in the batch leave their datasets to their own builders
    assert sorted(built) == ["a", "b_later", "c_later"]
    rows = Warehouse(spark, f"{scratch}/all").read("a_later").collect()
    assert sorted(tuple(r) for r in rows) == [(0, 2025), (1, 2025), (2, 2025)]
    built.clear()
    run_batch(Warehouse(spark, f"{scratch}/some"), {"a": build("a"), "a_later": build("a_later")}, QualityConfig(),
              row_limit=1, derived=derived)
    assert sorted(built) == ["a", "a_later"]   # limited rows are nobody's base


def test_lagged_marts_of_a_batch_are_the_lagged_marts(spark, src, cfg, scratch):
    from tallgrass.plans import LAGGED, MARTS, run_marts
    names = [n for pair in LAGGED.items() for n in (pair[0], pair[1][0])]
    wh = Warehouse(spark, scratch)
    run_marts(wh, src, cfg, names=names, quality=QualityConfig())
    for name in LAGGED:
        own = publishable(MARTS[name](src, cfg))
        back = wh.read(name)
        assert back.dtypes == own.dtypes and not back.isEmpty()
        assert back.exceptAll(own).isEmpty() and own.exceptAll(back).isEmpty()


def test_empty_result_writes_typed_parquet(spark, scratch):
    df = spark.createDataFrame([], "AREAID bigint, COUNTY_NAME string")
    df.write.parquet(f"{scratch}/empty")
    back = spark.read.parquet(f"{scratch}/empty")
    assert back.count() == 0 and [f.dataType.simpleString() for f in back.schema] == ["bigint", "string"]


def test_publishable_type_mapping(spark):
    df = spark.sql("select cast(1 as int) i, cast(1.5 as float) f, array(1, 2) a, named_struct('x', 1) s, "
                   "map('k', 1) m, date'2024-01-01' d, cast(1.25 as decimal(10,2)) n, true b, 'x' t")
    out = publishable(df)
    types = {f.name: f.dataType.simpleString() for f in out.schema}
    assert types == {"i": "bigint", "f": "double", "a": "string", "s": "string", "m": "string", "d": "date",
                     "n": "decimal(10,2)", "b": "boolean", "t": "string"}
    assert all(f.nullable for f in out.schema)
    assert out.first()["a"] == "[1,2]"


def test_entries_are_put_once(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    from tallgrass.sources.fs import CommitLog, put_if_absent
    assert put_if_absent(spark, f"{scratch}/a/b", "one") and not put_if_absent(spark, f"{scratch}/a/b", "two")
    log = CommitLog(spark, f"{scratch}/log")
    assert log.latest() is None and log.append("x", after=0) == 1 and log.append("late", after=0) is None
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda i: log.append(f"e{i}"), range(12)))
    assert sorted(numbers) == list(range(2, 14))
    assert {text for _, text in log.entries()} == {"x", *[f"e{i}" for i in range(12)]}
    # a writer that died over its entry: the number is taken, readers pass it over
    put_if_absent(spark, f"{scratch}/log/{14:020d}", "half")
    assert log.latest()[0] == 13 and log.append("next") == 15 and log.latest() == (15, "next")


def test_late_publisher_is_refused(spark, scratch):
    from tallgrass.sources.sinks import ConcurrentPublishError
    wh = Warehouse(spark, scratch)
    r = publish_cycle(wh, frame(spark, 3), "t", QualityConfig())
    wh.point_to("t", r.run_id, after=1)
    with pytest.raises(ConcurrentPublishError):
        wh.point_to("t", r.run_id, after=1)
    assert [(h["number"], h["action"]) for h in wh.history("t")] == [(1, "publish"), (2, "publish")]


def test_run_log_folds_to_states_and_closes_lost_runs(spark, scratch):
    from tallgrass.operators import dataops as D
    t0 = dt.datetime(2024, 1, 1)
    path = f"{scratch}/runs"
    D.append_run_records(spark, path, [D.run_record(i, "p", "d", "running", t0) for i in ("a", "b", "c")])
    D.append_run_records(spark, path, [D.run_record("a", "p", "d", "success", t0, t0 + dt.timedelta(hours=1), row_count=5)])
    now = t0 + dt.timedelta(hours=30)
    D.append_run_records(spark, path, [D.run_record("d", "p", "d", "running", now)])
    assert D.close_lost_runs(spark, path, now, hours=24) == 2
    assert D.close_lost_runs(spark, path, now, hours=24) == 0
    # a run that reports after it was closed does not change its state
    D.append_run_records(spark, path, [D.run_record("b", "p", "d", "success", t0, now + dt.timedelta(hours=1))])
    got = {r["run_id"]: (r["status"], r["row_count"], r["error"]) for r in D.read_manifest(spark, path).collect()}
    lost = ("failed", None, "RunLost: no end within 24 h")
    assert got == {"a": ("success", 5, None), "b": lost, "c": lost, "d": ("running", None, None)}
    assert D.read_run_log(spark, path).count() == 8


def test_chunk_types_fold_to_the_least_common_one():
    from pyspark.sql import types as T

    from tallgrass.operators.dataops import common_schema, common_type
    cases = [(T.IntegerType(), T.LongType(), T.LongType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()),
             (T.DecimalType(10, 2), T.IntegerType(), T.DecimalType(12, 2)), (T.DecimalType(38, 0), T.DecimalType(10, 9), T.DoubleType()),
             (T.DateType(), T.TimestampType(), T.TimestampType()), (T.NullType(), T.DateType(), T.DateType()),
             (T.LongType(), T.StringType(), T.StringType()), (T.BooleanType(), T.LongType(), T.StringType()),
             (T.FloatType(), T.FloatType(), T.FloatType())]
    for a, b, want in cases:
        assert common_type(a, b) == common_type(b, a) == want
    schemas = [T.StructType([T.StructField("a", T.NullType())]), T.StructType([T.StructField("b", T.LongType())])]
    assert [(f.name, f.dataType) for f in common_schema(schemas)] == [("a", T.StringType()), ("b", T.LongType())]


def test_failing_casts_are_named_in_their_rows(spark):
    from tallgrass.operators.dataops import merge_chunks
    first = spark.createDataFrame([(1, "x")], "a long, b string")
    later = spark.createDataFrame([("2", 7), ("two", 8), (None, 9)], "a string, extra int")
    got = sorted(((r["a"], r["b"], list(r["faults"])) for r in merge_chunks([first, later]).collect()), key=repr)
    assert got == sorted([(1, "x", []), (2, None, []), (None, None, ["a"]), (None, None, [])], key=repr)
    assert {r["a"] for r in merge_chunks([first, later], first_decides=False).collect()} == {"1", "2", "two", None}


def test_chunks_conform_to_first_schema(spark):
    first = spark.createDataFrame([(1, "a")], "AREAID bigint, COUNTY_NAME string")
    later = spark.createDataFrame([(2, "b")], "AREAID int, COUNTY_NAME string")
    both = first.unionByName(conform(later, first.schema))
    assert both.schema == first.schema and both.count() == 2


def test_run_record_clips_error_and_rejects_unknown_status():
    t0 = dt.datetime(2024, 1, 1)
    r = run_record("r", "p", "d", "failed", t0, t0 + dt.timedelta(seconds=1.2345), error="x" * 5000)
    assert len(r["error"]) == 4000
    assert r["duration_seconds"] in (1.234, 1.235)
    with pytest.raises(ValueError):
        run_record("r", "p", "d", "weird", t0)


def test_no_change_run_records_published_row_count(spark, scratch):
    wh = Warehouse(spark, scratch)
    assert record_no_change(wh, "t")["row_count"] is None          # never published: unknown
    publish_cycle(wh, frame(spark, 42), "t", QualityConfig())
    rec = record_no_change(wh, "t")
    assert rec["status"] == "success_no_change" and rec["row_count"] == 42
    assert sorted(r["status"] for r in wh.manifest().collect()) == ["success", "success_no_change", "success_no_change"]


def test_run_marts_by_group(spark, src, cfg, scratch):
    from tallgrass.plans import MARTS, datasets_in_group, group_for, run_marts
    assert group_for("fact_jobs") == "monthly" and len(datasets_in_group("monthly")) == len(MARTS)
    assert datasets_in_group("yearly") == []
    wh = Warehouse(spark, scratch)
    out = run_marts(wh, src, cfg, names=["dim_area", "dim_company"], quality=QualityConfig())
    assert {r["dataset"]: r["status"] for r in out.collect()} == {"dim_area": "success", "dim_company": "success"}
    # the source's own gate pins dim_area at 78 rows: the small data fails it, the batch says so
    with pytest.raises(RuntimeError, match="dim_area"):
        run_marts(wh, src, cfg, names=["dim_area"])
