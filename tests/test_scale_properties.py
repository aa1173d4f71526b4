"""Plan properties that matter at scale, checked on small frames.

A key may hold a third of all rows: "first row per key" and shares of raw
rows must not put a whole group in one window partition, and a broadcast
must only happen behind a size check.
"""

from pyspark.sql import functions as F

from tallgrass.operators import relational as O


def hot(spark, n=3000):
    # one key holds a third of the rows
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                 (F.col("id") % 7).alias("v"), F.col("id").alias("id"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefer_source_is_a_partial_aggregation_not_a_window(spark):
    df = hot(spark)
    out = O.prefer_source(df, ["k"], [F.col("v"), F.col("id")], ["v", "id"])
    p = plan(out)
    assert "Window" not in p and "partial_min_by" in p
    row = out.filter("k = 0").first()
    assert (row["v"], row["id"]) == (0, 0)
    assert out.count() == df.select("k").distinct().count()


def test_share_of_raw_rows_uses_aggregate_and_join(spark):
    df = hot(spark)
    out = O.share_of_group(df, ["k"], "v", "share")
    assert "Window" not in plan(out)
    total = out.filter("k = 0").agg(F.sum("share")).first()[0]
    assert abs(total - 1.0) < 1e-9


def test_share_window_form_only_on_request(spark):
    out = O.share_of_group(hot(spark), ["k"], "v", "share", method="window")
    assert "Window" in plan(out)


def test_broadcast_only_behind_a_size_check(spark):
    small = spark.range(10)
    assert O.estimated_bytes(small) < O.BROADCAST_LIMIT_BYTES
    big = spark.range(10)
    j_small = spark.range(1000).join(O.broadcast_if_bounded(small), "id")
    j_refused = spark.range(1000).join(O.broadcast_if_bounded(big, limit=1), "id")
    assert "broadcast" in j_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in j_refused._jdf.queryExecution().analyzed().toString().lower()


def test_flagged_count_null_key_gets_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id long, k string")
    flags = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    got = {r["k"]: (r["n"], r["f"]) for r in O.flagged_count(df, flags, "id", ["k"], "n", "f").collect()}
    assert got == {"a": (1, 1), None: (2, 0)}


def test_hierarchy_walk_reuses_one_broadcast_side(spark):
    d = spark.createDataFrame([("c", "b", 3), ("b", "a", 2), ("a", None, 1)], "id string, parent string, level int")
    out = O.flatten_hierarchy(d, "id", "parent", ["level"], F.col("level") == 3, depth=2)
    row = out.first()
    assert (row["h0_id"], row["h1_id"], row["h2_id"]) == ("c", "b", "a")
    out.collect()
    p = plan(out)
    assert p.count("BroadcastExchange") + p.count("ReusedExchange") >= 2


def test_index_to_baseline_matches_self_join(spark):
    df = spark.createDataFrame([("x", 2015, 10), ("x", 2016, 15), ("y", 2016, 7)], "a string, y int, m long")
    out = O.index_to_baseline(df, ["a"], "m", F.col("y") == 2015, "base", "idx")
    got = sorted((r["a"], r["y"], r["base"], r["idx"]) for r in out.collect())
    assert got == [("x", 2015, 10, 1.0), ("x", 2016, 10, 1.5)]   # y has no base row: dropped


def plain_fanout(pairs, hows):
    first, *rest = (r.select("id", a).distinct() for r, a in pairs)
    for r, how in zip(rest, hows):
        first = first.join(r, "id", how)
    return first.groupBy(*[a for _, a in pairs]).agg(F.count(F.lit(1)).alias("n"))


def test_fanout_splits_a_hot_id_and_keeps_the_counts(spark):
    # id 0 holds a third of the schools; ids 1-9 are small; id 10 has no county, ids 3 and 5 no
    # occupation; null ids and null attributes are there too
    edu = spark.range(600).select(F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 != 1, F.col("id") % 11).alias("id"),
                                  F.when(F.col("id") % 90 != 0, F.col("id") % 97).cast("string").alias("school"))
    cty = spark.range(40).select((F.col("id") % 10).alias("id"), (F.col("id") % 7).cast("string").alias("county"))
    occ = spark.range(300).filter("id % 10 not in (3, 5)").select((F.col("id") % 10).alias("id"),
                                                                  (F.col("id") % 60).cast("string").alias("occ"))
    pairs = [(edu, "school"), (cty, "county"), (occ, "occ")]
    for hows in (["inner", "left"], ["left", "left"], ["inner", "inner"]):
        want = sorted(map(tuple, plain_fanout(pairs, hows).collect()), key=repr)
        for cell in (1, 7, 30, 10 ** 9):
            out = O.entity_fanout_count(pairs, "id", hows, "n", cell=cell)
            assert sorted(map(tuple, out.collect()), key=repr) == want, (hows, cell)
            # the grid is planned only when an id needs it
            assert ("__cell" in plan(out)) == (cell < 10 ** 9)


def test_fanout_grid_counts_products_not_rows(spark):
    # three relations of 60 rows each: no relation is long, their product is
    three = [(spark.range(60).select(F.lit(7).alias("id"), F.col("id").alias(a)), a) for a in "abc"]
    # one long relation of repeated pairs whose product stays small
    dull = [(spark.range(5000).select(F.lit(8).alias("id"), (F.col("id") % 2).alias(a)), a) for a in "abc"]
    pairs = [(x.unionByName(y), a) for (x, a), (y, _) in zip(three, dull)]
    rows = O.fanout_grid(pairs, "id", ["inner", "inner"], cell=1000).collect()
    assert [(r["id"], list(r["__n"]), list(r["__g"])) for r in rows] == [(7, [60, 60, 60], [6, 6, 6])]
    uneven = spark.createDataFrame([([1, 1000, 4],), ([5000, 1, 1],), ([0, 0, 10],)], "n array<bigint>")
    got = [list(r[0]) for r in uneven.select(O._axis_buckets(F.col("n"), 100)).collect()]
    assert got == [[1, 40, 1], [50, 1, 1], [1, 1, 1]]
    # 216,000 joined rows of one id, made in many tasks, and as many as the plain join makes
    out = O.entity_fanout_count(pairs, "id", ["inner", "inner"], "n", cell=1000)
    assert out.agg(F.sum("n")).first()[0] == 60 ** 3 + 2 ** 3


def test_flags_meet_the_ids_before_they_are_shuffled(spark):
    flags = spark.range(1000).select((F.col("id") * 3).alias("id"))
    df = spark.range(50).select("id", (F.col("id") % 3).alias("k"))
    text = plan(O.flagged_count(df, flags, "id", ["k"], "n", "f"))
    # the id list is broadcast and tested in the stage that reads the flags
    assert "LeftSemi" in text
    out = {r["k"]: (r["n"], r["f"]) for r in O.flagged_count(df, flags, "id", ["k"], "n", "f").collect()}
    assert out == {0: (17, 17), 1: (17, 0), 2: (16, 0)}


def test_id_lists_are_broadcast_by_their_number(spark, monkeypatch):
    # an estimate far under the limit in bytes says nothing of the rows
    monkeypatch.setattr(O, "BROADCAST_LIMIT_IDS", 49)
    flags = spark.range(1000).select((F.col("id") * 3).alias("id"))
    df = spark.range(50).select("id", (F.col("id") % 3).alias("k"))
    assert O.estimated_bytes(df) < O.BROADCAST_LIMIT_BYTES
    assert O.reduce_to_ids(flags, "id", df) is flags
    out = {r["k"]: (r["n"], r["f"]) for r in O.flagged_count(df, flags, "id", ["k"], "n", "f").collect()}
    assert out == {0: (17, 17), 1: (17, 0), 2: (16, 0)}


def test_partitions_fit_a_task(spark):
    from tallgrass.session import apply_session_settings
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    apply_session_settings(own)
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_shuffles_begin_with_partitions_by_the_input(spark, monkeypatch):
    from tallgrass import session
    from tallgrass.sources.catalog import catalog
    from tallgrass.sources.fs import folder_bytes
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    folder = "/root/testdata/sf0.001"
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "8")
    catalog(own, folder)
    assert own.conf.get(key, None) is None   # little input: the session's number
    monkeypatch.setattr(session, "PARTITION_INPUT_BYTES", 1000)
    catalog(own, folder)
    n = -(-folder_bytes(own, folder) // 1000)
    assert n > 8 and own.conf.get(key) == str(n)
    text = plan(own.range(100).select((F.col("id") % 7).alias("k")).groupBy("k").count())
    assert "hashpartitioning(k#" in text and f", {n})" in text
    session.size_partitions(own, 1)
    assert own.conf.get(key) == str(n)


def test_distinct_rows_of_ids_shuffle_no_text_by_id(spark):
    # key 3 and the null key stand with several rows, of which some have ids in the list; 5 has none there
    data = [(1, 1, "a"), (2, 1, "a"), (3, 2, None), (4, 3, "x"), (9, 3, "y"), (1, 3, "z"), (2, None, "n"), (8, None, "m"),
            (None, 4, "q"), (9, 5, "r"), (4, 6, "s"), (9, 6, "s"), (4, None, None), (4, 3, None)]
    df = spark.createDataFrame(data, "id long, k long, t string")
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,), (None,), (77,)], "id long")
    for rows in (df, df.filter("k <> 3")):
        plain = rows.join(ids, "id", "left_semi").select("t", "k").distinct()
        got = O.distinct_of_ids(rows, ["t", "k"], "k", "id", ids)
        assert got.dtypes == plain.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    # without such keys only (id, key) meets the ids
    clear = O.distinct_of_ids(df.filter("k not in (3)"), ["t", "k"], "k", "id", ids)
    semi = [line for line in plan(clear).splitlines() if "Exchange hashpartitioning(id" in line]
    assert "LeftSemi" in plan(clear) and not any("t#" in line for line in semi)


def test_long_id_lists_reach_the_flags_as_a_bloom_filter(spark, scratch, monkeypatch):
    monkeypatch.setattr(O, "BROADCAST_LIMIT_BYTES", 0)
    spark.range(100_000).select("id", (F.col("id") % 50).alias("county")).write.parquet(f"{scratch}/jobs")
    spark.range(300_000).select(F.col("id")).write.parquet(f"{scratch}/flags")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        jobs = spark.read.parquet(f"{scratch}/jobs").filter("county = 7")
        out = O.flagged_count(jobs, spark.read.parquet(f"{scratch}/flags"), "id", ["county"], "n", "f")
        text = out._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in text.lower()
        assert [tuple(r) for r in out.collect()] == [(7, 2000, 2000)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_scorecard_reads_the_labour_force_once(spark, src, cfg):
    from tallgrass.plans.regional import _labour_force, fact_regional_indicators
    for out in (_labour_force(src, cfg), fact_regional_indicators(src, cfg)):
        out.collect()
        assert len([x for x in plan(out).split("== Initial Plan ==")[0].splitlines()
                    if "FileScan" in x and "lfp_denom" in x]) == 1


def test_link_discovery_stays_inside_the_page_row(spark):
    from tallgrass.operators import reshape as R

    from .conftest import SF_SMALL
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for out in (R.page_anchors(pages), R.discover_links(pages), R.link_warnings(pages)):
        text = plan(out)
        for node in ("Exchange", "Sort", "Window", "Join"):
            assert node not in text, node
        assert text.count("FileScan parquet") == 1
