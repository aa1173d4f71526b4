"""Query keys for the data-operations layer.

Manifest views read the run-manifest role table (derived from ``events``);
the publish-side keys run a real stage/validate/publish cycle into a fresh
warehouse folder under the shared checkpoint dir and return what a reader
of the published table (or the run record) sees.
"""

from __future__ import annotations

import contextlib
import dataclasses
import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.config import MartConfig
from tallgrass.operators import dataops
from tallgrass.plans import MARTS, batch
from tallgrass.session import scratch_root
from tallgrass.sources import reference_csv
from tallgrass.sources.sinks import Warehouse, publish_cycle, record_no_change, rollback, run_batch

# What the published fact_jobs must satisfy (its keys that are never NULL).
JOBS_QUALITY = dataops.QualityConfig(
    not_null={"fact_jobs": ["AREAID", "OCCID"]},
    period_columns={"fact_jobs": "YEAR_POSTED"},
)
# A stricter check set for the report key: INDID and MIN_EDULEVELS do hold
# NULLs (unmapped industries, postings without an education level), so the
# report shows failing rows next to passing ones.
REPORT_QUALITY = dataops.QualityConfig(
    not_null={"fact_jobs": ["AREAID", "OCCID", "INDID", "MIN_EDULEVELS", "SKILL_ID"]},
    known_row_counts={"fact_jobs": 12345},
    period_columns={"fact_jobs": "YEAR_POSTED"},
)


def _warehouse(src) -> Warehouse:
    return Warehouse(src.spark, f"{scratch_root(src.spark)}/tallgrass_warehouse/{uuid.uuid4().hex}")


def q_previous_successful(src, cfg: MartConfig) -> DataFrame:
    return dataops.previous_successful(src.runs)


def q_rollback(src, cfg: MartConfig) -> DataFrame:
    return dataops.rollback_targets(src.runs)


def q_dataset_freshness(src, cfg: MartConfig) -> DataFrame:
    return dataops.dataset_freshness(src.runs, cfg.ops_as_of)


def q_freshness_check(src, cfg: MartConfig) -> DataFrame:
    return dataops.stale_datasets(src.runs, dataops.thresholds_frame(src.spark), cfg.ops_as_of)


def q_freshness_message(src, cfg: MartConfig) -> DataFrame:
    return dataops.freshness_message(q_freshness_check(src, cfg))


def q_manifest_recent(src, cfg: MartConfig) -> DataFrame:
    return dataops.manifest_recent(src.runs)


def q_manifest_last_day(src, cfg: MartConfig) -> DataFrame:
    return dataops.manifest_last_day(src.runs, cfg.recent_as_of or cfg.ops_as_of)


def q_measure_staging(src, cfg: MartConfig) -> DataFrame:
    return dataops.measure(MARTS["fact_jobs"](src, cfg), "fact_jobs", REPORT_QUALITY)


def q_quality_report(src, cfg: MartConfig) -> DataFrame:
    """fact_jobs measured and checked against the newest baseline in the log."""
    m = dataops.measure(MARTS["fact_jobs"](src, cfg), "fact_jobs", REPORT_QUALITY)
    baseline = dataops.previous_successful(src.runs, keys=("dataset",)).filter(F.col("dataset") == "d0")
    baseline = baseline.withColumn("dataset", F.lit("fact_jobs"))
    return dataops.quality_report(m, "fact_jobs", REPORT_QUALITY, previous=baseline)


def q_publish_cycle(src, cfg: MartConfig) -> DataFrame:
    wh = _warehouse(src)
    publish_cycle(wh, MARTS["fact_jobs"](src, cfg), "fact_jobs", JOBS_QUALITY)
    return wh.read("fact_jobs")


LIMIT_ROWS = 100


def q_limited_run(src, cfg: MartConfig) -> DataFrame:
    wh = _warehouse(src)
    r = publish_cycle(wh, MARTS["fact_jobs"](src, cfg), "fact_jobs", JOBS_QUALITY, row_limit=LIMIT_ROWS)
    return src.spark.createDataFrame([("fact_jobs", r.status, r.published, r.row_count)],
                                     "DATASET string, STATUS string, PUBLISHED boolean, ROW_COUNT bigint")


def q_run_batch(src, cfg: MartConfig) -> DataFrame:
    wh = _warehouse(src)
    builders, derived = batch(src, cfg)
    return run_batch(wh, builders, dataops.QualityConfig(), derived=derived)


def q_schema_normalize(src, cfg: MartConfig) -> DataFrame:
    """Narrow and nested columns mapped to what the warehouse takes."""
    e = src.raw("embeddings").join(src.raw("labels").withColumnRenamed("doc_id", "vec_id"), "vec_id", "left")
    steps = F.transform("embedding", lambda x: F.floor(x * 1000).cast("int"))
    return dataops.publishable(e.select(
        "vec_id", F.col("label").cast("short").alias("label"), steps.alias("steps"),
        F.struct("quality", "toxic").alias("marks"), F.element_at("embedding", 1).alias("first"),
        (F.col("label") > 4).alias("high")))


def q_load_reference(src, cfg: MartConfig) -> DataFrame:
    """Write a code-like lookup CSV derived from ``part`` and load it back
    with its pinned schema (codes such as '44.0400' stay text)."""
    path = f"{scratch_root(src.spark)}/tallgrass_reference/{uuid.uuid4().hex}/dim_soc2cip"
    src.raw("part").createOrReplaceTempView("part")
    src.spark.sql(reference_csv.SOC2CIP_FROM_PART).write.option("header", True).csv(path)
    return reference_csv.load_reference(src.spark, path, json.dumps(reference_csv.SOC2CIP_SCHEMA))


def q_snapshot_pages(src, cfg: MartConfig) -> DataFrame:
    from tallgrass.plans.enrollment import snapshot_pages
    root = f"{scratch_root(src.spark)}/tallgrass_raw/{uuid.uuid4().hex}"
    return snapshot_pages(src.raw("pages"), root, run_id="snapshot")


def q_run_log(src, cfg: MartConfig) -> DataFrame:
    """What the run log tells of runs that ended well, failed outside the gate, found nothing
    new, or never ended: read back from appended records (A12, K10, K13, K19)."""
    wh = _warehouse(src)
    publish_cycle(wh, lambda: MARTS["dim_area"](src, cfg), "dim_area", dataops.QualityConfig(), group_name="monthly")
    record_no_change(wh, "dim_area", pipeline="labour_market", group_name="monthly")
    with contextlib.suppress(KeyError):   # the build fails before anything is staged
        publish_cycle(wh, lambda: MARTS["no_such_mart"](src, cfg), "no_such_mart", dataops.QualityConfig())
    started = dt.datetime(2024, 1, 1)
    dataops.append_run_records(src.spark, wh.manifest_path, [
        dataops.run_record("lost", "labour_market", "dim_occ", "running", started),
        dataops.run_record("young", "labour_market", "dim_ind", "running", started + dt.timedelta(hours=30))])
    dataops.close_lost_runs(src.spark, wh.manifest_path, started + dt.timedelta(hours=36), hours=24)
    log = dataops.read_run_log(src.spark, wh.manifest_path)
    records = log.groupBy("run_id").agg(F.count("*").alias("records"))
    return wh.manifest().join(records, "run_id").select(
        "dataset", "status", "group_name", "row_count", F.substring_index("error", ":", 1).alias("error"), "records",
        (F.col("duration_seconds") >= 0).alias("timed"))


def q_publish_history(src, cfg: MartConfig) -> DataFrame:
    """Publish, publish again, restore, then two publishers at once (A10, A11, K14): the numbered
    entries of the table, with the rows a reader found after the first three and at the end."""
    wh, none = _warehouse(src), dataops.QualityConfig(row_count_drift_pct=1000.0)
    builds = [MARTS["dim_area"](src, cfg), src.ref_area.select(F.col("areaid").alias("AREAID"))]
    seen = []
    for df in builds:
        publish_cycle(wh, df, "area", none)
        seen.append(wh.read("area").count())
    rollback(wh, "area")
    seen.append(wh.read("area").count())
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda df: publish_cycle(wh, df, "area", none), [builds[1], builds[1]]))
    seen += [wh.read("area").count()] * 2
    # an entry behind one that has been followed is refused
    refused = wh.commits("area").append("{}", after=1) is None
    return src.spark.createDataFrame(
        [(h["number"], h["action"], n, refused) for h, n in zip(wh.history("area"), seen, strict=True)],
        "ENTRY bigint, ACTION string, READ_ROWS bigint, LATE_REFUSED boolean")


def q_empty_publish(src, cfg: MartConfig) -> DataFrame:
    """A mart without rows is published as typed, empty Parquet (A7): its columns as read back."""
    wh = _warehouse(src)
    nowhere = dataclasses.replace(cfg, state="99")
    r = publish_cycle(wh, MARTS["fact_openings_occ"](src, nowhere), "fact_openings_occ", dataops.QualityConfig(), allow_empty=True)
    back = wh.read("fact_openings_occ")
    return src.spark.createDataFrame([(f.name, f.dataType.simpleString(), r.row_count, back.count()) for f in back.schema],
                                     "COLUMN_NAME string, TYPE string, STAGED_ROWS bigint, READ_ROWS bigint")


def q_stale_gate(src, cfg: MartConfig) -> DataFrame:
    """The job fails from SQL when datasets are stale (H29), and passes when none is."""
    stale = q_freshness_check(src, cfg)
    out = []
    for case, rows in (("as found", stale), ("none stale", stale.limit(0))):
        try:
            dataops.raise_if_stale(dataops.freshness_message(rows))
            out.append((case, False, None))
        except dataops.FreshnessError as e:
            out.append((case, True, "STALE" in str(e)))
    return src.spark.createDataFrame(out, "CASE_NAME string, RAISED boolean, NAMED boolean")


def _chunks(src) -> list[DataFrame]:
    """Three chunks of the orders whose types differ: the last is CSV text, types inferred."""
    o = src.raw("orders")
    part = F.pmod("o_orderkey", F.lit(3))
    path = f"{scratch_root(src.spark)}/tallgrass_chunks/{uuid.uuid4().hex}"
    text = o.filter(part == 2).select(
        F.col("o_orderkey").alias("ID"), F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(
            F.col("o_custkey").cast("string")).alias("PRIORITY"), F.col("o_orderstatus").alias("STATUS"))
    text.write.option("header", True).csv(path)
    return [o.filter(part == 0).select(F.col("o_orderkey").cast("bigint").alias("ID"), F.col("o_custkey").cast("int").alias("PRIORITY"),
                                       F.col("o_orderstatus").alias("STATUS")),
            o.filter(part == 1).select(F.col("o_orderkey").cast("int").alias("ID"),
                                       F.col("o_custkey").cast("double").alias("PRIORITY")),
            reference_csv.load_reference(src.spark, path)]


def q_chunk_agreement(src, cfg: MartConfig) -> DataFrame:
    """Later chunks cast to the first one's schema, failing casts named in their rows."""
    merged = dataops.merge_chunks(_chunks(src))
    return merged.withColumn("faults", F.array_join("faults", ","))


def q_chunk_common_type(src, cfg: MartConfig) -> DataFrame:
    """The same chunks in their common schema: nothing is lost, mixed columns become text."""
    merged = dataops.merge_chunks(_chunks(src), first_decides=False)
    number = F.col("PRIORITY").try_cast("double")
    return merged.select("ID", F.coalesce(number.cast("bigint").cast("string"), "PRIORITY").alias("PRIORITY"), "STATUS",
                         F.size("faults").alias("FAULTS"))


def q_file_inventory(src, cfg: MartConfig) -> DataFrame:
    """Files arrive in two waves and are landed by the stream, contents whole; the inventory's
    versions say what is new, changed, the same or no longer listed (L1, A14, J18, J19)."""
    from tallgrass.sources.inventory import Inventory
    from tallgrass.streaming import incremental_landing, landed
    base = f"{scratch_root(src.spark)}/tallgrass_inventory/{uuid.uuid4().hex}"
    pages = src.raw("pages").select(F.concat(F.lit("page-"), "page_id").alias("file_name"), "page_id",
                                    F.col("html").cast("binary").alias("content"))
    waves = [pages.filter("page_id % 5 != 0").withColumn("arrived_at", F.lit(1)),
             pages.filter("page_id % 5 = 0 or page_id % 7 = 0").withColumn("arrived_at", F.lit(2)).withColumn(
                 "content", F.when(F.col("page_id") % 7 == 0, F.concat("content", F.lit("v2").cast("binary"))).otherwise(F.col("content")))]
    listed = [pages.filter("page_id % 5 != 0"), pages.filter("page_id % 11 != 0")]
    inventory = Inventory(src.spark, f"{base}/inventory")
    out = None
    for wave, (arriving, names) in enumerate(zip(waves, listed), start=1):
        arriving.write.mode("append").parquet(f"{base}/incoming")
        run = incremental_landing(src.spark, f"{base}/incoming", arriving.schema, f"{base}/landed", f"{base}/_checkpoint")
        if run.rows != arriving.count():
            raise RuntimeError(f"wave {wave}: {run.rows} rows landed")
        new = landed(src.spark, f"{base}/landed", arriving.schema).filter(F.col("arrived_at") == wave)
        part = inventory.update(names, new).groupBy("change").agg(F.count("*").alias("files"), F.sum("n_bytes").alias("bytes")) \
            .withColumn("version", F.lit(inventory.version()))
        out = part if out is None else out.unionByName(part)
    stored = inventory.content().agg(F.count("*").alias("files"), F.sum(F.octet_length("content")).alias("bytes"))
    return out.unionByName(stored.withColumn("change", F.lit("stored")).withColumn("version", F.lit(2)))


OPS_QUERIES = {
    "previous_successful": q_previous_successful,
    "rollback": q_rollback,
    "dataset_freshness": q_dataset_freshness,
    "freshness_check": q_freshness_check,
    "freshness_message": q_freshness_message,
    "manifest_recent": q_manifest_recent,
    "manifest_last_day": q_manifest_last_day,
    "measure_staging": q_measure_staging,
    "quality_report": q_quality_report,
    "publish_cycle": q_publish_cycle,
    "limited_run": q_limited_run,
    "run_batch": q_run_batch,
    "schema_normalize": q_schema_normalize,
    "load_reference": q_load_reference,
    "snapshot_pages": q_snapshot_pages,
    "run_log": q_run_log,
    "publish_history": q_publish_history,
    "empty_publish": q_empty_publish,
    "stale_gate": q_stale_gate,
    "chunk_agreement": q_chunk_agreement,
    "chunk_common_type": q_chunk_common_type,
    "file_inventory": q_file_inventory,
}



def q_incremental_landing(src, cfg: MartConfig) -> DataFrame:
    """Pages arrive as files in a landing folder; two landing runs follow.

    The first run lands every file, the second finds nothing new.  The
    result is what the target holds afterwards (each page exactly once).
    """
    from tallgrass.streaming import incremental_landing, landed
    base = f"{scratch_root(src.spark)}/tallgrass_landing/{uuid.uuid4().hex}"
    pages = src.raw("pages").select("page_id", "url", "html")
    pages.write.parquet(f"{base}/incoming")
    schema = pages.schema
    first = incremental_landing(src.spark, f"{base}/incoming", schema, f"{base}/landed", f"{base}/_checkpoint")
    second = incremental_landing(src.spark, f"{base}/incoming", schema, f"{base}/landed", f"{base}/_checkpoint")
    if second.rows != 0 or first.rows != pages.count():
        raise RuntimeError(f"landing not incremental: first {first.rows}, second {second.rows}")
    return landed(src.spark, f"{base}/landed", schema)


OPS_QUERIES["incremental_landing"] = q_incremental_landing
