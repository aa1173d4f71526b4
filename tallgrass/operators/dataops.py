"""Data operations: measure, quality report, run manifest views, freshness.

All of it is DataFrame work over small, bounded inputs (one measurement
row per dataset, one manifest row per dataset per run), except the
measurement itself, which is one aggregation pass over the staged table
(or rides on the staging write through ``DataFrame.observe``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# manifest schema (one row per dataset per run)
# ---------------------------------------------------------------------------
MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("pipeline", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("group_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("max_year", T.LongType()),
    T.StructField("source_query_id", T.StringType()),
    T.StructField("source_uri", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("git_sha", T.StringType()),
    T.StructField("env", T.StringType()),
    T.StructField("error", T.StringType()),
])

STATUSES = ("running", "success", "success_no_change", "success_limited", "failed")
ERROR_LIMIT = 4000


def run_record(run_id: str, pipeline: str, dataset: str, status: str, started_at: _dt.datetime,
               finished_at: _dt.datetime | None = None, group_name: str | None = None,
               row_count: int | None = None, max_year: int | None = None, source_uri: str | None = None,
               error: str | None = None, git_sha: str | None = None, env: str | None = None,
               source_query_id: str | None = None, bytes_: int | None = None) -> dict:
    """One manifest row (K10): duration to the millisecond, error clipped."""
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    duration = None
    if finished_at is not None:
        duration = round((finished_at - started_at).total_seconds(), 3)
    return {
        "run_id": run_id, "pipeline": pipeline, "dataset": dataset, "group_name": group_name,
        "status": status, "row_count": row_count, "bytes": bytes_, "max_year": max_year,
        "source_query_id": source_query_id, "source_uri": source_uri, "started_at": started_at,
        "finished_at": finished_at, "duration_seconds": duration, "git_sha": git_sha, "env": env,
        "error": error[:ERROR_LIMIT] if error else error,
    }


def append_run_records(spark: SparkSession, path: str, records: Sequence[dict]) -> None:
    """Append records to the run log (partitioned by start day).

    A run appends a ``running`` record when it begins and one of its end; the log is never
    rewritten, ``run_states`` folds it."""
    by_day: dict[_dt.date, list[tuple]] = {}
    for r in records:
        by_day.setdefault(r["started_at"].date(), []).append(tuple(r[f.name] for f in MANIFEST_SCHEMA.fields))
    for day, rows in by_day.items():
        # a folder of its own: writers at the same time share no temporary files
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.parquet(
            f"{path}/run_date={day.isoformat()}/append={uuid.uuid4().hex}")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """All appended records."""
    from tallgrass.sources.fs import exists
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.parquet(path).select(*[f.name for f in MANIFEST_SCHEMA.fields])


def run_states(log: DataFrame) -> DataFrame:
    """The latest state of each run of a dataset: its end if there is one, else ``running``.

    Of several ends the first counts, so a run that was closed as lost and reports after all
    does not change what others have seen."""
    keys = ["run_id", "pipeline", "dataset"]
    rest = [c for c in log.columns if c not in keys]
    last = F.min_by(F.struct(*rest), F.struct((F.col("status") == "running").alias("open"), F.col("finished_at")))
    return log.groupBy(*keys).agg(last.alias("__s")).select(
        *[F.col(c) if c in keys else F.col(f"__s.{c}").alias(c) for c in log.columns])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per run of a dataset."""
    return run_states(read_run_log(spark, path))


def lost_runs(runs: DataFrame, as_of: _dt.datetime, hours: int) -> DataFrame:
    """Ends for runs still ``running`` more than ``hours`` after their start: their driver died."""
    gone = runs.filter((F.col("status") == "running") & (F.col("started_at") < F.lit(as_of - _dt.timedelta(hours=hours))))
    now = F.lit(as_of).cast("timestamp_ntz")
    seconds = F.timestamp_diff("MILLISECOND", "started_at", now) / 1000
    changed = {"status": F.lit("failed"), "finished_at": now, "duration_seconds": seconds.cast("double"),
               "error": F.lit(f"RunLost: no end within {hours} h")}
    return gone.select(*[changed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA.fields])


def close_lost_runs(spark: SparkSession, path: str, as_of: _dt.datetime, hours: int = 24) -> int:
    """Append the ends of lost runs to the log; how many there were."""
    rows = lost_runs(read_manifest(spark, path), as_of, hours).collect()   # runs in flight: a handful
    if rows:
        append_run_records(spark, path, [r.asDict() for r in rows])
    return len(rows)


# ---------------------------------------------------------------------------
# manifest views
# ---------------------------------------------------------------------------
def _latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order`` (descending), as a partial aggregation."""
    cols = [c for c in df.columns if c not in keys]
    pick = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*keys).agg(pick.alias("__p")).select(*keys, *[F.col(f"__p.{c}").alias(c) for c in cols])


def previous_successful(runs: DataFrame, keys: Sequence[str] = ("pipeline", "dataset")) -> DataFrame:
    """Baseline per dataset: latest ``success`` with a row count.

    Failed, limited and no-change runs never become a baseline; ties on
    ``finished_at`` go to the larger run id.
    """
    ok = runs.filter((F.col("status") == "success") & F.col("row_count").isNotNull())
    return _latest(ok, keys, ["finished_at", "run_id"])


def rollback_targets(runs: DataFrame, run_id: str | None = None, key: str = "dataset",
                     artifact_prefix: str | None = None) -> DataFrame:
    """Run to restore per dataset.

    With ``run_id``: that successful run.  Otherwise the second newest
    success with an artifact, or the only one if there is just one, so
    repeating a rollback restores the same run.
    """
    ok = runs.filter((F.col("status") == "success") & F.col("source_uri").isNotNull())
    if artifact_prefix:
        ok = ok.filter(F.col("source_uri").startswith(artifact_prefix))
    if run_id is not None:
        return ok.filter(F.col("run_id") == run_id)
    newest = _latest(ok, [key], ["finished_at", "run_id"])
    rest = ok.join(newest.select(key, F.col("run_id").alias("__newest")), on=key, how="inner") \
             .filter(F.col("run_id") != F.col("__newest")).drop("__newest")
    second = _latest(rest, [key], ["finished_at", "run_id"])
    only = newest.join(second.select(key), on=key, how="left_anti")
    return second.unionByName(only)


def manifest_recent(runs: DataFrame) -> DataFrame:
    """Every run, newest first, duration rounded to 0.1 s."""
    return runs.select(
        "started_at", "finished_at", "pipeline", "dataset", "group_name", "status", "row_count", "max_year",
        F.round("duration_seconds", 1).alias("duration_seconds"), "bytes", "source_query_id", "source_uri",
        "git_sha", "env", "run_id", "error",
    ).orderBy(F.col("started_at").desc(), F.col("run_id").desc())


def manifest_last_day(runs: DataFrame, as_of: _dt.datetime, hours: int = 24, limit: int = 50) -> DataFrame:
    """Runs started in the last ``hours`` before ``as_of``, newest ``limit``,
    error clipped to 60 characters (F5).  The limit is the feature here."""
    since = as_of - _dt.timedelta(hours=hours)
    recent = runs.filter(F.col("started_at") > F.lit(since))
    return (recent.select("started_at", "pipeline", "dataset", "status", "row_count",
                          F.round("duration_seconds", 1).alias("secs"),
                          F.left("error", F.lit(60)).alias("error"), "run_id")
                  .orderBy(F.col("started_at").desc(), F.col("run_id").desc())
                  .limit(limit))


def _whole_units(unit: str, start: Column, end) -> Column:
    return F.timestamp_diff(unit, start, F.lit(end))


def dataset_freshness(runs: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Latest success (or no-change) per dataset and its age in days.

    The last row count, max year and commit are the newest row's values,
    NULL included (a no-change run records no count; trap T14).
    """
    ok = runs.filter(F.col("status").isin("success", "success_no_change"))
    return ok.groupBy("pipeline", "dataset").agg(
        F.max("group_name").alias("schedule_group"),
        F.max("finished_at").alias("last_success_at"),
        _whole_units("DAY", F.max("finished_at"), as_of).alias("days_since_success"),
        F.max_by("row_count", F.struct("finished_at", "run_id")).alias("last_row_count"),
        F.max_by("max_year", F.struct("finished_at", "run_id")).alias("last_max_year"),
        F.max_by("git_sha", F.struct("finished_at", "run_id")).alias("last_git_sha"),
    )


# Schedule interval plus grace, in hours, per (pipeline, group).
FRESHNESS_THRESHOLDS = [
    ("labour_market", "monthly", 792),
    ("labour_market", "quarterly", 2304),
    ("labour_market", "yearly", 8952),
    ("enrollment", "monthly", 816),
]


def thresholds_frame(spark: SparkSession, rows=FRESHNESS_THRESHOLDS) -> DataFrame:
    return spark.createDataFrame(rows, "pipeline string, group_name string, max_age_hours bigint")


def stale_datasets(runs: DataFrame, thresholds: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Datasets whose last success is older than their group's limit.

    A dataset that never succeeded has no row here (it is invisible to the
    gate, as in the source).
    """
    latest = (runs.filter(F.col("status").isin("success", "success_no_change"))
                  .groupBy("pipeline", "dataset", "group_name")
                  .agg(F.max("finished_at").alias("last_success_at")))
    j = latest.join(F.broadcast(thresholds), on=["pipeline", "group_name"], how="inner")  # a fixed 4-row table
    j = j.withColumn("age_hours", _whole_units("HOUR", F.col("last_success_at"), as_of))
    return j.filter(F.col("age_hours") > F.col("max_age_hours")).select(
        "pipeline", "dataset", "group_name", "age_hours", "max_age_hours")


def freshness_message(stale: DataFrame, top: int = 20) -> DataFrame:
    """One row: the failure message, or NULL when nothing is stale.

    The 20 oldest are listed (ties broken by name, so the text is stable);
    the count covers all of them.
    """
    n = stale.select(F.count(F.lit(1))).scalar()
    oldest = stale.orderBy(F.col("age_hours").desc(), "pipeline", "dataset", "group_name").limit(top)
    item = F.format_string("%s/%s, %s: %d hours of %d", "pipeline", "dataset", "group_name", "age_hours", "max_age_hours")
    listed = oldest.withColumn("__item", item).agg(F.expr(
        "listagg(__item, ' | ') WITHIN GROUP (ORDER BY age_hours DESC, pipeline, dataset, group_name)")
        .alias("__items"))
    return listed.select(F.when(n > 0, F.format_string(
        "STALE: %d past their limit, the oldest: %s", n, F.col("__items"))).alias("message"))


class FreshnessError(RuntimeError):
    pass


def raise_if_stale(message: DataFrame) -> None:
    """Fail the job when the message is set (H29): ``raise_error`` evaluated
    by Spark on the single message row."""
    checked = message.select(F.when(F.col("message").isNotNull(), F.raise_error(F.col("message")))
                             .alias("ok"))
    try:
        checked.collect()
    except Exception as e:  # noqa: BLE001 - surface Spark's error as ours
        raise FreshnessError(str(e).split("\n")[0]) from e


# ---------------------------------------------------------------------------
# measurement and quality checks
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class QualityConfig:
    row_count_drift_pct: float = 20.0
    known_row_counts: dict[str, int] = field(default_factory=dict)
    not_null: dict[str, list[str]] = field(default_factory=dict)
    # column whose maximum is recorded as max_year (the source looks only
    # for a column named YEAR; trap T12)
    period_columns: dict[str, str] = field(default_factory=dict)


def _period_col(df: DataFrame, dataset: str, cfg: QualityConfig) -> str | None:
    wanted = cfg.period_columns.get(dataset, "YEAR").upper()
    return next((c for c in df.columns if c.upper() == wanted), None)


def measurement_exprs(df: DataFrame, dataset: str, cfg: QualityConfig) -> tuple[list[Column], list[str]]:
    """Aggregate expressions for one-scan measurement, and missing columns."""
    exprs = [F.count(F.lit(1)).alias("row_count")]
    year = _period_col(df, dataset, cfg)
    exprs.append((F.max(F.col(year)).cast("string").try_cast("bigint") if year else F.lit(None).cast("bigint"))
                 .alias("max_year"))
    upper = {c.upper(): c for c in df.columns}
    present = [c for c in cfg.not_null.get(dataset, []) if c.upper() in upper]
    missing = [c for c in cfg.not_null.get(dataset, []) if c.upper() not in upper]
    for c in present:
        exprs.append(F.count_if(F.col(upper[c.upper()]).isNull()).alias(f"null__{c}"))
    return exprs, missing


def measure(df: DataFrame, dataset: str, cfg: QualityConfig) -> DataFrame:
    """Row count, max period and null counts in one aggregation."""
    exprs, _ = measurement_exprs(df, dataset, cfg)
    return df.agg(*exprs).withColumn("dataset", F.lit(dataset))


def quality_report(measurement: DataFrame, dataset: str, cfg: QualityConfig,
                   previous: DataFrame | None = None, allow_empty: bool = False,
                   limited: bool = False) -> DataFrame:
    """Evaluate every configured check; one row per check (K1-K6, K9).

    ``measurement`` is the one-row output of ``measure``; ``previous`` the
    baseline run (``previous_successful``) with ``row_count``/``max_year``.
    A limited run drops count-based checks and keeps not-null.
    """
    m = measurement
    if previous is not None and not limited:
        # the baseline is at most one row per dataset: two scalar subqueries
        prev = previous.filter(F.col("dataset") == dataset)
        m = (m.withColumn("prev_rows", prev.select(F.max(F.col("row_count").cast("bigint"))).scalar())
              .withColumn("prev_year", prev.select(F.max(F.col("max_year").cast("bigint"))).scalar()))
    else:
        m = m.withColumn("prev_rows", F.lit(None).cast("bigint")).withColumn("prev_year", F.lit(None).cast("bigint"))
    rows, year = F.col("row_count"), F.col("max_year")
    prev_rows, prev_year = F.col("prev_rows"), F.col("prev_year")
    limit = float(cfg.row_count_drift_pct)
    moved = F.when(prev_rows == 0, F.lit(0.0)).otherwise(
        F.abs(rows - prev_rows).cast("double") / prev_rows.cast("double") * 100.0)
    checks: list[Column] = []

    def check(name: str, passed: Column, observed: Column, expected: Column, detail: Column, applies: Column = F.lit(True)):
        checks.append(F.when(applies, F.struct(
            F.lit(name).alias("check"), passed.alias("passed"), detail.alias("detail"),
            observed.cast("string").alias("observed"), expected.cast("string").alias("expected"))))

    for column in cfg.not_null.get(dataset, []):
        measured = f"null__{column}" in measurement.columns
        nulls = F.col(f"null__{column}") if measured else F.lit(None).cast("bigint")
        check("not_null", F.coalesce(nulls == 0, F.lit(False)), nulls, F.lit(0),
              F.format_string(f"{column} of {dataset}: %d rows without a value", nulls) if measured
              else F.lit(f"{column} of {dataset}: must have values, but there is no such column"))
    had = prev_rows.isNotNull()
    check("max_year_regressed", year >= prev_year, year, F.format_string("%d or later", prev_year),
          F.format_string(f"{dataset}: newest period %d, before %d", year, prev_year),
          had & year.isNotNull() & prev_year.isNotNull())
    check("row_count_drift", (prev_rows == 0) | (moved <= limit), rows, F.format_string(f"within {limit} %% of %d", prev_rows),
          F.format_string(f"{dataset}: %d rows, before %d, apart by %.1f %%", rows, prev_rows, moved), had)
    known = None if limited else cfg.known_row_counts.get(dataset)
    if known is not None:
        check("known_row_count", rows == known, rows, F.lit(known),
              F.format_string(f"{dataset}: %d rows where {known} are known", rows))
    if not allow_empty:
        check("empty_result", rows > 0, rows, F.lit("1 or more"), F.format_string(f"{dataset}: %d rows", rows))
    exploded = m.select(F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull())).alias("c"))
    return exploded.select(F.lit(dataset).alias("dataset"), "c.*")


class QualityCheckError(RuntimeError):
    pass


def raise_if_failed(report_rows: list, dataset: str) -> None:
    failures = [r for r in report_rows if not r["passed"]]
    if failures:
        raise QualityCheckError(f"{dataset} fails {len(failures)} of {len(report_rows)} checks: "
                                + "; ".join(f"{r['check']} ({r['detail']})" for r in failures))


# ---------------------------------------------------------------------------
# type mapping on publish
# ---------------------------------------------------------------------------
_KEEP = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
         T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType, T.StringType)


def publishable(df: DataFrame) -> DataFrame:
    """Map every column to a type the warehouse accepts.

    Scalars are kept (ints widen to bigint, floats to double); arrays,
    structs and maps become JSON text; anything else becomes a string.
    Every field ends up nullable.
    """
    out = []
    for f in df.schema.fields:
        c, t = F.col(f.name), f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.FloatType):
            c = c.cast("double")
        elif isinstance(t, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        elif not isinstance(t, _KEEP):
            c = c.cast("string")
        # a CASE without ELSE is nullable, whatever its input was
        out.append(F.when(c.isNotNull(), c).alias(f.name))
    return df.select(*out)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both; text where there is no other."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if type(a) in order and type(b) in order:
        return max(a, b, key=lambda t: order.index(type(t)))
    floats = (T.FloatType, T.DoubleType)
    numbers = (*order, *floats, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, floats) or isinstance(b, floats):
            return T.FloatType() if isinstance(a, T.FloatType) and isinstance(b, T.FloatType) else T.DoubleType()
        parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (digits[type(t)], 0) for t in (a, b)]
        whole, scale = max(p[0] for p in parts), max(p[1] for p in parts)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    dates = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, dates) and isinstance(b, dates):
        return max(a, b, key=lambda t: dates.index(type(t)))
    return T.StringType()


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Chunk schemas folded into one: columns by name in order of first sight, each of the
    common type of the chunks that have it."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            kinds[f.name] = common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(n, T.StringType() if isinstance(t, T.NullType) else t) for n, t in kinds.items()])


def conform(df: DataFrame, schema: T.StructType, faults: str | None = None) -> DataFrame:
    """A chunk cast to a schema by name (A8); columns it lacks are NULL, others go.

    With ``faults`` a value that cannot be cast becomes NULL and its column is named in that
    array column of its row; without, the cast fails the job."""
    cols, failed = [], []
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        if df.schema[f.name].dataType == f.dataType:
            cols.append(c.alias(f.name))
        elif faults is None:
            cols.append(c.cast(f.dataType).alias(f.name))
        else:
            cols.append(c.try_cast(f.dataType).alias(f.name))
            failed.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), F.lit(f.name)))
    if faults is not None:
        cols.append((F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")).alias(faults))
    return df.select(*cols)


def merge_chunks(chunks: Sequence[DataFrame], first_decides: bool = True, faults: str = "faults") -> DataFrame:
    """All rows of the chunks in one schema: the first chunk's, or the common one."""
    schema = chunks[0].schema if first_decides else common_schema([c.schema for c in chunks])
    merged = [conform(c, schema, faults) for c in chunks]
    out = merged[0]
    for part in merged[1:]:
        out = out.unionByName(part)
    return out
