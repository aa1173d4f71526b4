"""Staged, validated, atomic publishing of marts.

Layout under a warehouse root (any Hadoop filesystem path)::

    <root>/marts/<table>/run_id=<id>/     one folder per run (the artifact)
    <root>/marts/<table>/_commits/<n>      numbered entries; the highest names the run readers see
    <root>/ops/pipeline_runs/              run log, partitioned by day

A run writes its folder (staging), measures it while writing
(``DataFrame.observe``: row count, max period, null counts ride on the same
scan), checks it, and only then adds an entry, so a failed check leaves
the published table exactly as it was (K8).  Rolling back adds an entry that
names an earlier run's folder (A11, K14).  Entries are put if absent and never
replaced, which needs no rename: publishers of one table at the same time get
numbers of their own, in one order that every reader sees.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallgrass.operators.dataops import (
    ERROR_LIMIT,
    QualityCheckError,
    QualityConfig,
    append_run_records,
    measurement_exprs,
    previous_successful,
    publishable,
    quality_report,
    raise_if_failed,
    read_manifest,
    rollback_targets,
    run_record,
)
from tallgrass.sources.fs import CommitLog, exists


def new_run_id() -> str:
    now = _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%SZ") + "-" + uuid.uuid4().hex[:8]


class ConcurrentPublishError(RuntimeError):
    pass


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    def table_dir(self, table: str) -> str:
        return f"{self.root}/marts/{table}"

    def run_dir(self, table: str, run_id: str) -> str:
        return f"{self.table_dir(table)}/run_id={run_id}"

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/ops/pipeline_runs"

    def manifest(self) -> DataFrame:
        return read_manifest(self.spark, self.manifest_path)

    def commits(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.table_dir(table)}/_commits")

    def history(self, table: str) -> list[dict]:
        """Every entry of a table: number, action (publish or restore) and run id."""
        return [{"number": n, **json.loads(text)} for n, text in self.commits(table).entries()]

    def current_run(self, table: str) -> str | None:
        last = self.commits(table).latest()
        return json.loads(last[1])["run_id"] if last else None

    def read(self, table: str) -> DataFrame:
        run_id = self.current_run(table)
        if run_id is None:
            raise FileNotFoundError(f"{table} has never been published")
        return self.spark.read.parquet(self.run_dir(table, run_id))

    def published_row_count(self, table: str) -> int | None:
        """Rows of the published version (Parquet footers only); None if the
        table was never published."""
        if self.current_run(table) is None:
            return None
        return self.read(table).count()

    def point_to(self, table: str, run_id: str, action: str = "publish", after: int | None = None) -> int:
        """Add an entry; its number.  With ``after`` only behind the entry of that number."""
        if not exists(self.spark, f"{self.run_dir(table, run_id)}/_SUCCESS"):
            raise FileNotFoundError(f"no artifact for {table} run {run_id}")
        number = self.commits(table).append(json.dumps({"action": action, "run_id": run_id}), after)
        if number is None:
            raise ConcurrentPublishError(f"{table} was published by another run after entry {after}")
        return number


@dataclass
class LandResult:
    table: str
    run_id: str
    status: str
    row_count: int
    max_year: int | None
    published: bool
    report: list


def write_observed(df: DataFrame, path: str, table: str, quality: QualityConfig) -> dict:
    """Write ``df`` to ``path`` and measure it on the same scan."""
    exprs, missing = measurement_exprs(df, table, quality)
    obs = Observation(f"measure_{table}_{uuid.uuid4().hex[:6]}")
    publishable(df).observe(obs, *exprs).write.mode("overwrite").parquet(path)
    m = obs.get
    return {"row_count": int(m["row_count"]), "max_year": m.get("max_year"),
            "null_counts": {k[len("null__"):]: int(v) for k, v in m.items() if k.startswith("null__")},
            "missing": missing}


def publish_cycle(wh: Warehouse, df: DataFrame | Callable[[], DataFrame], table: str, quality: QualityConfig, *,
                  pipeline: str = "labour_market", group_name: str | None = None, run_id: str | None = None,
                  allow_empty: bool = False, row_limit: int | None = None, announced: bool = False) -> LandResult:
    """Stage -> measure -> validate -> publish -> record.

    A ``running`` record is appended first, unless a caller has ``announced`` the
    run, and one of the end last.
    """
    spark = wh.spark
    run_id = run_id or new_run_id()
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    limited = row_limit is not None
    if limited and row_limit <= 0:
        raise ValueError("row limit must be positive")
    path = wh.run_dir(table, run_id)
    if not announced:
        _record(wh, run_record(run_id, pipeline, table, "running", started, group_name=group_name))
    status, error, report_rows, m = "failed", None, [], {"row_count": None, "max_year": None}
    try:
        if callable(df):
            df = df()  # a failing build is recorded like any other failure
        if limited:
            df = df.limit(row_limit)
        m = write_observed(df, path, table, quality)
        schema = ", ".join(["dataset string", "row_count bigint", "max_year bigint",
                            *[f"`null__{c}` bigint" for c in m["null_counts"]]])
        measurement = spark.createDataFrame(
            [(table, m["row_count"], m["max_year"], *m["null_counts"].values())], schema)
        previous = None if limited else previous_successful(
            wh.manifest().filter(F.col("pipeline") == pipeline))
        report = quality_report(measurement, table, quality, previous=previous, allow_empty=allow_empty,
                                limited=limited)
        report_rows = [r.asDict() for r in report.collect()]  # a handful of check rows
        raise_if_failed(report_rows, table)
        if not limited:
            wh.point_to(table, run_id)
        status = "success_limited" if limited else "success"
    except Exception as e:  # noqa: BLE001 - recorded, then re-raised
        error = f"{type(e).__name__}: {e}"
        raise
    finally:
        finished = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rec = run_record(run_id, pipeline, table, status, started, finished, group_name=group_name,
                         row_count=m.get("row_count"), max_year=m.get("max_year"),
                         source_uri=path if status == "success" else None, error=error)
        _record(wh, rec)
    return LandResult(table, run_id, status, m["row_count"], m.get("max_year"), not limited, report_rows)


def _record(wh: Warehouse, *records: dict) -> None:
    """Append run records; a failing append is logged and leaves the run's outcome as it is."""
    try:
        append_run_records(wh.spark, wh.manifest_path, records)
    except Exception:  # noqa: BLE001
        logging.getLogger(__name__).exception("run records of %s not appended", ", ".join(r["dataset"] for r in records))


def record_no_change(wh: Warehouse, table: str, *, pipeline: str = "enrollment",
                     group_name: str | None = None, run_id: str | None = None) -> dict:
    """A run that found nothing new: one ``success_no_change`` record carrying
    the row count of what stays published (K19; NULL when unknown)."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rec = run_record(run_id or new_run_id(), pipeline, table, "success_no_change", now, now,
                     group_name=group_name, row_count=wh.published_row_count(table))
    _record(wh, rec)
    return rec


def run_batch(wh: Warehouse, builders: dict, quality: QualityConfig, *, pipeline: str = "labour_market",
              row_limit: int | None = None, raise_at_end: bool = True, parallelism: int = 4,
              groups: dict[str, str] | None = None, derived: dict[str, tuple[str, Callable]] | None = None) -> DataFrame:
    """Build and publish many marts; one outcome row each.

    Datasets run as concurrent Spark jobs (``parallelism`` at a time, like
    the source's four parallel tasks); each writes only its own run folder
    and pointer, and its run record is appended when it ends, whether it
    fails while building, writing or in a check.  ``groups`` names the schedule
    group of each dataset, which the freshness gate reads.  ``derived`` names
    datasets that come from another one's rows, ``(dataset, function)``: they
    start last and read what that one has written, so its work is not done
    twice; if it failed, or the batch is limited, their own builders run.
    A failing dataset does not stop the others; the batch fails at the end
    naming every failure.
    """
    from concurrent.futures import ThreadPoolExecutor

    derived = {n: d for n, d in (derived or {}).items()
               if row_limit is None and d[0] in builders and d[0] not in derived}
    begun = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    ids = {name: new_run_id() for name in builders}
    _record(wh, *[run_record(ids[name], pipeline, name, "running", begun, group_name=(groups or {}).get(name))
                  for name in builders])

    def one(name):
        build = builders[name]
        if name in derived:
            base, make = derived[name]
            if futures[base].result()[1] == "success":
                path = wh.run_dir(base, ids[base])
                build = lambda: make(wh.spark.read.parquet(path))
        try:
            r = publish_cycle(wh, build, name, quality, pipeline=pipeline, row_limit=row_limit, run_id=ids[name],
                              group_name=(groups or {}).get(name), announced=True)
            return (name, r.status, r.row_count, None)
        except Exception as e:  # noqa: BLE001
            return (name, "failed", None, f"{type(e).__name__}: {str(e)[:ERROR_LIMIT]}")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = {}
        for name in sorted(builders, key=lambda n: n in derived):   # bases are before what waits for them
            futures[name] = pool.submit(one, name)
        outcomes = [futures[name].result() for name in builders]
    result = wh.spark.createDataFrame(outcomes, "dataset string, status string, row_count bigint, error string")
    failed = [o[0] for o in outcomes if o[1] == "failed"]
    if failed and raise_at_end:
        raise RuntimeError(f"{len(failed)} dataset(s) failed: {', '.join(failed)}")
    return result


def rollback(wh: Warehouse, table: str, run_id: str | None = None) -> str:
    """Point ``table`` at an earlier successful run's artifact.

    Without ``run_id`` the second newest successful run is chosen (the only
    one if there is just one).  No quality gate and no manifest row, as in
    the source.
    """
    targets = rollback_targets(wh.manifest().filter(F.col("dataset") == table), run_id=run_id)
    rows = targets.select("run_id").collect()  # at most one row per dataset
    if not rows:
        raise LookupError(f"no successful run with an artifact found for {table}")
    chosen = rows[0]["run_id"]
    wh.point_to(table, chosen, "restore")
    return chosen


__all__ = ["Warehouse", "LandResult", "publish_cycle", "run_batch", "rollback", "write_observed", "record_no_change",
           "QualityCheckError", "ConcurrentPublishError", "new_run_id"]
