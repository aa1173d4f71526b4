"""Incremental landing: process only source files not seen before (L1).

The source job keeps a file cache and skips files it already holds (J18).
The Structured Streaming form of that is a file-source stream with a
checkpoint: each run (``trigger(availableNow=True)``) picks up exactly the
files that arrived since the last run, lands them once (the file sink is
exactly-once through its commit log), and stops.  A run with nothing new
lands nothing.  The checkpoint must live in the shared folder so a run can
resume on any driver after a failure.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener


class _Counts(StreamingQueryListener):
    """Rows per batch of every run (the query itself keeps its last 100 updates only)."""

    def __init__(self) -> None:
        self.rows: dict[str, dict[int, int]] = defaultdict(dict)
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            self.rows[str(p.runId)][p.batchId] = p.numInputRows

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def wait(self, query_id: str, run_id: str, seconds: int = 60) -> None:
        """Events come in order, so after the run's end all its batches are counted."""
        if not self.ended[run_id].wait(seconds):
            raise RuntimeError(f"no end event of streaming query {query_id}")


@dataclass
class LandingRun:
    rows: int
    batches: int


def incremental_landing(spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str,
                        checkpoint_dir: str, source_format: str = "parquet",
                        max_files_per_trigger: int | None = None, transform=None) -> LandingRun:
    """Land every not-yet-seen file of ``source_dir`` into ``target_dir``."""
    reader = spark.readStream.format(source_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream: DataFrame = reader.load(source_dir)
    if transform is not None:
        stream = transform(stream)
    counts = _Counts()
    spark.streams.addListener(counts)
    query = (stream.writeStream.format("parquet")
             .option("path", target_dir)
             .option("checkpointLocation", checkpoint_dir)
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    try:
        query.awaitTermination()
        counts.wait(str(query.id), str(query.runId))
    finally:
        spark.streams.removeListener(counts)
    rows = counts.rows[str(query.runId)]
    return LandingRun(rows=sum(rows.values()), batches=sum(1 for n in rows.values() if n))


def landed(spark: SparkSession, target_dir: str, schema: T.StructType) -> DataFrame:
    """What the landing target holds (read through the sink's commit log)."""
    return spark.read.schema(schema).parquet(target_dir)
