"""Session construction and the shared scratch location.

Everything that must survive an executor loss (materialised source tables,
staged marts, published versions) lives under ``spark.checkpoint.dir``, the
shared folder the cluster names.  A session that has none (local tests) gets
a fresh folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session defaults chosen for correctness parity and large-scale runs.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # partitions sized for a task's memory: AQE coalesces small shuffle partitions
    # toward this many compressed bytes, and rows of numbers take 10 times as much
    # in a sort; skewed ones are split (5x median)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "256m",
    # a filtered join side sends a Bloom filter of its keys (8 MB at most) into
    # the scan of the other side, before that is shuffled
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "2g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallgrass") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TALLGRASS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_settings(spark)
    return spark


def apply_session_settings(spark: SparkSession) -> None:
    """Runtime SQL settings the library relies on (safe on an existing session)."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
                "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                "spark.sql.optimizer.runtime.bloomFilter.enabled",
                "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"):
        spark.conf.set(key, SESSION_DEFAULTS[key])


PARTITION_INPUT_BYTES = 8 * 1024 * 1024   # compressed input for which a shuffle gets a partition


def size_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles begin with partitions in proportion to the input; AQE merges small ones.

    A fixed number makes each partition grow with the input, until its sort does not fit a
    task.  Never less than the session has."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = -(-input_bytes // PARTITION_INPUT_BYTES)
    if wanted > max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(key, None) or 0)):
        spark.conf.set(key, str(wanted))


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's checkpoint dir.

    Read from the session; set our own only when it is unset on a local master
    (tests).  ``local-cluster`` executors share the machine's folders too.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tallgrass-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")
