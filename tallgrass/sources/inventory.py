"""The files a source has handed over: a content-addressed store and a versioned inventory.

    <root>/content/prefix=<xx>/   every content once, under its SHA-256
    <root>/versions/<id>/         one table per version: file_name, sha256, n_bytes, since
    <root>/_versions/<n>          numbered entries; the highest names the present version

A version lists the files held from then on.  ``update`` compares what arrived and what is
still listed with the present version, stores contents that are new, and adds the next
version: files no longer listed are left out (J19), their contents stay for earlier versions.
Two updates at the same time cannot both follow one version: the second fails and can be
run again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.sources.fs import CommitLog, exists

HELD = "file_name string, sha256 string, n_bytes bigint, since bigint"


class ConcurrentUpdateError(RuntimeError):
    pass


class Inventory:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.log = CommitLog(spark, f"{root}/_versions")

    def version(self) -> int:
        last = self.log.latest()
        return last[0] if last else 0

    def held(self, version: int | None = None) -> DataFrame:
        """The files of a version (the present one): file_name, sha256, n_bytes, since (version)."""
        name = self.log.read(version) if version else (self.log.latest() or (0, None))[1]
        if name is None:
            return self.spark.createDataFrame([], HELD)
        return self.spark.read.schema(HELD).parquet(f"{self.root}/versions/{name}")

    def _contents(self) -> DataFrame | None:
        path = f"{self.root}/content"
        return self.spark.read.schema("sha256 string, content binary, prefix string").parquet(path) \
            if exists(self.spark, path) else None

    def content(self, version: int | None = None) -> DataFrame:
        """file_name, sha256 and content of the files of a version."""
        files = self.held(version).select("file_name", "sha256")
        stored = self._contents()
        if stored is None:
            return files.withColumn("content", F.lit(None).cast("binary"))
        return files.join(stored.select("sha256", "content").dropDuplicates(["sha256"]), "sha256").select(
            "file_name", "sha256", "content")

    def update(self, listed: DataFrame, arrived: DataFrame | None = None) -> DataFrame:
        """Add the next version; what changed: file_name, change (new, changed, same, removed),
        sha256, n_bytes.

        ``listed``: file_name of the files the source still names.  ``arrived``: file_name,
        content and optionally arrived_at (of several arrivals of a name the last counts); a
        listed file that never arrived is not held."""
        seen = self.version()
        held = self.held(seen or None)
        if arrived is None:
            arrived = self.spark.createDataFrame([], "file_name string, content binary")
        order = ["arrived_at"] if "arrived_at" in arrived.columns else []
        facts = arrived.select("file_name", *order, F.sha2("content", 256).alias("sha256"),
                               F.octet_length("content").cast("bigint").alias("n_bytes"))
        latest = facts.groupBy("file_name").agg(F.max_by(F.struct("sha256", "n_bytes"), F.struct(*order, "sha256")).alias("a")) \
            .select("file_name", F.col("a.sha256").alias("new_sha"), F.col("a.n_bytes").alias("new_bytes"))
        names = listed.select("file_name").filter(F.col("file_name").isNotNull()).distinct().withColumn("listed", F.lit(True))
        both = names.join(latest, "file_name", "left").join(held, "file_name", "full")
        stays = F.col("listed").isNotNull()
        change = (F.when(~stays, F.lit("removed")).when(F.col("sha256").isNull(), F.when(F.col("new_sha").isNotNull(), "new"))
                  .when(F.coalesce(F.col("new_sha") != F.col("sha256"), F.lit(False)), "changed").otherwise("same"))
        is_new = change.isin("new", "changed")
        name = uuid.uuid4().hex
        path = f"{self.root}/changes/{name}"
        both.filter(change.isNotNull()).select(
            "file_name", change.alias("change"), F.when(is_new, F.col("new_sha")).otherwise(F.col("sha256")).alias("sha256"),
            F.when(is_new, F.col("new_bytes")).otherwise(F.col("n_bytes")).alias("n_bytes"),
            F.when(is_new, F.lit(seen + 1).cast("bigint")).otherwise(F.col("since")).alias("since")).write.parquet(path)
        changes = self.spark.read.parquet(path)
        # contents first: a version names only what is stored
        wanted = changes.filter(F.col("change").isin("new", "changed")).select("sha256").distinct()
        stored = self._contents()
        if stored is not None:
            wanted = wanted.join(stored.select("sha256"), "sha256", "left_anti")
        fresh = arrived.select(F.sha2("content", 256).alias("sha256"), "content").join(wanted, "sha256", "left_semi")
        fresh.dropDuplicates(["sha256"]).withColumn("prefix", F.substring("sha256", 1, 2)) \
            .write.mode("append").partitionBy("prefix").parquet(f"{self.root}/content")
        changes.filter(F.col("change") != "removed").select("file_name", "sha256", "n_bytes", "since") \
            .write.parquet(f"{self.root}/versions/{name}")
        if self.log.append(name, after=seen) is None:
            raise ConcurrentUpdateError(f"another update followed version {seen}")
        return changes.select("file_name", "change", "sha256", "n_bytes")
