"""Shards of near equal bytes by longest-processing-time scheduling.

Rows with equal texts form a group that stays together.  Groups are jobs: by
falling size, each goes to the least loaded shard, kept in a heap.

The heap is never fed all groups.  A group of at least ``total / JOBS`` bytes
is a job of its own; there are at most ``JOBS`` of them.  Smaller groups are
bundled: within hash buckets, running sums of their sizes are cut every
``total / JOBS`` bytes.  That makes at most ``2 * JOBS`` more jobs plus one per
bucket, whatever the input.  The heap's result is a table of at most
``3 * JOBS + MAX_BUCKETS`` rows, so it may be broadcast; a group that holds many
rows is always a job of its own, and its rows find their shard there.  Shards
differ by about one job, ``total / JOBS`` bytes, beyond groups that are larger.

Slots number the rows of a shard from 0: rows are spread over buckets by a
hash of their id and text, numbered within (shard, bucket), and offset by the
prefix sums of the bucket counts.

Defined results: a null text counts 0 bytes, so size 1, and stands with empty
texts; null and repeated ids keep their rows; repeated rows share a shard and
get slots of their own; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.common import durable

JOBS = 16_384
MAX_BUCKETS = 4_096
ROWS_A_BUCKET = 200_000


def longest_first(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Job -> shard: jobs by falling size (ties by name), each to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, job in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[job] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, grp): what the scheduling needs of a row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(whole) + 1).cast("long").alias("size"),
                       F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("grp"))


def schedule(rows: DataFrame, shards: int, jobs: int = JOBS) -> DataFrame:
    """(grp, size) rows -> (grp, shard): see the module."""
    spark = rows.sparkSession
    groups = durable(rows.groupBy("grp").agg(F.sum("size").alias("bytes")), "groups")
    total, n = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    cut = max(1, -(-total // jobs))
    buckets = max(1, min(MAX_BUCKETS, -(-n // ROWS_A_BUCKET)))
    run = F.sum("bytes").over(Window.partitionBy("bucket").orderBy("grp"))
    small = groups.where(F.col("bytes") < cut).withColumn("bucket", F.pmod("grp", F.lit(buckets))) \
        .withColumn("bundle", F.floor((run - 1) / cut))
    named = durable(groups.where(F.col("bytes") >= cut).select(
        "grp", "bytes", F.concat(F.lit("g"), F.col("grp")).alias("job")).unionByName(small.select(
            "grp", "bytes", F.concat_ws("-", F.lit("b"), "bucket", "bundle").alias("job"))), "jobs")
    # bounded: at most 3 * jobs + MAX_BUCKETS rows
    placed = longest_first([(r.bytes, r.job) for r in named.groupBy("job").agg(F.sum("bytes").alias("bytes")).collect()],
                           shards)
    plan = spark.createDataFrame(list(placed.items()), "job string, shard int")
    return named.join(F.broadcast(plan), "job").select("grp", "shard", "job", "bytes")


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (with shard) plus slot, gapless from 0 per shard."""
    n = rows.count()
    buckets = max(1, min(MAX_BUCKETS * 16, -(-n // ROWS_A_BUCKET)))
    put = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    counts = put.groupBy("shard", "_bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("shard", "_bucket", F.coalesce(before, F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy(*keys)) - 1
    return put.withColumn("_row", within).join(bases, ["shard", "_bucket"]) \
        .withColumn("slot", F.col("_base") + F.col("_row")).drop("_bucket", "_base", "_row")


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under the law ``bytes``)."""
    rows = durable(sized(docs, doc_id, text), "sized")
    plan = schedule(rows, shards)
    # groups with many rows are jobs of their own: a bounded table
    own = plan.where(F.col("job").startswith("g")).select("grp", F.col("shard").alias("own_shard"))
    rest = plan.where(~F.col("job").startswith("g")).select("grp", "shard")
    marked = rows.join(F.broadcast(own), "grp", "left")
    single = marked.where(F.col("own_shard").isNotNull()).withColumnRenamed("own_shard", "shard")
    several = marked.where(F.col("own_shard").isNull()).drop("own_shard").join(rest, "grp")
    placed = durable(single.unionByName(several), "placed")
    out = numbered(placed, ["doc_id", "grp"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
