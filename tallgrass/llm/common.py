"""Helpers shared by the operators of this subpackage.

Words are the maximal runs of characters other than space and U+0009-U+000D.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.session import scratch_root

# The white space between words.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Arrow batches hold few rows, so a batch of very long texts still fits a worker.
ARROW_ROWS = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once per row.

    Inside array lambdas an outer expression would be evaluated per element;
    bound as a lambda variable it is a plain value.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` alone also changes other letters)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def window_hashes(tokens: Column, n: int) -> Column:
    """64-bit hashes of the ``n``-word windows; empty below ``n`` words."""
    def at(i: Column) -> Column:
        return F.xxhash64(*[tokens[i + j] for j in range(n)])
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(0), F.size(tokens) - n), at)) \
        .otherwise(F.array().cast("array<bigint>"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/llm/{tag}-{uuid.uuid4().hex}"


def durable(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and
    survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint only for a written table of at most ``max_rows`` rows
    (counted from the files' metadata); beyond that the planner joins by shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def few_arrow_rows(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
