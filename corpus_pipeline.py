"""Training-data pipeline: five stages over ``documents``, each on what its predecessor kept.

1. quality classifier: rows the additive model rejects go;
2. near-duplicates: one document of each component stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scan: found secrets are masked in the text (n_chars follows);
5. byte-level BPE: the result, token counts and digests per document.

Each stage returns the columns of documents (the last its own), is written as
Parquet to the shared folder and read again.  Null and empty texts pass the
stages that judge content as those operators define; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm import bpe, decontaminate, near_dedup, quality_gam, secret_scan
from tallgrass.llm.common import durable, table


#: Near duplicates from this similarity of their 5-word shingles on, in percent.
SIMILARITY = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_gam.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs, percent=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs)


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("bpe encoding and decoding", tokens),
]

#: SQL can express neither the model nor the tokenizer; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
