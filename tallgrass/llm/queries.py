"""The registered queries of this subpackage: thin forms of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm.common import table
from tallgrass.llm import (bpe, decontaminate, html_text, lexical_search, near_dedup, pitman_yor, quality_gam, quality_rules,
                           secret_scan, sharding, token_files, url_rules, whitening)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_rows(table(spark, sf_dir, "documents"))


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.language_scores(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_bpe_round_trip, op3_quality_gam, op4_near_dedup, op5_token_files, op6_pitman_yor, op7_secret_scan, op8_decontaminate,
    op9_sharding, op10_html_text, op11_lexical_search, op12_url_rules, op13_whitening)}
ORACLE_SQL: dict[str, str] = {"op11_lexical_search": lexical_search.ORACLE_SQL}
