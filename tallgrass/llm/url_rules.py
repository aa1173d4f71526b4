"""URL filter: listed host and path rules, and rules mined from what they decide
(DataFrame functions and Spark's FP-growth only).

A listed rule ``host/path`` fits a URL of that host or a subdomain whose path
begins with the rule's path; of several the longest decides.  The URLs that
listed rules decide are the labels from which the method learns to judge the
rest:

1. A URL becomes a set of tokens: the host's last label, the words of its other
   labels, words of the path (digits as one #).
2. Per token, URLs and blocked URLs are counted over all different labelled URLs.
   A URL enters mining with its label and at most ``MAX_TOKENS`` of its frequent
   tokens, those whose share of blocked URLs differs most from the whole; this
   bounds the itemsets (2^MAX_TOKENS for one URL, however long it is).
3. FP-growth gives the frequent itemsets; rules "tokens => label" below
   ``MIN_CONFIDENCE`` go, and so does a rule that one of its own parts (one token
   less) makes with at least the same confidence.
4. An inverted index holds each rule under its rarest token.  Different token
   sets are looked up once, whatever the number of URLs: tokens meet the
   index, the rule's other tokens are tested, and the strongest rule (confidence,
   support, more tokens, block before allow, text) gives the verdict.

A URL without any rule is allowed.

Defined results: host and path of a null URL, or one without ``://``, are
empty; no listed rule fits it and it is allowed.  Rows are judged one by one by
their URL, so null or repeated ids and repeated rows stay; extra columns are
ignored; an empty table gives an empty result.  Without labelled URLs, or with
fewer than ``MIN_COUNT``, no rule is mined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import ascii_lower, durable, small_side

ALLOW, BLOCK = "allow", "block"
#: A mined rule holds for this share of the labelled URLs, and this many.
MIN_SHARE = 0.01
MIN_COUNT = 5
MIN_CONFIDENCE = 0.8
MAX_TOKENS = 12
#: Rules that may be broadcast.
BROADCAST_RULES = 100_000

RULES_SCHEMA = "tokens array<string>, verdict string, confidence double, support double"


@dataclass(frozen=True)
class Listed:
    """A listed rule; ``path`` begins with a slash."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The listed rules of the registered query.
LISTED = (Listed("org", "/", ALLOW), Listed("example.org", "/es/", BLOCK), Listed("example.org", "/en/1", BLOCK),
          Listed("com", "/fr/", ALLOW), Listed("com", "/de/", BLOCK))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def listed_rule(host: Column, path: Column, rules: tuple[Listed, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits (null: none)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def url_tokens(host: Column, path: Column) -> Column:
    """The different tokens of a URL, in order of their text."""
    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))
    last = F.regexp_extract(host, r"([^.]*)$", 1)
    words = F.split(F.regexp_replace(ascii_lower(path), "[0-9]+", "#"), r"[^\p{L}\p{M}#]+")
    return F.array_sort(F.array_distinct(F.concat(
        marked("host:", F.split(F.regexp_replace(host, r"[^.]*$", ""), "[.-]")), marked("last:", F.array(last)), marked("path:", words))))


def token_counts(labelled: DataFrame) -> DataFrame:
    """Per token: labelled URLs that hold it, and blocked ones."""
    return labelled.select(F.explode("tokens").alias("token"), (F.col("verdict") == BLOCK).cast("long").alias("b")) \
        .groupBy("token").agg(F.count("*").alias("n"), F.sum("b").alias("blocked"))


def transactions(labelled: DataFrame, counts: DataFrame, least: float, total: int, blocked: int, max_tokens: int) -> DataFrame:
    """Per labelled URL the tokens it is mined with."""
    base = blocked / total
    useful = counts.where(F.col("n") >= least).select(
        "token", (F.abs(F.col("blocked") / F.col("n") - base) * F.sqrt("n")).alias("weight"))
    picked = labelled.select("url", "verdict", F.explode("tokens").alias("token")) \
        .join(small_side(durable(useful, "tokens"), BROADCAST_RULES), "token") \
        .groupBy("url", "verdict").agg(F.collect_list(F.struct((-F.col("weight")).alias("w"), "token")).alias("t"))
    return picked.select(F.concat(
        F.transform(F.slice(F.array_sort("t"), 1, max_tokens), lambda e: e["token"]),
        F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items"))


def mine(labelled: DataFrame, min_share: float = MIN_SHARE, min_count: int = MIN_COUNT,
         min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) from URLs with tokens and a verdict, each
    rule under its rarest token (column token)."""
    spark = labelled.sparkSession
    own = durable(labelled.select("url", "verdict", "tokens").distinct(), "labelled")
    all_ = own.agg(F.count("*").alias("n"), F.sum((F.col("verdict") == BLOCK).cast("long")).alias("b")).first()
    if all_.n < min_count:
        return spark.createDataFrame([], RULES_SCHEMA + ", token string")
    counts = durable(token_counts(own), "counts")
    least = max(min_count, min_share * all_.n)
    items = durable(transactions(own, counts, least, all_.n, all_.b, max_tokens), "transactions")
    mined = items.count()
    if mined < min_count:
        return spark.createDataFrame([], RULES_SCHEMA + ", token string")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / mined), minConfidence=min_confidence).fit(items)
    label = F.element_at("consequent", 1)
    rules = model.associationRules.where(F.startswith(label, F.lit("verdict:"))).select(
        F.array_sort("antecedent").alias("tokens"), F.substring_index(label, ":", -1).alias("verdict"),
        "confidence", "support")
    rules = durable(rules, "mined")
    # a rule goes if one token less does as well
    shorter = rules.where(F.size("tokens") > 1).select(
        "tokens", "verdict", "confidence", F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("part"))
    general = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("general"))
    spare = shorter.join(general, ["part", "verdict"]).where(F.col("general") >= F.col("confidence")) \
        .select("tokens", "verdict").distinct()
    left = rules.join(spare, ["tokens", "verdict"], "left_anti")
    rarest = left.select("tokens", F.explode("tokens").alias("token")).distinct().join(counts.select("token", "n"), "token") \
        .groupBy("tokens").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    return durable(left.join(rarest, "tokens"), "rules")


def judge(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The strongest rule's verdict for each different ``tokens`` that any rule fits."""
    index = rules.select("token", F.col("tokens").alias("needed"), "verdict", "confidence", "support")
    fits = token_sets.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token")) \
        .join(small_side(index, BROADCAST_RULES), "token") \
        .where(F.size(F.array_except("needed", "tokens")) == 0)
    strength = F.struct("confidence", "support", F.size("needed").alias("tokens"),
                        (F.col("verdict") == BLOCK).alias("block"), F.array_join("needed", " ").alias("text"))
    return fits.groupBy("tokens").agg(F.max_by("verdict", strength).alias("mined"))


def filter_urls(pages: DataFrame, rules: tuple[Listed, ...] = LISTED, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule (the listed one that fits, else null), verdict."""
    host, path = host_and_path(F.col("url"))
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")) \
        .withColumn("host", host).withColumn("path", path)
    name, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    judged = own.withColumn("rule", name).withColumn("listed", verdict) \
        .withColumn("tokens", url_tokens(F.col("host"), F.col("path")))
    mined = mine(judged.where(F.col("listed").isNotNull()).select("url", F.col("listed").alias("verdict"), "tokens"))
    open_ = judged.where(F.col("listed").isNull())
    verdicts = durable(judge(open_, mined), "verdicts")
    rest = open_.join(small_side(verdicts, BROADCAST_RULES), "tokens", "left")
    done = judged.where(F.col("listed").isNotNull()).withColumn("mined", F.lit(None).cast("string"))
    return done.unionByName(rest).select(
        "page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit(ALLOW)).alias("verdict"))
