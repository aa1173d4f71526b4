"""Quality rules from cross-document line frequency (DataFrame functions only).

Every line is normalised (lower case; runs of white space, digits and ASCII
punctuation become one space) and hashed together with its host.  A line is
above the limit if it stands in more than ``max(min_documents, share * texts
of the host)`` distinct texts of one host.  Those lines are removed; a
document is depleted, and rejected, if less than ``min_left`` of its words or
fewer than ``min_words`` of them are left while something was removed.

Two passes keep the shuffles small.  The first counts all (host, line) pairs
with map-side combining and keeps the keys above the smallest possible limit.
The second goes over the texts again and takes only occurrences of those few
keys; distinct texts are counted on them alone, so a line that stands in a
third of all documents is combined before it is shuffled.  Verdicts belong to
(host, text), so equal texts of a host share one and count once.

Defined results: a null or empty text, or one without words, has all counts 0
and fails the base; a null host is a host of its own; repeated rows each get
their row back; ``doc_id`` may be null or repeated; extra columns are ignored;
an empty table gives an empty result.  Texts of any length are handled inside
their row, in time n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import durable, let, small_side, window_hashes, words

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: A line may stand in this many texts of a host, or in this share of them.
MIN_DOCUMENTS = 20
HOST_SHARE = 0.01
MIN_LEFT = 0.5
#: Keys (8 bytes each) that may be broadcast.
BROADCAST_KEYS = 1_000_000


def repeated_words(tokens: Column, n: int = WINDOW) -> Column:
    """Words that lie in an ``n``-word window found at least twice in the text."""
    def covered(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(p: Column, e: Column, j: Column) -> Column:
            return F.coalesce(F.get(p, j)["h"] == e["h"], F.lit(False))

        def positions(p: Column) -> Column:
            twice = F.filter(p, lambda e, j: same(p, e, j - 1) | same(p, e, j + 1))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        def add(acc: Column, i: Column) -> Column:
            return F.struct((acc["n"] + F.least(F.lit(n), i - acc["last"])).alias("n"), i.alias("last"))

        return F.aggregate(let(ranked, positions), F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last")), add)["n"]

    return let(window_hashes(tokens, n), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))).cast("long")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    counted = docs.withColumn("_counts", let(words(whole), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"))))
    return counted.select(
        *docs.columns, "_counts.n_words", "_counts.word_chars",
        F.char_length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        "_counts.n_repeat_words",
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                 | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), "[\\s\\d\\p{Punct}]+", " "))


def _line_keys(host: Column, text: Column) -> Column:
    def entry(line: Column) -> Column:
        return F.struct(F.xxhash64(host, normal_line(line)).alias("line"), F.size(words(line)).alias("words"))
    full = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return F.transform(full, entry)


def lines_above_limit(keyed: DataFrame, min_documents: int, host_share: float) -> tuple[DataFrame, DataFrame]:
    """(occurrences of frequent lines by text, keys of the lines above their host's limit)."""
    first = keyed.select(F.explode(F.array_distinct(F.transform("lines", lambda e: e["line"]))).alias("line"))
    often = durable(first.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") > min_documents)
                    .select("line"), "often")
    hits = (keyed.select("host", "text_key", F.posexplode("lines").alias("pos", "e"))
            .select("host", "text_key", "pos", "e.line", "e.words")
            .join(small_side(often, BROADCAST_KEYS), "line"))
    # equal texts of a host count once; a line repeated in a text counts its words each time
    found = durable(hits.groupBy("host", "text_key", "line", "pos").agg(F.max("words").alias("words"))
                    .groupBy("host", "text_key", "line").agg(F.sum("words").alias("words")), "found")
    hosts = keyed.groupBy("host", "text_key").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("texts"))
    above = (found.groupBy("host", "line").agg(F.count("*").alias("n")).join(hosts, "host")
             .where(F.col("n") > F.greatest(F.lit(min_documents), F.col("texts") * host_share)).select("line"))
    return found, above


def line_frequency_rules(docs: DataFrame, text: str = "text", host: str = "source",
                         min_documents: int = MIN_DOCUMENTS, host_share: float = HOST_SHARE,
                         min_left: float = MIN_LEFT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (with n_words) without its text, with removed_words and depleted."""
    whole = F.coalesce(F.col(text), F.lit(""))
    tagged = docs.withColumn("_host", F.xxhash64(F.lit("host"), host)) \
        .withColumn("_text", F.xxhash64(F.lit("host"), host, whole))
    keyed = tagged.select(F.col("_host").alias("host"), F.col("_text").alias("text_key"),
                          _line_keys(F.xxhash64(F.lit("host"), host), whole).alias("lines"))
    found, above = lines_above_limit(keyed, min_documents, host_share)
    removed = durable(found.join(above, "line", "left_semi").groupBy("text_key")
                      .agg(F.sum("words").alias("removed_words")), "removed")
    joined = tagged.drop(text).join(removed, tagged["_text"] == removed["text_key"], "left")
    gone = F.coalesce(F.col("removed_words"), F.lit(0)).cast("long")
    left = F.col("n_words") - gone
    return joined.withColumn("removed_words", gone).withColumn(
        "depleted", (gone > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))) \
        .drop("_host", "_text", "text_key")


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: counts, base verdict, removed words and the final verdict."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("source"))
    out = line_frequency_rules(base_counts(own))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~F.col("depleted")).alias("kept"), "removed_words")
