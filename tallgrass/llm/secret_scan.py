"""Secret scan through a blob ledger (DataFrame functions only).

Every version of every path is addressed by its content (SHA-256 of the
text).  The ledger, a folder of Parquet tables, holds which (blob, rule, rule
version) triples were scanned and what was found.  A scan takes only triples
that the ledger does not hold, one version per blob, and joins the findings
of each blob back to all its paths.  A new rule version scans the known blobs
again for that rule alone.

A match is leftmost and non-overlapping per rule; matches that fail the
rule's length test are dropped.  ``split`` and ``regexp_extract_all`` with one
pattern give the text between the matches and the matches, in order; running
sums of their lengths give the positions (code points, end exclusive).

Defined results: a null or empty text has no findings; equal texts are
scanned once and all their rows get the findings; a null path or one that
occurs with several texts keeps one row per input row; extra columns are
ignored; an empty table gives an empty result and an unchanged ledger.  Only
texts that hold a rule's trigger, which every match of the rule contains, are
shuffled; positions of one text's matches are ordered by a window over that
text alone.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass.llm.common import durable, scratch_path
from tallgrass.sources import fs


@dataclass(frozen=True)
class Rule:
    """``trigger``: pattern that every text with a match contains.  ``tested``:
    the group whose length must reach ``least`` (0: the whole match)."""
    kind: str
    pattern: str
    trigger: str
    least: int = 1
    tested: int = 0
    version: int = 1


# The three base rules, in their order; the others add spans.
RULES = (
    Rule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         "[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]{6}", least=6, tested=2),
    # runs are maximal, so the length test may stand in the pattern itself
    Rule("access", "AKIA[A-Z0-9]{16,}", "AKIA[A-Z0-9]{16}", least=20),
    Rule("hex", "[0-9a-f]{24,}", "[0-9a-f]{24}", least=24),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", "eyJ[A-Za-z0-9_-]{8}"),
)
BASE = ("assign", "access", "hex")
PAIRS_SCHEMA = "blob string, rule string, rule_version int"
FINDINGS_SCHEMA = PAIRS_SCHEMA + ", start bigint, end bigint"


def _read(spark: SparkSession, ledger: str, part: str, schema: str) -> DataFrame:
    folder = f"{ledger}/{part}"
    runs = f"{folder}/*" if fs.exists(spark, folder) else None
    return spark.read.schema(schema).parquet(runs) if runs else spark.createDataFrame([], schema)


def _triggered(text: Column, rules: tuple[Rule, ...]) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(r.trigger), F.lit(r.kind)) for r in rules]))


def _find(texts: DataFrame, rule: Rule) -> DataFrame:
    """Findings of one rule over (blob, text)."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    pieces = texts.where(text.rlike(rule.trigger)).select("blob", F.posexplode(F.arrays_zip(
        F.split(text, rule.pattern).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.tested)).alias("tested"))).alias("i", "p"))
    gap, hit = F.char_length("p.gap"), F.coalesce(F.char_length("p.hit"), F.lit(0))
    upto = F.sum(gap + hit).over(Window.partitionBy("blob").orderBy("i"))
    return pieces.select("blob", "p.hit", "p.tested", (upto - hit).alias("start"), upto.alias("end")) \
        .where(F.col("hit").isNotNull() & (F.char_length("tested") >= rule.least)) \
        .select("blob", F.lit(rule.kind).alias("rule"), F.lit(rule.version).alias("rule_version"), "start", "end")


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> dict[str, DataFrame]:
    """Scan (path, text) versions against the ledger folder and extend it.

    Returns ``paths`` (path, blob per input row), ``findings`` (blob, rule,
    rule_version, start, end: all of the ledger) and ``scanned`` (the triples
    scanned by this call).
    """
    spark = versions.sparkSession
    run = uuid.uuid4().hex
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = _read(spark, ledger, "pairs", PAIRS_SCHEMA)
    own = versions.select("path", text.alias("text"), F.sha2(text, 256).alias("blob"))
    paths = durable(own.select("path", "blob", _triggered(F.col("text"), rules).alias("triggers")), "paths")
    # one path stands for each blob; every rule with its version is due unless the ledger has it
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"), F.first("triggers").alias("triggers"))
    due = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version"))
                              for r in rules])).alias("due")
    pending = durable(blobs.select("blob", "path", "triggers", due).select("blob", "path", "triggers", "due.*")
                      .join(seen, ["blob", "rule", "rule_version"], "left_anti"), "pending")
    wanted = pending.where(F.array_contains("triggers", F.col("rule"))).groupBy("blob", "path") \
        .agg(F.collect_set("rule").alias("rules"))
    texts = durable(_with_rules(own, wanted, rules).dropDuplicates(["blob"]), "blobs")
    found = None
    for rule in rules:
        part = _find(texts.where(F.array_contains("rules", rule.kind)), rule)
        found = part if found is None else found.unionByName(part)
    # findings first: a triple is marked as scanned only when its findings are there
    found.distinct().write.parquet(f"{ledger}/findings/{run}")
    pending.select("blob", "rule", "rule_version").write.parquet(f"{ledger}/pairs/{run}")
    return {"paths": paths.select("path", "blob"), "scanned": pending.select("blob", "rule", "rule_version"),
            # a run that died before its pairs were written left findings that its next scan finds again
            "findings": _read(spark, ledger, "findings", FINDINGS_SCHEMA).distinct()}


def _with_rules(own: DataFrame, wanted: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    some = own.where(F.size(_triggered(F.col("text"), rules)) > 0)
    w = wanted.select(F.col("blob").alias("_blob"), F.col("path").alias("_path"), "rules")
    return some.join(w, (F.col("blob") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("_path"))) \
        .select("blob", "text", "rules")


def _current(findings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of the rules' current versions, with the rule's place in the list."""
    is_now = F.lit(False)
    place = F.lit(None).cast("int")
    for i, r in enumerate(rules):
        is_now = is_now | ((F.col("rule") == r.kind) & (F.col("rule_version") == r.version))
        place = F.when(F.col("rule") == r.kind, F.lit(i)).otherwise(place)
    return findings.where(is_now).withColumn("place", place)


def spans_by_blob(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob with findings: its spans by start, then rule order."""
    return _current(findings, rules).groupBy("blob").agg(F.array_sort(F.collect_list(
        F.struct("start", "place", F.col("rule").alias("kind"), "end"))).alias("spans"))


def secret_spans(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base rules, digest of their spans, all spans."""
    versions = docs.select(F.col(doc_id).alias("path"), F.col(text).alias("text"))
    out = scan(versions, ledger or scratch_path(docs.sparkSession, "ledger"), rules)
    by_blob = spans_by_blob(out["findings"], rules)
    joined = out["paths"].join(by_blob, "blob", "left")

    def shown(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda e: e["kind"] == kind)).cast("long")

    empty = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    full = joined.withColumn("spans", F.coalesce("spans", empty))
    base = F.filter("spans", lambda e: e["kind"].isin(*BASE))
    return full.select(F.col("path").alias("doc_id"), of("assign").alias("n_assign"), of("access").alias("n_access"),
                       of("hex").alias("n_hex"), F.sha2(shown(base), 256).alias("base_sha256"),
                       shown(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES,
           ledger: str | None = None) -> DataFrame:
    """``docs`` (path column doc_id, column text, optionally n_chars) with every
    found span replaced by ``mask``; overlapping spans become one mask, and
    n_chars follows the text.  Rows, other columns and null texts stay."""
    out = scan(docs.select(F.col("doc_id").alias("path"), "text"), ledger or scratch_path(docs.sparkSession, "ledger"),
               rules)
    # names that no input has
    key, blob, found = (f"{n}_{uuid.uuid4().hex}" for n in ("key", "blob", "spans"))
    by_blob = spans_by_blob(out["findings"], rules).select(F.col("blob").alias(blob), F.col("spans").alias(found))
    held = F.size(_triggered(F.coalesce("text", F.lit("")), rules)) > 0
    # only rows that can hold a finding are joined
    rest = docs.where(~held)
    joined = docs.where(held).withColumn(key, F.sha2("text", 256)) \
        .join(by_blob, F.col(key) == F.col(blob), "left")

    def step(acc: Column, e: Column) -> Column:
        """Spans come by start: text up to a span that begins after the last end, then the mask."""
        new = e["start"] >= acc["upto"]
        gap = F.substring(F.col("text"), (acc["upto"] + 1).cast("int"), (e["start"] - acc["upto"]).cast("int"))
        return F.struct(F.when(new, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["upto"], e["end"]).alias("upto"))

    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("upto"))
    cut = F.aggregate(found, zero, step, lambda a: F.concat(
        a["out"], F.substring(F.col("text"), (a["upto"] + 1).cast("int"), F.lit(2147483647))))
    new = F.when(F.col(found).isNull(), F.col("text")).otherwise(cut)
    cols = {c: F.col(c) for c in docs.columns}
    masked = joined.withColumn("text", new)
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)).alias("n_chars")
    return rest.unionByName(masked.select(*cols.values()))
