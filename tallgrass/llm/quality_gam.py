"""Quality classifier: generalised additive model with pairwise interactions.

Every text becomes a few counts and shares (``FEATURES``).  Training bins each
feature at quantiles and boosts, in turn over the features, a shallow tree on
that feature's bins against the logistic loss; the sum of a feature's trees
is one lookup table.  Then the strongest pairs by residual gain get tables
over both bins, boosted the same way with trees of one cut per side.  A
score is the intercept plus one table entry per feature and pair, read for a
whole batch at once, through the logistic function.

Learning takes a bounded sample: at most ``SAMPLE`` labelled documents (those
with the smallest hash of their id), of the given folds only.  Nothing else
is sampled; every whole text is scored.

Defined results: null and empty texts have all features 0 and get a score
like any other; labels that are null, or whose document is missing, teach
nothing; a document with several labels counts with the smallest; with fewer
than two classes the model is the (smoothed) share alone; repeated rows score
alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallgrass.llm.common import few_arrow_rows

SAMPLE = 12_000
BINS = 32
ROUNDS = 60
PAIR_ROUNDS = 20
PAIRS = 6
RATE = 0.2
LEAVES = 3
FOLDS, HELD_OUT = 3, 1

FEATURES = ("words_log", "chars_a_word", "distinct_share", "top_share", "top_pair_share", "same_neighbour_share",
            "symbol_share", "bar_share", "bang_share", "upper_share", "digit_share", "dup_line_share", "stop_share",
            "line_words", "short_line_share", "packed_share")
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&<>~^_=+@\\{}[]"]] = True


def text_features(text: str | None) -> np.ndarray:
    """The features of one text; shares are per word, letter, line or byte."""
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode()
    words = (text or "").split()
    if not words:
        return out
    n = len(words)
    seen = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, counts[65:91].sum() + counts[97:123].sum())
    lines = [line for line in text.split("\n") if line.strip()]
    out[:] = (
        np.log1p(n), sum(map(len, words)) / n, len(seen) / n, max(seen.values()) / n,
        max(pairs.values()) / (n - 1) if n > 1 else 0, sum(a == b for a, b in zip(words, words[1:])) / n,
        counts[_SYMBOLS].sum() / n, counts[ord("|")] / n, counts[ord("!")] / n, counts[65:91].sum() / letters,
        counts[48:58].sum() / len(raw), 1 - len(set(lines)) / len(lines), (counts[ord(".")] + counts[ord("?")]) / n,
        np.log1p(n / len(lines)), sum(len(x) < 20 for x in lines) / len(lines),
        len(zlib.compress(raw, 1)) / len(raw),
    )
    return out


def feature_matrix(texts) -> np.ndarray:
    return np.vstack([text_features(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)))


@dataclass
class Model:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            out += t[b[:, f]]
        for (f, g), t in zip(self.pairs, self.pair_tables):
            out += t[b[:, f], b[:, g]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -35, 35)))


def _value(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Step function over the bins: the best cuts, one after another."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            gain = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _value(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both sides at once: its gain and its step table."""
    G, H = (np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (g, h))
    i, j = np.arange(1, g.shape[0])[:, None], np.arange(1, g.shape[1])[None, :]

    def four(M):
        a, b, c, d = M[i, j], M[i, -1], M[-1, j], M[-1, -1]
        return a, b - a, c - a, d - b - c + a
    gain = sum(_gain(p, q) for p, q in zip(four(G), four(H))) - _gain(G[-1, -1], H[-1, -1])
    r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros(g.shape)
    for rows in (slice(0, r + 1), slice(r + 1, None)):
        for cols in (slice(0, c + 1), slice(c + 1, None)):
            out[rows, cols] = _value(g[rows, cols].sum(), h[rows, cols].sum())
    return float(gain[r, c]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    n_features = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0)
             for f in range(n_features)]
    model = Model(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges], [], [])
    if len(np.unique(y)) < 2:
        return model
    b = model.bins(x)
    at = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-at))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n_features):
            size = len(model.tables[f])
            if size < 2:
                continue
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, f], g, size), np.bincount(b[:, f], h, size))
            model.tables[f] += step
            at += step[b[:, f]]
    g, h = slopes()
    ranked = []
    for f in range(n_features):
        for k in range(f + 1, n_features):
            if len(model.tables[f]) > 1 and len(model.tables[k]) > 1:
                ranked.append((_quadrants(*_cells(b, f, k, g, h, model))[0], f, k))
    model.pairs = [(f, k) for _, f, k in sorted(ranked, key=lambda r: (-r[0], r[1:]))[:PAIRS]]
    model.pair_tables = [np.zeros((len(model.tables[f]), len(model.tables[k]))) for f, k in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for p, (f, k) in enumerate(model.pairs):
            step = RATE * _quadrants(*_cells(b, f, k, *slopes(), model))[1]
            model.pair_tables[p] += step
            at += step[b[:, f], b[:, k]]
    return model


def _cells(b, f, k, g, h, model):
    shape = (len(model.tables[f]), len(model.tables[k]))
    cell = b[:, f] * shape[1] + b[:, k]
    size = shape[0] * shape[1]
    return np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, label: str = "quality",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents (``learn``: which label rows may teach)."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if learn is not None:
        usable = usable.where(learn)
    chosen = usable.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("_label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` rows: bounded
    taught = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("doc_id"))
    few_arrow_rows(docs.sparkSession)

    def measure(batches):
        for b in batches:
            m = feature_matrix(b["_text"])
            yield pd.DataFrame({"id": b["_id"], "label": b["_label"], **{f"f{i}": m[:, i] for i in range(len(FEATURES))}})

    kind = taught.schema["_id"].dataType.simpleString()
    cols = ", ".join(f"f{i} double" for i in range(len(FEATURES)))
    rows = taught.select("_id", "_text", "_label").mapInPandas(measure, f"id {kind}, label int, {cols}").toPandas()
    # one row per document, in a fixed order
    rows = rows.sort_values(list(rows.columns)).drop_duplicates("id")
    return fit(rows[[f"f{i}" for i in range(len(FEATURES))]].to_numpy(float), rows["label"].to_numpy(float))


def score_column(text: Column, model: Model) -> Column:
    @F.pandas_udf(DoubleType())
    def score(s: pd.Series) -> pd.Series:
        return pd.Series(model.score(feature_matrix(s)), index=s.index)
    return score(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from the folds that are not held out."""
    few_arrow_rows(docs.sparkSession)
    model = train(docs, labels, fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    own = docs.select(F.col("doc_id"), (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                      score_column(F.col("text"), model).alias("score"))
    return own.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns as they are."""
    few_arrow_rows(docs.sparkSession)
    model = train(docs, labels, fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    return docs.where(score_column(F.col("text"), model) >= least)
