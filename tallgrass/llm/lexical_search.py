"""Ranked lexical search by dense blocked matrix multiplication.

Every item of a query set is ranked against all documents.  Terms are the
maximal runs of ASCII letters, ASCII digits and non-ASCII characters, A-Z in
lower case.  With N documents that hold a term, L terms in them, n terms and
tf occurrences in one, df documents with a term:

    w = floor(1000 ln((2N + 2) / (2 df + 1)))          (in doubles)
    m = 10 + (90 n N) div L
    score = sum over the item's terms of  w * ((10^9 tf) div (1000 tf + 8 m))

1. Items go through the driver block by block (at most ``BLOCK_ITEMS`` items
   and ``BLOCK_TERMS`` different terms; a larger item is a block of its own).
   The terms of a block are its vocabulary, the only thing that is broadcast.
2. One pass over the texts writes, per document, n and the (place, tf) pairs of
   the vocabulary; N, L and df are sums over that table.
3. Documents are taken in tiles.  The vocabulary that occurs in a tile, cut
   into strips, gives a matrix of impacts, which BLAS multiplies by the items'
   weights in float64.  An impact is below 10^6, so a strip of width t sums to
   less than t * w * 10^6, and t is chosen to keep that below 2^53: every
   partial sum is exact.  Strips are added as 64-bit integers.
4. A task keeps each item's k best (score, doc_id) pairs, a total order, so ties
   at the edge are decided by the id and not by chance; a window joins the tasks'
   lists (k rows an item and task).

Several blocks mean several passes; each is bounded by the block, not the items.

Defined results: a null or empty text, or one without terms, is no document and
is never found; an item without terms, or one whose terms no document holds,
has no rows; equal (item_id, text) rows are one item, equal ids with other texts
are ranked apart; ids may be null or repeated (a null doc_id comes last among
equal scores, repeated rows are documents of their own); extra columns are
ignored; empty tables give an empty result.  Very long texts are split into
terms a segment at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.common import durable

TOP = 10
BLOCK_ITEMS = 256
BLOCK_TERMS = 1 << 15
TILE_DOCS = 512
STRIP_TERMS = 4096
#: Bytes of a text that are split at a time.
SEGMENT = 1 << 22
#: Impacts are below this.
IMPACT = 10**6

# Every byte that is no part of a term becomes a space; A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

RESULT = "item_id long, rank int, doc_id long, score long"
_COMPACT = "doc_id long, n long, place array<int>, tf array<long>"
_PARTIAL = "item int, doc_id long, score long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, a list for each segment."""
    at = 0
    folded = text.translate(_FOLD)
    while at < len(folded):
        to = folded.find(b" ", at + SEGMENT)
        to = len(folded) if to < 0 else to
        yield folded[at:to].split()
        at = to


def _distinct(text: str | None) -> set[bytes]:
    return set().union(*map(set, terms((text or "").encode("utf-8", "surrogatepass"))))


def item_blocks(items: DataFrame, max_items: int, max_terms: int) -> Iterator[list[tuple[int | None, set[bytes]]]]:
    """(item_id, different terms) in blocks; one partition of the items at a time is on the driver."""
    block, size = [], 0
    for row in items.toLocalIterator():
        own = _distinct(row.text)
        if not own:
            continue
        if block and (len(block) == max_items or size + len(own) > max_terms):
            yield block
            block, size = [], 0
        block.append((row.item_id, own))
        size += len(own)
    if block:
        yield block


def _compact(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Per document with a term: n, and the vocabulary's (place, tf)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        place = {t: i for i, t in enumerate(shared.value)}
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("place", pa.list_(pa.int32())),
                            ("tf", pa.list_(pa.int64()))])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                n, found = 0, Counter()
                for part in terms(text.as_py() or b""):
                    n += len(part)
                    found.update(filter(place.__contains__, part))
                if n:
                    rows.append((doc_id.as_py(), n, [place[t] for t in found], list(found.values())))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return docs.mapInArrow(run, _COMPACT)


class Best:
    """The k best (score, id) pairs of every item, in the order score falling, id rising, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores``: items x documents.  Equal scores at the edge stay until ids decide."""
        item, doc = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, doc]])
        own, none = np.concatenate([self.id, ids[doc]]), np.concatenate([self.null, null[doc]])
        order = np.lexsort((own, none, -score, item))
        item = item[order]
        first = np.searchsorted(item, np.arange(len(self.least)))
        rank = np.arange(len(item)) - first[item]
        kept = rank < self.k
        order = order[kept]
        self.item, self.score, self.id, self.null = item[kept], score[order], own[order], none[order]
        full = rank[kept] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def strip_width(weights: np.ndarray) -> int:
    """Terms whose weighted impacts can be added in float64 without rounding."""
    return max(1, min(STRIP_TERMS, (2**53 - 1) // (max(1, int(weights.max(initial=1))) * IMPACT)))


def tile_scores(weights: np.ndarray, places: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int) -> np.ndarray:
    """Exact scores (items x documents) of a tile: ``weights`` is items x vocabulary,
    the impact of term ``places[i]`` in document ``docs[i]`` is ``impacts[i]``."""
    present, col = np.unique(places, return_inverse=True)
    out, width = np.zeros((len(weights), n_docs), np.int64), strip_width(weights)
    for lo in range(0, len(present), width):
        hi = min(lo + width, len(present))
        dense = np.zeros((hi - lo, n_docs))
        here = (col >= lo) & (col < hi)
        dense[col[here] - lo, docs[here]] = impacts[here]
        out += (weights[:, present[lo:hi]] @ dense).astype(np.int64)
    return out


def _rank_block(docs: DataFrame, block: list[tuple[int | None, set[bytes]]], k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted(set().union(*(own for _, own in block)))
    compact = durable(_compact(docs, vocabulary), "search")
    total = compact.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_all, l_all = total.n, total.l or 1
    df = np.zeros(len(vocabulary), np.int64)
    for r in compact.select(F.explode("place").alias("place")).groupBy("place").count().collect():
        df[r["place"]] = r["count"]
    weight = [math.floor(1000 * math.log((2 * n_all + 2) / (2 * int(d) + 1))) for d in df]
    at = {t: i for i, t in enumerate(vocabulary)}
    columns = [sorted(at[t] for t in own) for _, own in block]
    shared = spark.sparkContext.broadcast((weight, columns))

    def run(batches):
        weight, columns = shared.value
        weights = np.zeros((len(columns), len(weight)))
        for i, own in enumerate(columns):
            weights[i, own] = [weight[j] for j in own]
        best = Best(len(columns), k)
        for whole in batches:
            for lo in range(0, whole.num_rows, TILE_DOCS):
                batch = whole.slice(lo, TILE_DOCS)
                place, tf = batch.column(2), batch.column(3)
                docs = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(place.offsets)))
                # flatten() follows a slice's own range
                places, tfs = place.flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64)
                m = np.array([10 + 90 * n * n_all // l_all for n in batch.column(1).to_pylist()], np.int64)
                impacts = 10**9 * tfs // (1000 * tfs + 8 * m[docs])
                ids = batch.column(0)
                null = np.asarray(ids.is_null())
                best.add(tile_scores(weights, places, docs, impacts, batch.num_rows),
                         ids.fill_null(0).to_numpy(), null)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int32()), pa.array(best.id, pa.int64(), mask=best.null), pa.array(best.score, pa.int64())],
            names=["item", "doc_id", "score"])

    found = compact.where(F.size("place") > 0).select("doc_id", "n", "place", "tf").mapInArrow(run, _PARTIAL)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id long")
    # a block holds few items
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of every item with a score above 0: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = durable(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
                    .distinct(), "items")
    out = None
    for block in item_blocks(asked, block_items, block_terms):
        part = durable(_rank_block(own, block, k), "ranked")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], RESULT) if out is None else out


#: The same ranking as DuckDB SQL over the views documents and benchmark.
ORACLE_SQL = r"""
with doc as (
  select row_number() over () as row_id, doc_id,
         regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents where text is not null),
used as (select row_id, doc_id, len(t)::bigint as n, t from doc where len(t) > 0),
totals as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from used),
word as (
  select row_id, translate(unnest(t), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from used),
tf as (select row_id, term, count(*)::bigint as tf from word group by all),
df as (select term, count(*)::bigint as df from tf group by all),
item as (select row_number() over () as item, item_id, text from (select distinct item_id, text from benchmark)),
asked as (
  select distinct item, item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from item where text is not null),
weighted as (
  select item, item_id, term, floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double))::bigint as w
  from asked join df using (term) cross join totals),
scored as (
  select item, item_id, used.doc_id, row_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::bigint as score
  from weighted join tf using (term) join used using (row_id) cross join totals group by all),
ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id asc nulls last, row_id) as rank
  from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
