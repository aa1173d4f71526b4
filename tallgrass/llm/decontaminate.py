"""Benchmark decontamination by CGK embedding, bit sampling and edit verification.

Texts and items become sequences of words (ASCII letters in lower case; other
ASCII characters than letters and digits separate; a character of a script
without spaces between words is a word).  A document is
contaminated by an item if some stretch of it has a word edit distance of at
most ``TOLERANCE`` of the item's words.

Windows of an item's size class begin at every word of every document.  The
CGK random walk embeds a window: step j writes the word under the pointer and
moves on if a random bit of (j, word) is set.  Words in both sequences that
the walk has brought into step agree, so a small edit distance becomes a
small Hamming distance.  Each of ``REPEATS`` walks goes over the whole window
(the pointer moves half a word a step) and samples ``SAMPLED`` coordinates of
it; an item takes part in the repeats whose coordinates lie inside it.  Windows
and items that agree on all coordinates in some repeat are candidates, and a
dynamic programme then verifies the edit distance exactly, for every start
within the tolerance of the window's.  Equal passages always collide: the
first repeat samples steps that lie inside every item.  The recall at the
tolerance is measured (README), not derived.

Before embedding, windows that cannot pass are left out without loss.  A
window within the tolerance has all but that many of its words from the
item, so at least that many from the words of all items of its class.  And an
edit touches at most ``GRAM`` of an item's runs of ``GRAM`` words: of n - GRAM + 1
runs all but GRAM times the edits stand in the stretch unchanged, so a window of
the class's longest stretch must hold as many runs of items of the class.

Items of fewer than ``MIN_ITEM_WORDS`` words are matched exactly: their words in
their order, found by a hash of so many words and compared.

Items are a stated query set.  They are broadcast in blocks of at most
``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes, ``BLOCKS_A_PASS`` of them in one
pass over the documents, so any number of items works.

Defined results: null and empty texts hold no item; items without words (null
ones too) are never matched; repeated items each count; repeated rows get equal results; extra
columns are ignored; empty tables give an empty result, or no contamination.
Whole texts are searched, in segments of words within memory bounds.
"""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tallgrass.llm import runs
from tallgrass.llm.common import durable, few_arrow_rows

TOLERANCE = 0.2
REPEATS = 72
SAMPLED = 3
#: Steps of a walk for a word of a class's shortest items.
STEPS = 2.25
MIN_ITEM_WORDS = 8
#: Words of the runs that a stretch must share with the items.
GRAM = 3
CLASS_STEP = 1.25
BLOCK_ITEMS = 50_000
BLOCK_BYTES = 32 << 20
#: Blocks searched in one pass; a worker keeps the indexes of as many.
BLOCKS_A_PASS = 2
#: Bytes of text that are searched together.
GATHER = 4 << 20
#: Numbers in an array of the walks, or of the dynamic programme, at a time (one window or stretch at least).
AT_ONCE = 1 << 15

_BREAKS = np.ones(256, bool)
_BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: Stands behind every text and item; a walk that reaches it stays there (0 times anything has no top bit).
_PAD = np.zeros(1, np.uint64)


# Code points of scripts written without spaces between words (Thai, Lao, Burmese, Khmer,
# kana, Han).
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
             (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of UTF-8 text (behind which there is a break)."""
    starts, ends = runs.bounds(data, _BREAKS)
    if not len(data) or data.max() < 0xE0:
        return starts, ends
    cuts = []
    for least, size in ((0xE0, 3), (0xF0, 4)):
        at = np.flatnonzero((data >= least) & (data < least + 16))
        at = at[at + size <= len(data)]
        code = data[at].astype(np.int64) & (0x0F if size == 3 else 0x07)
        for i in range(1, size):
            code = code << 6 | data[at + i].astype(np.int64) & 0x3F
        alone = at[np.logical_or.reduce([(code >= a) & (code <= b) for a, b in _UNSPACED])]
        cuts += [alone, alone + size]
    inside = np.unique(np.concatenate(cuts))
    inside = inside[(inside > 0) & (inside < len(data))]
    inside = inside[~_BREAKS[data[inside]] & ~_BREAKS[data[inside - 1]]]
    return np.sort(np.concatenate([starts, inside])), np.sort(np.concatenate([ends, inside]))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the place of each text's first word (and the end)."""
    data, begin = runs.join_texts(texts)
    data = runs.LOWER[data]
    starts, ends = word_bounds(data)
    return runs.hashes(data, starts, ends), np.searchsorted(starts, begin)


def gram_hashes(words: np.ndarray, size: int = GRAM) -> np.ndarray:
    """One hash for the run of ``size`` words that begins at each word (none at the last ones)."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = runs.mix(out + words[i:i + n])
    return out


def edit_distances(items: np.ndarray, sizes: np.ndarray, texts: np.ndarray, most: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """For every row, the least word edit distance between the item (``sizes`` words) and a prefix of the
    text (of what is left after up to ``skip`` words), or ``most + 1`` if it is above ``most``.  Padding of
    the texts is a word of no item."""
    steps = np.arange(1, texts.shape[1] + 1, dtype=np.int32)
    row = np.maximum(np.arange(texts.shape[1] + 1) - skip[:, None], 0).astype(np.int32)
    out, own = most + 1, np.arange(len(items))
    for i in range(1, items.shape[1] + 1):
        # insertions: a running minimum along the row
        run = np.empty_like(row)
        run[:, 0] = i
        np.minimum(row[:, :-1] + (texts != items[:, i - 1:i]), row[:, 1:] + 1, out=run[:, 1:])
        run[:, 1:] -= steps
        row = np.minimum.accumulate(run, axis=1)
        row[:, 1:] += steps
        least = row.min(axis=1)
        ready = sizes == i
        out[own[ready]] = np.minimum(least, most + 1)[ready]
        going = np.flatnonzero((sizes > i) & (least <= most))
        if not len(going):
            break
        if len(going) <= 0.75 * len(own):
            own, items, sizes, texts, most, row = (a[going] for a in (own, items, sizes, texts, most, row))
    return out


def edit_distance(item: np.ndarray, text: np.ndarray, most: int, skip: int = 0) -> int:
    """The same for one item and one text."""
    text = text[:skip + len(item) + most]
    return int(edit_distances(item[None], np.array([len(item)]), text[None], np.array([most]), np.array([skip]))[0])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Lookup:
    """Sorted hashes: a bit table by the low bits first, the exact test for those that pass."""

    def __init__(self, values: np.ndarray, most_bits: int = 1 << 20) -> None:
        bits = 1 << 12
        while bits < min(8 * len(values), most_bits):
            bits *= 2
        self.values, self.low, self.bits = values, np.uint64(bits - 1), np.zeros(bits, bool)
        self.bits[values & self.low] = True

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``asked`` are there, and the place of the first equal value."""
        at = np.flatnonzero(self.bits[(asked & self.low).view(np.int64)])
        first = np.searchsorted(self.values, asked[at])
        there = self.values[np.minimum(first, len(self.values) - 1)] == asked[at]
        return at[there], first[there]


class SizeClass(NamedTuple):
    low: int            # words of the shortest item the class may hold
    most: int           # edits
    vocab: Lookup
    grams: Lookup
    least: int          # runs of words that a stretch of `longest` words must share
    longest: int
    walks: np.ndarray
    sampled: np.ndarray
    keys: Lookup
    members: np.ndarray  # the item of each key


class Index:
    """The items of a block: words, size classes and sampled embeddings."""

    def __init__(self, items: list[tuple[int, bytes]], seed: int = 7) -> None:
        hashes, first = word_hashes([t for _, t in items])
        self.ids, self.words = [], []
        short = defaultdict(list)
        for (item_id, _), a, b in zip(items, first[:-1], first[1:]):
            if 0 < b - a < MIN_ITEM_WORDS:
                short[int(b - a)].append((gram_hashes(hashes[a:b], int(b - a))[0], item_id, hashes[a:b]))
            elif b - a:
                self.ids.append(item_id)
                self.words.append(hashes[a:b])
        #: Short items by their number of words: their hashes, and (item id, words) in that order.
        self.short = {n: (Lookup(np.array([h for h, _, _ in own], np.uint64)), [o[1:] for o in own])
                      for n, own in ((n, sorted(x, key=lambda o: o[0])) for n, x in sorted(short.items()))}
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.most = np.array([int(TOLERANCE * len(w)) for w in self.words], np.int64)
        rng = np.random.Generator(np.random.PCG64(seed))
        self.classes = []
        by_size = defaultdict(list)
        for k, w in enumerate(self.words):
            low = MIN_ITEM_WORDS
            while int(low * CLASS_STEP) + 1 <= len(w):
                low = int(low * CLASS_STEP) + 1
            by_size[low].append(k)
        for low, members in sorted(by_size.items()):
            steps = int(STEPS * low)
            walks = rng.integers(0, 2**64, (REPEATS, steps), dtype=np.uint64) | np.uint64(1)
            # the first repeat's coordinates lie within `low` steps: inside every item whatever the walk
            sampled = np.array([sorted(rng.choice(steps if r else low, SAMPLED, replace=False).tolist()) for r in range(REPEATS)])
            vocab = Lookup(np.unique(np.concatenate([self.words[k] for k in members])))
            most = max(int(self.most[k]) for k in members)
            grams = Lookup(np.unique(np.concatenate([gram_hashes(self.words[k]) for k in members])))
            least = min(int(self.size[k] - GRAM + 1 - GRAM * self.most[k]) for k in members)
            longest = max(int(self.size[k] + self.most[k]) for k in members)
            flat = np.concatenate([a for k in members for a in (self.words[k], _PAD)])
            end = np.cumsum([len(self.words[k]) + 1 for k in members])
            keys, whole = self._keys(flat, np.concatenate([[0], end[:-1]]), walks, sampled)
            owner = np.broadcast_to(np.asarray(members), keys.shape)[whole]
            order = np.argsort(keys[whole], kind="stable")
            self.classes.append(SizeClass(low, most, vocab, grams, least, longest, walks, sampled,
                                          Lookup(keys[whole][order]), owner[order]))
        if self.classes:
            self.grams = Lookup(np.unique(np.concatenate([c.grams.values for c in self.classes])), 1 << 22)

    @staticmethod
    def _keys(words: np.ndarray, at: np.ndarray, walks: np.ndarray, sampled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One key per repeat (different in every repeat) for the window that begins at each of ``at``, and
        whether all its coordinates lie before the padding."""
        order = np.argsort(-sampled[:, -1], kind="stable")     # the longest walks first: those that have ended are behind
        walks, sampled = walks[order], sampled[order]
        going = np.searchsorted(-sampled[:, -1], -np.arange(sampled.max() + 1), "right")
        drawn = [np.nonzero(sampled[:n] == j) for j, n in enumerate(going)]
        out = np.empty((len(sampled), len(at)), np.uint64)
        whole = np.empty(out.shape, bool)
        part = max(1, AT_ONCE // len(sampled))
        for a in range(0, len(at), part):
            place = np.repeat(at[None, a:a + part].astype(np.int64), len(sampled), axis=0)
            seen = np.empty((len(sampled), SAMPLED, place.shape[1]), np.uint64)
            for j, n in enumerate(going):
                word = words[place[:n]]
                rows, which = drawn[j]
                if len(rows):
                    seen[rows, which] = word[rows]
                word *= walks[:n, j:j + 1]
                word >>= np.uint64(63)
                place[:n] += word.view(np.int64)
            key = np.repeat(order.astype(np.uint64)[:, None] + np.uint64(1), place.shape[1], axis=1)
            for i in range(SAMPLED):
                key = runs.mix(key + seen[:, i])
            out[order, a:a + part] = key
            whole[order, a:a + part] = (seen != _PAD).all(axis=1)
        return out, whole

    def search(self, texts: list[bytes]) -> list[dict[int, int]]:
        """For every text: item id -> least edit distance found."""
        found: list[dict[int, int]] = [{} for _ in texts]
        words, first = word_hashes(texts)
        if not len(words):
            return found
        for n, (table, items) in self.short.items():
            grams = gram_hashes(words, n)
            for at, k in zip(*(x.tolist() for x in table.find(grams))):
                doc = int(np.searchsorted(first, at, "right")) - 1
                while at + n <= first[doc + 1] and k < len(items) and table.values[k] == grams[at]:
                    item_id, own = items[k]
                    if (own == words[at:at + n]).all():
                        found[doc][item_id] = 0
                    k += 1
        if not self.classes:
            return found
        text_grams = gram_hashes(words)
        shared, _ = self.grams.find(text_grams)
        owner = np.searchsorted(first, shared, "right") - 1
        inside = shared + GRAM <= first[owner + 1]
        shared, owner = shared[inside], owner[inside]
        shared_grams = text_grams[shared]
        padded = None
        for c in self.classes:
            own, _ = c.grams.find(shared_grams)
            at, doc = self._shared_runs(shared[own], owner[own], first, c.least, c.longest)
            upto = np.minimum(at + c.low, first[doc + 1])
            likely = self._known(words, at, upto, c.vocab) >= c.low - c.most
            at, doc = at[likely], doc[likely]
            if not len(at):
                continue
            if padded is None:
                padded = np.insert(words, first[1:], _PAD[0])
            keys, _ = self._keys(padded, at + doc, c.walks, c.sampled)
            for k, text, edits in self._verified(words, first, *self._candidates(at, doc, keys, c), c.longest):
                found[text][self.ids[k]] = min(edits, found[text].get(self.ids[k], edits))
        return found

    @staticmethod
    def _shared_runs(at: np.ndarray, owner: np.ndarray, first: np.ndarray, least: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (and their texts) from which a stretch of ``longest`` words within its text holds at least
        ``least`` of the runs that begin at ``at`` in the texts ``owner``."""
        more = max(1, least) - 1
        # with at[i] the first run of a stretch, at[i + more] must be inside, too
        a, last, doc = at[:max(0, len(at) - more)], at[more:], owner[:max(0, len(at) - more)]
        start = np.maximum(first[doc], last - longest + GRAM)
        start[1:] = np.maximum(start[1:], a[:-1] + 1)
        size = np.where(owner[more:] == doc, np.maximum(a + 1 - start, 0), 0)
        return _ranges(start, size), np.repeat(doc, size)

    @staticmethod
    def _known(words: np.ndarray, at: np.ndarray, upto: np.ndarray, vocab: Lookup) -> np.ndarray:
        """How many words of each window (in order of their places) are in the vocabulary."""
        start = at.copy()
        start[1:] = np.maximum(at[1:], upto[:-1])       # every word is looked up once
        place = _ranges(start, np.maximum(upto - start, 0))
        known = place[vocab.find(words[place])[0]]
        return np.searchsorted(known, upto) - np.searchsorted(known, at)

    @staticmethod
    def _candidates(at: np.ndarray, doc: np.ndarray, keys: np.ndarray, c: SizeClass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, place and text of windows that share a key with an item, in this order, once each."""
        hit, lo = c.keys.find(keys.reshape(-1))
        n = np.searchsorted(c.keys.values, keys.reshape(-1)[hit], "right") - lo
        pairs = np.unique(c.members[_ranges(lo, n)] * len(at) + np.repeat(hit % len(at), n))
        return pairs // len(at), at[pairs % len(at)], doc[pairs % len(at)]

    def _verified(self, words: np.ndarray, first: np.ndarray, item: np.ndarray, at: np.ndarray, doc: np.ndarray,
                  longest: int) -> Iterator[tuple[int, int, int]]:
        """(item, text, edits) of the candidates within the tolerance.  Candidates whose starts adjoin are one stretch."""
        if not len(item):
            return
        most = self.most[item]
        new = np.ones(len(item), bool)
        new[1:] = ((np.diff(item) != 0) | (np.diff(doc) != 0) | (np.diff(at) > 2 * most[1:] + 1)
                   | (np.diff(at // longest) != 0))
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(item)) - 1
        item, doc, most, begin, skip = item[head], doc[head], most[head], at[head] - most[head], at[tail] - at[head] + 2 * most[head]
        size = self.size[item]
        width = skip + size + most
        part = max(1, AT_ONCE // int(width.max()))
        for a in range(0, len(item), part):
            p = slice(a, a + part)
            own = np.zeros((len(item[p]), int(size[p].max())), np.uint64)
            for i, k in enumerate(item[p].tolist()):
                own[i, :len(self.words[k])] = self.words[k]
            place = begin[p, None] + np.arange(int(width[p].max()))
            inside = (place >= first[doc[p], None]) & (place < np.minimum(first[doc[p] + 1], begin[p] + width[p])[:, None])
            text = np.where(inside, words[np.clip(place, 0, len(words) - 1)], _PAD[0])
            edits = edit_distances(own, size[p], text, most[p], skip[p])
            for i in np.flatnonzero(edits <= most[p]).tolist():
                yield int(item[p][i]), int(doc[p][i]), int(edits[i])


@lru_cache(maxsize=BLOCKS_A_PASS)
def _index(items: tuple[tuple[int, bytes], ...]) -> Index:
    return Index(list(items))


def item_blocks(spark: SparkSession, items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator:
    """Broadcasts of at most BLOCK_ITEMS items and BLOCK_BYTES bytes each, made as they are asked for."""
    own = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    block, size = [], 0
    for r in own.orderBy("i", "t").toLocalIterator():
        raw = r.t.encode()
        if block and (len(block) >= BLOCK_ITEMS or size + len(raw) > BLOCK_BYTES):
            yield spark.sparkContext.broadcast(tuple(block))
            block, size = [], 0
        block.append((r.i, raw))
        size += len(raw)
    if block:
        yield spark.sparkContext.broadcast(tuple(block))


_HITS = ArrayType(StructType([StructField("item_id", LongType()), StructField("edits", LongType())]))


def hits_column(text: Column, block) -> Column:
    """Items of one block within each text: array of (item_id, edits), by item."""
    @F.pandas_udf(_HITS)
    def search(s: pd.Series) -> pd.Series:
        index = _index(block.value)
        out, part, size = [], [], 0
        raw = [(t or "").encode() for t in s]
        for i, t in enumerate(raw):
            part.append(t)
            size += len(t)
            if size >= GATHER or i == len(raw) - 1:
                out += [[{"item_id": k, "edits": d} for k, d in sorted(f.items(), key=lambda x: (x[0] is not None, x[0]))]
                        for f in index.search(part)]
                part, size = [], 0
        return pd.Series(out, index=s.index, dtype=object)
    return search(F.coalesce(text, F.lit("")))


def with_hits(docs: DataFrame, items: DataFrame, text: str = "text", hits: str = "hits") -> DataFrame:
    """``docs`` plus a column ``hits``: array of (item_id, edits) over all items."""
    few_arrow_rows(docs.sparkSession)
    out = docs.withColumn(hits, F.array().cast("array<struct<item_id:bigint,edits:bigint>>"))
    for n, part in enumerate(itertools.batched(item_blocks(docs.sparkSession, items), BLOCKS_A_PASS)):
        if n:   # one pass is written before the next pair of blocks
            out = durable(out, "searched")
        out = out.withColumn(hits, F.concat(hits, *[hits_column(F.col(text), b) for b in part]))
    return out


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: whether it holds an item, how many, which (by id), the least edits."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = with_hits(own, items).select("doc_id", "hits")
    ids = F.transform("hits", lambda h: h["item_id"].cast("string"))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"),
                        F.array_join(ids, ",").alias("item_ids"),
                        F.array_min(F.transform("hits", lambda h: h["edits"])).alias("least_edits"))


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are, whatever their names."""
    hits = f"hits_{uuid.uuid4().hex}"
    return with_hits(docs, items, text, hits).where(F.size(hits) == 0).drop(hits)
