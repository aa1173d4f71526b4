"""Hierarchical Pitman-Yor language model over words.

Restaurants: one per context, below one shared parent (all words), below the
uniform distribution over the training vocabulary and one unseen word.  A
word's context is its predecessor, named by a hash into ``CONTEXTS`` values;
the start of a text has its own.  Words are the runs of characters other than
space and U+0009-U+000D with A-Z in lower case; every text ends with one end
token.  Words are named by 64-bit hashes.

All statistics of one word, in every context and in the parent, stand in one
bucket (by the word's hash).  Buckets depend on each other only through sums:
tables per context, customers and tables of the parent.  Within a bucket the
seating is Gibbs-sampled.  A restaurant's strength term is Gamma-augmented,
which makes its dishes independent given the Gamma variable: the number of
tables t of a dish with c customers then has weight S(c, t) x**t, with
generalised Stirling numbers S and x = discount * gamma * P_parent(word).  t is
drawn from that distribution: up to ``EXACT`` customers from the numbers themselves,
beyond from a contour integral that gives them to many digits at the places that
matter.  Sums between buckets are those of the last exchange (``EXCHANGES`` rounds
of ``SWEEPS`` sweeps); the last two samples are kept with the bucket and their
predictive probabilities averaged.

Passes over the texts count and score; each sends, for a batch of texts and a
bucket, one packed row of the distinct words, (word, context) types and
occurrences.  The counting pass also counts every bucket's occurrences: a bucket with
more than ``REQUESTS`` of them to score, as that of a word that makes up a third of all
tokens, is copied (its state is bounded by its types) and its batches are dealt over the
copies.  In the counting pass such a word has at most ``CONTEXTS`` types a batch.
Scoring returns one row of sums per batch and bucket.  Nothing whole passes the driver
but the sums per context (a fixed size) and totals.

A batch is named by its partition and number, so a task that is run again after an
executor was lost sends the same rows; the input must then give a partition's rows in the
same order again, as files do (write other inputs first).

Defined results: a null or empty text is the end token alone; texts of any
length work (a batch holds at least one text); a null id is hashed as the
empty text, so it is held out; repeated rows count and score each; words
unseen in training share one probability; extra columns are ignored; empty
tables give an empty result, and without training texts all words are unseen.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import runs
from tallgrass.llm.common import durable, few_arrow_rows, small_side

CONTEXTS = 4_096
DISCOUNT, STRENGTH = 0.75, 1.0          # of the context restaurants
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 10.0
EXACT = 256
NODES, CELLS = 32, 36
SWEEPS = 2
EXCHANGES = 2
BATCH_BYTES = 16 << 20
BUCKET_BYTES = 24 << 20
REQUESTS = 6 << 20                      # occurrences scored by one task, some batch more
FOLDS = 10
PLAN_ROWS = 1_000_000                   # a bucket's number of copies is broadcast up to this many buckets
_END = np.uint64(0xE4D)
SUMS = "t_context array<double>, c_context array<double>, root_customers double, root_tables double, tokens double, " \
       "vocabulary double"


# -- texts -> packed rows -----------------------------------------------------
def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, context, text) of every token, end tokens included."""
    data, begin = runs.join_texts(texts)
    data = runs.LOWER[data]
    starts, ends = runs.bounds(data, runs.WORD_BREAKS)
    words = runs.hashes(data, starts, ends)
    first = np.searchsorted(starts, begin)
    counts = np.diff(first) + 1
    total = int(counts.sum())
    upto = np.cumsum(counts)
    tokens = np.full(total, _END)
    inner = np.ones(total, bool)
    inner[upto - 1] = False
    tokens[inner] = words
    before = np.empty(total, np.uint64)
    before[1:] = tokens[:-1]
    before[upto - counts] = np.uint64(0)
    context = (runs.mix(before) % np.uint64(CONTEXTS)).astype(np.uint16)
    return tokens, context, np.repeat(np.arange(len(texts)), counts)


def _pack(*arrays: np.ndarray) -> bytes:
    out = []
    for a in arrays:
        raw = a.tobytes()
        out += [struct.pack("<q", len(raw)), raw]
    return b"".join(out)


def _unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for k in kinds:
        n = struct.unpack_from("<q", raw, at)[0]
        out.append(np.frombuffer(raw, k, n // np.dtype(k).itemsize, at + 8))
        at += 8 + n
    return out


def _varint(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as bytes, 255 marking those that follow in full."""
    return np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255].astype("<u4")


def _unvarint(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    out = small.astype(np.int64)
    out[small == 255] = large
    return out


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (runs.mix(tokens + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def batch_rows(found: tuple, trains: np.ndarray, buckets: int, occurrences: bool) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed statistics) of one batch, given ``tokens_of`` its texts."""
    tokens, context, text = found
    if not occurrences:
        own = trains[text]
        tokens, context, text = tokens[own], context[own], text[own]
    if not len(tokens):
        return
    key = bucket_of(tokens, buckets)
    order = np.lexsort((text, context, tokens, key)) if occurrences else np.lexsort((context, tokens, key))
    tokens, context, text, key = tokens[order], context[order], text[order], key[order]
    new_word = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    new_type = new_word | np.concatenate([[True], context[1:] != context[:-1]])
    types = np.flatnonzero(new_type)
    occurs = np.diff(np.append(types, len(tokens)))
    words = np.flatnonzero(new_word)
    of_word = np.diff(np.append(np.searchsorted(types, words), len(types)))
    cuts = np.flatnonzero(np.diff(key)) + 1
    for a, b in zip(np.concatenate([[0], cuts]), np.append(cuts, len(tokens))):
        w0, w1 = np.searchsorted(words, [a, b])
        t0, t1 = np.searchsorted(types, [a, b])
        packed = _pack(tokens[words[w0:w1]].astype("<u8"), *_varint(of_word[w0:w1]),
                       context[types[t0:t1]].astype("<u2"), *_varint(occurs[t0:t1]),
                       text[a:b].astype("<u2" if len(trains) <= 1 << 16 else "<u4") if occurrences else np.zeros(0, "<u2"))
        yield int(key[a]), packed


def _read_types(raw: bytes, wide: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, count) per type, and the texts of the occurrences."""
    words, s1, l1, context, s2, l2, text = _unpack(raw, "<u8", "u1", "<u4", "<u2", "u1", "<u4", "<u4" if wide else "<u2")
    return np.repeat(words, _unvarint(s1, l1)), context, _unvarint(s2, l2), text


# -- seating -------------------------------------------------------------------
@lru_cache(maxsize=4)
def log_stirling(discount: float) -> np.ndarray:
    """log S(c, t) for c, t up to EXACT: S(c+1, t) = S(c, t-1) + (c - discount t) S(c, t)."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(EXACT + 1)
    for c in range(EXACT):
        grow = c - discount * t
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(grow > 0, np.log(np.maximum(grow, 1e-300)) + out[c], -np.inf)
        out[c + 1] = np.logaddexp(stay, np.concatenate([[-np.inf], out[c, :-1]]))
    return out


def log_factorial(n: np.ndarray) -> np.ndarray:
    """log n!, by Stirling's series at n + 9."""
    y = np.asarray(n, float) + 9
    near = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return near - sum(np.log(y - k) for k in range(1, 9))


def _slope(p: np.ndarray, discount: float) -> np.ndarray:
    """-d/dp log F with F = 1 - (1 - exp(-p))**discount: the mean size of a table under the tilt p."""
    q = -np.expm1(-p)
    return discount * np.exp(-p) * q ** (discount - 1) / _share(p, discount)


def _share(p: np.ndarray, discount: float) -> np.ndarray:
    return -np.expm1(discount * np.log(-np.expm1(-p)))


def _halve(low: np.ndarray, high: np.ndarray, above: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """exp of the place in [low, high] where ``above`` turns false."""
    for _ in range(40):
        mid = (low + high) / 2
        right = above(np.exp(mid))
        low, high = np.where(right, mid, low), np.where(right, high, mid)
    return np.exp((low + high) / 2)


def log_compositions(c: np.ndarray, t: np.ndarray, near: np.ndarray, discount: float) -> np.ndarray:
    """log of the coefficient of z**c in (1 - (1 - z)**discount)**t, for c > EXACT.

    A row of t per c, within some five standard deviations of the number ``near``.
    Times c! / (t! discount**t) it is S(c, t).  The coefficient is the integral of
    exp(c p + t log F(p)) / (2 pi i) with z = exp(-p), along a path through the saddle
    point of ``near``: where that is far from the branch point p = 0 the vertical line,
    else a parabola around it that meets the axis at 10 / c or more.
    """
    c, near = c.astype(float), near.astype(float)
    at = _halve(np.log(10 / c), np.full(c.shape, math.log(30.0)), lambda p: near * _slope(p, discount) > c)
    spread = near * (_slope(at, discount) - _slope(at * 1.001, discount)) / (0.001 * at)
    straight = c * at >= 200
    reach = np.where(straight, np.minimum(math.pi, 9 / np.sqrt(np.maximum(spread, 1e-9))), np.sqrt(60 / (c * at)) + 0.3)
    u = reach[:, None] * (np.arange(NODES) + 0.5) / NODES
    v, line = at[:, None], straight[:, None]
    p = np.where(line, v + 1j * u, v * (1 + 1j * u) ** 2)
    turn = np.where(line, 1j, 2j * v * (1 + 1j * u))
    top = np.log(_share(at, discount))
    log_f = np.log(_share(p, discount)) - top[:, None]
    part = np.exp(c[:, None, None] * (p - v)[:, None, :] + t[:, :, None] * log_f[:, None, :])
    part = np.imag((part * turn[:, None, :]).sum(-1)) * (reach / (NODES * math.pi))[:, None]
    return (c * at)[:, None] + t * top[:, None] + np.log(np.maximum(part, 1e-300))


def sample_many(c: np.ndarray, x: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """``sample_tables`` for c > EXACT: the same law, its weights taken at CELLS + 1 places.

    The weights are log-concave in t.  A saddle point gives about their mode and spread; the
    places lie around it, some third of a standard deviation apart, and the logarithm runs
    straight between two of them (up to a spread of about three tables every t is a place).
    """
    rate = np.log(np.maximum(x, 1e-290)) - math.log(discount)

    def rise(p: np.ndarray) -> np.ndarray:
        return rate - np.log(c / _slope(p, discount)) + np.log(_share(p, discount))

    at = _halve(np.full(len(c), -80.0), np.full(len(c), math.log(30.0)), lambda p: rise(p) > 0)
    beside = at * 1.01
    mode, other = c / _slope(at, discount), c / _slope(beside, discount)
    with np.errstate(divide="ignore", invalid="ignore"):
        bend = np.where(other > mode, (rise(at) - rise(beside)) / (other - mode), np.inf)
    middle = np.clip(np.rint(mode), 1, c).astype(np.int64)
    step = np.maximum(1, np.ceil(11 / np.sqrt(np.maximum(bend, 1 / (middle + 1))) / CELLS)).astype(np.int64)
    t = np.maximum(1, middle - step * (CELLS // 2))[:, None] + step[:, None] * np.arange(CELLS + 1)
    w = t * rate[:, None] - log_factorial(t) + log_compositions(c, t, middle, discount)
    w = np.where(t > c[:, None], -np.inf, w)
    w -= w.max(1, keepdims=True)
    a, wide = np.maximum(w[:, :-1], -700.0), step[:, None].astype(float)
    s = (np.maximum(w[:, 1:], -700.0) - a) / wide
    s = np.where(np.abs(s) < 1e-9, 1e-9, s)
    mass = np.where(w[:, :-1] > -700, np.exp(a) * np.where(wide == 1, 1.0, np.expm1(s * wide) / np.expm1(s)), 0.0)
    upto = mass.cumsum(1)
    cell = np.minimum((upto < rng.random(len(c))[:, None] * upto[:, -1:]).sum(1), CELLS - 1)
    row = np.arange(len(c))
    s, wide = s[row, cell], wide[:, 0]
    inner = np.log1p(rng.random(len(c)) * np.expm1(s * wide)) / s
    return np.minimum(t[row, cell] + np.clip(inner, 0, wide - 1).astype(np.int64), c)


def sample_tables(c: np.ndarray, x: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """A number of tables for every dish with c customers and weight x for a new one."""
    t = np.minimum(c, 1).astype(np.int64)
    table = log_stirling(discount)
    few = np.flatnonzero((c > 1) & (c <= EXACT))
    order = few[np.argsort(c[few], kind="stable")]
    cuts = np.flatnonzero(np.diff(c[order])) + 1
    for part in np.split(order, cuts):
        n = int(c[part[0]]) if len(part) else 0
        for a in range(0, len(part), max(1, 2_000_000 // max(1, n))):
            some = part[a:a + max(1, 2_000_000 // n)]
            w = table[n, 1:n + 1] + np.arange(1, n + 1) * np.log(np.maximum(x[some], 1e-290))[:, None]
            w = np.exp(w - w.max(1, keepdims=True)).cumsum(1)
            t[some] = 1 + (w < rng.random(len(some))[:, None] * w[:, -1:]).sum(1)
    many = np.flatnonzero(c > EXACT)
    for a in range(0, len(many), 256):
        some = many[a:a + 256]
        t[some] = sample_many(c[some], x[some], discount, rng)
    return t


class Bucket:
    """The words of one bucket: types (word, context, customers) and their seating."""

    def __init__(self, words: np.ndarray, context: np.ndarray, count: np.ndarray) -> None:
        key, inverse = pd.factorize(words, sort=True)[::-1]
        order = np.lexsort((context, inverse))
        inverse, context, count = inverse[order], context[order], count[order]
        new = np.concatenate([[True], (inverse[1:] != inverse[:-1]) | (context[1:] != context[:-1])]) if len(order) \
            else np.zeros(0, bool)
        at = np.flatnonzero(new)
        self.words = key
        self.word = inverse[at]
        self.context = context[at].astype(np.int64)
        self.customers = np.add.reduceat(count, at) if len(at) else np.zeros(0, np.int64)
        self.tables = np.ones(len(at), np.int64)
        self.root_tables = np.ones(len(key), np.int64)
        self.root_customers = np.bincount(self.word, self.tables, len(key)).astype(np.int64)

    def seat(self, tables: np.ndarray, root_tables: np.ndarray) -> None:
        """The seating of a sample."""
        self.tables, self.root_tables = tables, root_tables
        self.root_customers = np.bincount(self.word, tables, len(self.words)).astype(np.int64)

    def sweep(self, sums: dict, rng: np.random.Generator) -> None:
        """One Gibbs sweep given the sums over all buckets."""
        g = rng.gamma(STRENGTH / DISCOUNT + np.asarray(sums["t_context"]))
        x = DISCOUNT * g[self.context] * self.root_probability(sums)[self.word]
        self.seat(sample_tables(self.customers, x, DISCOUNT, rng), self.root_tables)
        g0 = rng.gamma(ROOT_STRENGTH / ROOT_DISCOUNT + sums["root_tables"])
        x0 = np.full(len(self.words), ROOT_DISCOUNT * g0 / (sums["vocabulary"] + 1))
        self.root_tables = sample_tables(self.root_customers, x0, ROOT_DISCOUNT, rng)

    def root_probability(self, sums: dict) -> np.ndarray:
        return (self.root_customers - ROOT_DISCOUNT * self.root_tables + root_rest(sums)) \
            / (ROOT_STRENGTH + sums["root_customers"])

    def sums(self) -> tuple:
        return (np.bincount(self.context, self.tables, CONTEXTS).tolist(),
                np.bincount(self.context, self.customers, CONTEXTS).tolist(), float(self.root_customers.sum()),
                float(self.root_tables.sum()), float(self.customers.sum()), float(len(self.words)))


def root_rest(sums: dict) -> float:
    return (ROOT_STRENGTH + ROOT_DISCOUNT * sums["root_tables"]) / (sums["vocabulary"] + 1)


def sampled(bucket: Bucket, number: int, history: list[dict]) -> Iterator[Bucket]:
    """The bucket as it is, and after the sweeps that follow each known exchange."""
    rng = np.random.Generator(np.random.PCG64([17, number]))
    yield bucket
    for sums in history:
        for _ in range(SWEEPS):
            bucket.sweep(sums, rng)
        yield bucket


# -- Spark ---------------------------------------------------------------------
def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes], np.ndarray]]:
    """(ids, texts, whether each trains) of about BATCH_BYTES, the same on every run of the task."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(1).nbytes
        if size >= BATCH_BYTES:
            yield _gather(held)
            held, size = [], 0
    if held:
        yield _gather(held)


def _gather(held: list[pa.RecordBatch]) -> tuple[pa.Array, list[bytes], np.ndarray]:
    t = pa.Table.from_batches(held).combine_chunks()
    ids = t.column(0).combine_chunks()
    raw = [(x or "").encode() for x in t.column(1).to_pylist()]
    trains = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS != 0 for i in ids.to_pylist()], bool)
    return ids, raw, trains


def count_types(own: DataFrame, buckets: int) -> DataFrame:
    """(bucket, state, occurrences): the training types of every bucket, packed, and its tokens in all texts."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, trains in _batches(batches):
            found = tokens_of(texts)
            packed = dict(batch_rows(found, trains, buckets, False))
            all_of = np.bincount(bucket_of(found[0], buckets), minlength=buckets)
            some = np.flatnonzero(all_of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([packed.get(k) for k in some.tolist()], pa.binary()),
                 pa.array(all_of[some], pa.int64())], names=["bucket", "packed", "occurrences"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_read_types(p)[:3] for p in rows["packed"] if p is not None]
        b = Bucket(*(np.concatenate([p[i] for p in parts]) for i in range(3))) if parts else Bucket(*NO_TYPES)
        return pd.DataFrame({"bucket": [key[0]], "state": [_state(b, [])], "occurrences": [rows["occurrences"].sum()]})

    return durable(own.mapInArrow(send, "bucket int, packed binary, occurrences bigint").repartition(buckets, "bucket")
                   .groupBy("bucket").applyInPandas(merge, "bucket int, state binary, occurrences bigint"), "types")


NO_TYPES = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)


def _state(b: Bucket, seats: list[tuple]) -> bytes:
    """The types of a bucket and any samples of their (tables, tables in the parent)."""
    of_word = np.bincount(b.word, minlength=len(b.words))
    packed = [a for tables, root in seats for a in (*_varint(tables), *_varint(root))]
    return zlib.compress(_pack(b.words.astype("<u8"), *_varint(of_word), b.context.astype("<u2"), *_varint(b.customers),
                               *packed), 1)


def _bucket(state: bytes, seats: int = 0) -> tuple[Bucket, list[tuple]]:
    """What ``_state`` packed."""
    words, s1, l1, context, s2, l2, *packed = _unpack(
        zlib.decompress(state), "<u8", "u1", "<u4", "<u2", "u1", "<u4", *["u1", "<u4"] * (2 * seats))
    b = Bucket(np.repeat(words, _unvarint(s1, l1)), context, _unvarint(s2, l2))
    read = [_unvarint(packed[i], packed[i + 1]) for i in range(0, len(packed), 2)]
    return b, list(zip(read[::2], read[1::2]))


def exchange(types: DataFrame, history: list[dict], last: bool) -> tuple[dict, DataFrame]:
    """Sums over all buckets after the sweeps of the exchanges so far, and the table they come
    from: the last one holds the buckets with their last two samples."""
    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for number, state in zip(rows["bucket"], rows["state"]):
                seats = []
                for b in sampled(_bucket(state)[0], number, history):
                    seats.append((b.tables, b.root_tables))
                yield pd.DataFrame([(number, _state(b, seats[-2:]) if last else None, *b.sums())],
                                   columns=[c.split()[0] for c in schema.split(", ")])
    schema = f"bucket int, state binary, {SUMS}"
    parts = durable(types.select("bucket", "state").mapInPandas(local, schema), "sums")
    scalars = ["root_customers", "root_tables", "tokens", "vocabulary"]
    vectors = parts.select(F.posexplode(F.arrays_zip("t_context", "c_context")).alias("i", "z")) \
        .groupBy("i").agg(F.sum("z.t_context").alias("t"), F.sum("z.c_context").alias("c")).collect()
    out = parts.agg(*[F.coalesce(F.sum(s), F.lit(0.0)).alias(s) for s in scalars]).first().asDict()
    out["t_context"], out["c_context"] = np.zeros(CONTEXTS), np.zeros(CONTEXTS)
    for r in vectors:
        out["t_context"][r.i], out["c_context"][r.i] = r.t, r.c
    return out, parts


def score_types(b: Bucket, sums: dict, words: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Predictive probability of each (word, context) under one seating."""
    place = np.searchsorted(b.words, words)
    known = (place < len(b.words))
    known[known] = b.words[place[known]] == words[known]
    p = np.full(len(words), root_rest(sums) / (ROOT_STRENGTH + sums["root_customers"]))
    p[known] = b.root_probability(sums)[place[known]]
    key = b.word * CONTEXTS + b.context
    wanted = np.where(known, place, -1) * CONTEXTS + context
    at = np.minimum(np.searchsorted(key, wanted), max(0, len(key) - 1))
    hit = known & (key[at] == wanted) if len(key) else np.zeros(len(words), bool)
    own = np.zeros(len(words))
    own[hit] = b.customers[at[hit]] - DISCOUNT * b.tables[at[hit]]
    c, t = np.asarray(sums["c_context"])[context], np.asarray(sums["t_context"])[context]
    return (own + (STRENGTH + DISCOUNT * t) * p) / (STRENGTH + c)


def language_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    few_arrow_rows(spark)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(8, -(-size // BUCKET_BYTES))
    types = count_types(own, buckets)
    history, seated = [], types
    for i in range(EXCHANGES + 1):
        sums, seated = exchange(types, history, i == EXCHANGES)
        history.append(sums)
    tokens, vocabulary = history[0]["tokens"], history[0]["vocabulary"]
    kind = own.schema["doc_id"].dataType.simpleString()
    log_all = math.log10(max(1.0, tokens) + 0.1 * (vocabulary + 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (ids, texts, trains) in enumerate(_batches(batches)):
            name, found = f"{TaskContext.get().partitionId()}-{number}", tokens_of(texts)
            rows = [(-1, _pack_ids(ids, trains, np.bincount(found[2], minlength=len(texts))))]
            rows += batch_rows(found, trains, buckets, True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int32()), pa.array([name] * len(rows)),
                 pa.array([len(texts) > 1 << 16] * len(rows)), pa.array([p for _, p in rows], pa.binary())],
                names=["bucket", "batch", "wide", "packed"])

    columns = ["batch", "ids", "packed"]

    def score(key: tuple, rows: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:      # the texts of a batch, on their way
            return pd.DataFrame([(b, True, p) for b, p in zip(rows["batch"], rows["packed"])], columns=columns)
        if not len(rows):
            return pd.DataFrame([], columns=columns)
        b, seats = _bucket(state["state"].iloc[0], 2) if len(state) else (Bucket(*NO_TYPES), [(np.zeros(0, np.int64),) * 2] * 2)
        of_word = np.bincount(b.word, b.customers, len(b.words))
        out = []
        for batch, wide, raw in zip(rows["batch"], rows["wide"], rows["packed"]):
            words, context, count, at = _read_types(raw, wide)
            context = context.astype(np.int64)
            # two last samples: after the sweeps of all exchanges but the last, and of all
            p = np.zeros(len(words))
            for (tables, root), sums in zip(seats, history[-2:]):
                b.seat(tables, root)
                p += score_types(b, sums, words, context) / len(seats)
            c = np.zeros(len(words))
            place = np.searchsorted(b.words, words)
            hit = place < len(b.words)
            hit[hit] = b.words[place[hit]] == words[hit]
            c[hit] = of_word[place[hit]]
            n = int(at.max()) + 1
            s = np.bincount(at, np.repeat(np.log10(p), count), n)
            base = np.bincount(at, np.repeat(np.log10(c + 0.1), count), n)
            known = np.bincount(at, np.repeat(c > 0, count), n)
            some = np.unique(at)
            out.append((batch, False, _pack(some.astype("<u4"), s[some], base[some], known[some].astype("<u4"))))
        return pd.DataFrame(out, columns=columns)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        ids, held_out, n_tokens = _unpack_ids(next(p for own, p in zip(rows["ids"], rows["packed"]) if own))
        s, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for packed in (p for own, p in zip(rows["ids"], rows["packed"]) if not own):
            at, x, y, z = _unpack(packed, "<u4", "<f8", "<f8", "<u4")
            s[at] += x
            base[at] += y
            known[at] += z
        return pd.DataFrame({
            "doc_id": pd.Series(ids, dtype=object), "held_out": held_out, "n_tokens": n_tokens, "n_known": known,
            "train_tokens": int(tokens), "base_score": base - n_tokens * log_all, "score": s})

    # a bucket's state is copied once per REQUESTS of its occurrences, and its batches are dealt over the copies
    copies = F.coalesce(F.expr(f"(occurrences + {REQUESTS} - 1) div {REQUESTS}"), F.lit(1))
    plan = types.select("bucket", copies.cast("int").alias("copies"))
    requests = own.mapInArrow(send, "bucket int, batch string, wide boolean, packed binary") \
        .join(small_side(plan, PLAN_ROWS), "bucket", "left") \
        .withColumn("copy", F.pmod(F.hash("batch"), F.coalesce("copies", F.lit(buckets)))).drop("copies")
    copied = seated.select("bucket", "state").join(plan, "bucket") \
        .select("bucket", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "state")
    partial = requests.repartition(buckets, "bucket", "copy").groupBy("bucket", "copy") \
        .cogroup(copied.repartition(buckets, "bucket", "copy").groupBy("bucket", "copy")) \
        .applyInPandas(score, "batch string, ids boolean, packed binary")
    return partial.groupBy("batch").applyInPandas(
        add, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
             "score double")


def _pack_ids(ids: pa.Array, trains: np.ndarray, n_tokens: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    rows = pa.RecordBatch.from_arrays([ids, pa.array(~trains), pa.array(n_tokens, pa.int64())], names=["id", "held", "n"])
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpack_ids(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    t = pa.ipc.open_stream(raw).read_all()
    return t.column(0).to_pylist(), t.column(1).to_numpy(), t.column(2).to_numpy()
