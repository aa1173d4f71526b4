"""Whitening of embeddings by the leading eigenvectors of their covariance.

An entry c of a vector becomes the whole number x = floor(64 c) + 1,000,000.
The fit takes all usable vectors, in three passes that shuffle only sums:

1. count n and the sums S per dimension, exactly (two 64-bit halves);
2. covariance: with S = q n + r per dimension, x - S/n = (x - q) - r/n loses
   nothing to the large common offset; tasks add up products of the centred
   vectors, Spark adds the tasks' matrices;
3. the same for the whitened vectors: how far their covariance is from I.

The eigenproblem of the covariance (dimensions x dimensions, whatever the rows)
is solved on the driver: Householder reflections make it tridiagonal, Sturm
counts bisect the leading eigenvalues, inverse iteration with
reorthogonalisation inside clusters gives their vectors, the reflections take
them back.  The projection (dimensions x components) is broadcast.

Defined results: a row goes if its vector is null, empty, or holds a null or
non-finite entry, or if its length is not the most common one (of equally common
ones the longer): it has no place in the other rows' matrix.  Whole numbers
beyond 2^52 in size count as 2^52.  Components are numbered by falling
eigenvalue; of the two signs the one whose largest coordinate is positive is
taken.  Directions without variance (eigenvalue at rounding level) cannot be
scaled to 1 and are left out, so equal vectors or a single one give no rows.
``deviation`` is null where a long cannot hold it.  Null and repeated ids are
rows like others, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import durable

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Largest size of a whole number.
LARGEST = 2**52
#: Rows of a task worked on at a time.
TILE = 2048
_LOW = 26

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


# -- eigenproblem ------------------------------------------------------------
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and the Householder vectors of a symmetric matrix."""
    a, reflectors = np.array(a, float), []
    size = len(a)
    off = np.zeros(max(0, size - 1))
    for j in range(size - 2):
        column = a[j + 1:, j].copy()
        scale = np.abs(column).max()
        if scale == 0 or not np.any(column[1:]):
            off[j] = column[0]
            reflectors.append(None)
            continue
        column /= scale
        length = np.sqrt(column @ column)
        alpha = -np.copysign(length, column[0])
        v = column
        v[0] -= alpha
        v /= np.sqrt(v @ v)
        rest = a[j + 1:, j + 1:]
        p = rest @ v
        p -= (v @ p) * v
        rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        off[j] = alpha * scale
        reflectors.append(v)
    if size > 1:
        off[size - 2] = a[size - 1, size - 2]
    return np.diag(a).copy(), off, reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """Sturm counts: eigenvalues below each of the points ``at``."""
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        q = d - at - e * e / np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, bisected until no double lies between the bounds."""
    around = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low, high = (diagonal - around).min(), (diagonal + around).max()
    size = max(abs(low), abs(high))
    tiny = max(np.finfo(float).eps ** 2 * size, np.finfo(float).tiny)
    rank = len(diagonal) - 1 - np.arange(k)
    lo, hi = np.full(k, low - 1e-12 * size), np.full(k, high + 1e-12 * size)
    while True:
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi) & (hi - lo > np.finfo(float).eps * size / 8)
        if not open_.any():
            return mid
        below = count_below(diagonal, off, mid, tiny) <= rank
        lo, hi = np.where(open_ & below, mid, lo), np.where(open_ & ~below, mid, hi)


def _solve(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, right: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = right for all shifts at once: elimination with row exchanges."""
    size = len(diagonal)
    x = right.copy()
    first, second, third = (np.zeros_like(right) for _ in range(3))
    d, e = diagonal[0] - shifts, np.full(len(shifts), off[0] if size > 1 else 0.0)
    f = np.zeros(len(shifts))
    for i in range(size - 1):
        below_d, below_e = diagonal[i + 1] - shifts, off[i + 1] if i + 2 < size else 0.0
        lower = off[i]
        swap = np.abs(d) < abs(lower)
        first[i] = np.where(swap, lower, d)
        second[i] = np.where(swap, below_d, e)
        third[i] = np.where(swap, below_e, f)
        pivot = np.where(np.abs(first[i]) < tiny, tiny, first[i])
        first[i] = pivot
        factor = np.where(swap, d, lower) / pivot
        top, under = np.where(swap, x[i + 1], x[i]), np.where(swap, x[i], x[i + 1])
        x[i], x[i + 1] = top, under - factor * top
        d, e, f = (np.where(swap, e, below_d) - factor * second[i],
                   np.where(swap, f, below_e) - factor * third[i], np.zeros(len(shifts)))
    first[size - 1] = np.where(np.abs(d) < tiny, tiny, d)
    for i in range(size - 1, -1, -1):
        value = x[i]
        if i + 1 < size:
            value = value - second[i] * x[i + 1]
        if i + 2 < size:
            value = value - third[i] * x[i + 2]
        x[i] = value / first[i]
        # keep growth inside a double's range
        x /= np.maximum(1.0, np.abs(x[i]) / 1e150)
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors by inverse iteration; eigenvalues closer than a thousandth of
    the norm form a cluster, whose vectors are made orthogonal again in every round."""
    size, k = len(diagonal), len(values)
    norm = (np.abs(diagonal) + np.abs(np.append(off, 0)) + np.abs(np.append(0, off))).max()
    eps = np.finfo(float).eps
    # equal eigenvalues are moved apart by rounding errors
    shifts = values.copy()
    for i in range(1, k):
        shifts[i] = min(shifts[i], shifts[i - 1] - 4 * eps * norm)
    cluster = np.concatenate([[0], np.cumsum(values[:-1] - values[1:] > 1e-3 * norm)])
    x = np.random.Generator(np.random.PCG64(7)).standard_normal((size, k))
    for _ in range(rounds):
        x = _solve(diagonal, off, shifts, x / np.sqrt((x * x).sum(0)), eps * norm)
        x /= np.abs(x).max(0)
        for i in range(k):
            before = x[:, :i][:, cluster[:i] == cluster[i]]
            for _ in range(2):
                x[:, i] -= before @ (before.T @ x[:, i])
            x[:, i] /= np.sqrt(x[:, i] @ x[:, i])
    return x


def leading(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The (at most) ``k`` largest eigenvalues above rounding level, and their unit vectors as columns."""
    size = len(covariance)
    diagonal, off, reflectors = tridiagonal(covariance)
    if not np.any(diagonal):
        return np.zeros(0), np.zeros((size, 0))
    values = leading_values(diagonal, off, min(k, size))
    values = values[values > 8 * size * np.finfo(float).eps * values[0]]
    vectors = leading_vectors(diagonal, off, values)
    for j in range(len(reflectors) - 1, -1, -1):
        v = reflectors[j]
        if v is not None:
            vectors[j + 1:] -= 2 * np.outer(v, v @ vectors[j + 1:])
    vectors /= np.sqrt((vectors * vectors).sum(0))
    largest = np.abs(vectors).argmax(0)
    return values, vectors * np.sign(vectors[largest, np.arange(len(values))])


# -- rows ------------------------------------------------------------------
def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of vectors: all entries (null: NaN), the start of each row, and its
    length (0: unusable)."""
    offsets = np.asarray(column.offsets)
    entries = np.asarray(column.values.to_numpy(zero_copy_only=False), float)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    length = np.diff(offsets)
    good = np.asarray(column.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    return entries, offsets[:-1], np.where(good, length, 0)


def whole(entries: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The whole numbers of the rows at ``starts``, as a matrix."""
    with np.errstate(over="ignore"):
        x = np.floor(SCALE * entries[starts[:, None] + np.arange(size)])
    return np.clip(x, -LARGEST, LARGEST).astype(np.int64) + OFFSET


def _tiles(batch: pa.RecordBatch, size: int):
    """(row numbers, whole numbers) of the rows of this length, some at a time."""
    entries, starts, length = usable(batch.column(1))
    rows = np.flatnonzero(length == size)
    for lo in range(0, len(rows), TILE):
        part = rows[lo:lo + TILE]
        yield part, whole(entries, starts[part], size)


def _sums(vectors: DataFrame) -> DataFrame:
    """Per task and length: rows and sums, the whole numbers cut into high and low bits."""
    def run(batches):
        total: dict[int, list] = {}
        for batch in batches:
            entries, starts, length = usable(batch.column(1))
            for size in np.unique(length[length > 0]).tolist():
                rows = np.flatnonzero(length == size)
                one = total.setdefault(size, [0, np.zeros(size, np.int64), np.zeros(size, np.int64)])
                for lo in range(0, len(rows), TILE):
                    x = whole(entries, starts[rows[lo:lo + TILE]], size)
                    one[0] += len(x)
                    one[1] += (x >> _LOW).sum(0)
                    one[2] += (x & ((1 << _LOW) - 1)).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([t[0] for t in total.values()], pa.int64()),
             pa.array([t[1] for t in total.values()], pa.list_(pa.int64())),
             pa.array([t[2] for t in total.values()], pa.list_(pa.int64()))], names=["size", "n", "high", "low"])
    return vectors.mapInArrow(run, "size long, n long, high array<long>, low array<long>")


def _matrix_sum(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the tasks' matrices (column ``values``, rows one after another)."""
    out = np.zeros(int(np.prod(shape)))
    for r in parts.select(F.posexplode("values").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(shape)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform.  S = base * n + rest per dimension."""

    n: int
    base: list[int]
    rest: list[int]
    #: Dimensions x components, already divided by the roots of the eigenvalues.
    projection: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.base, np.int64)) - np.array(self.rest, float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2; null from 2^63."""
        y = x - np.array(self.base, np.int64)
        rough = ((self.n * self.centred(x)) ** 2).sum(1)
        # modulo 2^64 the sum is right wherever it fits
        wrapped = ((np.int64(self.n) * y - np.array(self.rest, np.int64)) ** 2).sum(1)
        out = np.where(rough < 2.0**63, wrapped, 0).tolist()
        for i in np.flatnonzero(rough >= 0.999 * 2.0**63).tolist():
            exact = sum((self.n * int(v) - r) ** 2 for v, r in zip(y[i], self.rest)) if rough[i] < 1.001 * 2.0**63 else 2**63
            out[i] = exact if exact < 2**63 else None
        return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from all usable rows of ``vectors`` (an id and an array); None without any."""
    sc = vectors.sparkSession.sparkContext
    sums = durable(_sums(vectors), "sums")
    common = sums.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return None
    size, n = common["size"], common["n"]
    base, rest = [0] * size, [0] * size
    for r in (sums.where(F.col("size") == size).select(F.posexplode(F.arrays_zip("high", "low")).alias("at", "v"))
              .groupBy("at").agg(F.sum("v.high").alias("high"), F.sum("v.low").alias("low")).collect()):
        base[r["at"]], rest[r["at"]] = divmod((r["high"] << _LOW) + r["low"], n)
    centre = Whitening(n, base, rest, np.zeros((size, 0)), np.zeros(0))
    shared = sc.broadcast(centre)

    def products(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _tiles(batch, size):
                d = shared.value.centred(x)
                total += d.T @ d
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["values"])

    covariance = _matrix_sum(vectors.mapInArrow(products, "values array<double>"), (size, size)) / n
    covariance = (covariance + covariance.T) / 2
    values, axes = leading(covariance, components)
    return Whitening(n, base, rest, axes / np.sqrt(values), values / np.trace(covariance) if len(values) else values)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the whitened rows' covariance minus the identity."""
    size, k = model.projection.shape
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def products(batches):
        # a last row holds the sums, for the mean
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in _tiles(batch, size):
                w = shared.value.centred(x) @ shared.value.projection
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["values"])

    total = _matrix_sum(vectors.mapInArrow(products, "values array<double>"), (k + 1, k)) / model.n
    # rows are centred already: the mean is at rounding level, so nothing cancels here
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


def transform(vectors: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row per usable vector and component."""
    size, k = model.projection.shape
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            ids = batch.column(0)
            for rows, x in _tiles(batch, size):
                whitened = model.centred(x) @ model.projection
                each = np.repeat(np.arange(len(rows)), k)
                component = np.tile(np.arange(k), len(rows))
                deviation = pa.array(model.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows[each])), pa.array(component + 1, pa.int32()),
                     pa.array(np.full(len(each), model.n), pa.int64()), deviation.take(pa.array(each)),
                     pa.array(whitened.ravel()), pa.array(model.explained[component]),
                     pa.array(np.full(len(each), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, RESULT)


def whiten(table: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Fit on all usable rows and return them whitened (see the module)."""
    vectors = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    model = fit(vectors, components)
    if model is None or not model.projection.shape[1]:
        return table.sparkSession.createDataFrame([], RESULT)
    return transform(vectors, model, identity_error(vectors, model))
