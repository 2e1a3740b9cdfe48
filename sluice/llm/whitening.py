"""Whitening of embeddings: projection on the leading eigenvectors of their covariance, scaled to unit variance.

The sums per dimension and the covariance are Spark aggregates of per-task numpy blocks; the driver holds one d x d
matrix (d: dimensions of a vector, whatever the number of rows). Its eigenvectors are found by Householder
tridiagonalisation, bisection on Sturm counts and inverse iteration, and sent to every task for the projection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Integer entries are kept within +-LARGEST, so that they fit a long.
LARGEST = 1 << 61
#: Rows that numpy works on at once.
BLOCK = 4096
#: Eigenvalues below this share of the largest are rounding noise of a matrix without full rank.
NOISE = 1e-12


# eigenvectors of a symmetric matrix

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, unit reflectors) of Q' a Q, Q being the product of the Householder reflections."""
    a, d, reflectors = a.copy(), len(a), []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        largest = np.abs(v).max()
        if largest == 0:
            reflectors.append(np.zeros(len(v)))
            continue
        v /= largest
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        below = a[k + 1 :, k]
        below -= 2 * v * (v @ below)
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each x: the negative pivots of T - x."""
    least = np.finfo(float).tiny * max(1.0, float(np.max(off * off, initial=0)))
    q = diagonal[0] - x
    below = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diagonal[i] - x - off[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    radius = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    edge = 1e-9 + 1e-9 * np.abs(diagonal).max()
    low = np.full(k, (diagonal - radius).min() - edge)
    high = np.full(k, (diagonal + radius).max() + edge)
    place = len(diagonal) - 1 - np.arange(k)  # the j-th largest has so many eigenvalues below it
    while True:
        mid = low + (high - low) / 2
        open_ = (mid > low) & (mid < high)
        if not open_.any():
            return mid
        above = sturm_count(diagonal, off, mid) <= place
        low, high = np.where(open_ & above, mid, low), np.where(open_ & ~above, mid, high)


def _shifted_solve(diagonal: np.ndarray, off: np.ndarray, x: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """(T - x)^-1 b by elimination with row exchanges; a zero pivot becomes ``tiny``."""
    n, b = len(diagonal), b.copy()
    u0, u1, u2 = diagonal - x, np.append(off, 0.0), np.zeros(n)
    for i in range(n - 1):
        below, pivot = off[i], u0[i]
        if abs(below) > abs(pivot):
            u0[i], u1[i], u2[i], u0[i + 1], u1[i + 1] = below, u0[i + 1], u1[i + 1], u1[i], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
            factor = pivot / below
            u0[i + 1] -= factor * u1[i]
            u1[i + 1] -= factor * u2[i]
        else:
            u0[i] = pivot if abs(pivot) > tiny else tiny
            factor = below / u0[i]
            u0[i + 1] -= factor * u1[i]
        b[i + 1] -= factor * b[i]
    if abs(u0[-1]) < tiny:
        u0[-1] = tiny
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            b[i] -= u1[i] * b[i + 1]
        if i + 2 < n:
            b[i] -= u2[i] * b[i + 2]
        b[i] /= u0[i]
        if abs(b[i]) > 1e100:
            b /= 1e100
    return b


def leading_vectors(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the k largest eigenvalues of symmetric ``a``, falling."""
    scale = np.abs(a).max() if a.size else 0.0
    if scale == 0 or not k:
        return np.zeros(k), np.eye(len(a), k)
    diagonal, off, reflectors = tridiagonal(a / scale)
    values = leading_values(diagonal, off, k)
    norm = np.abs(diagonal).max() + np.abs(off).max(initial=0)
    tiny, near, draw = np.finfo(float).eps * norm, 1e-3 * norm, np.random.default_rng(0)
    vectors, first, shift = np.zeros((len(a), k)), 0, np.inf
    for j in range(k):
        if j and values[j - 1] - values[j] > near:
            first = j  # a new cluster
        shift = min(values[j], shift - 2 * tiny) if j > first else values[j]  # equal ones are told apart
        x = draw.standard_normal(len(a))
        for _ in range(6):
            for _ in range(2):  # twice is enough
                x -= vectors[:, first:j] @ (vectors[:, first:j].T @ x)
            x /= np.linalg.norm(x)
            before, x = x, _shifted_solve(diagonal, off, shift, x, tiny)
            x /= np.linalg.norm(x)
            if min(np.abs(x - before).max(), np.abs(x + before).max()) < 1e-15:
                break
        for _ in range(2):
            x -= vectors[:, first:j] @ (vectors[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        vectors[:, j] = x
    for i in range(len(reflectors) - 1, -1, -1):  # back to the given coordinates
        v = reflectors[i]
        vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    return np.einsum("ij,ij->j", vectors, a @ vectors), vectors


# passes over the rows

def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(first column, rows of integer entries); every vector has d finite entries."""
    for b in batches:
        for at in range(0, len(b), BLOCK):
            part = b.slice(at, BLOCK)
            c = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), d)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(SCALE * c), -LARGEST, LARGEST)
            yield part.column(0), x.astype(np.int64) + OFFSET


def _wide(x: np.ndarray, rows: int) -> np.ndarray:
    """``x`` such that sums over ``rows`` entries are exact: Python integers if longs could overflow."""
    return x if int(np.abs(x).max(initial=0)) * rows < 1 << 62 else x.astype(object)


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for ids, x in _blocks(batches, d):
            n += len(ids)
            total = [a + int(b) for a, b in zip(total, _wide(x, len(ids)).sum(0))]
        if n:
            columns = [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(total, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "s"])
    return run


class Centre:
    """Exact centring: S / n is ``whole`` + ``rest`` / n with integers of any size."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - S)^2, exact."""
        y = x - self.whole
        if ((int(np.abs(y).max(initial=0)) + 1) * self.n) ** 2 * x.shape[1] >= 1 << 63:
            y = y.astype(object)
        u = y * self.n - self.rest
        return (u * u).sum(1)


def _products(d: int, centre: Centre, mean: np.ndarray | None, basis: np.ndarray | None):
    """Sums of products of the centred entries, or of their projections less ``mean``: the upper triangle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for _, x in _blocks(batches, d):
            z = centre.centred(x)
            if basis is not None:
                z = z @ basis - mean
            total = total + z.T @ z
        if not np.isscalar(total):
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])
    return run


def _projected_sums(d: int, centre: Centre, basis: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(basis.shape[1])
        for _, x in _blocks(batches, d):
            total += (centre.centred(x) @ basis).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "s"])
    return run


def _covariance(rows: DataFrame, n: int, size: int, task) -> np.ndarray:
    out = np.zeros((size, size))
    for r in rows.mapInArrow(task, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # size^2 / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def _whitened(d: int, centre: Centre, basis: np.ndarray, explained: np.ndarray, error: float):
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, d):
            rows = len(ids)
            each = pa.array(np.repeat(np.arange(rows), k))
            own = pa.array([int(v) if abs(int(v)) < 10**38 else None for v in centre.deviations(x)], pa.decimal128(38, 0))
            columns = [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, centre.n)),
                       own.take(each), pa.array((centre.centred(x) @ basis).ravel()), pa.array(np.tile(explained, rows)),
                       pa.array(np.full(rows * k, error))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per kept vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries c count as x = floor(64 * c) + 1000000 (held within +-2^61). Rows whose vector is null or has null, NaN or
    infinite entries are dropped; so are those whose length is not the most frequent one among the others (the larger
    one if tied), as they lie in another space. Null and repeated ids are kept as they are, a repeated row counts as
    often as it is there, extra columns are not read, and an empty table gives an empty result. ``n`` is the number of
    kept vectors; ``deviation`` (decimal, null beyond 38 digits) the exact sum over dimensions of (n * x - S)^2;
    ``explained`` the component's share of the variance. Components whose variance is nothing but rounding (constant or
    dependent dimensions, one row) cannot be scaled and are left out. ``identity_error`` is measured on the result: the
    largest entry of its covariance less the identity. Sums are exact; products are centred first.
    """
    v = F.col("v")
    sound = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(v.isNotNull() & sound)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    fields = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), " \
        "whitened double, explained double, identity_error double"
    if not d:
        return rows.sparkSession.createDataFrame([], fields)
    rows = rows.filter(F.size("v") == d)
    sums = rows.mapInArrow(_sums(d), "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    n, centre = sums[0]["n"], Centre(sums[0]["n"], [int(r["s"]) for r in sums])
    covariance = _covariance(rows, n, d, _products(d, centre, None, None))
    values, axes = leading_vectors(covariance, min(components, d))
    real = values > NOISE * max(values[0], 0)
    values, axes = values[real], axes[:, real]
    if not len(values):
        return rows.sparkSession.createDataFrame([], fields)
    basis, explained = axes / np.sqrt(values), values / np.trace(covariance)
    mean = np.zeros(len(values))
    for r in rows.mapInArrow(_projected_sums(d, centre, basis), "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        mean[r["i"]] = r["s"] / n
    error = float(np.abs(_covariance(rows, n, len(values), _products(d, centre, mean, basis)) - np.eye(len(values))).max())
    return rows.mapInArrow(_whitened(d, centre, basis, explained, error), fields)
