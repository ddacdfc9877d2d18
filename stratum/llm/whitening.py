"""Embedding whitening: vectors projected on unit variance along their main axes.

Every usable vector is put on an integer grid, ``x = floor(scale * c) + shift``,
so that all sums over the corpus are exact whatever the order of the tasks:

1. one pass gives the number of vectors and the sum of each dimension;
2. a second one the scatter of ``y = x - m``, m being the integer nearest to the
   mean: vectors are centred before they are multiplied, and what rounding the
   mean has left over is taken off exactly, in integers, on the driver;
3. the driver factors that one (dimensions x dimensions) matrix: Cholesky with
   complete (diagonal) pivoting, then one-sided Jacobi rotations on the
   triangular factor itself until its columns are orthogonal.  The norms of the
   rotated columns are the roots of the eigenvalues, the normalised columns the
   components.  The scatter is never diagonalised, so small eigenvalues keep
   their relative accuracy.  Arithmetic is ``numpy.longdouble``;
4. a third pass projects, and the covariance of what it wrote is measured.

Tasks send one partial matrix per partition, added up by (row, column) in Spark;
the driver holds one matrix of the dimension, never a vector of the table.

Defined cases: a row whose vector is null, or holds a null, an infinite or a NaN
entry, or one whose grid value reaches 2**52, is left out; so is a vector whose
length is not the most frequent one (ties: the longer).  Null or repeated ids
and repeated rows are rows like any other.  Components of an eigenvalue that is
zero to working precision have no direction: ``explained`` is 0 there (null when
all vectors are equal) and ``whitened`` null.  No usable vector: an empty result.  Eigenvalues that are equal leave
their components free within the common plane.  A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import map_batches, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: grid values from here on are not exact in a double
_LIMIT = 2.0 ** 52
_LONG = 2 ** 63


# ------------------------------------------------------------------ linear algebra
def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """G (n x rank) with ``G @ G.T == a``: lower triangular up to the order of its
    rows, columns in the order of the pivots."""
    a = np.array(a, np.longdouble)
    n = len(a)
    left = a.diagonal().copy()
    floor = n * np.finfo(np.float64).eps * max(left.max(initial=0), 0)
    g = np.zeros((n, n), np.longdouble)
    for k in range(n):
        p = int(np.argmax(left))
        if left[p] <= floor:
            return g[:, :k]
        g[:, k] = (a[:, p] - g[:, :k] @ g[p, :k]) / np.sqrt(left[p])
        left -= g[:, k] ** 2
        left[p] = -1  # done
    return g


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs (round-robin)."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if a < n and b < n]
        out.append((np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) of ``g @ g.T`` and their unit eigenvectors as columns."""
    g = np.array(g, np.longdouble)
    tolerance = np.finfo(np.longdouble).eps * max(g.shape[0], 1)
    rounds = _rounds(g.shape[1])
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            u, v = g[:, p], g[:, q]
            a, b, c = (u * u).sum(0), (v * v).sum(0), (u * v).sum(0)
            cosine = np.abs(c) / np.sqrt(a * b)
            turn = cosine > tolerance
            if not turn.any():
                continue
            worst = max(worst, float(cosine.max()))
            zeta = (b - a) / np.where(turn, 2 * c, 1)
            t = np.where(zeta >= 0, 1, -1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0)
            cs = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = cs * u - cs * t * v, cs * t * u + cs * v
        if worst <= tolerance:
            break
    squares = (g * g).sum(0)
    order = np.argsort(-squares, kind="stable")
    return squares[order], g[:, order] / np.sqrt(squares[order])


# ------------------------------------------------------------------ vectors of a batch
def _grid(column: pa.Array, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grid values of all rows, row offsets, rows that are usable)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry becomes NaN
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values * scale)
        bad = ~(np.abs(x) < _LIMIT)
    until = np.concatenate([[0], np.cumsum(bad)])
    usable = (until[offsets[1:]] == until[offsets[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    return np.where(bad, 0, x).astype(np.int64) + shift, offsets, usable


def _matrix(column: pa.Array, scale: int, shift: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows used, their grid vectors) for the vectors of ``dims`` entries."""
    x, offsets, usable = _grid(column, scale, shift)
    rows = np.flatnonzero(usable & (np.diff(offsets) == dims))
    return rows, x[offsets[rows][:, None] + np.arange(dims)]


def _products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` exactly, as Python integers where a double would round."""
    top = int(np.abs(y).max(initial=0))
    if len(y) * top * top < 2 ** 53:
        m = y.astype(np.float64)
        return (m.T @ m).astype(np.int64).astype(object)
    m = y.astype(object)
    return m.T @ m


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


@dataclass(frozen=True)
class Whitening:
    """What a fit has learnt; components are the columns of ``axes``."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace else None for e in self.eigenvalues]


def fit(vectors: DataFrame, vector_col: str, scale: int = SCALE, shift: int = SHIFT,
        components: int = COMPONENTS) -> Whitening | None:
    """Mean, leading components and eigenvalues of all usable vectors."""
    vectors = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, offsets, usable = _grid(batch.column(0), scale, shift)
            lengths = np.diff(offsets)
            for d in map(int, np.unique(lengths[usable])):
                rows = np.flatnonzero(usable & (lengths == d))
                m = x[offsets[rows][:, None] + np.arange(d)]
                top = int(np.abs(m).max(initial=0))
                s = m.sum(0).astype(object) if top * len(rows) < _LONG else m.astype(object).sum(0)
                count[d] = count.get(d, 0) + len(rows)
                total[d] = total.get(d, 0) + s
        for d, n in count.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()),
                 _decimals([n, *(total[d].tolist() if d else [])])], ["dims", "i", "total"])

    parts = stored(map_batches(vectors, sums, "dims int, i int, total decimal(38,0)"), "whitening-sums")
    totals = parts.groupBy("dims", "i").agg(F.sum("total").alias("total"))
    top = totals.filter("i = -1").orderBy(F.desc("total"), F.desc("dims")).first()
    if top is None:
        return None
    dims, n = top.dims, int(top.total)
    s = [int(r.total) for r in totals.filter((F.col("dims") == dims) & (F.col("i") >= 0)).orderBy("i").collect()]
    middle = [(2 * t + n) // (2 * n) for t in s]
    m = np.array(middle, np.int64)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            total += _products(_matrix(batch.column(0), scale, shift, dims)[1] - m)
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          _decimals([int(v) for v in total[i, j]])], ["i", "j", "total"])

    # n^2 times the covariance, exactly: what m misses of the mean comes off again
    a = np.zeros((dims, dims), np.longdouble)
    rest = [t - n * k for t, k in zip(s, middle)]
    cells = map_batches(vectors, scatter, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    for r in cells.collect():
        v = Fraction(n * int(r.total) - rest[r.i] * rest[r.j], n * n)
        high = float(v)
        a[r.i, r.j] = a[r.j, r.i] = np.longdouble(high) + np.longdouble(float(v - Fraction(high)))
    e, u = one_sided_jacobi(pivoted_cholesky(a))
    k = min(components, dims)
    e, u = e[:k], u[:, :k]
    flat = k - len(e)
    return Whitening(n, s, np.concatenate([e, np.zeros(flat)]).astype(np.float64),
                     np.concatenate([u, np.zeros((dims, flat))], axis=1).astype(np.float64), float(a.trace()))


def project(vectors: DataFrame, model: Whitening, id_col: str, vector_col: str,
            scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, deviation, whitened array) of every usable vector."""
    n, sums, dims = model.n, model.sums, len(model.sums)
    middle = [(2 * t + n) // (2 * n) for t in sums]
    m, rest = np.array(middle, np.int64), [t - n * k for t, k in zip(sums, middle)]
    known = model.eigenvalues > 0
    to = model.axes[:, known] / np.sqrt(model.eigenvalues[known])
    slots = np.flatnonzero(known)
    k = len(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _matrix(batch.column(1), scale, shift, dims)
            y = x - m
            if n * (int(np.abs(y).max(initial=0)) + 1) < 2 ** 62:
                d = n * y - np.array(rest, np.int64)
            else:
                d = n * y.astype(object) - np.array(rest, object)
            centred = d.astype(np.float64)
            if (centred ** 2).sum(1).max(initial=0) < 2.0 ** 62:
                deviation = pa.array((d * d).sum(1).astype(np.int64), pa.int64())
            else:
                exact = (d.astype(object) ** 2).sum(1)
                deviation = pa.array([int(v) if v < _LONG else None for v in exact], pa.int64())
            w = np.zeros((len(rows), k))
            w[:, slots] = (centred / n) @ to
            values = pa.array(w.ravel(), mask=np.tile(~known, len(rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), deviation,
                 pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k), values)],
                ["id", "deviation", "whitened"])

    pairs = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    schema = T.StructType([pairs.schema["id"], T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return map_batches(pairs, run, schema)


def identity_error(projected: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    known = np.flatnonzero(model.eigenvalues > 0)
    k = len(model.eigenvalues)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(known), len(known) + 1))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)[:, known]
            total += np.concatenate([w.T @ w, w.sum(0)[:, None]], axis=1)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          pa.array(total.ravel())], ["i", "j", "total"])

    if not len(known):
        return None
    total = np.zeros((len(known), len(known) + 1))
    parts = map_batches(projected.select("whitened"), moments, "i int, j int, total double")
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        total[r.i, r.j] = r.total / model.n
    mean = total[:, -1]
    return float(np.abs(total[:, :-1] - np.outer(mean, mean) - np.eye(len(known))).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
           shift: int = SHIFT, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector: id, n, deviation, whitened and explained (arrays
    by component), identity_error."""
    model = fit(vectors, vector_col, scale, shift, components)
    if model is None:
        empty = T.StructType([T.StructField(id_col, vectors.schema[id_col].dataType)])
        return (vectors.sparkSession.createDataFrame([], empty)
                .selectExpr(f"`{id_col}`", "0L AS n", "0L AS deviation", "array(0D) AS whitened",
                            "array(0D) AS explained", "0D AS identity_error"))
    rows = stored(project(vectors, model, id_col, vector_col, scale, shift), "whitened")
    error = identity_error(rows, model)
    return rows.select(
        F.col("id").alias(id_col), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(e).cast("double") for e in model.explained]).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
