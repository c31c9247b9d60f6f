"""Whitening of embeddings by their leading principal components.

1. Entries become whole numbers, so sums are exact. One pass adds them up by
   dimension; a second adds up products of the centred vectors, a matrix a task.
   A task's matrix has one row per dimension, however many vectors it read.
2. The covariance is reduced to a tridiagonal matrix by Householder reflections.
   Counting negative pivots of the shifted matrix (Sturm) tells how many
   eigenvalues lie below a point; bisection on that count finds the largest ones.
   Inverse iteration gives their vectors, and the vectors of close eigenvalues
   are made orthogonal again in each step. The reflections carry them back.
3. The components are broadcast (dimensions x components) and every vector is
   projected. A further pass over the projected vectors measures how far their
   covariance is from the identity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.vectors import finite_vectors, stacked
from starloom.session import cut_lineage

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Entries from here on have no exact whole number; their vectors are left out.
LARGEST = float(1 << 42)
SLICE = 4096
#: Eigenvalues closer than this share of the matrix's norm count as a cluster.
CLUSTER = 1e-3
EPS = np.finfo(float).eps

RESULT = (
    "id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit Householder vectors of a symmetric matrix."""
    a, vectors = matrix.copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        scale = np.abs(v).max()
        if scale:
            v /= scale
            v[0] += math.copysign(np.linalg.norm(v), v[0])
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        vectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), vectors


def below(diag: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point: negative pivots of T - point."""
    count, pivot = np.zeros(len(points), int), np.ones(len(points))
    tiny = np.finfo(float).tiny / EPS
    for k, d in enumerate(diag):
        pivot = d - points - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def largest_eigenvalues(diag: np.ndarray, off: np.ndarray, how_many: int) -> np.ndarray:
    """In falling order, by bisection of Gershgorin's interval."""
    d = len(diag)
    reach = np.r_[0, np.abs(off)] + np.r_[np.abs(off), 0]
    bound = np.abs(diag).max() + reach.max() + np.finfo(float).tiny
    rank = d - 1 - np.arange(how_many)
    low, high = np.full(how_many, (diag - reach).min() - EPS * bound), np.full(how_many, (diag + reach).max() + EPS * bound)
    for _ in range(1100):
        middle = (low + high) / 2
        over = below(diag, off, middle) > rank
        open_ = (middle > low) & (middle < high) & (high - low > EPS * EPS * bound)
        if not open_.any():
            break
        high, low = np.where(open_ & over, middle, high), np.where(open_ & ~over, middle, low)
    return (low + high) / 2


def _solved(diag: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = right, by elimination with row exchanges; the tridiagonal
    matrix fills at most two diagonals above its own."""
    d = len(diag)
    main, up, up2 = diag - shift, np.r_[off, 0.0], np.zeros(d)
    x = right.copy()
    for k in range(d - 1):
        low = off[k]
        if abs(main[k]) < abs(low):
            main[k], low = low, main[k]
            up[k], main[k + 1] = main[k + 1], up[k]
            up2[k], up[k + 1] = up[k + 1], 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        if abs(main[k]) < tiny:
            main[k] = tiny
        f = low / main[k]
        main[k + 1] -= f * up[k]
        up[k + 1] -= f * up2[k]
        x[k + 1] -= f * x[k]
    for k in range(d - 1, -1, -1):
        if abs(main[k]) < tiny:
            main[k] = tiny
        rest = (up[k] * x[k + 1] if k + 1 < d else 0.0) + (up2[k] * x[k + 2] if k + 2 < d else 0.0)
        x[k] = (x[k] - rest) / main[k]
        if abs(x[k]) > 1e200:
            x *= 1e-200
    return x


def eigenvectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray, steps: int = 6) -> np.ndarray:
    """Columns for the falling ``values``, by inverse iteration."""
    d, norm = len(diag), max(np.abs(diag).max() + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    rng, out, first = np.random.default_rng(d), np.empty((d, len(values))), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        # equal values get shifts of their own
        shift = value - EPS * norm * (k - first)
        x, again = rng.standard_normal(d), 0
        for _ in range(steps):
            x = _solved(diag, off, shift, x / np.abs(x).max(), EPS * norm)
            for _twice in range(2):
                x /= np.abs(x).max()
                x -= out[:, first:k] @ (out[:, first:k].T @ x)
            x /= np.linalg.norm(x)
        out[:, k] = x
    return out


def leading_components(matrix: np.ndarray, how_many: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit vectors as columns; without those
    that are zero to the matrix's accuracy."""
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        return np.empty(0), np.empty((len(matrix), 0))
    diag, off, reflections = tridiagonal(matrix / scale)
    values = largest_eigenvalues(diag, off, min(how_many, len(matrix)))
    values = values[values > len(matrix) * EPS * max(values[0], 0.0)]
    vectors = eigenvectors(diag, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as packed longs."""
    for batch in batches:
        flat, starts, lengths = finite_vectors(batch.column("v"))
        rows, packed, dims = [], [], []
        for row, (at, n) in enumerate(zip(starts, lengths, strict=True)):
            x = flat[at : at + max(n, 0)]
            if n > 0 and np.abs(x).max() < LARGEST:
                rows.append(row)
                packed.append((np.floor(SCALE * x).astype(np.int64) + OFFSET).tobytes())
                dims.append(int(n))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())],
            names=["id", "dim", "x"],
        )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            some = batch.slice(at, SLICE)
            yield some, stacked(some.column("x"), "<i8")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, x in _matrices(batches):  # a slice's sums cannot overflow
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(x)], pa.int64()), pa.array([x.sum(axis=0)], pa.list_(pa.int64()))], names=["n", "sums"]
        )


@dataclass(frozen=True)
class Centre:
    """Exact means of n vectors: ``whole`` + ``rest`` / n by dimension."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """sum over dimensions of (n * x - sum)^2, null beyond 38 digits."""
        y = x - self.whole
        largest = self.n * int(np.abs(y).max(initial=0)) + self.n
        if largest**2 * x.shape[1] < 1 << 63:
            d = ((self.n * y - self.rest) ** 2).sum(axis=1)
            return pa.array(d).cast(pa.decimal128(38, 0))
        d = ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([str(v) if v < 10**38 else None for v in d], pa.string()).cast(pa.decimal128(38, 0))


def _scatter(centre: Centre, basis, mean: np.ndarray | None):
    """A task's sum of products, by row, of the centred vectors or of their
    projections less ``mean``; row -1 has the sums of the vectors themselves."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sums = None
        for _, x in _matrices(batches):
            y = centre.centred(x)
            if basis is not None:
                y = y @ basis.value - mean
            total, sums = (0 if total is None else total) + y.T @ y, (0 if sums is None else sums) + y.sum(axis=0)
        if total is not None:
            packed = [sums.tobytes(), *(row.tobytes() for row in total)]
            at = pa.array(np.arange(-1, len(total)), pa.int64())
            yield pa.RecordBatch.from_arrays([at, pa.array(packed, pa.binary())], names=["at", "part"])

    return scatter


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, part in zip(batch.column("at").to_pylist(), batch.column("part").to_pylist(), strict=True):
            sums[at] = sums.get(at, 0) + np.frombuffer(part)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["at", "part"]
    )


def _covariance(whole: DataFrame, centre: Centre, basis=None, mean: np.ndarray | None = None):
    """(means, covariance) over all rows: one row per task and dimension is
    shuffled, and one row per dimension reaches the driver."""
    parts = whole.mapInArrow(_scatter(centre, basis, mean), "at bigint, part binary")
    added = parts.repartition("at").sortWithinPartitions("at", "part").mapInArrow(_add_parts, "at bigint, part binary")
    rows = {r["at"]: np.frombuffer(r["part"]) for r in added.collect()}
    matrix = np.stack([rows[k] for k in range(len(rows) - 1)]) / centre.n
    return rows[-1] / centre.n, (matrix + matrix.T) / 2


def _project(centre: Centre, basis, explained: np.ndarray, error: float):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _matrices(batches):
            w = centre.centred(x) @ basis.value
            k = w.shape[1]
            row = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("id").take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(row), centre.n)),
                    centre.deviations(x).take(row),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(row), error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return project


def whiten(
    vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``: a row for each usable vector and component.

    A vector is left out if it is null or empty, holds a null or non-finite entry or
    one of 2**42 or more, or is not of the table's most frequent length (of equally
    frequent ones the greatest). Rows are fitted as often as they stand, whatever
    their id, null included. There are fewer components than asked for where the
    vectors span fewer dimensions, and no row at all for an empty table or if all
    vectors are equal. ``deviation`` is exact, and null beyond 38 digits.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    whole = cut_lineage(rows.mapInArrow(_whole, "id bigint, dim int, x binary"), "whole-vectors")
    usual = whole.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    nothing = spark.createDataFrame([], RESULT)
    if usual is None:
        return nothing
    whole = whole.filter(F.col("dim") == usual["dim"]).select("id", "x")
    totals = whole.mapInArrow(_sums, "n bigint, sums array<bigint>")
    by_dim = totals.select("n", F.posexplode("sums").alias("d", "s")).groupBy("d")
    # one row per dimension
    exact = by_dim.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("d").collect()
    n = exact[0]["n"]
    means = [divmod(int(r["s"]), n) for r in exact]
    centre = Centre(n, np.array([q for q, _ in means], np.int64), np.array([r for _, r in means], np.int64))
    mean, covariance = _covariance(whole, centre)
    values, directions = leading_components(covariance, components)
    if not len(values):
        return nothing
    basis = directions / np.sqrt(values)
    shared = spark.sparkContext.broadcast(basis)
    _, identity = _covariance(whole, centre, shared, mean @ basis)
    error = float(np.abs(identity - np.eye(len(values))).max())
    return whole.mapInArrow(_project(centre, shared, values / np.trace(covariance), error), RESULT)


def op11_query(spark: SparkSession, root: str) -> DataFrame:
    vectors = spark.read.parquet(f"{root}/embeddings.parquet").select("vec_id", "embedding")
    exact = F.expr("try_cast(deviation as bigint)")
    return whiten(vectors).withColumn("deviation", exact).withColumnRenamed("id", "vec_id")
