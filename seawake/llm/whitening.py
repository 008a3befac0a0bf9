"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

With V = P L L' P' every rotation of L's columns from the right leaves V as it is. Rotations that make the columns
orthogonal turn them into eigenvectors of V, each as long as the square root of its eigenvalue. Entries are whole numbers
(64 steps per unit), so sums and deviations are exact; means are taken off before anything is multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import written

STEPS, ORIGIN = 64, 1_000_000
LARGEST = 2.0**40  # of a step number; a greater entry is no number here
COMPONENTS = 16
NEGLIGIBLE = 1e-12  # share of the largest eigenvalue below which a direction has no variance
ROWS_PER_SUM = 1 << 20  # rows whose entries add up in 64 bits
VECTORS = "vec_id long, x binary"
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double"


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening. The mean of dimension j is ``whole[j] + rest[j] / n``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray  # one column each
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def dimensions(self) -> int:
        return len(self.whole)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / max(self.n, 1)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sums of (n * x - S)^2; null where 64 bits cannot hold one."""
        near = x - self.whole
        size = np.square(near.astype(np.float64) * self.n - self.rest).sum(axis=1)
        fits = size < 2.0**63 * (1 - 1e-9)
        exact = np.square(np.where(fits[:, None], near, 0) * self.n - np.where(fits[:, None], self.rest, 0)).sum(axis=1)
        return pa.array(exact, pa.int64(), mask=~fits)


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the vector's step numbers as 64-bit integers, of rows whose vector is whole.

    Left out are vectors that are null or empty, or that hold an entry that is null, not finite or beyond 2^40 steps.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            vectors = batch.column(1)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            steps = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * STEPS)
            ok = np.abs(steps) < LARGEST  # False for NaN, which also stands for null
            owner = np.repeat(np.arange(len(lengths)), lengths)
            whole = (np.bincount(owner[~ok], minlength=len(lengths)) == 0) & (lengths > 0)
            if not whole.any():
                continue
            x = (steps[whole[owner]].astype(np.int64) + ORIGIN).tobytes()
            at = np.concatenate(([0], np.cumsum(lengths[whole]) * 8)).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), int(whole.sum()), [None, pa.py_buffer(at), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(whole)), data], ["vec_id", "x"])

    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, VECTORS)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    data = np.frombuffer(b"".join(column.to_pylist()), np.int64)
    return data.reshape(len(column), -1)


def _summed(fit: DataFrame, of_rows, size: int, kind: str) -> list:
    """``of_rows`` of all rows added up: an array per task (or per million rows), then sums by place.

    ``size`` numbers reach the driver; it depends on the dimensions only.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        total, rows = 0, 0
        for batch in batches:
            total, rows = total + of_rows(_matrix(batch.column(0))), rows + batch.num_rows
            if rows >= ROWS_PER_SUM:
                yield part(total)
                total, rows = 0, 0
        if rows:
            yield part(total)

    def part(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["k", "v"])

    parts = fit.select("x").mapInArrow(run, f"k int, v {kind}")
    total = F.sum(F.col("v").cast("decimal(38,0)") if kind == "long" else "v")
    sums = {r.k: r.v for r in parts.groupBy("k").agg(total.alias("v")).collect()}
    return [sums.get(k, 0) for k in range(size)]


def pivoted_cholesky(matrix: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): ``matrix[order][:, order]`` is L L', with the largest remaining diagonal entry as the next pivot.

    L is lower triangular and has a column for each pivot above ``least``.
    """
    size = len(matrix)
    order, diagonal = np.arange(size), matrix.diagonal().copy()
    lower = np.zeros((size, size))
    for k in range(size):
        p = k + int(np.argmax(diagonal[order[k:]]))
        if diagonal[order[p]] <= least:
            return lower[:, :k], order
        order[[k, p]], lower[[k, p]] = order[[p, k]], lower[[p, k]]
        pivot, below = order[k], order[k + 1:]
        lower[k, k] = np.sqrt(diagonal[pivot])
        lower[k + 1:, k] = (matrix[below, pivot] - lower[k + 1:, :k] @ lower[k, :k]) / lower[k, k]
        diagonal[below] -= lower[k + 1:, k] ** 2
    return lower, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times rotations that make its columns orthogonal.

    A sweep meets every pair of columns once; the pairs of a round have no column in common and turn together.
    """
    columns = factor.copy()
    n = columns.shape[1]
    ring = list(range(n + n % 2))  # with an odd number the last one is a bye
    exact = np.finfo(float).eps * 4
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = np.array([(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1]) if max(a, b) < n])
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not len(pairs):
                continue
            x, y = columns[:, pairs[:, 0]], columns[:, pairs[:, 1]]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(c) > exact * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            half_cot = (b - a)[turn] / (2 * c[turn])
            tan = np.where(half_cot < 0, -1.0, 1.0) / (np.abs(half_cot) + np.hypot(1, half_cot))
            cos = 1 / np.hypot(1, tan)
            x, y, pairs = x[:, turn], y[:, turn], pairs[turn]
            columns[:, pairs[:, 0]] = cos * x - cos * tan * y
            columns[:, pairs[:, 1]] = cos * tan * x + cos * y
        if not turned:
            break
    return columns


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue; directions without variance are left out."""
    size = len(covariance)
    largest = covariance.diagonal().max(initial=0.0)
    lower, order = pivoted_cholesky(covariance, size * np.finfo(float).eps * largest)
    if not lower.shape[1]:
        return np.zeros(0), np.zeros((size, 0))
    rotated = one_sided_jacobi(lower)
    norms = np.sqrt((rotated * rotated).sum(axis=0))
    by_size = np.argsort(-norms, kind="stable")
    by_size = by_size[norms[by_size] ** 2 > NEGLIGIBLE * norms.max() ** 2]
    vectors = np.empty((size, len(by_size)))
    vectors[order] = rotated[:, by_size] / norms[by_size]
    return norms[by_size] ** 2, vectors


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """The fit list: each distinct x once, written to the shared folder. Copies meet in the map tasks first.

    All vectors have the length that most of the distinct ones have (the greater of equally common ones).
    """
    fit = written(quantised(embeddings).select("x").distinct(), "fit_list")
    common = fit.groupBy(F.length("x").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).first()
    return fit.filter(F.length("x") == (common.bytes if common else 0))


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fits up to ``components`` directions on the rows of ``fit`` (what :func:`distinct_vectors` returns).

    Two passes: sums, then products of centred rows. Tasks send sums only; the driver's work depends on the dimensions,
    not on the rows. An empty list or one of equal vectors gives no component.
    """
    first = fit.first()
    size = len(first.x) // 8 if first else 0
    n = fit.count()
    if not n:
        return Whitening(0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    sums = [int(v) for v in _summed(fit, lambda x: x.sum(axis=0), size, "long")]
    whole = np.array([s // n for s in sums], np.int64)
    centre = Whitening(n, whole, np.array([s % n for s in sums], np.int64), np.zeros((size, 0)), np.zeros(0), np.zeros(0))
    upper = np.triu_indices(size)

    def scatter(x: np.ndarray) -> np.ndarray:
        y = centre.centred(x)
        return (y.T @ y)[upper]

    covariance = np.zeros((size, size))
    covariance[upper] = np.array(_summed(fit, scatter, len(upper[0]), "double")) / n
    covariance += np.triu(covariance, 1).T
    values, vectors = eigen(covariance)
    return Whitening(n, whole, centre.rest, vectors[:, :components], values[:components],
                     values[:components] / covariance.trace() if len(values) else values)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; 0 without components."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.project(x)
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    sums = np.array(_summed(fit, moments, k + k * k, "double")) / model.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def whiten(embeddings: DataFrame, model: Whitening) -> DataFrame:
    """A row per usable vector and component: the whitened value, the component's share of the variance, and the exact
    squared distance of n * x from the sums (null where it does not fit into 64 bits).

    Vectors that :func:`quantised` leaves out, and those of another length than the fit list's, have no rows. A null
    vec_id is kept, repeated rows give their rows each, other columns are ignored; an empty table, or one of equal
    vectors, gives an empty result. A scan; no rows are moved.
    """
    k = len(model.eigenvalues)
    length = 8 * model.dimensions

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            fits = batch.filter(pc.equal(pc.binary_length(batch.column(1)), length))
            if not fits.num_rows or not k:
                continue
            x = _matrix(fits.column(1))
            row = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [fits.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(row), model.n)), model.deviation(x).take(pa.array(row)),
                 pa.array(model.project(x).ravel()), pa.array(np.tile(model.explained, len(x)))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return quantised(embeddings).mapInArrow(run, WHITENED)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fits on the distinct vectors and whitens every row; ``identity_error`` checks the result on the fit list."""
    fit = distinct_vectors(embeddings)
    model = fit_whitening(fit, components)
    return whiten(embeddings, model).withColumn("identity_error", F.lit(identity_error(fit, model)))
