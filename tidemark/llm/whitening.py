"""Whitening of embeddings with a covariance found by polarisation.

Entries become integers ``x = floor(256 * c)``. The fit list is each distinct integer vector
once. Spark sums, over the fit list, the squares of every centred dimension and of every
centred sum of two dimensions; the cross-covariance of two dimensions is half of what the
variance of their sum has over the sum of their variances. Everything up to that matrix is
integer arithmetic: values are centred at the whole number next to the mean, and what is left
of the mean is taken off exactly (sum (n x - S)^2 = n^2 sum y^2 - n (S - n m)^2 for y = x - m).
Only the matrix of a size given by the vector length reaches the driver, for ``eigh``.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries, are
dropped, and so are rows whose length isn't the most frequent one (of equally frequent ones the
longest). Entries of more than 2**31 after scaling raise ValueError. Repeated rows stay as they
are, each with its components, but count once in the fit. Components without variance can't be
scaled and give no rows, so one distinct vector, or an empty table, gives none. ``deviation`` is null
where it passes 64 bits; ``deviation_wide`` has it as a decimal. Further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written

COMPONENTS = 4
SCALE = 256
#: Largest entry after scaling: its square, summed over a batch, stays within 64 bits.
MOST = 1 << 31
#: A component with less than this share of the variance is rounding noise.
LEAST_SHARE = 1e-13


def scaled_vectors(table: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, length, x): the integer entries as 32-bit little-endian bytes, of rows with a usable vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for i, v in enumerate(b.column(1)):
                if not v.is_valid or not len(v) or v.values.null_count:
                    continue
                c = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(c).all():
                    x = np.floor(SCALE * c)
                    if np.abs(x).max() >= MOST:
                        raise ValueError(f"an entry is too large for exact sums: {np.abs(c).max()}")
                    rows.append(i)
                    out.append(x.astype("<i4").tobytes())
            take = pa.array(rows, pa.int64())
            sizes = pa.array([len(x) // 4 for x in out], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()).take(take), sizes, pa.array(out, pa.binary())], ["vec_id", "length", "x"])

    return table.select(F.col(id_column).cast("long"), column).mapInArrow(run, "vec_id long, length int, x binary")


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, length).astype(np.int64)


def _sums(fit: DataFrame, names: int, each) -> np.ndarray:
    """Exact totals, as Python integers, of ``each(matrix)`` (an array of ``names`` 64-bit sums) over the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(names, dtype=object)
        for b in batches:
            if b.num_rows:
                total = total + each(b.column(0)).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(names, dtype=np.int32)), pa.array([str(t) for t in total])], ["k", "s"])

    rows = fit.select("x").mapInArrow(run, "k int, s string").groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = np.zeros(names, dtype=object)
    for r in rows:
        out[r["k"]] = int(r["s"])
    return out


def squares(fit: DataFrame, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of squares of every centred dimension, and of every centred sum of two dimensions (i < j, in order)."""
    d = len(centre)

    def each(column: pa.Array) -> np.ndarray:
        y = _matrix(column, d) - centre
        most = int(np.abs(y).max(initial=0))
        if 4 * most * most * max(1, len(y)) >= 1 << 63:
            y = y.astype(object)
        own = (y * y).sum(axis=0)
        pairs = [((y[:, i : i + 1] + y[:, i + 1 :]) ** 2).sum(axis=0) for i in range(d - 1)]
        return np.concatenate([own, *pairs])

    got = _sums(fit, d * (d + 1) // 2, each)
    return got[:d], got[d:]


def covariance(n: int, sums: np.ndarray, centre: np.ndarray, own: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The covariance matrix by polarisation, each entry rounded once from its exact value."""
    d = len(sums)
    left = [int(s) - n * int(m) for s, m in zip(sums, centre)]  # n times what the whole-number centre leaves of the mean
    spread = [n * int(own[i]) - left[i] ** 2 for i in range(d)]  # n^2 times the variance
    out = np.empty((d, d))
    k = 0
    for i in range(d):
        out[i, i] = float(Fraction(spread[i], n * n))
        for j in range(i + 1, d):
            both = n * int(pairs[k]) - (left[i] + left[j]) ** 2
            out[i, j] = out[j, i] = float(Fraction(both - spread[i] - spread[j], 2 * n * n))
            k += 1
    return out


def principal(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of at most ``most`` components that vary; the largest entry of each is positive."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > LEAST_SHARE * max(values.sum(), 0.0)]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * signs


class Model:
    """What a fit gives: n, the sums, and the components."""

    def __init__(self, n: int, sums: np.ndarray, cov: np.ndarray, most: int = COMPONENTS):
        self.n, self.sums, self.trace = n, [int(s) for s in sums], float(np.trace(cov))
        self.mean = np.array([float(Fraction(s, n)) for s in self.sums])
        self.values, self.vectors = principal(cov, most)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        sums = np.array(self.sums, dtype=object)
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if most * most * x.shape[1] < 1 << 63 else object
        return [int(v) for v in ((self.n * x.astype(kind) - sums.astype(kind)) ** 2).sum(axis=1)]


def fit(rows: DataFrame, length: int, most: int = COMPONENTS) -> tuple[Model | None, DataFrame]:
    """The model, and the fit list that it stands on."""
    once = written(rows.select("x").distinct(), "whitening-fit")
    n = once.count()
    if n == 0:
        return None, once
    sums = _sums(once, length, lambda column: _matrix(column, length).sum(axis=0))
    centre = np.array([round(Fraction(int(s), n)) for s in sums], dtype=np.int64)
    own, pairs = squares(once, centre)
    return Model(n, sums, covariance(n, sums, centre, own, pairs), most), once


def identity_error(once: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on the list."""
    k, length = len(model.values), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                w = model.whiten(_matrix(b.column(0), length))
                first += w.sum(axis=0)
                second += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k, dtype=np.int32)), pa.array(np.concatenate((first, second.ravel())))], ["k", "s"])

    rows = once.select("x").mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    total = np.zeros(k * k + k)
    for r in rows:
        total[r["k"]] = r["s"]
    mean = total[:k] / model.n
    return float(np.abs(total[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(table: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, deviation_wide) per usable row and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double, deviation_wide decimal(38,0)"
    rows = scaled_vectors(table, id_column, column)
    lengths = rows.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    if not lengths:
        return table.sparkSession.createDataFrame([], schema)
    length = lengths[0]["length"]
    rows = rows.where(F.col("length") == length)
    model, once = fit(rows, length, components)
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], schema)
    error = identity_error(once, model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), length)
            far = np.repeat(np.array(model.deviations(x), dtype=object), k)
            wide = pa.array([str(v) for v in far]).cast(pa.decimal128(38, 0))
            each = lambda v: pa.array(np.tile(v, len(x)))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), each(np.arange(1, k + 1, dtype=np.int32)), each(np.full(k, model.n)),
                    pa.array([int(v) if v < 1 << 63 else None for v in far], pa.int64()), pa.array(model.whiten(x).ravel()), each(model.values / model.trace),
                    each(np.full(k, error)), each(model.values), wide,
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue", "deviation_wide"],
            )

    return rows.select("vec_id", "x").mapInArrow(run, schema)
