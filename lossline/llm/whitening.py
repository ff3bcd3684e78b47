"""Whitening of vectors: centred, turned to the principal components, scaled to unit variance.

The mean and the covariance are sums over all distinct vectors, taken in the tasks and added up by Spark; only the
covariance (dimensions x dimensions, whatever the number of rows) reaches the driver. Its eigenvectors start in float32
and are corrected by the iterations of Ogita and Aishima in extended precision, whose work is matrix products alone.
Eigenvalues closer than the iteration can tell apart form a cluster; its vectors are turned by a solve of the small
shifted matrix of the cluster, whose own rounding is as much smaller as the cluster is narrow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import hidden, parts, write

#: Entries beyond do not fit the exact sums; rows that hold one take no part.
LARGEST = float(1 << 52)
#: Steps at most: each doubles the digits, and float32 starts with seven.
STEPS = 8
#: An eigenvalue of less than this part of their sum counts as zero.
ZERO = 1e-15
LIMB = 18
WIDEST = Decimal(10) ** 38


def usable(rows: DataFrame, vector: str, scale: int, shift: int) -> DataFrame:
    """rows with x appended (floor(scale * c) + shift of each entry c), without those whose vector is null or empty or holds
    null, non-finite or too large entries."""
    c = F.col(vector)
    fits = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) * scale < LARGEST))
    x = F.transform(c, lambda e: F.floor(e.cast("double") * scale) + F.lit(shift).cast("long"))
    return rows.filter(c.isNotNull() & (F.size(c) > 0) & F.coalesce(fits, F.lit(False))).withColumn("x", x)


# --- eigenvectors ------------------------------------------------------------------------


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Stretches of sorted values whose neighbours are no further apart than `near`, of two values or more."""
    cut = np.flatnonzero(np.diff(values) > near) + 1
    return [each for each in np.split(np.arange(len(values)), cut) if len(each) > 1]


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision."""
    matrix = matrix.astype(np.longdouble)
    size = np.trace(matrix)
    if not size > 0:
        return np.zeros(len(matrix), np.longdouble), np.eye(len(matrix), dtype=np.longdouble)
    a = matrix / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    norm = float(np.linalg.norm(a.astype(float), 2))
    smallest = float(np.finfo(np.longdouble).eps)
    for _ in range(STEPS):
        lost = one - x.T @ x
        seen = x.T @ (a @ x)
        values = np.diag(seen) / (1 - np.diag(lost))
        order = np.argsort(values, kind="stable")
        x, values, lost, seen = x[:, order], values[order], lost[np.ix_(order, order)], seen[np.ix_(order, order)]
        off = seen - np.diag(values)
        near = 2 * (np.linalg.norm(off.astype(float), 2) + norm * np.linalg.norm(lost.astype(float), 2))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        turn = np.where(apart, ((seen + seen.T) / 2 + values[None, :] * lost) / np.where(apart, gap, 1), lost / 2)
        # Both sides of the diagonal add up to what is lost, rounding or not: the vectors stay orthogonal.
        turn = np.triu(turn) + np.tril(lost - turn.T, -1)
        x = x + x @ turn
        if float(np.abs(turn).max()) <= smallest * len(a):
            break
        for each in _clusters(values, near):
            x[:, each] = _turned(a, x[:, each])
    x = _orthonormal(x)
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Vectors that are nearly orthonormal made so; each step squares what is missing."""
    for _ in range(2):
        x = x @ (1.5 * np.eye(x.shape[1]) - 0.5 * (x.T @ x))
    return x


def _turned(a: np.ndarray, some: np.ndarray) -> np.ndarray:
    """The vectors of a cluster turned so that the matrix is diagonal between them: a solve shifted by their mean value."""
    basis = _orthonormal(some)
    inner = basis.T @ (a @ basis)
    centre = np.trace(inner) / len(inner)
    inner = inner - centre * np.eye(len(inner))
    inner = (inner + inner.T) / 2
    most = np.abs(inner).max()
    if not most > 0:
        return basis
    turn = np.linalg.eigh((inner / most).astype(float))[1].astype(np.longdouble)
    return _orthonormal(basis @ turn)


# --- sums in tasks -----------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _added(partials: DataFrame) -> list[np.ndarray]:
    """Sums of the arrays hi + lo of each key, in extended precision; a task holds one array of sums at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for k, hi, lo in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                value = np.array(hi.values, np.longdouble) + np.array(lo.values, np.longdouble)
                if k == key:
                    total = total + value
                else:
                    if key is not None:
                        yield _split([key], total[None])
                    key, total = k, value
        if key is not None:
            yield _split([key], total[None])

    n = parts(partials)
    rows = partials.repartition(n, "key").sortWithinPartitions("key", "hi").mapInArrow(run, partials.schema).collect()
    return [np.array(r.hi, np.longdouble) + np.array(r.lo, np.longdouble) for r in sorted(rows, key=lambda r: r.key)]


def _split(keys: list[int], rows: np.ndarray) -> pa.RecordBatch:
    """Extended precision as two doubles a value."""
    high = rows.astype(np.float64)
    low = (rows - high).astype(np.float64)
    lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (high, low)]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *lists], names=["key", "hi", "lo"])


def _products(rows: DataFrame, width: int, made) -> list[np.ndarray]:
    """Sum over all rows of m.T @ m, where m = made(matrix of x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                m = made(_matrix(batch.column(0), width))
                product = (m.T @ m).astype(np.longdouble)
                total = product if total is None else total + product
        if total is not None:
            yield _split(list(range(len(total))), total)

    return _added(rows.select("x").mapInArrow(run, "key long, hi array<double>, lo array<double>"))


def _sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, [0] * width
        for batch in batches:
            x = _matrix(batch.column(0), width)
            count += len(x)
            # Two halves, so that no sum over a batch leaves 64 bits.
            high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
            total = [t + (h << 26) + g for t, h, g in zip(total, high, low)]
        if count:
            values = pa.array([Decimal(v) for v in [count, *total]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int64()), values], names=["entry", "value"])

    told = rows.select("x").mapInArrow(run, "entry long, value decimal(38,0)")
    found = {r.entry: int(r.total) for r in told.groupBy("entry").agg(F.sum("value").alias("total")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


# --- model -------------------------------------------------------------------------------


@dataclass
class Whitening:
    """n distinct vectors with sums S; components (columns) with their eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None

    def __post_init__(self):
        # The mean as its nearest whole number and the rest: differences to the first are exact.
        self.centre = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, self.centre)]
        self.offset = np.array([float(Decimal(r) / self.n) for r in self.rest])
        self.positive = self.values > ZERO * self.trace if self.trace > 0 else np.zeros(len(self.values), bool)
        self.turn = self.components[:, self.positive] / np.sqrt(self.values[self.positive]) if len(self.values) else self.components

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The positive components of each row."""
        return ((x - self.centre).astype(np.float64) - self.offset) @ self.turn

    def deviation(self, x: np.ndarray) -> list[int]:
        """The exact sum over entries of (n x - S)**2 for each row."""
        away = x - self.centre
        if self.n * (int(np.abs(away).max(initial=0)) + 1) >= 1 << (3 * LIMB):
            rest = self.rest
            return [sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in away.tolist()]
        v = np.abs(away * self.n - np.array(self.rest, np.int64))
        mask = (1 << LIMB) - 1
        a, b, c = v & mask, (v >> LIMB) & mask, v >> (2 * LIMB)
        terms = [a * a, 2 * a * b, 2 * a * c + b * b, 2 * b * c, c * c]
        sums = [t.sum(axis=1).tolist() for t in terms]
        return [sum(t << (LIMB * i) for i, t in enumerate(row)) for row in zip(*sums)]


def fit(vectors: DataFrame, most: int = 16) -> Whitening | None:
    """The whitening of the distinct arrays x of whole numbers in `vectors`, of at most `most` components.

    Where arrays differ in length, those of the commonest length among the distinct ones count (of the longer one, if
    equally common). None if there is no row. A copy weighs nothing, however many rows hold it.
    """
    distinct = write(vectors.select("x").distinct(), "distinct-vectors")
    widths = distinct.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    width = widths.orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not width:
        return None
    width = width[0].width
    distinct = distinct.filter(F.size("x") == width)
    n, sums = _sums(distinct, width)
    none = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    centre, rest = none.centre, np.array(none.rest, np.int64).astype(np.longdouble)
    products = np.array(_products(distinct, width, lambda x: (x - centre).astype(np.float64)))
    covariance = (products - rest[:, None] * (rest[None, :] / n)) / n
    values, components = eigen((covariance + covariance.T) / 2)
    found = Whitening(n, sums, components[:, :most].astype(float), values[:most].astype(float), float(np.trace(covariance)))
    if found.positive.any():
        # A column of ones beside the whitened vectors gives their sums too.
        told = np.array(_products(distinct, width, lambda x: np.c_[found.whitened(x), np.ones(len(x))])) / n
        mean = told[:-1, -1]
        found.identity_error = float(np.abs(told[:-1, :-1] - mean[:, None] * mean[None, :] - np.eye(len(mean))).max())
    return found


def whiten(rows: DataFrame, vector: str = "embedding", scale: int = 64, shift: int = 1_000_000, most: int = 16) -> tuple[DataFrame, Whitening | None]:
    """The rows whose vector takes part, every column of them, with deviation and whitened appended; and the model.

    Each entry c counts as x = floor(scale * c) + shift. The model is fitted on the distinct x. `whitened` has a number for
    each component, from the largest eigenvalue on; those with an eigenvalue of zero (as where all vectors are equal) have
    none: null. `deviation` is the exact sum of (n x - S)**2 (null beyond 38 digits). Rows with a vector that is null or
    empty, holds null or non-finite entries or ones of 2**52 / scale and more, or is of another length than the commonest one
    do not come back. Repeated rows and null ids are rows like others; other columns may have any name.
    """
    inner, names, (at,) = hidden(rows, vector)
    held = usable(inner, at, scale, shift)
    model = fit(held, most)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema) + ", deviation decimal(38,0), whitened array<double>"
    names = [*names, "deviation", "whitened"]
    if model is None:
        return rows.sparkSession.createDataFrame([], schema).toDF(*names), None
    width = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(batch.num_columns - 1), width)
            out = np.full((len(x), len(model.values)), np.nan)
            out[:, model.positive] = model.whitened(x)
            flat = pa.array(out.ravel(), pa.float64(), from_pandas=True)  # NaN: null
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * out.shape[1], pa.int32()), flat)
            exact = [Decimal(v) if v < WIDEST else None for v in model.deviation(x)]
            columns = [*batch.columns[:-1], pa.array(exact, pa.decimal128(38, 0)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "deviation", "whitened"])

    return held.filter(F.size("x") == width).mapInArrow(run, schema).toDF(*names), model
