"""Whitening of vectors from covariances that are made of variances alone (polarisation).

Entries become whole numbers, so every sum is exact. Each dimension is centred on the whole number next to its mean; the
rest of the mean, less than one half and the same for all vectors, is taken off the finished sums without rounding. Tasks
then add up one kind of number: squares of centred values, of every dimension and of the sum of every two dimensions. As
var(a + b) = var(a) + var(b) + 2 cov(a, b), these variances hold all covariances; the driver assembles the matrix, whose size
depends on the dimensions only, and ``eigh`` gives the components.

The matrix is fitted to each distinct vector once, so copies, however many, have no weight; they are combined before the
shuffle. Every row is whitened. Sums are exact in any order: a repeated task changes no digit.

Defined results: vectors that are null, empty or hold null or non-finite entries give no rows, nor do vectors of another
length than the most common one. Rows without an id and repeated rows give rows like others. Entries beyond a long's range
are taken as its ends. A component without variance (all vectors equal, or fewer independent dimensions) is not whitened:
null, and explains nothing; without any variance ``explained`` and ``identity_error`` are null. A deviation beyond a long is
null. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged

SCALE = 256
COMPONENTS = 4
#: Vectors worked on at a time.
STEP = 2_048
#: Bits of the parts in which exact sums are added up by Spark.
LIMB = 32
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_END = 2**63


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest width that holds them: equal vectors give equal bytes."""
    width = next(w for w in (2, 4, 8) if w == 8 or np.abs(x).max() < 1 << (8 * w - 1))
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    """Packed vectors as rows of longs."""
    rows = [np.frombuffer(v, f"<i{v[0]}", offset=1) for v in column.to_pylist()]
    return np.array(rows, np.int64).reshape(-1, dims)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, dims and x, the vector in whole numbers floor(256 * c), of all rows that take part, as a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, packed = [], [], []
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                if not vector.is_valid or not len(vector) or vector.values.null_count:
                    continue
                c = vector.values.to_numpy(zero_copy_only=False)
                if np.isfinite(c).all():
                    with np.errstate(over="ignore"):
                        scaled = np.floor(SCALE * c)
                    x = np.where(scaled >= _END, _END - 1, np.clip(scaled, -_END, _END - 1024).astype(np.int64))
                    ids.append(vec_id)
                    dims.append(len(c))
                    packed.append(_packed(x))
            columns = [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dims", "x"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = staged(rows.mapInArrow(run, "vec_id long, dims int, x binary"), "whole-vectors")
    common = rows.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1)
    return rows.join(F.broadcast(common.select("dims")), "dims", "left_semi")


def _limbs(place: int, total: int) -> Iterator[tuple[int, int, int]]:
    """An exact sum as parts of LIMB bits, which longs can add up; the last part carries the sign."""
    part = 0
    while total not in (0, -1):
        yield place, part, total & ((1 << LIMB) - 1)
        total, part = total >> LIMB, part + 1
    if total:
        yield place, part, total


def exact_sums(vectors: DataFrame, width: int, add: Callable[[np.ndarray], list[np.ndarray]], dims: int) -> list[int]:
    """Sums over all vectors of the ``width`` numbers that ``add`` makes of some of them, without rounding or overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * width
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                for i, part in enumerate(add(_whole(batch.column("x").slice(start, STEP), dims)).tolist()):
                    totals[i] += int(part)
        rows = [limb for place, total in enumerate(totals) for limb in _limbs(place, total)]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["place", "part", "sum"])

    parts = vectors.select("x").mapInArrow(run, "place int, part int, sum long")
    totals = [0] * width
    for place, part, total in parts.groupBy("place", "part").agg(F.sum("sum")).collect():
        totals[place] += total << (LIMB * part)
    return totals


def _plain(x: np.ndarray) -> np.ndarray:
    """Count of vectors and sum of every dimension."""
    wide = x if not len(x) or float(np.abs(x.astype(np.float64)).max()) * len(x) < 2.0**62 else x.astype(object)
    return np.concatenate([[len(x)], wide.sum(axis=0)])


def _squares(centre: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Sums of squares of every centred dimension and of the sum of every two: row i of the upper triangle for each i."""

    def add(x: np.ndarray) -> np.ndarray:
        most = float(np.abs(x.astype(np.float64) - centre.astype(np.float64)).max()) if len(x) else 0.0
        # Squares of sums of two that don't fit a long are added up as Python's whole numbers.
        kind = np.int64 if 4 * (most + 1) ** 2 * max(1, len(x)) < 2.0**62 else object
        y = np.ascontiguousarray((x.astype(kind) - centre.astype(kind)).T)
        sums = []
        for i in range(len(y)):
            pairs = y[i] + y[i + 1 :]
            sums.append(np.concatenate([[(y[i] * y[i]).sum()], (pairs * pairs).sum(axis=1)]))
        return np.concatenate(sums)

    return add


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """The matrix from variances of dimensions and of sums of two.

    ``rest``: sums of the centred dimensions; what they are off zero is taken off here, in whole numbers.
    """
    dims = len(rest)
    starts = np.cumsum([0, *range(dims, 0, -1)]).tolist()
    # n * n times a variance is a whole number.
    single = [n * squares[starts[i]] - rest[i] ** 2 for i in range(dims)]
    matrix = np.zeros((dims, dims))
    for i in range(dims):
        matrix[i, i] = single[i] / n**2
        for j in range(i + 1, dims):
            both = n * squares[starts[i] + j - i] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - single[i] - single[j]) / (2 * n**2)
    return matrix


def components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; each vector's largest entry is positive."""
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:most].copy(), vectors[:, ::-1][:, :most]
    noise = max(float(np.abs(matrix).max()), 0.0) * len(matrix) * 1e-14
    values[values <= noise] = 0.0
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


class Whitening:
    """What tasks need: count, centre and rest of the mean, and the scaled components."""

    def __init__(self, n: int, centre: np.ndarray, rest: list[int], values: np.ndarray, vectors: np.ndarray):
        self.n, self.centre, self.rest = n, centre, rest
        self.shift = np.array([r / n for r in rest])
        self.there = values > 0
        self.scaled = vectors / np.sqrt(np.where(self.there, values, 1.0))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Centred vectors on the components, over the square roots of their eigenvalues."""
        if len(x) and np.abs(x.astype(np.float64)).max() >= 2.0**62:
            return (x.astype(np.float64) - self.centre.astype(np.float64) - self.shift) @ self.scaled
        return ((x - self.centre).astype(np.float64) - self.shift) @ self.scaled

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - S) squared, exact."""
        most = float(np.abs(x.astype(np.float64) - self.centre.astype(np.float64)).max()) if len(x) else 0.0
        kind = np.int64 if ((most + 1) * self.n) ** 2 * x.shape[1] < 2.0**62 else object
        rest = np.array(self.rest, object).astype(kind)
        far = (x.astype(kind) - self.centre.astype(kind)) * self.n - rest
        return [int(v) if v < _END else None for v in (far * far).sum(axis=1).tolist()]


def identity_error(fit: DataFrame, model: Whitening, dims: int) -> float | None:
    """Largest entry, without sign, of the whitened vectors' covariance minus the identity, as measured on the fit list."""
    k = int(model.there.sum())
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, squares = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                z = model.whiten(_whole(batch.column("x").slice(start, STEP), dims))[:, model.there]
                sums += z.sum(axis=0)
                squares += z.T @ z
        values = np.concatenate([sums, squares.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["place", "sum"])

    found = fit.select("x").mapInArrow(run, "place int, sum double").groupBy("place").agg(F.sum("sum")).collect()
    values = np.zeros(k + k * k)
    for place, total in found:
        values[place] = total
    mean = values[:k] / model.n
    return float(np.abs(values[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every row and component up to ``most``."""
    rows = quantised(vectors, id_col, vector_col)
    first = rows.select("dims").first()
    if first is None:
        return _nothing(rows.sparkSession)
    dims = first["dims"]
    fit = staged(rows.select("x").distinct(), "distinct-vectors")
    n, *sums = exact_sums(fit, 1 + dims, _plain, dims)
    # The whole number next to the mean: what is left is at most one half.
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * c for s, c in zip(sums, centre.tolist(), strict=True)]
    matrix = covariance(n, rest, exact_sums(fit, dims * (dims + 1) // 2, _squares(centre), dims))
    values, axes = components(matrix, most)
    model = Whitening(n, centre, rest, values, axes)
    error = identity_error(fit, model, dims)
    trace = float(np.trace(matrix))
    explained = [float(v) / trace if trace > 0 else None for v in values]
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                x = _whole(part.column("x"), dims)
                z = np.where(model.there, model.whiten(x), np.nan)
                columns = [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n, np.int64)),
                    pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(z.ravel(), from_pandas=True),
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([error] * (len(x) * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    return rows.select("vec_id", "x").mapInArrow(run, SCHEMA)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
