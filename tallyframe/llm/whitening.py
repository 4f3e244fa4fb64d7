"""Whitening of embeddings from an exact covariance by digit-slice products.

Entries become integers x = floor(256 c). Each distinct x vector is fitted once. A task takes blocks of them, splits the
integers into digits of DIGIT bits so small that a float64 matrix product of two digit slices over a block is exact,
puts the products together as big integers, and hands its sums on in digits of 30 bits, which Spark adds without a loss.
The driver gets one number for each pair of dimensions and digit, whatever the number of rows; the covariance is a
quotient of integers, rounded once, and is decomposed there. Projection is map-only.

Defined cases: a vector that is null or holds a null or non-finite entry is dropped; a shorter vector counts as filled up
with zeros to the longest one's length; entries whose x exceeds 64 bits take the nearest 64-bit value; rows that repeat, or
whose vec_id is null or repeats, are each projected, equal vectors are fitted once; a component without variance has
whitened 0 and is left out of identity_error; deviation is null where it exceeds 64 bits; without vectors, or with empty
ones only, there are no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrow
from .common import forget, stash, table

#: Bits of a digit and rows of a block: digits are at most 2**19 in size, so sums of products stay under 2**51.
DIGIT, BLOCK = 20, 8192
#: Bits of the digits that Spark adds up.
SUM_BITS = 30
#: Components at most, and the factor of x.
COMPONENTS, FACTOR = 4, 256.0
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of an array<double> column that remain, their integer vectors in one matrix, filled up with zeros, and their lengths."""
    rows = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
    lists = column.take(pa.array(rows))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    good = bad[ends] == bad[ends - sizes]
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(FACTOR * values)
        x = np.where(np.abs(scaled) < 2.0**63, scaled, 0).astype(np.int64)
    x[scaled >= 2.0**63], x[scaled <= -(2.0**63)] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    out = np.zeros((len(rows), sizes.max(initial=0)), np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    out[row, np.arange(len(values)) - np.repeat(ends - sizes, sizes)] = x
    return rows[good], out[good], sizes[good]


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as a byte for its width and its integers in the narrowest type, without zeros at the end: equal vectors, equal bytes."""
    out = [b""] * len(x)
    low, high = x.min(1, initial=0), x.max(1, initial=0)
    width = np.zeros(len(x), int)
    for k, t in enumerate(_WIDTHS[:-1]):
        width[(low < np.iinfo(t).min) | (high > np.iinfo(t).max)] = k + 1
    for k, t in enumerate(_WIDTHS):
        own = np.flatnonzero(width == k)
        data, step = x[own].astype(np.dtype(t).newbyteorder("<")).tobytes(), x.shape[1] * np.dtype(t).itemsize
        for i, row in enumerate(own):
            out[row] = bytes([k]) + data[i * step : (i + 1) * step].rstrip(b"\0")
    return out


def unpacked(codes: list[bytes], dims: int) -> np.ndarray:
    out, width = np.zeros((len(codes), dims), np.int64), np.array([c[0] for c in codes], int)
    for k, t in enumerate(_WIDTHS):
        own = np.flatnonzero(width == k)
        size = dims * np.dtype(t).itemsize
        data = b"".join([codes[i][1:].ljust(size, b"\0") for i in own])
        out[own] = np.frombuffer(data, np.dtype(t).newbyteorder("<")).reshape(len(own), dims)
    return out


def digits(x: np.ndarray) -> list[np.ndarray]:
    """x as float64 slices: x = sum of slice k times 2**(DIGIT k), each entry at most 2**(DIGIT - 1) in size."""
    out = []
    while x.any() or not out:
        low = x & ((1 << DIGIT) - 1)
        low = np.where(low >= 1 << (DIGIT - 1), low - (1 << DIGIT), low)
        out.append(low.astype(np.float64))
        x = (x >> DIGIT) + (low < 0)
    return out


def products(x: np.ndarray) -> np.ndarray:
    """x.T @ x as big integers, for at most BLOCK rows."""
    slices, total = digits(x), 0
    for i, a in enumerate(slices):
        for j, b in enumerate(slices[: i + 1]):
            p = (a.T @ b).astype(np.int64).astype(object)
            total = total + ((p if i == j else p + p.T) << (DIGIT * (i + j)))
    return total


def sum_digits(value: int) -> list[int]:
    """value in digits of SUM_BITS bits, the last one signed."""
    out = []
    while not -(1 << SUM_BITS) <= value < 1 << SUM_BITS:
        out.append(value & ((1 << SUM_BITS) - 1))
        value >>= SUM_BITS
    return [*out, value]


class Fit:
    """n vectors with sums (big integers), eigenvalues, their trace and components (columns) of the covariance."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray):
        self.n, self.sums = n, sums
        values, vectors = np.linalg.eigh(covariance)
        many = min(COMPONENTS, len(sums))
        self.trace = float(np.trace(covariance))
        self.values = np.maximum(values[::-1][:many], 0)
        # What rounding leaves of a component without variance is no variance.
        self.values[self.values <= len(sums) * np.finfo(float).eps * self.trace] = 0
        self.axes = vectors[:, ::-1][:, :many]
        self.mean = np.array([s / n for s in sums])
        self.scale = np.divide(1, np.sqrt(self.values), out=np.zeros(many), where=self.values > 0)
        self.explained = self.values / self.trace if self.trace else np.zeros(many)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.axes * self.scale

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)**2 of each row."""
        most = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, self.sums))
        if most**2 * len(self.sums) < 2**63:
            return pa.array(((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1))
        big = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(1)
        return pa.array([v if v < 2**63 else None for v in big], pa.int64())


def distinct(vectors: DataFrame) -> DataFrame:
    """code (packed integers), dim (length) of each distinct vector of vectors (embedding). A task's copies are one row before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x, sizes = integers(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(packed(x), pa.binary()), pa.array(sizes.astype(np.int32))], ["code", "dim"])

    return vectors.mapInArrow(arrow.task(run), "code binary, dim int").groupBy("code").agg(F.max("dim").alias("dim"))


def fit(codes: DataFrame) -> Fit | None:
    """The fit of distinct vectors (code, dim)."""
    dims = codes.agg(F.max("dim")).first()[0]
    if not dims:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = unpacked(batch.column(0).slice(at, BLOCK).to_pylist(), dims)
                n, sums, total = n + len(x), sums + x.astype(object).sum(0), total + products(x)
        if n:
            entries = [(-1, -1, n), *((-1, j, v) for j, v in enumerate(sums)), *((i, j, total[i, j]) for i in range(dims) for j in range(i, dims))]
            rows = [(i, j, k, d) for i, j, v in entries for k, d in enumerate(sum_digits(int(v)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["i", "j", "k", "part"])

    parts = codes.select("code").mapInArrow(arrow.task(run), "i int, j int, k int, part long")
    merged: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "k").agg(F.sum("part").alias("part")).collect():
        merged[r.i, r.j] = merged.get((r.i, r.j), 0) + (r.part << (SUM_BITS * r.k))
    n, sums = merged[-1, -1], [merged[-1, j] for j in range(dims)]
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            covariance[i, j] = covariance[j, i] = (n * merged[i, j] - sums[i] * sums[j]) / n**2
    return Fit(n, sums, covariance)


def identity_error(codes: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the covariance of the distinct vectors' whitened values minus the identity, over components with variance."""
    dims, live = len(model.sums), np.flatnonzero(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live), len(live)))
        for batch in batches:
            z = model.whiten(unpacked(batch.column(0).to_pylist(), dims))[:, live]
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["at", "part"])

    sums = codes.select("code").mapInArrow(arrow.task(run), "at int, part double").groupBy("at").agg(F.sum("part").alias("part")).collect()
    got = np.zeros(len(live) ** 2)
    got[[r["at"] for r in sums]] = [r.part for r in sums]
    return float(np.abs(got.reshape(len(live), len(live)) / model.n - np.eye(len(live))).max(initial=0))


def whiten(vectors: DataFrame, model: Fit, error: float) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each remaining row of vectors (vec_id, embedding) and component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    dims, many = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, short, _ = integers(batch.column(1))
            x = np.zeros((len(short), dims), np.int64)
            x[:, : short.shape[1]] = short[:, :dims]
            each = pa.array(np.repeat(np.arange(len(x)), many))
            columns = [
                batch.column(0).take(pa.array(np.repeat(rows, many))), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), model.n, np.int64)),
                model.deviations(x).take(each), pa.array(model.whiten(x).ravel()), pa.array(np.tile(model.explained, len(x))), pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(arrow.task(run), f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened(vectors: DataFrame) -> DataFrame:
    """whiten() of vectors (vec_id, embedding) by their own fit."""
    cols = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    codes = stash(distinct(cols.select("embedding")))
    model = fit(codes)
    if model is None:
        forget(codes)
        return whiten(cols.limit(0), Fit(1, [0], np.zeros((1, 1))), 0.0)
    error = identity_error(codes, model)
    forget(codes)
    return whiten(cols, model, error)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
