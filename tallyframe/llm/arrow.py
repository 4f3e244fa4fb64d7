"""Arrow batches cut to a bound of text bytes; functions on Arrow data that hand their memory back when they are done."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Text bytes of a slice; a longer text is a slice of its own.
SLICE = 4 << 20
#: Bytes of a batch of rows on its way to a Python worker; a longer row is a batch of its own.
BATCH = 4 << 20
#: The session's setting for that. Spark fills batches of 10,000 rows up to 64 MiB, which JVM and worker each hold, with as much again while they grow.
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: The C library's call that returns freed memory to the system, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of batch of at most that many bytes in the text column."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array as one array, and each row's start and size in it; null: empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at[:-1] - at[0], np.diff(at)


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, with the session's batches for Python workers bounded to BATCH bytes from now on; a lower bound stays. Results don't depend on it."""
    spark = df.sparkSession
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_KEY)) > BATCH:
        spark.conf.set(_BATCH_KEY, str(BATCH))
    return df


def give_back() -> None:
    """Return freed memory to the system. Arrow's pool and the C library keep it otherwise, and an idle worker would hold it while other stages run."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def task(run: Callable) -> Callable:
    """run for mapInArrow, with its memory handed back at the task's end."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidy


def group(run: Callable) -> Callable:
    """run for applyInArrow, with its memory handed back after each group."""

    def tidy(rows):
        out = run(rows)
        give_back()
        return out

    return tidy


def group_of_two(run: Callable) -> Callable:
    """group() for functions of two arguments: a key and its rows, or the two sides of a cogroup."""

    def tidy(left, right):
        out = run(left, right)
        give_back()
        return out

    return tidy
