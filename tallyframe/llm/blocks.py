"""Packed blocks: rows of numpy arrays that Spark deals by a key, and the number of groups that they are dealt to."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes for each group that a shuffle deals to, of a batch that is summed up before it is dealt, and of a slice that is hashed at a time.
GROUP_BYTES, BATCH_BYTES, SLICE_BYTES = 8 << 20, 8 << 20, 1 << 20


def groups_for(docs: DataFrame, text: Column) -> int:
    """Groups of about GROUP_BYTES of text, and at least as many as there are shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // GROUP_BYTES))


def pack(*arrays: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return b"".join([np.array([len(r) for r in raw], "<u8").tobytes(), *raw])


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = np.frombuffer(data, "<u8", len(kinds))
    at, out = 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def gather(blocks: Iterator[bytes], *kinds: str) -> list[np.ndarray]:
    """The arrays of several blocks, end to end."""
    parts = [unpack(b, *kinds) for b in blocks]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind) for k, kind in enumerate(kinds)]


def by_key(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key and the places that have it, in order."""
    order = np.argsort(key, kind="stable")
    if len(order):
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for rows in np.split(order, cuts):
            yield int(key[rows[0]]), rows


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, end to end."""
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(total)


def rows_of(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [() for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
