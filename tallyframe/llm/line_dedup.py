"""Reversible line dedup: exact reference counts of lines, and sharded cuckoo filters of those that are too common.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased; an index holds, by 128-bit digest
of the key, the number of documents that have it. Each insertion or deletion of documents is a run of signed counts, so what
was inserted can be deleted again; runs are summed up when read and merged by compact(). Keys that reach the bound enter the
cuckoo filter of their shard and keys that fall below it leave it: a filter has 32-bit fingerprints in buckets of four, and
a digest's first bits name its shard.

Documents look their lines up in the filters where they lie, as long as all filters together are under FILTER_BYTES; what
the filters hold is held against the exact counts once, and their false positives, one in 500 million lines, go along as
exceptions. Beyond that size, or with more than EXCEPTIONS of these, the lines' digests meet the counts in a join in which
common keys stay where they lie (common.join_counted), so results don't depend on it.

Defined cases: a null or empty text is one empty line, which stays; keys of fewer than `shortest` code points always stay;
a row is a document, so rows that repeat count each; a null doc_id is an id like others; deleting what was not inserted
raises ValueError; documents that were not inserted may be cleaned too, with the counts of those that were; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrow
from .arrow import slices
from .common import delete, join_counted, scratch, stash, table

#: ASCII white space.
WHITE = b" \t\n\x0b\x0c\r"
#: Keys of a shard's filter at most, and bytes of all filters that may be sent to every task.
SHARD_KEYS, FILTER_BYTES = 1 << 15, 16 << 20
#: False positives that may be sent along, and digests that a task counts before it hands them on.
EXCEPTIONS, HELD = 1 << 16, 1 << 17
#: Slots of a bucket, moves before a filter counts as full. A filter has two slots for each of its shard's keys at least.
SLOTS, MOVES = 4, 500


def keys_of(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Lines of a text in UTF-8 and their keys."""
    data = (text or "").encode()
    return data.split(b"\n"), [line.strip(WHITE) for line in data.lower().split(b"\n")]


def chars(key: bytes) -> int:
    """Code points of a key in UTF-8."""
    return len(key) if key.isascii() else len(key.decode())


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


class Cuckoo:
    """A cuckoo filter of 16-byte digests. A key's second bucket follows from the first and its fingerprint, so a fingerprint can move without its key."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, SLOTS)

    @classmethod
    def empty(cls, keys: int) -> Cuckoo:
        """With room for that many keys."""
        return cls(np.zeros(SLOTS << max(0, -(-2 * keys // SLOTS) - 1).bit_length(), np.uint32))

    @staticmethod
    def split(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint, never 0, and hash of digests (n, 16) of bytes."""
        parts = digests.view("<u4").reshape(-1, 4)
        return np.maximum(parts[:, 2], 1), parts[:, 3]

    def other(self, bucket, fingerprint):
        return (bucket ^ ((fingerprint * np.uint32(0x5BD1E995)) >> np.uint32(8))) & np.uint32(len(self.slots) - 1)

    def places(self, key: bytes) -> tuple[int, int, np.uint32]:
        f, h = self.split(np.frombuffer(key, np.uint8))
        first = h & np.uint32(len(self.slots) - 1)
        return int(first[0]), int(self.other(first, f)[0]), f[0]

    def insert(self, key: bytes) -> bool:
        """False if no place was found; the filter has then lost a fingerprint and is of no use."""
        at, second, f = self.places(key)
        for bucket in (at, second):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = f
                return True
        for move in range(MOVES):
            slot = (move * 7 + at) % SLOTS
            f, self.slots[at, slot] = self.slots[at, slot], f
            at = int(self.other(np.array([at], np.uint32), np.array([f], np.uint32))[0])
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = f
                return True
        return False

    def remove(self, key: bytes) -> None:
        first, second, f = self.places(key)
        for bucket in (first, second):
            held = np.flatnonzero(self.slots[bucket] == f)
            if len(held):
                self.slots[bucket, held[0]] = 0
                return


class Filters:
    """All shards' filters as one array of slots, each digest looked up in its shard."""

    def __init__(self, shards: int, blobs: dict[int, bytes]):
        self.shards, self.exceptions = shards, frozenset()
        tables = [np.frombuffer(blobs.get(s, b"\0" * 4 * SLOTS), "<u4").reshape(-1, SLOTS) for s in range(shards)]
        self.mask = np.array([len(t) - 1 for t in tables], np.uint32)
        self.start = np.cumsum([0] + [len(t) for t in tables])[:-1]
        self.slots = np.concatenate(tables)

    def holds(self, keys: list[bytes]) -> np.ndarray:
        """Whether each digest is held; true for all that were inserted, and for few others."""
        if not keys:
            return np.zeros(0, bool)
        data = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
        f, h = Cuckoo.split(data)
        shard = data[:, :4].copy().view(">u4").ravel().astype(np.int64) % self.shards
        mask = self.mask[shard]
        first = h & mask
        second = (first ^ ((f * np.uint32(0x5BD1E995)) >> np.uint32(8))) & mask
        found = (self.slots[self.start[shard] + first] == f[:, None]).any(1) | (self.slots[self.start[shard] + second] == f[:, None]).any(1)
        if self.exceptions:
            found[found] = [keys[i] not in self.exceptions for i in np.flatnonzero(found)]
        return found


def shard_of(shards: int):
    """Shard of column digest: its first four bytes, as Filters.holds has it."""
    return F.expr(f"int(cast(conv(hex(substring(digest, 1, 4)), 16, 10) as bigint) % {shards})")


class LineIndex:
    """Counts and filters of the lines of a changing set of documents, below one folder. least: documents from which on a key is too common."""

    def __init__(self, spark: SparkSession, path: str | None = None, least: int = 10, shortest: int = 1, filter_bytes: int = FILTER_BYTES, shard_keys: int = SHARD_KEYS):
        self.spark, self.path, self.least, self.shortest, self.filter_bytes, self.shard_keys = spark, path or scratch(spark), least, shortest, filter_bytes, shard_keys
        self.runs: list[str] = []
        self.version, self.shards, self.common, self.filters = 0, 0, 0, ""

    def insert(self, docs: DataFrame) -> None:
        self._change(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Take back documents that were inserted."""
        self._change(docs, -1)

    def counts(self, runs: list[str] | None = None) -> DataFrame:
        """digest, docs of each key that some document has."""
        paths = self.runs if runs is None else runs
        got = self.spark.read.schema("digest binary, docs long").parquet(*paths) if paths else self.spark.createDataFrame([], "digest binary, docs long")
        if len(paths) > 1:
            got = got.groupBy("digest").agg(F.sum("docs").alias("docs"))
        return got.where("docs <> 0")

    def frequent(self) -> DataFrame:
        return self.counts().where(F.col("docs") >= self.least)

    def compact(self) -> None:
        """Merge all runs into one."""
        if len(self.runs) > 1:
            old, self.runs = self.runs, [self._write(self.counts(), "run")]
            for path in old:
                delete(self.spark, path)

    def _write(self, df: DataFrame, kind: str) -> str:
        self.version += 1
        path = f"{self.path}/{kind}-{self.version}"
        df.write.parquet(path)
        return path

    def _change(self, docs: DataFrame, sign: int) -> None:
        """A run of counts and new filters. What the index holds changes when both are written; a change that fails leaves it as it was."""
        run = self._write(line_counts(docs, self.shortest, sign), "run")
        runs, before = [*self.runs, run], self.counts()
        try:
            if sign < 0 and not self.counts(runs).where("docs < 0").isEmpty():
                raise ValueError("a document to be deleted was not inserted")
            crossed = self._crossed(before, run)
            common = self.common + (crossed.agg(F.sum(F.when(F.col("enters"), 1).otherwise(-1))).first()[0] or 0)
            wanted = 1 << max(0, -(-common // self.shard_keys) - 1).bit_length()
            shards, path = self.shards, None
            if shards >= wanted:
                path = self._fitting(self._filters(), crossed, shards)
            while path is None:
                # More shards, so every digest may change its shard: all filters are made anew.
                shards = max(wanted, 2 * shards)
                whole = self.counts(runs).where(F.col("docs") >= self.least).select("digest", F.lit(True).alias("enters"))
                path = self._fitting(self.spark.createDataFrame([], "shard int, slots binary"), whole, shards)
        except Exception:
            delete(self.spark, run)
            raise
        self.runs, self.common, self.shards, self.filters = runs, common, shards, path

    def _fitting(self, held: DataFrame, crossed: DataFrame, shards: int) -> str | None:
        """Path of the filters after a change, or None if one of them is too full."""
        path = self._write(updated(held, crossed.withColumn("shard", shard_of(shards)), self.shard_keys), "filters")
        return path if self._filters(path).where("slots is null").isEmpty() else None

    def _crossed(self, before: DataFrame, run: str) -> DataFrame:
        """digest, enters of the run's keys that reach the bound or fall below it."""
        change = self.spark.read.schema("digest binary, docs long").parquet(run)
        if not self.runs:
            return change.where(F.col("docs") >= self.least).select("digest", F.lit(True).alias("enters"))
        met = change.withColumnRenamed("docs", "change").join(before, "digest", "left").withColumn("docs", F.coalesce("docs", F.lit(0)))
        had, has = F.col("docs") >= self.least, F.col("docs") + F.col("change") >= self.least
        return met.where(had != has).select("digest", has.alias("enters"))

    def _filters(self, path: str | None = None) -> DataFrame:
        return self.spark.read.schema("shard int, slots binary").parquet(path or self.filters)

    def lookup(self, docs: DataFrame) -> Filters | None:
        """Filters with the exceptions that docs need, or None if they are too large to be sent to every task."""
        if not self.filters:
            return Filters(1, {})
        size = self._filters().agg(F.sum(F.length("slots"))).first()[0] or 0
        if size > self.filter_bytes:
            return None
        made = Filters(self.shards, {r.shard: bytes(r.slots) for r in self._filters().collect()})
        held, shortest = self.spark.sparkContext.broadcast(made), self.shortest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (x for whole in batches for x in slices(whole, 0)):
                keys = list({digest(k) for text in batch.column(0) for k in set(keys_of(text.as_py())[1]) if chars(k) >= shortest})
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in np.flatnonzero(held.value.holds(keys))], pa.binary())], ["digest"])

        said = arrow.in_small_batches(docs.select("text")).mapInArrow(arrow.task(run), "digest binary").distinct()
        wrong = [bytes(r.digest) for r in said.join(self.frequent(), "digest", "left_anti").limit(EXCEPTIONS + 1).collect()]
        made.exceptions = frozenset(wrong)
        return None if len(wrong) > EXCEPTIONS else made

    def clean(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped, text (without the lines of common keys) for each row of docs (doc_id, text)."""
        cols = docs.select("doc_id", "text")
        made = self.lookup(cols)
        return self._clean_joined(cols) if made is None else self._clean_in_place(cols, made)

    def _clean_in_place(self, docs: DataFrame, made: Filters) -> DataFrame:
        held, shortest = self.spark.sparkContext.broadcast(made), self.shortest

        def common(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[bytes], set[bytes]]]:
            parts = [keys_of(t.as_py()) for t in batch.column(1)]
            keys = list({k for _, own in parts for k in own if chars(k) >= shortest})
            out = {keys[i] for i in np.flatnonzero(held.value.holds([digest(k) for k in keys]))}
            return ((lines, own, out) for lines, own in parts)

        return cleaned(docs, common)

    def _clean_joined(self, docs: DataFrame) -> DataFrame:
        """The same by a join of the lines' digests with the counts; rows that agree in doc_id and text share its result."""
        shortest = self.shortest
        row = F.sha2(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))), 256)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (x for whole in batches for x in slices(whole, 1)):
                pairs = [(r, digest(k)) for r, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for k in set(keys_of(t.as_py())[1]) if chars(k) >= shortest]
                cols = list(zip(*pairs, strict=True)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary())], ["row", "digest"])

        named = stash(docs.withColumn("row", row))
        pairs = stash(arrow.in_small_batches(named.select("row", "text").dropDuplicates(["row"])).mapInArrow(arrow.task(run), "row string, digest binary"))
        met = join_counted(pairs, self.frequent(), "digest", "docs", pairs.count())
        gone = met.groupBy("row").agg(F.collect_set("digest").alias("gone"))

        def common(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[bytes], set[bytes]]]:
            for text, gone in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                lines, own = keys_of(text.as_py())
                held = set(gone or ())
                yield lines, own, {k for k in set(own) if chars(k) >= shortest and digest(k) in held}

        return cleaned(named.join(gone, "row", "left").select("doc_id", "text", "gone"), common)


def line_counts(docs: DataFrame, shortest: int = 1, sign: int = 1) -> DataFrame:
    """digest, docs: documents of docs (text) that have each key, times sign. A task's documents are added up before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([digest(k) for k in held], pa.binary()), pa.array([sign * n for n in held.values()], pa.int64())], ["digest", "docs"])
            held.clear()
            return made

        size = 0
        for batch in (x for whole in batches for x in slices(whole, 0)):
            for text in batch.column(0):
                for k in set(keys_of(text.as_py())[1]):
                    if chars(k) >= shortest:
                        size += len(k) if k not in held else 0
                        held[k] = held.get(k, 0) + 1
            if len(held) > HELD or size > arrow.SLICE * 4:
                size = 0
                yield out()
        yield out()

    parts = arrow.in_small_batches(docs.select("text")).mapInArrow(arrow.task(run), "digest binary, docs long")
    return parts.groupBy("digest").agg(F.sum("docs").alias("docs"))


def updated(held: DataFrame, crossed: DataFrame, shard_keys: int) -> DataFrame:
    """shard, slots: filters (shard, slots) after the keys of crossed (shard, digest, enters) entered or left; slots is null where the keys found no place.
    A shard's keys are bounded by the number of shards."""

    def run(old: pa.Table, changes: pa.Table) -> pa.Table:
        shard = (changes if changes.num_rows else old).column("shard")[0].as_py()
        made = Cuckoo(np.frombuffer(old.column("slots")[0].as_py(), "<u4").copy()) if old.num_rows else Cuckoo.empty(shard_keys)
        changed = list(zip(changes.column("digest").to_pylist(), changes.column("enters").to_pylist(), strict=True))
        for key, enters in changed:
            if not enters:
                made.remove(key)
        fits = all(made.insert(key) for key, enters in changed if enters)
        return pa.table({"shard": pa.array([shard], pa.int32()), "slots": pa.array([made.slots.astype("<u4").tobytes() if fits else None], pa.binary())})

    left, right = held.groupBy("shard"), crossed.select("shard", "digest", "enters").groupBy("shard")
    return left.cogroup(right).applyInArrow(arrow.group_of_two(run), "shard int, slots binary")


def cleaned(docs: DataFrame, common) -> DataFrame:
    """doc_id, n_lines, n_dropped, text. common(batch): lines, keys and common keys for each row of a batch, whose first columns are doc_id and text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole, 1)):
            n, dropped, texts = [], [], []
            for lines, keys, out in common(batch):
                kept = [line for line, k in zip(lines, keys, strict=True) if k not in out] if out else lines
                n.append(len(lines))
                dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])

    return arrow.in_small_batches(docs).mapInArrow(arrow.task(run), f"doc_id {kind}, n_lines long, n_dropped long, text string")


def dedup(docs: DataFrame, least: int = 10, shortest: int = 1) -> DataFrame:
    """clean() of docs by an index of themselves."""
    index = LineIndex(docs.sparkSession, least=least, shortest=shortest)
    index.insert(docs)
    return index.clean(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS nth FROM documents),
k AS (SELECT doc_id, nth, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key GROUP BY doc_id
"""
