"""Ranked lexical search by a tiered index, exact in 64-bit integers.

A term's postings are dealt to tiers by impact: the first tier takes its highest, about TIERS[0] of them, the next about
TIERS[1], the last all others. Where a tier ends comes from counts of impact classes by term, so nothing is sorted by term,
and a class of any size (copies all have one impact) goes to one tier whole. Each term and tier has a residual bound: the
highest impact below. A tier is a column of one row for each document, so a round reads only the tiers that it needs and
moves none of them.

A round scores all documents by the tiers so far, which gives each open item a floor, the lowest of its best scores. What a
document may have more is at most the residuals of the terms that it wasn't found for. An item is proved when the sum of its
terms' residuals, which bounds documents that no tier so far has, lies under the floor; the documents whose bound reaches
the floor are then scored in full. All other items fall through to the next tier. After the last one residuals are zero.

Items are taken in blocks of a bounded number of terms, documents always whole. Scores of a batch are integers in one matrix
of documents and items; a task hands on its best LIMIT documents for each item, and ties go by doc_id.

Defined cases: a null text has no term; a document without terms isn't counted; items without a term that some document has
give no rows; each row of items is an item, so rows that repeat are ranked each; a null item_id or doc_id is an id like
others, doc_id null after all; rows that repeat a doc_id are ranked each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import arrow
from .arrow import slices
from .common import forget, key_filter, maybe_in, stash, table

#: Postings of a term that the first tiers take, about; the last takes all others.
TIERS = (1 << 10, 1 << 14)
#: Documents for each item; distinct terms of a block of items at most, unless one item has more; items of a block.
LIMIT, BLOCK_TERMS, BLOCK_ITEMS = 20, 1 << 17, 2048
#: Impacts of a class; scores that a matrix has at most.
CLASS, CELLS = 1024, 1 << 20
#: Parts that ranks of an item are chosen in before they meet.
PARTS = 256
#: Bytes: letters, digits and all of other characters stay, A-Z in lower case, the rest are blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
_PAIR = np.dtype([("term", "<i4"), ("n", "<i4")])


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_BYTES).split()


class Block:
    """Items (item_id, Counter of terms) in memory: their distinct terms in order, and for each term the items that have it with their multiples of it."""

    def __init__(self, items: list[tuple[object, Counter]]):
        self.items = [i for i, _ in items]
        self.terms = sorted(set().union(*[c for _, c in items]))
        place = {t: k for k, t in enumerate(self.terms)}
        triples = sorted((place[t], k, n) for k, (_, c) in enumerate(items) for t, n in c.items())
        self.term, self.item, self.times = (np.array(x, np.int64) for x in (zip(*triples, strict=True) if triples else ((), (), ())))

    def chosen(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start of each term's entries, the entries' items (places in items) and multiples, for some of the items only."""
        place = np.full(len(self.items), -1)
        place[items] = np.arange(len(items))
        own = place[self.item] >= 0
        start = np.searchsorted(self.term[own], np.arange(len(self.terms) + 1))
        return start, place[self.item[own]], self.times[own]


def blocks(items: DataFrame) -> Iterator[Block]:
    """Blocks of items (item_id, text), each of a bounded number of terms."""
    held, size = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        count = Counter(terms(r.text))
        if held and (size + len(count) > BLOCK_TERMS or len(held) == BLOCK_ITEMS):
            yield Block(held)
            held, size = [], 0
        held.append((r.item_id, count))
        size += len(count)
    if held:
        yield Block(held)


class Tiers:
    """A block's terms: weight, last class of each tier, highest impact below each tier (residual)."""

    def __init__(self, weight: np.ndarray, ends: np.ndarray, residual: np.ndarray):
        self.weight, self.ends, self.residual = weight, ends, residual


class TieredIndex:
    """Postings of all documents for the terms of a block of items, by tier."""

    def __init__(self, docs: DataFrame, block: Block, tiers: tuple[int, ...] = TIERS):
        self.spark, self.block, self.sizes, self.kind = docs.sparkSession, block, tiers, docs.schema["doc_id"].dataType.simpleString()
        counted = stash(self._counted(docs))
        self.n, self.total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        self.tiers = self._bounds(counted)
        self.rows = stash(self._dealt(counted))
        forget(counted)

    def _counted(self, docs: DataFrame) -> DataFrame:
        """doc_id, n, postings (pairs of term and times) of each document with a term."""
        words = self.spark.sparkContext.broadcast(self.block.terms)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = {t: k for k, t in enumerate(words.value)}
            for batch in (x for whole in batches for x in slices(whole, 1)):
                rows, n, out = [], [], []
                for row, text in enumerate(batch.column(1)):
                    found = terms(text.as_py())
                    if found:
                        own = Counter([place[t] for t in found if t in place])
                        pairs = np.empty(len(own), _PAIR)
                        pairs["term"], pairs["n"] = list(own), list(own.values())
                        rows.append(row)
                        n.append(len(found))
                        out.append(pairs.tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n", "postings"])

        return arrow.in_small_batches(docs.select("doc_id", "text")).mapInArrow(arrow.task(run), f"doc_id {self.kind}, n long, postings binary")

    def _bounds(self, counted: DataFrame) -> Tiers:
        many, size = len(self.block.terms), (self.n, self.total)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros((0, 3), np.int64)
            for batch in batches:
                _, term, impact = impacts(batch, *size)
                held = merged(np.concatenate((held, np.stack((term.astype(np.int64) * CLASS + impact // CLASS, np.ones(len(term), np.int64), impact), 1))))
            yield pa.RecordBatch.from_arrays([pa.array(held[:, 0] // CLASS, pa.int64()), pa.array(held[:, 0] % CLASS, pa.int64()), pa.array(held[:, 1]), pa.array(held[:, 2])], ["term", "class", "docs", "high"])

        classes = counted.mapInArrow(arrow.task(run), "term long, class long, docs long, high long").groupBy("term", "class").agg(F.sum("docs").alias("docs"), F.max("high").alias("high"))
        above = F.sum("docs").over(Window.partitionBy("term").orderBy(F.desc("class"))) - F.col("docs")
        tier = F.lit(len(self.sizes))
        for k in reversed(range(len(self.sizes))):
            tier = F.when(F.col("above") < sum(self.sizes[: k + 1]), k).otherwise(tier)
        got = classes.withColumn("above", above).withColumn("tier", tier).groupBy("term", "tier").agg(F.min("class").alias("low"), F.max("high").alias("high"), F.sum("docs").alias("docs"))
        df, ends, high = np.zeros(many, np.int64), np.full((len(self.sizes) + 1, many), CLASS, np.int64), np.zeros((len(self.sizes) + 2, many), np.int64)
        term, tier, low, highest, n = (c.to_numpy() for c in got.select("term", "tier", "low", "high", "docs").toArrow().columns)
        np.add.at(df, term, n)
        ends[tier, term], high[tier, term] = low, highest
        ends = np.minimum.accumulate(ends, 0)
        residual = np.maximum.accumulate(high[:0:-1], 0)[::-1]
        weight = np.floor(1000 * np.log((2 * self.n + 2) / (2 * df + 1))).astype(np.int64)
        return Tiers(weight, ends, residual)

    def _dealt(self, counted: DataFrame) -> DataFrame:
        """doc_id, t0, t1, ...: each tier's postings (pairs of term and impact) of each document."""
        made, size = self.spark.sparkContext.broadcast(self.tiers), (self.n, self.total)
        names = [f"t{k}" for k in range(len(self.sizes) + 1)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ends = made.value.ends
            for batch in batches:
                row, term, impact = impacts(batch, *size)
                tier = (impact // CLASS < ends[:-1, term]).sum(0)
                columns = [batch.column(0)]
                for k in range(len(names)):
                    own = tier == k
                    pairs = np.empty(own.sum(), _PAIR)
                    pairs["term"], pairs["n"] = term[own], impact[own]
                    at = np.searchsorted(row[own], np.arange(batch.num_rows + 1))
                    columns.append(pa.array([pairs[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:], strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names])

        return counted.mapInArrow(arrow.task(run), ", ".join([f"doc_id {self.kind}", *[f"{x} binary" for x in names]]))

    def best(self, rows: DataFrame, items: np.ndarray, tier: int, limit: int) -> DataFrame:
        """item (place in the block), doc_id, score: the highest scores of rows for some items by the tiers up to one, limit of each item in each task at most."""
        held, block = self.spark.sparkContext.broadcast(self.tiers), self.spark.sparkContext.broadcast(self.block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, item, times = block.value.chosen(items)
            floor, top = np.zeros(len(items), np.int64), None
            for part, scores, _ in scored(batches, start, item, times, held.value, tier, len(items)):
                if len(scores) >= limit:
                    floor = np.maximum(floor, np.partition(scores, -limit, 0)[-limit])
                row, at = np.nonzero((scores >= floor) & (scores > 0))
                new = pa.table({"item": pa.array(items[at]), "doc_id": part.column(0).take(pa.array(row)), "score": pa.array(scores[row, at])})
                top = first(new if top is None else pa.concat_tables([top, new]), limit)
                held_items, n = np.unique(top.column("item").to_numpy(), return_counts=True)
                lowest = top.column("score").to_numpy()[np.cumsum(n) - 1]
                place = np.searchsorted(items, held_items[n == limit])
                floor[place] = np.maximum(floor[place], lowest[n == limit])
            if top is not None:
                yield from top.combine_chunks().to_batches()

        found = rows.select("doc_id", *[f"t{k}" for k in range(tier + 1)]).mapInArrow(arrow.task(run), f"item long, doc_id {self.kind}, score long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        # An item's rows come from all tasks, so they are first ranked in parts.
        near = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= limit)
        return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= limit)

    def candidates(self, items: np.ndarray, floors: np.ndarray, tier: int) -> DataFrame:
        """doc_id of the documents whose bound reaches the floor of one of the items."""
        held, block = self.spark.sparkContext.broadcast(self.tiers), self.spark.sparkContext.broadcast(self.block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, item, times = block.value.chosen(items)
            weight, residual = held.value.weight, held.value.residual[tier]
            whole = np.zeros(len(items), np.int64)
            np.add.at(whole, item, times * np.repeat(weight * residual, np.diff(start)))
            for part, scores, found in scored(batches, start, item, times, held.value, tier, len(items)):
                # A document that no tier so far has is under the floor.
                may = ((scores + whole - found >= floors) & (scores > 0)).any(1)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(may))], ["doc_id"])

        return self.rows.select("doc_id", *[f"t{k}" for k in range(tier + 1)]).mapInArrow(arrow.task(run), f"doc_id {self.kind}")

    def search(self, limit: int = LIMIT) -> Iterator[DataFrame]:
        """item, rank, doc_id, score, tier: what each round proves, to be written before the next one is asked for. The index is gone afterwards."""
        items, last = np.arange(len(self.block.items)), len(self.sizes)
        bound = np.zeros((last + 1, len(items)), np.int64)
        for k in range(last + 1):
            np.add.at(bound[k], self.block.item, self.block.times * (self.tiers.weight * self.tiers.residual[k])[self.block.term])
        for tier in range(last + 1):
            if not len(items):
                break
            rest = bound[tier, items]
            top = stash(self.best(self.rows, items, tier, limit))
            floors = np.full(len(self.block.items), -1, np.int64)
            for r in top.where(F.col("rank") == limit).select("item", "score").toLocalIterator():
                floors[r["item"]] = r.score
            # Without anything below, scores are whole; else the floor must lie over what is below.
            whole, proved = items[rest == 0], items[(rest > 0) & (floors[items] > rest)]
            if len(whole):
                yield top.where(F.col("item").isin(whole.tolist())).withColumn("tier", F.lit(tier))
            if len(proved):
                some = stash(self.candidates(proved, floors[proved], tier))
                # Others that the filter lets pass are scored in full too, which changes nothing. It doesn't know null.
                near = maybe_in(self.rows.where("doc_id is not null"), F.col("doc_id"), key_filter(some, F.col("doc_id"))).unionByName(self.rows.where("doc_id is null"))
                yield self.best(near, proved, last, limit).withColumn("tier", F.lit(tier))
                forget(some)
            forget(top)
            items = np.setdiff1d(items, np.concatenate((whole, proved)))
        forget(self.rows)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a binary column, and the row of each."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return data.view(_PAIR), np.repeat(np.arange(len(column)), np.diff(at) // _PAIR.itemsize)


def impacts(batch: pa.RecordBatch, n: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and impact of each posting of a batch of (doc_id, n, postings), for n documents of total terms."""
    data, row = joined(batch.column(2))
    m = 75 + 25 * batch.column(1).to_numpy() * n // total
    times = data["n"].astype(np.int64)
    return row, data["term"], 1_000_000_000 * times // (1000 * times + 12 * m[row])


def merged(rows: np.ndarray) -> np.ndarray:
    """Rows of (key, number, highest) with each key once."""
    keys, place = np.unique(rows[:, 0], return_inverse=True)
    out = np.zeros((len(keys), 3), np.int64)
    out[:, 0] = keys
    np.add.at(out[:, 1], place, rows[:, 1])
    np.maximum.at(out[:, 2], place, rows[:, 2])
    return out


def first(rows: pa.Table, limit: int) -> pa.Table:
    """The limit best rows (item, doc_id, score) of each item, by item, then best first."""
    rows = rows.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
    item = rows.column("item").to_numpy()
    begin = np.searchsorted(item, item)
    return rows.filter(pa.array(np.arange(len(item)) - begin < limit))


def scored(batches: Iterator[pa.RecordBatch], start: np.ndarray, item: np.ndarray, times: np.ndarray, tiers: Tiers, tier: int, many: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches of (doc_id, t0 to that tier), their scores for each of many items, and the residuals of the terms that they were found for.
    start, item, times: entries of each term, as Block.chosen has them."""
    step, weight, residual = max(1, CELLS // max(1, many)), tiers.weight, tiers.residual[tier]
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            scores, found = np.zeros(part.num_rows * many, np.int64), np.zeros(part.num_rows * many, np.int64)
            for k in range(tier + 1):
                data, row = joined(part.column(k + 1))
                fan = start[data["term"] + 1] - start[data["term"]]
                ends = np.cumsum(fan)
                lo = 0
                while lo < len(fan):
                    # As many postings at a time as give CELLS entries.
                    hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CELLS, "right")))
                    n, term = fan[lo:hi], data["term"][lo:hi]
                    entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[term], n)
                    cell = np.repeat(row[lo:hi] * many, n) + item[entry]
                    np.add.at(scores, cell, times[entry] * np.repeat(weight[term] * data["n"][lo:hi], n))
                    if tier + 1 < len(tiers.residual):
                        np.add.at(found, cell, times[entry] * np.repeat(weight[term] * residual[term], n))
                    lo = hi
            yield part, scores.reshape(-1, many), found.reshape(-1, many)


def search(docs: DataFrame, items: DataFrame, limit: int = LIMIT, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """item_id, rank, doc_id, score, tier for the limit best documents of docs (doc_id, text) for each of items (item_id, text); tier: the last that was needed."""
    spark = docs.sparkSession
    kinds = items.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    schema = f"item_id {kinds[0].simpleString()}, rank int, doc_id {kinds[1].simpleString()}, score long, tier int"
    out = spark.createDataFrame([], schema)
    for block in blocks(items):
        if not block.terms:
            continue
        index = TieredIndex(docs, block, tiers)
        if not index.total:
            continue
        names = spark.createDataFrame(list(enumerate(block.items)), f"item long, item_id {kinds[0].simpleString()}")
        for found in index.search(limit):
            out = out.unionByName(stash(found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "tier")))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tier")


SQL = r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
w AS (SELECT term, floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, s.docs),
p AS (SELECT tf.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * n.n * s.docs) // s.total))) AS part FROM tf JOIN n USING (doc_id) JOIN w USING (term), s),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
g AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
r AS (SELECT item_id, doc_id, sum(times * part)::BIGINT AS score FROM g JOIN p USING (term) GROUP BY item_id, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 20
"""
