"""Removal of repeated passages by suffix order and longest-previous-factor arrays, over all documents.

A byte goes if a LENGTH-byte string that covers it also starts earlier: in a smaller doc_id, or earlier in its document.
The strings' starts are dealt out so that equal strings meet: each string belongs to the anchor in it, its GRAM-byte
substring of least hash, which depends on its bytes alone. An anchor and the strings that belong to it are a context.

1. Each batch of texts finds its contexts and settles those that it can: equal contexts after the first are repeats;
   contexts of one anchor that differ are open. One entry for each anchor goes on, so a passage that a third of all rows
   hold is one entry a batch.
2. Entries meet by anchor. An anchor met once settles nothing; equal contexts after the first are repeats; others are open.
3. Open contexts bring their bytes and meet by anchor: their strings' starts are put in suffix order, with common prefixes
   of neighbours, and the previous and next smaller positions in that order give each start's longest previous factor.
   Strings of an anchor with more than CROWD open contexts in a group of texts meet by a 128-bit fingerprint of each
   instead, the first of each group only; that group sends a notice by the anchor, so that the few contexts that other
   groups have sent there follow by their fingerprints.
4. Starts whose factor has LENGTH bytes or more are marked, and what they cover is taken out.

Contexts are compared by 48 bits of anchor and 48 of context, with their places in between.

Defined cases: a null text is empty; a text of under LENGTH bytes loses nothing; a null doc_id comes before all others, with
-2^63, the least id; rows that share a place come in order of a hash of the text, and rows that repeat both have the same
result; bytes of a cut character that stay are dropped from text (not from kept_sha256); other columns
are passed on by cut() and ignored by report(), whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrow
from .arrow import slices, text_bytes
from .blocks import BATCH_BYTES, SLICE_BYTES, by_key, gather, groups_for, pack, rows_of, runs, spread
from .common import stash, table

#: Bytes of a repeat, bytes of an anchor, open contexts of one anchor in a group above which its strings meet one by one.
LENGTH, GRAM, CROWD = 100, 32, 32
WIDTH = LENGTH - GRAM + 1
#: Where a null doc_id comes in the order.
NO_ID = -(1 << 63)
#: Starts whose anchors are found at a time.
STEP = 1 << 18
_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _ODD[3]
    return x ^ (x >> _U(29))


_BYTE = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _ODD[0])


def rolling(data: np.ndarray, span: int) -> np.ndarray:
    """A 64-bit hash of the span bytes (a power of two) from each place."""
    g, have = _BYTE[data], 1
    while have < span:
        left = g[: max(len(g) - have, 0)] * _ODD[have.bit_length() % 6]
        left ^= left >> _U(31)
        left += g[have:]
        g, have = left, 2 * have
    return g


def anchor_of_each(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each LENGTH-byte string of data: the place of its anchor, leftmost of the least, and the anchor's hash."""
    n = max(len(data) - LENGTH + 1, 0)
    place, value = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    low = _U(2 * STEP - 1)
    for lo in range(0, n, STEP):
        hi = min(n, lo + STEP)
        g = mix(rolling(data[lo : hi + LENGTH - 1], GRAM))
        m = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        wide = 1
        while 2 * wide <= WIDTH:
            m, wide = np.minimum(m[:-wide], m[wide:]), 2 * wide
        if wide < WIDTH:
            m = np.minimum(m[: wide - WIDTH], m[WIDTH - wide :])
        at = (m & low).astype(np.int64)
        place[lo:hi], value[lo:hi] = at + lo, g[at]
    return place, value


def contexts(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts that lie in data: text, start in it of the first string, strings less one, anchor and context (48 bits each) of each context."""
    doc = np.repeat(np.arange(len(size)), size)
    end = (start + size)[doc]
    place, value = anchor_of_each(data)
    n = len(place)
    if not n:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    new = np.ones(n, bool)
    new[1:] = place[1:] != place[:-1]
    new[start[start < n]] = True
    cut = (start + size - LENGTH + 1)[size >= LENGTH]
    new[cut[cut < n]] = True
    lo = np.flatnonzero(new)
    more = np.diff(np.append(lo, n)) - 1
    kept = lo + LENGTH <= end[lo]
    lo, more = lo[kept], more[kept]
    g = rolling(data, 64)
    last = lo + more + LENGTH - 64
    body = (g[lo] * _ODD[0] ^ g[np.minimum(lo + 64, last)]) * _ODD[1]
    body = mix(((body ^ body >> _U(31)) + g[last]) * _ODD[2] + (place[lo] - lo).astype(np.uint64) * _ODD[4] + more.astype(np.uint64) * _ODD[5])
    return doc[lo], lo - start[doc[lo]], more, value[lo] >> _U(16), body >> _U(16)


def ranks(doc_id: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Rank of each document by doc_id, then tie; equal ones share it."""
    order = np.lexsort((tie, doc_id))
    new = np.concatenate(([False], (doc_id[order][1:] != doc_id[order][:-1]) | (tie[order][1:] != tie[order][:-1])))[: len(order)]
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def positions(doc: np.ndarray, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return rank[doc] << 32 | at


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48 bits as 32 and 16."""
    return (x >> _U(16)).astype("<u4"), (x & _U(0xFFFF)).astype("<u2")


def whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << _U(16) | low


class Names:
    """Documents of a group: doc_id and tie by number, and the group that holds the text."""

    def __init__(self, doc_id: np.ndarray, tie: np.ndarray, groups: int):
        self.doc_id, self.tie = doc_id, tie
        self.home = tie % groups

    def block(self, doc: np.ndarray, *arrays: np.ndarray) -> bytes:
        """A block of rows in order of doc: each document once, with how many rows it has."""
        first = runs(doc)
        own = doc[first]
        return pack(self.doc_id[own], self.tie[own], np.diff(np.append(first, len(doc))).astype("<u4"), *arrays)


def read(blocks, *kinds: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """doc_id and tie of the documents of blocks, the document's number of each row, and the rows' arrays."""
    doc_id, tie, count, *arrays = gather(blocks, "<i8", "<i8", "<u4", *kinds)
    return doc_id, tie, np.repeat(np.arange(len(count)), count), arrays


def repeats(names: Names, doc: np.ndarray, at: np.ndarray, more: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Blocks of marked starts by the documents' home: start and number of strings of each stretch."""
    if not len(doc):
        return
    order = np.lexsort((at, doc))
    doc, at, more = doc[order], at[order], more[order]
    ends = at + more + 1
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (at[1:] != ends[:-1])))[: len(doc)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    doc, at, many = doc[first], at[first], ends[last] - at[first]
    for home, rows in by_key(names.home[doc]):
        yield home, names.block(doc[rows], at[rows].astype("<u4"), many[rows].astype("<u4"))


def opened(names: Names, doc: np.ndarray, at: np.ndarray, more: np.ndarray, anchor: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Blocks of open contexts by the documents' home."""
    order = np.lexsort((at, doc))
    doc, at, more, anchor = doc[order], at[order], more[order], anchor[order]
    for home, rows in by_key(names.home[doc]):
        yield home, names.block(doc[rows], at[rows].astype("<u4"), more[rows].astype("u1"), *halves(anchor[rows]))


ENTRY = ("<u4", "u1", "u1", "<u4", "<u2", "<u4", "<u2")
OPEN = ("<u4", "u1", "<u4", "<u2")
MARK = ("<u4", "<u4")
_DEALT = pa.schema([("to", pa.int64()), ("home", pa.int64()), ("kind", pa.string()), ("data", pa.binary())])
_HOMED = pa.schema([("home", pa.int64()), ("kind", pa.string()), ("data", pa.binary())])


def settle_batch(names: Names, doc, at, more, anchor, body, groups: int) -> list[tuple]:
    """Step 1: rows of entries for step 2, of repeats and of open contexts."""
    pos = positions(doc, at, ranks(names.doc_id, names.tie))
    order = np.lexsort((pos, body, anchor))
    doc, at, more, anchor, body, pos = (x[order] for x in (doc, at, more, anchor, body, pos))
    if not len(doc):
        return []
    new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    new_body = new_anchor | np.concatenate(([True], body[1:] != body[:-1]))
    group = np.cumsum(new_anchor) - 1
    many = np.add.reduceat(new_body.astype(np.int64), np.flatnonzero(new_anchor)) > 1
    first_pos = pos[np.flatnonzero(new_body)][np.cumsum(new_body) - 1]
    again, open_now = pos > first_pos, new_body & many[group]
    rows = [(home % groups, home, "repeat", b) for home, b in repeats(names, doc[again], at[again], more[again])]
    rows += [(home % groups, home, "open", b) for home, b in opened(names, doc[open_now], at[open_now], more[open_now], anchor[open_now])]
    sent = np.flatnonzero(new_anchor)
    sent = sent[np.argsort(doc[sent], kind="stable")]
    for to, k in by_key((anchor[sent] % _U(groups)).astype(np.int64)):
        i = sent[k]
        block = names.block(doc[i], at[i].astype("<u4"), more[i].astype("u1"), many[group[i]].astype("u1"), *halves(anchor[i]), *halves(body[i]))
        rows.append((to, -1, "entry", block))
    return rows


def settle_anchors(blocks, groups: int) -> list[tuple]:
    """Step 2: rows of repeats and open contexts of the anchors of one group."""
    doc_id, tie, doc, (at, more, many, a1, a2, b1, b2) = read(blocks, *ENTRY)
    if not len(doc):
        return []
    names = Names(doc_id, tie, groups)
    anchor, body, at = whole(a1, a2), whole(b1, b2), at.astype(np.int64)
    pos = positions(doc, at, ranks(doc_id, tie))
    order = np.lexsort((pos, anchor))
    doc, at, more, many, anchor, body, pos = (x[order] for x in (doc, at, more.astype(np.int64), many, anchor, body, pos))
    first = runs(anchor)
    group = np.cumsum(np.bincount(first, minlength=len(anchor))) - 1
    differ = (np.maximum.reduceat(body, first) != np.minimum.reduceat(body, first)) | (np.maximum.reduceat(many, first) > 0)
    again, open_now = (pos > pos[first][group]) & ~differ[group], differ[group] & (many == 0)
    rows = [(home, "repeat", b) for home, b in repeats(names, doc[again], at[again], more[again])]
    return rows + [(home, "open", b) for home, b in opened(names, doc[open_now], at[open_now], more[open_now], anchor[open_now])]


def previous_factor(pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix in suffix order. pos: its position; lcp: common prefix with the suffix before it in the order.

    The previous and next smaller positions are found by jumping over larger ones, all suffixes at once; the common prefix
    with them is the least on the way.
    """
    n = len(pos)
    best = np.zeros(n, lcp.dtype)
    for p, near in ((pos, lcp), (pos[::-1], np.append(0, lcp[:0:-1]) if n else lcp)):
        to, least = np.arange(n) - 1, near.copy()
        todo = np.arange(n)
        while len(todo := todo[(to[todo] >= 0) & (p[to[todo]] >= p[todo])]):
            over = to[todo]
            least[todo], to[todo] = np.minimum(least[todo], least[over]), to[over]
        got = np.where(to >= 0, least, 0)
        best = np.maximum(best, got if p is pos else got[::-1])
    return best


def suffix_order(data: np.ndarray, start: np.ndarray, pos: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes from start, cut to length bytes, equal ones by position; common prefix of each with the one before."""
    at = [*range(0, length - 7, 8)]
    at += [length - 8] if length % 8 else []
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.stack([eight[start + k].copy().view(">u8")[:, 0].astype(np.uint64) for k in at])
    order = np.lexsort((pos, *words[::-1]))
    words = words[:, order]
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = words[:, 1:] ^ words[:, :-1]
        k = (differ != 0).argmax(0)
        first = differ[k, np.arange(len(k))]
        same = (first.astype(">u8").view("u1").reshape(-1, 8) != 0).argmax(1)
        lcp[1:] = np.where(first == 0, length, np.array(at)[k] + same)
    return order, lcp


def suffix_repeats(blocks, notices, groups: int) -> list[tuple]:
    """Step 3: rows of repeats among the open contexts of one group; of strings for the crowds that notices tell of."""
    doc_id, tie, doc, (at, more, anchor, data) = read_contexts(blocks)
    if not len(doc):
        return []
    names, rows = Names(doc_id, tie, groups), []
    crowd = np.isin(anchor, whole(*gather(notices, "<u4", "<u2")))
    size = more + LENGTH
    first = np.cumsum(size) - size
    if crowd.any():
        rows += crowd_strings(names, data, doc[crowd], at[crowd], more[crowd], first[crowd], groups)
        doc, at, more, first = doc[~crowd], at[~crowd], more[~crowd], first[~crowd]
    if len(doc):
        start = spread(first, more + 1)
        of = np.repeat(np.arange(len(doc)), more + 1)
        from_ = at[of] + start - first[of]
        pos = positions(doc[of], from_, ranks(doc_id, tie))
        order, lcp = suffix_order(data, start, pos)
        found = order[previous_factor(pos[order], lcp) >= LENGTH]
        rows += marks_of(names, doc[of[found]], from_[found], groups)
    return rows


def crowd_repeats(blocks, groups: int) -> list[tuple]:
    """Rows of repeats among the crowds' strings of one group."""
    doc_id, tie, doc, (at, x, y) = read(blocks, "<u4", "<u8", "<u8")
    if not len(doc):
        return []
    pos = positions(doc, at.astype(np.int64), ranks(doc_id, tie))
    order = np.lexsort((pos, y, x))
    lcp = np.concatenate(([0], np.where((x[order][1:] == x[order][:-1]) & (y[order][1:] == y[order][:-1]), LENGTH, 0)))
    found = order[previous_factor(pos[order], lcp) >= LENGTH]
    return [(home, "repeat", b) for home, b in repeats(Names(doc_id, tie, groups), doc[found], at[found].astype(np.int64), np.zeros(len(found), np.int64))]


def marks_of(names: Names, doc: np.ndarray, at: np.ndarray, groups: int) -> list[tuple]:
    return [(home % groups, home, "repeat", b) for home, b in repeats(names, doc, at, np.zeros(len(doc), np.int64))]


def read_contexts(blocks):
    doc_id, tie, doc, (at, more, a1, a2, data) = read(blocks, "<u4", "u1", "<u4", "<u2", "u1")
    return doc_id, tie, doc, (at.astype(np.int64), more.astype(np.int64), whole(a1, a2), data)


class Texts:
    """Texts of a group by doc_id and tie."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        doc_id, tie = (rows.column(c).to_numpy().astype(np.int64) for c in ("sa_id", "sa_tie"))
        self.data, self.start, self.size = text_bytes(rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string()))
        self.of: dict[tuple, list[int]] = {}
        for i, k in enumerate(zip(doc_id.tolist(), tie.tolist(), strict=True)):
            self.of.setdefault(k, []).append(i)

    def numbers(self, doc_id: np.ndarray, tie: np.ndarray) -> list[list[int]]:
        """Rows of each document; more than one where rows repeat."""
        return [self.of.get(k, []) for k in zip(doc_id.tolist(), tie.tolist(), strict=True)]


def bring(texts: Texts, blocks, groups: int) -> list[tuple]:
    """Rows of open contexts with their bytes; of notices, strings and repeats of crowds."""
    doc_id, tie, doc, (at, more, a1, a2) = read(blocks, *OPEN)
    if not len(doc):
        return []
    names = Names(doc_id, tie, groups)
    row = np.array([r[0] for r in texts.numbers(doc_id, tie)])
    anchor, more, at = whole(a1, a2), more.astype(np.int64), at.astype(np.int64)
    where, size = texts.start[row[doc]] + at, more + LENGTH
    distinct, of, many = np.unique(anchor, return_inverse=True, return_counts=True)
    crowd, meet = many[of] > CROWD, (anchor % _U(groups)).astype(np.int64)
    rows, few = [], np.flatnonzero(~crowd)
    for to, k in by_key(meet[few]):
        i = few[k]
        i = i[np.argsort(doc[i], kind="stable")]
        rows.append((to, -1, "context", names.block(doc[i], at[i].astype("<u4"), more[i].astype("u1"), *halves(anchor[i]), texts.data[spread(where[i], size[i])])))
    if crowd.any():
        told = distinct[many > CROWD]
        rows += [(to, -1, "notice", pack(*halves(told[k]))) for to, k in by_key((told % _U(groups)).astype(np.int64))]
        rows += crowd_strings(names, texts.data, doc[crowd], at[crowd], more[crowd], where[crowd], groups)
    return rows


def crowd_strings(names: Names, data: np.ndarray, doc, at, more, where, groups: int) -> list[tuple]:
    """Rows of the strings of contexts that lie at where in data, the first of equal ones, by fingerprint; and of repeats among them."""
    size = more + LENGTH
    data = data[spread(where, size)]
    start = spread(np.cumsum(size) - size, more + 1)
    of = np.repeat(np.arange(len(doc)), more + 1)
    from_ = spread(at, more + 1)
    g = rolling(data, 64)
    x, y = mix(g[start]), mix(g[start + LENGTH - 64] * _ODD[4] + g[start])
    pos = positions(doc[of], from_, ranks(names.doc_id, names.tie))
    order = np.lexsort((pos, y, x))
    new = np.concatenate(([True], (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])))
    again = order[pos[order] > pos[order][np.flatnonzero(new)][np.cumsum(new) - 1]]
    rows = marks_of(names, doc[of[again]], from_[again], groups)
    first = order[new]
    first = first[np.argsort(doc[of[first]], kind="stable")]
    for to, k in by_key((x[first] % _U(groups)).astype(np.int64)):
        i = first[k]
        rows.append((to, -1, "crowd", names.block(doc[of[i]], from_[i].astype("<u4"), x[i], y[i])))
    return rows


def removed(texts: Texts, blocks) -> np.ndarray:
    """Step 4: for each byte of texts whether it goes."""
    doc_id, tie, doc, (at, many) = read(blocks, *MARK)
    step = np.zeros(len(texts.data) + 1, np.int32)
    rows = texts.numbers(doc_id, tie)
    copies = np.array([len(r) for r in rows], np.int64)
    flat = np.array([i for r in rows for i in r], np.int64)
    first = np.cumsum(copies) - copies
    row = flat[spread(first[doc], copies[doc])] if len(doc) else flat[:0]
    lo = texts.start[row] + np.repeat(at.astype(np.int64), copies[doc])
    np.add.at(step, lo, 1)
    np.add.at(step, lo + np.repeat(many.astype(np.int64), copies[doc]) - 1 + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def apply(docs: DataFrame, finish, schema) -> DataFrame:
    """finish(rows, texts, gone) of each group of docs (doc_id, text and what finish needs), with a mark for each byte that goes."""
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.withColumn("sa_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("text", body)
    docs = docs.withColumn("sa_tie", F.xxhash64("sa_id", "text"))
    groups = groups_for(docs, F.col("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, ties, n, size = [], [], [], 0, 0

        def flush():
            names = Names(np.concatenate(ids), np.concatenate(ties), groups)
            for row in settle_batch(names, *[np.concatenate(x) for x in zip(*held, strict=True)], groups):
                yield from rows_of(_DEALT, [row]).to_batches()

        for batch in (x for b in batches for x in slices(b, 2, SLICE_BYTES)):
            data, start, sizes = text_bytes(batch.column(2))
            doc, *rest = contexts(data, start, sizes)
            held.append((doc + n, *rest))
            ids.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            ties.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
            n, size = n + len(sizes), size + len(data)
            if size >= BATCH_BYTES:
                yield from flush()
                held, ids, ties, n, size = [], [], [], 0, 0
        if held:
            yield from flush()

    def meet(rows: pa.Table) -> pa.Table:
        kinds, data = rows.column("kind").to_pylist(), rows.column("data").to_pylist()
        out = [(h, k, b) for h, k, b in zip(rows.column("home").to_pylist(), kinds, data, strict=True) if k != "entry"]
        return rows_of(_HOMED, out + settle_anchors((b for k, b in zip(kinds, data, strict=True) if k == "entry"), groups))

    def fetch(texts: pa.Table, rows: pa.Table) -> pa.Table:
        return rows_of(_DEALT, bring(Texts(texts), rows.column("data").to_pylist(), groups) if rows.num_rows else [])

    def order(rows: pa.Table) -> pa.Table:
        kind, data = np.array(rows.column("kind").to_pylist()), rows.column("data").to_pylist()
        own = lambda k: [data[i] for i in np.flatnonzero(kind == k).tolist()]
        return pa.concat_tables([rows.filter(pa.array((kind == "repeat") | (kind == "crowd"))), rows_of(rows.schema, suffix_repeats(own("context"), own("notice"), groups))])

    def follow(rows: pa.Table) -> pa.Table:
        kind, data = np.array(rows.column("kind").to_pylist()), rows.column("data").to_pylist()
        same = rows.filter(pa.array(kind == "repeat")).drop_columns("to")
        return pa.concat_tables([same, rows_of(same.schema, crowd_repeats([data[i] for i in np.flatnonzero(kind == "crowd").tolist()], groups))])

    def end(rows: pa.Table, marks: pa.Table) -> pa.Table:
        texts = Texts(rows)
        return finish(rows.combine_chunks(), texts, removed(texts, marks.column("data").to_pylist()))

    dealt = arrow.in_small_batches(docs).select("sa_id", "sa_tie", "text").mapInArrow(arrow.task(find), "to long, home long, kind string, data binary")
    settled = stash(dealt.groupBy("to").applyInArrow(arrow.group(meet), "home long, kind string, data binary"))
    # Both uses of the texts take the same columns and the same deal, so one exchange serves both.
    homed = docs.withColumn("sa_home", F.pmod("sa_tie", F.lit(groups))).groupBy("sa_home")
    four = "to long, home long, kind string, data binary"
    fetched = homed.cogroup(settled.where("kind = 'open'").groupBy("home")).applyInArrow(arrow.group_of_two(fetch), four)
    found = fetched.groupBy("to").applyInArrow(arrow.group(order), four).groupBy("to").applyInArrow(arrow.group(follow), "home long, kind string, data binary")
    marks = settled.where("kind = 'repeat'").unionByName(found)
    return homed.cogroup(marks.groupBy("home")).applyInArrow(arrow.group_of_two(end), schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs (doc_id, text)."""
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def finish(rows: pa.Table, texts: Texts, gone: np.ndarray) -> pa.Table:
        ids, found = rows.column("doc_id").to_pylist(), []
        for i, lo, n in zip(ids, texts.start.tolist(), texts.size.tolist(), strict=True):
            g = gone[lo : lo + n]
            k = int(g.sum())
            spans = int(np.count_nonzero(g[1:] & ~g[:-1])) + int(g[0]) if k else 0
            kept = texts.data[lo : lo + n][~g] if k else texts.data[lo : lo + n]
            found.append((i, n, k, spans, hashlib.sha256(kept).hexdigest()))
        return rows_of(out, found)

    return apply(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(docs: DataFrame) -> DataFrame:
    """docs with what repeats taken out of text, and n_chars, where there is such a column, its new length."""

    def finish(rows: pa.Table, texts: Texts, gone: np.ndarray) -> pa.Table:
        kept = []
        for lo, n in zip(texts.start.tolist(), texts.size.tolist(), strict=True):
            g = gone[lo : lo + n]
            kept.append(texts.data[lo : lo + n][~g].tobytes().decode(errors="ignore"))
        rows = rows.set_column(rows.schema.get_field_index("text"), "text", pa.array(kept, pa.string()))
        return rows.select([f"d{i}" if c != "text" else "text" for i, c in enumerate(names)])

    names = docs.columns
    # Other columns go under names of their own meanwhile.
    plain = docs.select("doc_id", *[F.col(c).alias(f"d{i}" if c != "text" else "text") for i, c in enumerate(names)])
    kinds = ", ".join(f"{f'd{i}' if c != 'text' else 'text'} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    done = apply(plain, finish, kinds)
    return done.select(*[(F.length("text").cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"d{i}" if c != "text" else "text")).alias(c) for i, c in enumerate(names)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c0 AS (SELECT doc_id, h, unnest(range(0, length(h) // 2, 500)) AS base FROM t),
c1 AS (SELECT doc_id, base, substr(h, 2 * base + 1, 1198) AS part FROM c0),
p AS (SELECT doc_id, base, part, unnest(range(0, greatest(length(part) // 2 - 99, 0))) AS o FROM c1),
m AS (SELECT doc_id, k FROM (SELECT doc_id, base + o AS k, row_number() OVER (PARTITION BY md5(substr(part, 2 * o + 1, 200)) ORDER BY doc_id, base + o) AS nth FROM p) WHERE nth > 1),
i AS (SELECT doc_id, k, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS span FROM (SELECT doc_id, k, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id ORDER BY k) + 100 THEN 0 ELSE 1 END AS new FROM m)),
r AS (SELECT doc_id, min(k) AS lo, max(k) + 100 AS hi FROM i GROUP BY doc_id, span),
b AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM r),
c AS (SELECT b.doc_id, string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (lo - before) AS BIGINT)), '' ORDER BY lo) AS head, max(hi) AS last, CAST(sum(hi - lo) AS BIGINT) AS n_removed, count(*) AS n_spans FROM b JOIN t ON t.doc_id = b.doc_id GROUP BY b.doc_id)
SELECT t.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256 FROM t LEFT JOIN c ON c.doc_id = t.doc_id
"""
