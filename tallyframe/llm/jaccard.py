"""Exact n-gram Jaccard join with signature trees, and the components of its links.

1. Each batch of texts hashes the shingles of every document; a document stands for its set (a 128-bit fingerprint), so
   copies are one node. Each distinct set of a batch sends its tokens to meet by token, with its number in the batch.
2. Where a token meets, the number of sets that hold it is known, a set of several batches counted for each. Tokens of two
   sets or more go back to their batch; the others can't be in an intersection. A token of HOT sets or more within a batch
   sends one mark instead of an entry for each set and counts as frequent everywhere.
3. A set with less than THRESHOLD of its tokens shared has no link and is done. The others are gathered to clusters by
   their prefix: under an order with rare tokens first, linked sets share one of their first n - ceil(THRESHOLD n) + 1.
4. Clusters are joined by signature trees: leaves are sets, nodes hold the OR of their sets' token bitmaps and size
   ranges, and a dual traversal drops pairs of nodes whose sizes or largest possible overlap rule a link out. What is
   left is verified on the tokens, except within what is already connected. A cluster holds whole components, so a task
   names each set's smallest connected one. Large clusters are cut into blocks, a task for each pair of blocks.
5. What the blocks of large clusters connect goes to components. join() finds no links but those that connect;
   join(links=True) counts all links of each set too: the sizes of intersections within a task, 256 sets by 256 sets,
   with no pair given out.

Hot groups: a token that many prefixes hold meets in two steps, by token and salt and then by token; rows that share a set,
a cluster or a component of many are joined where they lie (common.join_counted).

Tokens are compared by 48 bits and the group that they meet in.

Defined cases: a null text is empty; a document without words has n_shingles 0 and its own doc_id as component; under five
words the whole sequence is one shingle; rows that repeat are each returned; a null doc_id comes after all others, so it
is a component_id only where its component has no other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrow
from .arrow import slices, text_bytes
from .blocks import BATCH_BYTES, SLICE_BYTES, by_key, gather, groups_for, pack, rows_of, runs, spread, unpack
from .common import components, join_counted, stash, table

#: Words of a shingle; a link has 100 * intersection >= PERCENT * union.
SHINGLE, PERCENT = 5, 80
#: Sets of a batch that make a token frequent, the count that stands for frequent, tokens of a task of step 4, fan-out of a tree.
HOT, FREQUENT, TASK_TOKENS, FAN_OUT = 64, 255, 2_000_000, 16
#: Parts of a token's sets that meet by themselves first.
SALTS = 256
#: For counts of links: sets of a group, pairs of a token that make it dense, dense tokens of one product.
GROUP, DENSE, WIDE = 256, 400, 4096
_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _ODD[3]
    x = (x ^ (x >> _U(29))) * _ODD[1]
    return x ^ (x >> _U(32))


#: A byte's value within a word; 0: white space. A-Z count as a-z.
_BYTE = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _ODD[0])
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def shingle_sets(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of texts that lie in data, ascending within each text, and each text's number of them."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(size), np.int64)
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    at = start[size > 0]
    first[at] = ~space[at]
    begin = np.flatnonzero(first)
    doc = np.repeat(np.arange(len(size)), size)[begin]
    # A word's hash sums its bytes' values times powers of an odd number, counted from the word's start.
    length = np.diff(np.append(begin, len(data)))
    place = np.arange(len(data)) - np.repeat(begin, length)[: len(data)] if begin.size and begin[0] == 0 else None
    if place is None:
        place = np.arange(len(data)) - np.repeat(np.append(0, begin), np.diff(np.concatenate(([0], begin, [len(data)]))))
    longest = int(place.max()) + 1
    value = np.where(space, _U(0), _BYTE[data])
    value *= powers(longest)[place]
    words = mix(np.add.reduceat(value, begin)) if len(begin) else np.zeros(0, np.uint64)
    count = np.bincount(doc, minlength=len(size))
    grams = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    head = np.cumsum(count) - count
    from_ = spread(head, grams)
    of = np.repeat(np.arange(len(size)), grams)
    width = np.minimum(count, SHINGLE)[of]
    h = width.astype(np.uint64) * _ODD[4]
    for k in range(SHINGLE):
        on = k < width
        h = np.where(on, mix(h ^ words[np.where(on, from_ + k, 0)]) if len(words) else h, h)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return h[new], np.bincount(of[new], minlength=len(size))


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.full(max(n, 2 * len(_POWERS)), _ODD[2]), dtype=np.uint64)
    return _POWERS


def fingerprints(tokens: np.ndarray, count: np.ndarray) -> np.ndarray:
    """128 bits of each set, as rows of two numbers; zero for empty sets."""
    out = np.zeros((len(count), 2), np.uint64)
    has = np.flatnonzero(count)
    if len(has):
        first = (np.cumsum(count) - count)[has]
        n = count[has].astype(np.uint64)
        out[has, 0] = mix(np.add.reduceat(mix(tokens), first) + n)
        out[has, 1] = mix(np.add.reduceat(mix(tokens * _ODD[0] + _ODD[2]), first) ^ n * _ODD[4])
    return out


def same_sets(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct key, and each row's number among those."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]).any(1)
    of = np.zeros(len(k), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The high 48 bits as 32 and 16."""
    return (x >> _U(32)).astype("<u4"), (x >> _U(16)).astype("<u2")


def whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << _U(16) | low


def lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal values as 16-bit values and lengths; longer runs are cut."""
    first = runs(values)
    size = np.diff(np.append(first, len(values)))
    parts = -(-size // 65_535)
    out = np.full(int(parts.sum()), 65_535)
    if len(size):
        out[np.cumsum(parts) - 1] = size - (parts - 1) * 65_535
    return np.repeat(values[first], parts).astype("<u2"), out.astype("<u2")


_DEALT = pa.schema([("to", pa.int64()), ("home", pa.int64()), ("kind", pa.string()), ("data", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])
_MET = "home long, kind string, data binary, doc_id long, n long, node binary"
_DEALT_SQL = f"to long, {_MET}"


def settle_batch(keys: np.ndarray, n: np.ndarray, tokens: np.ndarray, groups: int) -> Iterator[tuple]:
    """(to or None, kind, data) for step 2 from the sets of a batch: entries and marks by token, frequent tokens, and the sets themselves."""
    rep, _ = same_sets(keys)
    kept = np.zeros(len(keys), bool)
    kept[rep] = n[rep] > 0
    row = np.repeat(np.arange(len(keys)), n)
    tokens, row = tokens[kept[row]], row[kept[row]]
    if not len(tokens):
        return
    yield None, "sets", pack(keys, n.astype("<u4"))
    order = np.argsort(tokens, kind="stable")
    first = runs(tokens[order])
    size = np.diff(np.append(first, len(tokens)))
    hot = np.zeros(len(tokens), bool)
    hot[order] = np.repeat(size >= HOT, size)
    marks = tokens[order][first][size >= HOT]
    for to, k in by_key((marks % _U(groups)).astype(np.int64)):
        yield to, "mark", pack(*halves(marks[k]))
    cold = np.flatnonzero(~hot)
    for to, k in by_key((tokens[cold] % _U(groups)).astype(np.int64)):
        i = cold[k]
        yield to, "entry", pack(*lengths(row[i]), *halves(tokens[i]))
    i = np.flatnonzero(hot)
    if len(i):
        yield None, "shared", pack(*lengths(row[i]), whole_tokens(tokens[i], groups), np.full(len(i), FREQUENT, "u1"))


def whole_tokens(tokens: np.ndarray, groups: int) -> np.ndarray:
    """Tokens as all of steps 3 to 5 know them: 48 bits and the group they meet in."""
    return mix((tokens >> _U(16)) * _ODD[0] + tokens % _U(groups))


def count_tokens(entries: list[tuple[int, bytes]], marks: Iterator[bytes], group: int) -> Iterator[tuple[int, bytes]]:
    """Step 2: blocks of the tokens that two sets or more share, with their counts, by batch. entries: (batch, block)."""
    if not entries:
        return
    blocks = [unpack(data, "<u2", "<u2", "<u4", "<u2") for _, data in entries]
    tokens = np.concatenate([whole(b[2], b[3]) for b in blocks])
    order = np.argsort(tokens, kind="stable")
    first = runs(tokens[order])
    size = np.diff(np.append(first, len(tokens)))
    count = np.where(np.isin(tokens[order][first], whole(*gather(marks, "<u4", "<u2"))), FREQUENT, np.minimum(size, FREQUENT)).astype("u1")
    each = np.empty(len(tokens), "u1")
    each[order] = np.repeat(count, size)
    at = 0
    for (batch, _), (value, length, high, _) in zip(entries, blocks, strict=True):
        c = each[at : at + len(high)]
        keep = c > 1
        if keep.any():
            of = np.repeat(value, length)[keep]
            yield batch, pack(*lengths(of), mix(tokens[at : at + len(high)][keep] * _ODD[0] + _U(group)), c[keep])
        at += len(high)


_SHARING = pa.schema([("node", pa.binary()), ("n", pa.int64()), ("k", pa.int64()), ("tokens", pa.binary()), ("prefix", pa.list_(pa.int64()))])


def sharing(sets: bytes, blocks: Iterator[bytes]) -> list[tuple]:
    """Step 3: sets of a batch with enough shared tokens: those tokens, ascending, and the shared ones of the prefix."""
    keys, n = unpack(sets, "<u8", "<u4")
    keys = keys.reshape(-1, 2)
    value, length, tokens, count = gather(blocks, "<u2", "<u2", "<u8", "u1")
    of = np.repeat(value, length).astype(np.int64)
    k = np.bincount(of, minlength=len(n))
    enough = (100 * k >= PERCENT * n.astype(np.int64))[of]
    of, tokens, count = of[enough], tokens[enough], count[enough]
    order = np.lexsort((tokens, of))
    of, tokens, count = of[order], tokens[order], count[order]
    first = runs(of)
    rows = []
    for lo, hi in zip(first.tolist(), np.append(first[1:], len(of)).tolist(), strict=True):
        i, k = of[lo], hi - lo
        size = int(n[i])
        least = -(-PERCENT * size // 100)
        take = size - least + 1 - (size - k)
        own = np.lexsort((tokens[lo:hi], count[lo:hi]))[:take]
        rows.append((keys[i].tobytes(), size, k, tokens[lo:hi].tobytes(), tokens[lo:hi][own].view(np.int64)))
    return rows


class SignatureTree:
    """Sets (tokens, size) as leaves in the order given, and levels of nodes of FAN_OUT children each, up to one root.

    A node has the OR of bitmaps, the least and greatest size, and the most tokens that a set under it has beyond its
    bitmap's ones: tokens that share a bit with another. Two sets share at most as many tokens as the AND of their
    bitmaps has ones, plus those of either. Trees that are joined have bitmaps of the same width, bits.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, bits: int | None = None):
        self.sets, self.sizes = sets, sizes
        own = np.array([len(s) for s in sets])
        self.bits = bits = bits or 1 << int(np.clip(8 * np.median(own), 512, 16384)).bit_length()
        flat = np.concatenate(sets)
        maps = np.zeros((len(sets), bits // 8), np.uint8)
        at = (flat % _U(bits)).astype(np.int64)
        np.bitwise_or.at(maps, (np.repeat(np.arange(len(sets)), own), at >> 3), (1 << (at & 7)).astype(np.uint8))
        maps = maps.view(np.uint64)
        self.levels = [(maps, sizes, sizes, own - np.bitwise_count(maps).sum(1, dtype=np.int64))]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, lost = self.levels[-1]
            cut = np.arange(0, len(maps), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(lost, cut)))

    def possible(self, other: SignatureTree, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of nodes of a level may have a link under them."""
        (m1, lo1, hi1, x1), (m2, lo2, hi2, x2) = self.levels[level], other.levels[level]
        sized = (100 * hi1[a] >= PERCENT * lo2[b]) & (100 * hi2[b] >= PERCENT * lo1[a])
        out = np.zeros(len(a), bool)
        i = np.flatnonzero(sized)
        for part in np.array_split(i, max(1, len(i) * m1.shape[1] >> 21)):
            shared = np.bitwise_count(m1[a[part]] & m2[b[part]]).sum(1, dtype=np.int64)
            most = shared + np.minimum(x1[a[part]], x2[b[part]])
            out[part] = (100 + PERCENT) * most >= PERCENT * (lo1[a[part]] + lo2[b[part]])
        return out

    def linked(self, i: int, other: SignatureTree, j: int) -> bool:
        a, b = self.sets[i], other.sets[j]
        at = np.searchsorted(a, b)
        shared = int((a[np.minimum(at, len(a) - 1)] == b).sum())
        return (100 + PERCENT) * shared >= PERCENT * int(self.sizes[i] + other.sizes[j])


def join_trees(left: SignatureTree, right: SignatureTree | None = None) -> list[tuple[int, int]]:
    """Links that connect all that is linked: within left, or between left and right."""
    own = right is None
    right = left if own else right
    n, shift = len(left.sets), 0 if own else len(left.sets)
    part = np.arange(n + (0 if own else len(right.sets)))
    members: dict[int, list[int]] = {}
    links = []
    # Levels of the two trees are counted from the leaves; the lower tree's root stands in above its top.
    top = min(len(left.levels), len(right.levels)) - 1
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(left.levels[top][0])), np.arange(len(right.levels[top][0])), indexing="ij"))
    todo = [(top, a, b)]
    while todo:
        level, a, b = todo.pop()
        if own:
            keep = a <= b
            a, b = a[keep], b[keep]
        width = FAN_OUT**level
        lo_a, lo_b = a * width, b * width + shift
        hi_a, hi_b = np.minimum(lo_a + width, n), np.minimum(lo_b + width, len(part))
        if level:
            # Nodes whose sets are all connected already have nothing to add.
            open_ = ~(uniform(part, lo_a, hi_a) & uniform(part, lo_b, hi_b) & (part[lo_a] == part[lo_b]))
        else:
            open_ = (part[lo_a] != part[lo_b]) & ((a != b) | (not own))
        a, b = a[open_], b[open_]
        keep = left.possible(right, level, a, b)
        a, b = a[keep], b[keep]
        if level:
            if len(a) > 256:
                for k in range((len(a) - 1) // 256, -1, -1):
                    todo.append((level, a[256 * k : 256 * k + 256], b[256 * k : 256 * k + 256]))
                continue
            m1, m2 = len(left.levels[level - 1][0]), len(right.levels[level - 1][0])
            step = np.arange(FAN_OUT)
            x = np.repeat(a * FAN_OUT, FAN_OUT**2) + np.tile(np.repeat(step, FAN_OUT), len(a))
            y = np.repeat(b * FAN_OUT, FAN_OUT**2) + np.tile(step, FAN_OUT * len(a))
            keep = (x < m1) & (y < m2)
            todo.append((level - 1, x[keep], y[keep]))
            continue
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            p, q = part[i], part[j + shift]
            if p != q and left.linked(i, right, j):
                links.append((i, j))
                if len(members.get(p, ())) < len(members.get(q, ())):
                    p, q = q, p
                gone = members.pop(q, [q])
                members.setdefault(p, [p]).extend(gone)
                part[gone] = p
    return links


def uniform(part: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether all of part[lo:hi] agree, for each pair."""
    change = np.concatenate(([0], np.cumsum(part[1:] != part[:-1])))
    return change[hi - 1] == change[lo]


def shared_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each of left with each of right. Tokens of many pairs are multiplied as 0/1 matrices, the others paired."""
    out = np.zeros(len(left) * len(right), np.int64)
    (x, i), (y, j) = ((np.concatenate(s), np.repeat(np.arange(len(s)), [len(v) for v in s])) for s in (left, right))
    known = np.intersect1d(x, y)
    if not len(known):
        return out.reshape(len(left), -1)

    def held(tokens, of):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        ok = known[at] == tokens
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], of[ok][order], np.bincount(at[ok], minlength=len(known))

    (x, i, m), (y, j, n) = held(x, i), held(y, j)
    dense = m * n > DENSE
    columns = np.flatnonzero(dense)
    for lo in range(0, len(columns), WIDE):
        c = columns[lo : lo + WIDE]
        place = np.full(len(known), -1)
        place[c] = np.arange(len(c))
        one, two = (np.zeros((len(s), len(c)), np.float32) for s in (left, right))
        for matrix, token, of in ((one, x, i), (two, y, j)):
            k = place[token] >= 0
            matrix[of[k], place[token[k]]] = 1
        out += (one @ two.T).astype(np.int64).ravel()
    # Each entry on the left meets all entries of its token on the right.
    k = np.flatnonzero(~dense[x])
    begin = np.cumsum(n) - n
    for part in np.array_split(k, max(1, int(n[x[k]].sum()) >> 20)):
        size = n[x[part]]
        out += np.bincount(np.repeat(i[part], size) * len(right) + j[spread(begin[x[part]], size)], minlength=len(out))
    return out.reshape(len(left), -1)


def count_links(left: SignatureTree, weights: np.ndarray, right: SignatureTree | None = None, others: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights of all sets that each set of left, and of right, is linked to: within left, or between left and right."""
    own = right is None
    if own:
        right, others = left, weights
    a_out, b_out = np.zeros(len(left.sets), np.int64), np.zeros(len(right.sets), np.int64)
    for a in range(0, len(left.sets), GROUP):
        for b in range(a if own else 0, len(right.sets), GROUP):
            i, j = slice(a, a + GROUP), slice(b, b + GROUP)
            p, q = left.sizes[i], right.sizes[j]
            if 100 * p.max() < PERCENT * q.min() or 100 * q.max() < PERCENT * p.min():
                continue
            linked = (100 + PERCENT) * shared_tokens(left.sets[i], right.sets[j]) >= PERCENT * (p[:, None] + q)
            if own and a == b:
                np.fill_diagonal(linked, False)
            a_out[i] += linked @ others[j]
            if not own or a != b:
                b_out[j] += weights[i] @ linked
    return (a_out + b_out, b_out) if own else (a_out, b_out)


def tree_of(rows: pa.Table, bits: int | None = None) -> tuple[list[bytes], np.ndarray, SignatureTree]:
    """Sets, and their copies, in an order that puts similar ones near each other: by cluster, then size."""
    order = sorted(range(rows.num_rows), key=list(zip(rows.column("cluster").to_pylist(), rows.column("n").to_pylist(), rows.column("node").to_pylist(), strict=True)).__getitem__)
    node, n, tokens = (rows.column(c).to_pylist() for c in ("node", "n", "tokens"))
    copies = rows.column("copies").to_numpy()[order] if "copies" in rows.column_names else None
    return [node[i] for i in order], copies, SignatureTree([np.frombuffer(tokens[i], np.uint64) for i in order], np.array([n[i] for i in order]), bits)


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n_links", pa.int64()), ("part", pa.bool_())])


def stars(links: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """Each linked set but the least with the least set that it is connected to."""
    least: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while (up := least.get(x, x)) != x:
            least[x] = x = least.get(up, up)
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        least[b] = a
    return [(x, root(x)) for x in least if root(x) != x]


def join_block(rows: pa.Table) -> pa.Table:
    """Rows (a, b, null, part) of the sets of one task: b is the least set that a is connected to there; part: of a cluster cut into blocks.
    Side 1 is there for a pair of blocks of one cluster. With copies, also rows (a, null, n_links, part)."""
    first, second = (rows.filter(pc.equal(rows.column("side"), k)) for k in (0, 1))
    pair = pc.any(pc.not_equal(rows.column("one"), rows.column("two"))).as_py()
    if not first.num_rows or pair and not second.num_rows:
        return rows_of(_LINKS, [])
    names, copies, tree = tree_of(first)
    others, more, right = tree_of(second, tree.bits) if pair else (names, None, None)
    part = pc.any(pc.greater_equal(rows.column("one"), 0)).as_py()
    out = [(a, b, None, part) for a, b in stars([(names[i], others[j]) for i, j in join_trees(tree, right)])]
    if copies is not None:
        a, b = count_links(tree, copies, right, more)
        out += [(x, None, n, part) for x, n in [*zip(names, a.tolist(), strict=True), *(zip(others, b.tolist(), strict=True) if pair else ())] if n]
    return rows_of(_LINKS, out)


def clusters_of(sets: DataFrame) -> DataFrame:
    """(node, root): sets whose prefixes are connected by common tokens have one root."""
    meets = sets.select("node", F.explode("prefix").alias("token")).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    parts = meets.groupBy("token", "salt").agg(F.min("node").alias("head"), F.count("*").alias("m"))
    within = meets.join(parts.where("m > 1"), ["token", "salt"]).where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    firsts = parts.groupBy("token").agg(F.min("head").alias("first"), F.count("*").alias("n")).where("n > 1")
    across = parts.join(firsts, "token").where("head <> first").select(F.col("head").alias("a"), F.col("first").alias("b"))
    return stash(components(within.unionByName(across)))


def find_links(sets: DataFrame, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """Rows (a, b, null, part) that connect all linked sets of sets (node, n, k, tokens, prefix): all there is to a where not part, within the
    task where part. With a column copies, also (a, null, n_links, part) by task: copies of sets linked to a."""
    held = ["node", "n", "tokens", *(["copies"] if "copies" in sets.columns else [])]
    clusters = clusters_of(sets)
    sized = stash(sets.select("node", "k").join(clusters, "node").groupBy("root").agg(F.sum("k").alias("weight"), F.count("*").alias("nodes")))
    total, nodes = sized.agg(F.sum("weight"), F.sum("nodes")).first()
    bundles = max(1, -(-(total or 0) // task_tokens))
    placed = join_counted(clusters, sized.withColumn("blocks", F.expr(f"int(ceil(weight / {task_tokens}))")), "root", "nodes", nodes or 0)
    placed = sets.select(*held).join(placed, "node").withColumn("block", F.expr("int(pmod(xxhash64(node), blocks))"))
    small = placed.where("blocks = 1").select(F.pmod(F.xxhash64("root"), F.lit(bundles)).alias("task"), F.lit(-1).alias("one"), F.lit(-1).alias("two"), F.lit(0).alias("side"), F.col("root").alias("cluster"), *held)
    each = placed.where("blocks > 1").withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    large = each.select(
        F.xxhash64("root").alias("task"), F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"), (F.col("block") > F.col("with")).cast("int").alias("side"), F.col("root").alias("cluster"), *held
    )
    return small.unionByName(large).groupBy("task", "one", "two").applyInArrow(arrow.group(join_block), "a binary, b binary, n_links long, part boolean")


def join(docs: DataFrame, task_tokens: int = TASK_TOKENS, links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text); with links also n_links, the other rows that it is linked to."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = groups_for(docs, F.col("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, batch = [], 0, TaskContext.get().partitionId() << 32

        def flush():
            keys, n, tokens = (np.concatenate(x) for x in zip(*held, strict=True))
            for to, kind, data in settle_batch(keys, n, tokens, groups):
                yield from rows_of(_DEALT, [(batch % groups if to is None else to, batch, kind, data, None, None, None)]).to_batches()

        for part in (y for b in batches for x in slices(b, 1, SLICE_BYTES) for y in (x.slice(lo, 30_000) for lo in range(0, x.num_rows, 30_000))):
            data, start, size = text_bytes(part.column(1))
            if held and total + len(data) > BATCH_BYTES or sum(len(h[1]) for h in held) > 30_000:
                yield from flush()
                held, total, batch = [], 0, batch + 1
            tokens, n = shingle_sets(data, start, size)
            keys = fingerprints(tokens, n)
            held.append((keys, n, tokens))
            total += len(data)
            m, raw = len(n), keys.tobytes()
            node = pa.array([raw[16 * i : 16 * i + 16] if n[i] else None for i in range(m)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array((batch + np.arange(m)) % groups), pa.nulls(m, pa.int64()), pa.array(["document"] * m), pa.nulls(m, pa.binary()), part.column(0), pa.array(n, pa.int64()), node], schema=_DEALT)
        if held:
            yield from flush()

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        kind, home, data = np.array(rows.column("kind").to_pylist()), rows.column("home"), rows.column("data")
        same = rows.filter(pa.array((kind != "entry") & (kind != "mark"))).drop_columns("to")
        places = lambda k: np.flatnonzero(kind == k).tolist()
        entries = [(home[i].as_py(), data[i].as_py()) for i in places("entry")]
        found = [(h, "shared", b, None, None, None) for h, b in count_tokens(entries, (data[i].as_py() for i in places("mark")), key[0].as_py())]
        return pa.concat_tables([same, rows_of(same.schema, found)])

    def share(rows: pa.Table) -> pa.Table:
        kind, data = rows.column("kind").to_pylist(), rows.column("data")
        (sets,) = [data[i].as_py() for i, k in enumerate(kind) if k == "sets"]
        return rows_of(_SHARING, sharing(sets, (data[i].as_py() for i, k in enumerate(kind) if k == "shared")))

    dealt = arrow.in_small_batches(docs).mapInArrow(arrow.task(find), _DEALT_SQL)
    met = stash(dealt.groupBy("to").applyInArrow(arrow.group_of_two(meet), _MET))
    sets = met.where("kind <> 'document'").select("home", "kind", "data").groupBy("home").applyInArrow(arrow.group(share), "node binary, n long, k long, tokens binary, prefix array<long>")
    # A set that several batches hold is one node.
    sets = stash(sets.dropDuplicates(["node"]))
    rows = met.where("kind = 'document'").select("doc_id", "n", "node")
    copies = stash(rows.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")))
    found = stash(find_links(sets.join(copies.select("node", "copies"), "node") if links else sets, task_tokens))
    connected = found.where("b is not null")
    roots = connected.where("not part").select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(components(connected.where("part").select("a", "b")))
    joined = stash(copies.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    total, nodes = joined.agg(F.sum("copies"), F.count("*")).first()
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes"))
    named = join_counted(joined.select("node", "root", "copies"), named, "root", "nodes", nodes).drop("root")
    out = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    if links:
        counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("others"))
        named = named.join(counts, "node", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0))).drop("others")
        out = [*out, "n_links"]
    linked = join_counted(rows.where("node is not null"), named, "node", "copies", total or 0).select(*out)
    alone = rows.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *([F.lit(0).cast("long").alias("n_links")] if links else []))
    return linked.unionByName(alone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


def links_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), links=True)


SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s FROM t),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM s UNION SELECT r.d, e.b FROM r JOIN e ON r.c = e.a)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM s JOIN r ON r.d = s.doc_id GROUP BY s.doc_id
"""
