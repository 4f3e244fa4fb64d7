"""Links of the n-gram Jaccard join in clusters cut into blocks."""

from collections import Counter

import numpy as np

from tallyframe.llm import jaccard
from tests.llm.conftest import frame, prose
from tests.llm.test_pairs_and_copies import jaccard_brute


def test_trees_of_different_medians():
    """Blocks whose medians ask for bitmaps of different widths are joined."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    names = [bytes([k]) * 16 for k in range(20)]
    for small, large in ((range(110, 120), range(130, 140)), (range(130, 140), range(110, 120))):
        sets = [base[:k] for k in (*small, *large)]
        rows = [{"one": 0, "two": 1, "side": int(k >= 10), "cluster": names[0], "node": names[k], "n": len(s), "tokens": s.tobytes()} for k, s in enumerate(sets)]
        out = jaccard.join_block(jaccard.pa.Table.from_pylist(rows))
        part = {n: n for n in names}
        for r in out.to_pylist():
            part = {n: part[r["a"]] if p == part[r["b"]] else p for n, p in part.items()}
        assert len(set(part.values())) == 1


def test_jaccard_blocks_of_mixed_sizes(spark):
    """A chain of near copies of 110 to 300 shingles in blocks on both sides of 128 shared tokens."""
    words = prose(11, 310).split()
    rows = [(i, " ".join(words[: 114 + 4 * i])) for i in range(48)]
    want = jaccard_brute(rows)
    for size in (300, 900, 2500):
        assert Counter(tuple(r) for r in jaccard.join(frame(spark, rows, 2), task_tokens=size).collect()) == want


def links_brute(rows):
    """Rows with the number of other rows that each is linked to."""
    sets = []
    for _, t in rows:
        words = (t or "").lower().split()
        sets.append(frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else frozenset())
    linked = lambda a, b: bool(a) and bool(b) and 180 * len(a & b) >= 80 * (len(a) + len(b))
    n = [sum(linked(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)]
    return Counter((*r, k) for r, k in zip(sorted_like(rows, jaccard_brute(rows)), n, strict=True))


def sorted_like(rows, counted):
    """What jaccard_brute gives, in the order of rows, whose doc_ids differ."""
    by_id = {r[0]: r for r in counted.elements()}
    return [by_id[d] for d, _ in rows]


def test_links_are_counted(spark):
    """Links beyond those that connect, copies, rows without words, and blocks of a cluster."""
    words = prose(3, 100).split()
    rows = [(i, " ".join(words[:k] + [f"w{i}"] + words[k + 1 :])) for i in range(300) for k in [i * 7 % 100]]
    rows += [(400 + i, rows[i % 3][1]) for i in range(20)] + [(500 + i, " ".join(words[: 40 + i])) for i in range(60)]
    rows += [(600, None), (601, ""), (602, ""), (603, "one two"), (604, "one two"), (605, prose(9, 50)), (606, prose(9, 50))]
    want = links_brute(rows)
    assert max(r[3] for r in want) > 50 and min(r[3] for r in want) == 0
    for parts, size in ((1, 10**6), (3, 3000)):
        got = jaccard.join(frame(spark, rows, parts), task_tokens=size, links=True)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
        assert Counter(tuple(r) for r in got.collect()) == want


def test_shared_tokens():
    """Rare and frequent tokens give the sizes of all intersections; each pair counts once, in one block or between two."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 130).astype(np.uint64)
    sets = [np.unique(np.append(rng.choice(base, 122, replace=False), rng.integers(0, 2**63, 4).astype(np.uint64))) for _ in range(560)]
    sets += [np.unique(rng.choice(base[:40], rng.integers(1, 30))) for _ in range(60)]
    sizes, copies = np.array([len(s) + k % 3 for k, s in enumerate(sets)]), rng.integers(1, 5, len(sets))
    exact = np.array([[len(set(a) & set(b)) for b in (set(s.tolist()) for s in sets[550:])] for a in (set(s.tolist()) for s in sets[540:])])
    assert (jaccard.shared_tokens(sets[540:], sets[550:]) == exact).all()
    tree = jaccard.SignatureTree(sets, sizes)
    want = [sum(int(copies[j]) for j in range(len(sets)) if j != i and tree.linked(i, tree, j)) for i in range(0, len(sets), 31)]
    assert (jaccard.count_links(tree, copies)[0][::31] == want).all() and max(want) > 0
    left, right = jaccard.SignatureTree(sets[:300], sizes[:300]), jaccard.SignatureTree(sets[300:], sizes[300:])
    a, b = jaccard.count_links(left, copies[:300], right, copies[300:])
    apart = np.concatenate((a + jaccard.count_links(left, copies[:300])[0], b + jaccard.count_links(right, copies[300:])[0]))
    assert (apart == jaccard.count_links(tree, copies)[0]).all()
