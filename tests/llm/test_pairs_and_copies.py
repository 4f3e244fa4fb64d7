"""N-gram Jaccard join, exact dedup and suffix-array dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tallyframe.llm import exact_dedup, jaccard, suffix_dedup
from tests.llm.conftest import SF, frame, prose

SPACE = r"[\x20\x09-\x0D]+"


def jaccard_brute(rows):
    sets = []
    for _, t in rows:
        words = [w for w in re.split(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
        sets.append(frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else frozenset())
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    inverse = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inverse[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in inverse[x] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                part[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    best = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return Counter((d, len(sets[i]), best[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


def test_jaccard(odd):
    rows, docs = odd
    want = jaccard_brute(rows)
    assert Counter(tuple(r) for r in jaccard.join(docs).collect()) == want
    assert Counter(tuple(r) for r in jaccard.join(docs.repartition(1), task_tokens=900).collect()) == want


def test_jaccard_crowd(spark):
    """A token of over HOT sets in a batch, a large group of near copies, and blocks of one cluster."""
    words = prose(3, 100).split()
    rows = [(i, " ".join(words[:k] + [f"w{i}"] + words[k + 1 :])) for i in range(150) for k in [i * 7 % 100]]
    rows += [(1000 + i, " ".join(words[:30]) + " " + prose(5000 + i, 40)) for i in range(100)]
    want = jaccard_brute(rows)
    for parts, size in ((1, 10**6), (4, 3000)):
        assert Counter(tuple(r) for r in jaccard.join(frame(spark, rows, parts), task_tokens=size).collect()) == want


def test_jaccard_empty(spark, none):
    assert jaccard.join(none).collect() == []
    assert [tuple(r) for r in jaccard.join(frame(spark, [(5, None)])).collect()] == [(5, 0, 5)]


def test_signature_bound():
    """No pair of nodes with a link under it is dropped."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.unique(np.concatenate((rng.choice(base, 120, replace=False), rng.integers(0, 2**63, rng.integers(1, 30)).astype(np.uint64)))) for _ in range(60)]
    sets += [np.unique(np.append(s[: len(s) - rng.integers(0, 12)], _u(rng))) for s in sets]
    sizes = np.array([len(s) for s in sets])
    tree = jaccard.SignatureTree(sets, sizes)
    links = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if tree.linked(i, tree, j)}
    assert links
    for level in range(len(tree.levels)):
        w = jaccard.FAN_OUT**level
        a, b = (np.array(x) for x in zip(*[(i // w, j // w) for i, j in links], strict=True))
        assert tree.possible(tree, level, a, b).all()

    def classes(pairs):
        part = list(range(len(sets)))
        for i, j in pairs:
            p, q = part[i], part[j]
            part = [p if x == q else x for x in part]
        return {frozenset(i for i, x in enumerate(part) if x == c) for c in set(part)}

    assert classes(jaccard.join_trees(tree)) == classes(links)


def _u(rng):
    return rng.integers(0, 2**63, 1).astype(np.uint64)


def exact_brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(SPACE, "", t or "")].append((-len(t or ""), d is None, d))
    out = Counter()
    for body, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        for _, _, d in members:
            out[d, keep, len(members), d == keep, hashlib.sha256(body.encode()).hexdigest()] += 1
    return out


def test_exact(odd, none):
    rows, docs = odd
    want = exact_brute(rows)
    assert Counter(tuple(r) for r in exact_dedup.exact_dedup(docs).collect()) == want
    assert Counter(tuple(r) for r in exact_dedup.exact_dedup(docs, memtable_rows=7, fan_out=2).collect()) == want
    assert exact_dedup.exact_dedup(none).collect() == []


def test_exact_clashing_digests(odd):
    """Rows whose digests agree though their bytes don't are told apart by the bytes."""
    rows, docs = odd
    got = exact_dedup.exact_dedup(docs, digest=lambda t: F.substring(F.sha2(t, 256), 1, 1))
    assert Counter(tuple(r) for r in got.collect()) == exact_brute(rows)


def test_exact_rows_kept(odd):
    rows, docs = odd
    kept = exact_dedup.distinct(docs).collect()
    assert len(kept) == len({re.sub(SPACE, "", t or "") for _, t in rows}) and kept[0].__fields__ == docs.columns


def suffix_brute(rows):
    order = sorted({(d is not None, d or 0, t or "") for d, t in rows})
    ids = Counter(d for _, d, _ in order)
    assert max(ids.values()) <= 2  # rows that share an id with other texts come in the order of a hash
    seen, out = set(), {}
    for has, d, t in order:
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[d if has else None, t] = (d if has else None, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return Counter(out[d, t or ""] for d, t in rows)


def test_suffix(odd, none):
    rows, docs = odd
    rows = [r for r in rows if r != (7, prose(9, 50)) and r[0] is not None] + [(None, "n" + prose(1, 120))]
    want = suffix_brute(rows)
    for parts in (1, 4):
        assert Counter(tuple(r) for r in suffix_dedup.report(frame(docs.sparkSession, rows, parts)).collect()) == want
    assert suffix_dedup.report(none).collect() == []


def test_suffix_crowd(spark):
    """Over CROWD documents with one passage in different surroundings, runs of one byte, and repeats within a document."""
    passage = prose(11, 40)
    rows = [(i, prose(900 + i, 12) + f" {i}" + passage + f"{i} " + prose(1900 + i, 12)) for i in range(150)]
    rows += [(500, "ab" * 300), (501, "a" * 1000), (502, "a" * 99), (503, passage * 3), (504, "é" * 200)]
    want = suffix_brute(rows)
    for parts in (1, 5):
        assert Counter(tuple(r) for r in suffix_dedup.report(frame(spark, rows, parts)).collect()) == want
    # With about CROWD documents a group, some groups are crowds and others aren't.
    some = [r for r in rows if r[0] < 4 * suffix_dedup.CROWD]
    assert Counter(tuple(r) for r in suffix_dedup.report(frame(spark, some, 3)).collect()) == suffix_brute(some)


def test_suffix_cut(spark):
    rows = [(1, prose(1, 60)), (2, "x" + prose(1, 60) + "y"), (3, None)]
    got = {r.doc_id: r for r in suffix_dedup.cut(frame(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "xy" and got[2].n_chars == 2 and got[3].text == "" and got[2].node == "r1"


def test_previous_factor():
    rng = np.random.default_rng(2)
    for _ in range(20):
        n = 60
        pos, lcp = rng.permutation(n), rng.integers(0, 9, n)
        want = []
        for i in range(n):
            best = 0
            for step in (-1, 1):
                least, j = 99, i
                while 0 <= j + step < n:
                    least = min(least, lcp[j] if step < 0 else lcp[j + 1])
                    j += step
                    if pos[j] < pos[i]:
                        best = max(best, least)
                        break
            want.append(best)
        assert suffix_dedup.previous_factor(pos, lcp).tolist() == want


def test_sf(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in jaccard.query(spark, SF).collect()) == jaccard_brute(rows)
    assert Counter(tuple(r) for r in suffix_dedup.query(spark, SF).collect()) == suffix_brute(rows)
