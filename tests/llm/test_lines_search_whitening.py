"""Line index, ranked search and whitening against brute force, and odd rows."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyframe.llm import line_dedup, registry, search, whitening
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_ranked_search"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = con.execute(registry.SQL[name])
    cols = [d[0] for d in got.description]
    assert sorted(tuple(r[c] for c in cols) for r in registry.QUERIES[name](spark, SF).collect()) == sorted(got.fetchall())


# Lines


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain_lines(inserted, rows, least, shortest=1):
    """(doc_id, n_lines, n_dropped, text) of rows by the lines of inserted rows."""
    n = Counter(k for _, t in inserted for k in {key(x) for x in (t or "").split("\n")} if len(k) >= shortest)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if n[key(x)] < least]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_rows(seed=1):
    rng = random.Random(seed)
    common = ["Share this", "  Share THIS\t", "ÄÖ ü", "äö ü", "a", "\x0bx\x0c", "All rights reserved " * 50]
    rows = [(None, "Share this\n\nb"), (1, None), (2, ""), (2, ""), (3, "\n\n"), (4, " \t\r"), (5, "a\na\na"), (5, "a\na\na"), (6, "x\n" * 5000)]
    return rows + [(10 + i, "\n".join(rng.choice(common) if rng.random() < 0.5 else f"line {rng.randrange(60)}" for _ in range(rng.randrange(1, 9)))) for i in range(120)]


def cleaned(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, 0])
def test_lines(spark, filter_bytes):
    """In place, and beyond the bound of the filters by a join."""
    rows = line_rows()
    for least, shortest in ((10, 1), (3, 4), (1, 1)):
        index = line_dedup.LineIndex(spark, least=least, shortest=shortest, filter_bytes=filter_bytes, shard_keys=16)
        index.insert(frame(spark, rows))
        assert cleaned(index.clean(frame(spark, rows))) == sorted(plain_lines(rows, rows, least, shortest), key=repr)


def test_lines_reversible(spark):
    rows = line_rows()
    parts = [rows[:50], rows[50:90], rows[90:]]
    index = line_dedup.LineIndex(spark, least=4, shard_keys=4)
    now = []
    for what, part in ((1, 0), (1, 1), (-1, 0), (1, 2), (-1, 1)):
        index.insert(frame(spark, parts[part])) if what > 0 else index.delete(frame(spark, parts[part]))
        now = now + parts[part] if what > 0 else [r for r in now if r not in parts[part]]
        counts = Counter(line_dedup.digest(key(k).encode()) for _, t in now for k in {key(x) for x in (t or "").split("\n")} if key(k))
        assert {bytes(r.digest): r.docs for r in index.counts().collect()} == counts
        common = {d for d, n in counts.items() if n >= 4}
        assert index.common == len(common)
        # Filters hold all common keys and hardly any other.
        made = index.lookup(frame(spark, rows))
        held = made.holds(sorted(common))
        assert held.all()
        assert cleaned(index.clean(frame(spark, rows))) == sorted(plain_lines(now, rows, 4), key=repr)
    was = index.runs, index.common, index.shards, index.filters
    with pytest.raises(ValueError):
        index.delete(frame(spark, [(9, "never seen")]))
    with pytest.raises(PySparkException):
        index.insert(frame(spark, [(9, "x")]).withColumn("text", F.raise_error(F.lit("broken"))))
    assert was == (index.runs, index.common, index.shards, index.filters)
    index.compact()
    assert len(index.runs) == 1 and cleaned(index.clean(frame(spark, rows))) == sorted(plain_lines(now, rows, 4), key=repr)


def test_lines_false_positives(spark):
    """What a filter holds by mistake stays, told by the exact counts."""
    rows = [(i, "often\nseldom") for i in range(5)]
    index = line_dedup.LineIndex(spark, least=5)
    index.insert(frame(spark, rows[:4] + [(4, "often")]))
    held = line_dedup.Cuckoo(np.frombuffer(index._filters().first().slots, "<u4").copy())
    assert held.insert(line_dedup.digest(b"seldom"))
    index.filters = index._write(spark.createDataFrame([(0, bytearray(held.slots.astype("<u4").tobytes()))], "shard int, slots binary"), "filters")
    made = index.lookup(frame(spark, rows))
    assert made.exceptions == {line_dedup.digest(b"seldom")}
    assert {r.text for r in index.clean(frame(spark, rows)).collect()} == {"seldom"}


def test_cuckoo():
    keys = [line_dedup.digest(str(i).encode()) for i in range(3000)]
    full = line_dedup.Cuckoo.empty(1500)
    assert all(full.insert(k) for k in keys[:1500])
    for k in keys[:700]:
        full.remove(k)
    assert all(full.insert(k) for k in keys[1500:2200])
    made = line_dedup.Filters(1, {0: full.slots.astype("<u4").tobytes()})
    assert made.holds(keys[700:2200]).all() and not made.holds(keys[2200:] + keys[:700]).any()
    tiny = line_dedup.Cuckoo(np.zeros(8, np.uint32))
    assert not all(tiny.insert(k) for k in keys[:20])


def test_lines_full_shard(spark, monkeypatch):
    """Keys that agree in fingerprint and bucket fill their places; more shards part them."""
    same = [bytes([i, i, i, i]) + bytes(4) + b"same" + bytes(4) for i in range(20)]
    monkeypatch.setattr(line_dedup, "line_counts", lambda docs, shortest, sign: spark.createDataFrame([(bytearray(k), 10) for k in same], "digest binary, docs long"))
    index = line_dedup.LineIndex(spark)
    index.insert(frame(spark, [(1, "x")]))
    made = line_dedup.Filters(index.shards, {r.shard: bytes(r.slots) for r in index._filters().collect()})
    assert index.shards > 1 and made.holds(same).all()


def test_lines_odd(spark, odd, none):
    rows, docs = odd
    assert cleaned(line_dedup.dedup(docs)) == sorted(plain_lines(rows, rows, 10), key=repr)
    assert line_dedup.dedup(none).collect() == []
    empty = line_dedup.LineIndex(spark)
    assert cleaned(empty.clean(docs)) == sorted(plain_lines([], rows, 10), key=repr)


# Search


def plain_search(docs, items, limit=20):
    """item_id, rank, doc_id, score by the definition, score by score."""
    def words(text):
        out, now = [], ""
        for c in text or "":
            if ord(c) > 127 or c.isalnum():
                now += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif now:
                out, now = [*out, now], ""
        return out + [now] if now else out

    held = [(d, Counter(words(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for i, text in items:
        scores = []
        for d, c, length in held:
            m = 75 + 25 * length * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:limit])]
    return out


def found(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def search_docs():
    rng = random.Random(3)
    word = [f"w{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]
    docs = [(i, " ".join(rng.choices(word, weights, k=rng.randrange(1, 120)))) for i in range(500)]
    docs += [(1000 + i, "same copy of w1 w2 w250 w251") for i in range(60)] + [(2000, None), (2001, " .-"), (2002, "Ünï W1! w1"), (7, "w299 w299"), (None, "w299 w298"), (3000, "w0 " * 5000)]
    items = [(1, "w0 w1 w2"), (2, "w250 w251 copy"), (3, "W299, w298; w298"), (4, "nothing here"), (5, None), (6, "w5 w17 w120 w0 w0 w230"), (6, "ünï ünÏ"), (None, "w7"), (8, "")]
    return docs, items + [(20 + i, " ".join(rng.choices(word, k=6))) for i in range(20)]


def test_search(spark, monkeypatch):
    docs, items = search_docs()
    want = sorted(plain_search(docs, items), key=repr)
    given = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("score", F.lit(2)).withColumn("term", F.lit("x"))
    tiers = set()
    for sizes in ((1, 4), (64, 256), (3,)):
        got = search.search(frame(spark, docs), given, tiers=sizes).collect()
        assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == want
        tiers |= {(sizes, r.tier) for r in got}
    # Some items are proved early, and others fall through to the last tier.
    assert {t for s, t in tiers if s == (64, 256)} >= {0, 1} and {t for s, t in tiers if s == (1, 4)} >= {2}
    monkeypatch.setattr(search, "CELLS", 50)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 7)
    got = search.search(frame(spark, docs), given, limit=3, tiers=(5, 40)).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == sorted(plain_search(docs, items, 3), key=repr)


def test_search_proves_by_bounds(spark):
    """An item is proved before its terms' postings are all read, and its documents are scored in full."""
    docs = [(i, "rare " * 5 + "often") for i in range(5)] + [(10 + i, "rare " * 4 + "other words here") for i in range(25)] + [(100 + i, f"often with x{i} and more words of no use") for i in range(400)]
    items = [(1, "rare often")]
    got = search.search(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), tiers=(35, 50)).collect()
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == sorted(plain_search(docs, items))
    assert {r.tier for r in got} == {0}


def test_search_odd(spark, odd, none):
    rows, docs = odd
    items = [(1, rows[7][1]), (2, "one"), (3, "x" * 500)]
    given = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search.search(docs, given).collect()), key=repr) == sorted(plain_search(rows, items), key=repr)
    assert search.search(none, given).collect() == [] and search.search(docs, given.limit(0)).collect() == []
    assert search.search(frame(spark, [(1, None), (2, "..")]), given).collect() == []


# Whitening


def plain_whitening(vectors):
    """n, sums, and each kept row's integer vector, exactly."""
    kept = [(i, [math.floor(256 * Fraction(c)) for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + [0] * (dims - len(x))) for i, x in kept]
    fitted = sorted({tuple(x) for _, x in kept})
    return kept, fitted


def check_whitening(got, vectors, scale=1e-9):
    kept, fitted = plain_whitening(vectors)
    n, dims = len(fitted), len(fitted[0])
    sums = [sum(x[j] for x in fitted) for j in range(dims)]
    v = np.array([[float(Fraction(n * sum(x[i] * x[j] for x in fitted) - sums[i] * sums[j], n * n)) for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(v)
    many = min(4, dims)
    rows = {}
    for r in got:
        rows.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(got) == many * len(kept)
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        r = rows[i, deviation if deviation < 2**63 else None]
        assert sorted(r) == list(range(1, many + 1)) and all(y.n == n for ys in r.values() for y in ys)
    for k in range(many):
        e, axis = values[-1 - k], axes[:, -1 - k]
        mine = np.array([float(np.dot([c - s / n for c, s in zip(x, sums, strict=True)], axis)) / math.sqrt(e) for _, x in kept])
        theirs = [sorted(y.whitened for y in rows[key][k + 1]) for key in rows]
        for sign in (1, -1):
            if np.allclose(sorted(np.concatenate(theirs)), sorted(sign * mine), atol=1e-6):
                break
        else:
            raise AssertionError(k)
        assert all(abs(y.explained - e / np.trace(v)) <= scale * y.explained for key in rows for y in rows[key][k + 1])
    assert all(r.identity_error <= 1e-6 for r in got)


def test_whitening(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(300, 6)) * np.array([9, 5, 3, 2, 1, 0.5]))]
    data += [(i, data[i][1]) for i in range(40)] + [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6), (904, [2.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("code", F.lit(1)).withColumn("i", F.lit(2)).withColumn("n", F.lit(3)).repartition(5)
    check_whitening(whitening.whitened(df).collect(), data)


def test_whitening_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(registry.QUERIES["op13_whitening"](spark, SF).collect(), rows)


def test_whitening_large_numbers(spark):
    """Entries of several digits; deviations beyond 64 bits are null."""
    rng = random.Random(5)
    data = [(i, [rng.uniform(-1, 1) * 2.0**40, rng.uniform(-1, 1) * 2.0**36, rng.uniform(-1, 1) * 2.0**41]) for i in range(60)]
    got = whitening.whitened(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    check_whitening(got, data, 1e-6)
    assert {r.deviation for r in got} == {None}


def test_digits_are_exact():
    rng = np.random.default_rng(2)
    x = rng.integers(-(2**63), 2**63 - 1, size=(50, 3), dtype=np.int64)
    x[0], x[1] = [-(2**63), 2**63 - 1, 0], [-1, 1, -(2**19)]
    back = sum(d.astype(object).astype(int).astype(object) * 2 ** (whitening.DIGIT * k) for k, d in enumerate(whitening.digits(x)))
    assert (back == x.astype(object)).all()
    assert (whitening.products(x) == x.astype(object).T @ x.astype(object)).all()
    assert all(sum(d << (whitening.SUM_BITS * k) for k, d in enumerate(whitening.sum_digits(v))) == v for v in (0, -1, 2**200, -(2**200) + 7, 5))
    assert (whitening.unpacked(whitening.packed(x), 3) == x).all()
    assert whitening.packed(np.array([[1, 0, 0]])) == whitening.packed(np.array([[1]]))


def test_whitening_odd(spark):
    one = lambda rows: whitening.whitened(spark.createDataFrame(rows, "vec_id string, embedding array<float>")).collect()
    assert one([]) == [] and one([("a", None)]) == [] and one([("a", [])]) == []
    same = one([("a", [1.0, 2.0]), ("b", [1.0, 2.0])])
    assert len(same) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, 0.0, 0.0, 0.0)}
    line = one([("a", [1.0, 1.0]), ("b", [2.0, 2.0]), ("c", [4.0, 4.0])])
    assert all(r.whitened == 0 and r.explained == 0 for r in line if r.component == 2) and max(r.identity_error for r in line) < 1e-9
    big = one([("a", [3e38]), ("b", [-3e38]), ("c", [0.0])])
    assert len(big) == 3 and {r.component for r in big} == {1}


def test_kept_hash(spark):
    got = registry.QUERIES["op11_line_dedup"](spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain_lines(list(docs.items()), list(docs.items()), 10)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == want
