import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
CLASHING = ["toxic", "quality", "nth", "letter", "problem", "side", "x", "word", "n", "class", "mark", "term", "postings", "score", "rank", "row", "docs", "shard", "held_out", "keep_id"]


def frame(spark, rows, parts=3):
    """Documents (doc_id, text) with columns whose names the operators use themselves."""
    full = [(i, t, None, None, None if t is None else len(t), f"r{k}", k, k % 2, *[k % 3] * len(CLASHING)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS + ", node string, root long, digest int" + "".join(f", {c} int" for c in CLASHING)).repartition(parts)


def prose(seed, n_words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioubdfgklmnprst") for _ in range(rng.randint(2, 7))) for _ in range(n_words))


def odd_rows():
    """Null ids and texts, empty, blank, short, repeated and very long texts, and texts that share passages."""
    base, passage = prose(1, 120), prose(2, 60)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One\x0bTWO"), (5, "One\x0bTWO"), (6, "ä€𝄞 " * 40), (7, base), (8, base), (8, base), (9, base.upper()), (10, base.replace(" ", "\n")), (None, base), (None, None), (11, base + " tail words"), (12, "x" * 500)]
    rows += [(20 + i, prose(100 + i, 30) + " " + passage + " " + prose(200 + i, 25)) for i in range(40)]
    words = base.split()
    rows += [(100 + i, " ".join(words[:i] + [f"new{i}"] + words[i + 1 :])) for i in range(0, 120, 9)]
    return rows + [(300, prose(7, 60_000)), (301, prose(7, 60_000)[1000:]), (7, prose(9, 50))]


@pytest.fixture(scope="session")
def odd(spark):
    rows = odd_rows()
    return rows, frame(spark, rows)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [(1, "x")]).limit(0)
