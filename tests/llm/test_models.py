"""Language and toxicity models: held-out quality, and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyframe.llm import language, toxicity
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.01"


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = language.query(spark, SF).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_ignores_what_it_must(spark):
    """Labels of held-out rows, source and doc_id don't matter."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = language.identify(docs).orderBy("doc_id").collect()
    changed = docs.withColumn("source", F.lit("x")).withColumn("lang", F.when(language.held_out(), "zz").otherwise(F.col("lang")))
    assert language.identify(changed).orderBy("doc_id").collect() == a


def test_language_odd(spark, odd, none):
    rows, docs = odd
    got = language.identify(docs).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} == {"und"}  # no labels
    labelled = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    more = labelled.unionByName(frame(spark, [(10**6, None), (10**6, ""), (None, "12 34"), (10**6 + 1, "the of and " * 30_000)]).select("doc_id", "text", "lang"))
    got = {(r.doc_id, r.lang_pred) for r in language.identify(more).collect() if r.doc_id is None or r.doc_id >= 10**6}
    assert got == {(10**6, "und"), (None, "und"), (10**6 + 1, "en")}
    assert language.identify(none).collect() == []
    assert language.recognised(docs).count() == sum(any(c.isalpha() for c in t or "") for _, t in rows)


def plain_language(model, text):
    """Language and score of one text, n-gram by n-gram."""
    import math

    data = bytearray()
    for b in text.encode():
        data.append(b + 32 if 65 <= b < 91 or (data and data[-1] == 0xC3 and 0x80 <= b <= 0x9E) else b)
    found = []
    for n in language.GRAMS:
        for k in range(len(data) - n + 1):
            code = 0
            for b in data[k : k + n]:
                code = (code * 257 + b + 1) & 0xFFFFFFFF
            found.append(((code * 2654435761 + n) & 0xFFFFFFFF) >> 20)
    margins = [sum(float(w[f]) for f in found) / len(found) + b for w, b in zip(model.weights, model.biases, strict=True)]
    chance = lambda m: 1 / (1 + math.exp(-2 * m))
    many = len(model.families)
    best = max(range(many), key=lambda k: (margins[k], -k))
    pairs = {p: margins[many + k] for k, p in enumerate(model.pairs)}
    group = model.groups[best]
    against = {a: [pairs.get((a, b), -pairs.get((b, a), 0)) for b in group if b != a] for a in group}
    lang = max(group, key=lambda a: sum((m >= 0) + math.tanh(m) * 1e-3 for m in against[a]))
    return lang, chance(margins[best]) * (chance(min(against[lang])) if len(group) > 1 else 1)


def test_language_score_by_definition(spark):
    """Predictions against a plain sum of the fitted weights; texts that repeat, and repeat in the sample, change nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language.learn(docs)
    assert len(model.families) == 2 and len(model.pairs) >= 1
    for r in language.predict(docs, model).join(docs.select("doc_id", "text"), "doc_id").where("length(text) between 1 and 600").limit(40).collect():
        lang, score = plain_language(model, r.text)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3
    twice = language.identify(docs.unionByName(docs))
    got = {}
    for r in twice.collect():
        got.setdefault(r.doc_id, set()).add((r.lang_pred, r.score))
    assert all(len(x) == 1 for x in got.values())


def test_language_many(spark):
    """Each of many languages is learnt, also rare ones."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(100 * k + i, (letters[k % 26] * 3 + letters[(k * 7 + 3) % 26] + " ") * (3 + i), f"l{k:02}") for k in range(30) for i in range(8 if k else 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.learn(docs, sample=60).languages == sorted({r[2] for r in rows})
    got = language.predict(docs, language.learn(docs, sample=60)).join(docs, "doc_id")
    assert got.where("lang = lang_pred").count() > 0.9 * len(rows)


def test_recognised(spark):
    """Documents of unwanted languages go, and so do those with letters that no language is sure of; the others stay whole."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn(docs)
    said = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    some = language.recognised(docs, ["en", "de"])
    assert some.columns == docs.columns
    assert {r.doc_id for r in some.collect()} == {d for d, (v, s) in said.items() if v in ("en", "de") and s >= language.LEAST}
    assert 0 < some.count() < docs.count()
    strict = {r.doc_id for r in language.recognised(docs, None, 0.8).collect()}
    assert strict == {d for d, (_, s) in said.items() if s >= 0.8} and 0 < len(said) - len(strict) < 0.2 * len(said)
    assert language.recognised(docs).count() >= 0.999 * docs.count()


def test_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = toxicity.query(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {r.doc_id for r in got if r.held_out} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    bad, good = np.array([s for s, t in held if t]), np.array([s for s, t in held if not t])
    # About 16 % of the toxic labels of these tables are of texts without any insult.
    auc = (bad[:, None] > good).mean() + 0.5 * (bad[:, None] == good).mean()
    assert auc > 0.75 and (bad >= 0.5).mean() > 0.6 and (good >= 0.5).mean() < 0.05


def test_toxicity_odd(spark, odd, none):
    rows, docs = odd
    labels = spark.createDataFrame([(7, 0, 1), (8, 0, 0), (8, None, None), (None, 1, 1), (11, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == len(rows)
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(none, toxicity.learn(none, labels)).collect() == []


def test_toxicity_score_by_definition(spark):
    """Scores against a plain sum over subsequences with the fitted weights; ties and rows that repeat score alike."""
    import itertools
    import math

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)

    def code(c):
        return ord(c) - 97 if 97 <= ord(c) <= 125 else 29 + ord(c) % 35

    def word(w):
        best = []
        for p in toxicity.windows(toxicity.spell(w)):
            if len(p) < 3:
                best.append(model.bias)
                continue
            weight, p = {}, "{" + p + "}"
            for i, j, k in itertools.combinations(range(len(p)), 3):
                key = (code(p[i]) * 64 + code(p[j])) * 64 + code(p[k])
                key = (key * 2654435761 & 0xFFFFFFFF) >> 16
                weight[key] = weight.get(key, 0) + toxicity.DECAY ** (k - i + 1)
            norm = math.sqrt(sum(v * v for v in weight.values()))
            best.append(sum(v * float(model.weights[k]) for k, v in weight.items()) / norm + model.bias)
        return max(best)

    texts = [(r.doc_id, r.text) for r in docs.where("length(text) < 400").limit(25).collect()] + [(-1, None), (-2, ""), (-3, "ab " + "worthless" * 9), (-4, "same"), (-5, "same")]
    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, texts + texts[:3]), model).collect()}
    for d, t in texts:
        found = toxicity.tokens(t or "")
        top = sorted((word(w) for w in found), reverse=True)[:2] + [toxicity.NOTHING] * 2
        x = [min(max(top[0], toxicity.NOTHING), 1), min(max(top[1], toxicity.NOTHING), 1), math.log1p(len(found)), 1]
        assert abs(got[d] - 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.slopes, strict=True))))) < 1e-3
    assert got[-4] == got[-5]


def test_toxicity_repeated_rows_in_the_sample(spark):
    """Of rows that repeat an id one is learnt from."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    once, twice = toxicity.sampled(docs, labels), toxicity.sampled(docs.unionByName(docs), labels)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert toxicity.windows("a" * 24) == ["a" * 24] and [len(w) for w in toxicity.windows("b" * 60)] == [24, 24, 24, 24]


def test_string_kernel():
    """The kernel against its definition, and a gapped insult nearer its landmark than another word."""
    import itertools

    def brute(a, b):
        def vec(w):
            out = {}
            w = "{" + w + "}"
            for i, j, k in itertools.combinations(range(len(w)), 3):
                out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + toxicity.DECAY ** (k - i + 1)
            return out
        x, y = vec(a), vec(b)
        dot = lambda p, q: sum(v * q.get(s, 0) for s, v in p.items())
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    words = ["worthless", "woorthlesss", "thoughtful", "abc"]
    k = toxicity.kernel(words, toxicity.vectors(words))
    want = np.array([[brute(a, b) for b in words] for a in words])
    assert np.abs(k - want).max() < 0.02
    assert k[0, 1] > 0.5 > k[0, 2]


def labelled(spark, rows):
    """Documents (doc_id, text, lang)."""
    return frame(spark, [(i, t) for i, t, _ in rows]).drop("lang").join(spark.createDataFrame([(t, x) for t, x in {(t, x) for _, t, x in rows}], "text string, lang string"), "text")


def texts_in(k, words):
    return [f"{words[i % len(words)]} {words[(i * 3 + 1) % len(words)]} {words[(i * 7 + 2) % len(words)]} {words[(i * i + 3) % len(words)]} {i}" for i in range(k)]


EN, DE = ["the", "with", "which", "there", "should", "they", "though"], ["und", "nicht", "auch", "über", "schön", "zwischen", "würde"]
FR, ES = ["était", "avec", "vous", "leçon", "toujours", "jamais", "chaque"], ["señor", "mañana", "pero", "también", "siempre", "nunca", "cuando"]


def right(spark, rows, **size):
    got = {r.text: r.lang_pred for r in language.predict(labelled(spark, rows).withColumn("doc_id", F.xxhash64("text")), language.learn(labelled(spark, rows), **size)).join(labelled(spark, rows).select(F.xxhash64("text").alias("doc_id"), "text").distinct(), "doc_id").collect()}
    return np.mean([got[t] == x for _, t, x in rows])


def test_language_without_ids(spark):
    assert right(spark, [(None, t, "en") for t in texts_in(20, EN)] + [(None, t, "de") for t in texts_in(20, DE)]) > 0.9


def test_language_some_without_ids(spark):
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[k], t, "en") for k, t in enumerate(texts_in(40, EN))] + [(ids[100 + k], t, "de") for k, t in enumerate(texts_in(40, DE))]
    rows += [(None, t, "fr") for t in texts_in(20, FR)] + [(None, t, "es") for t in texts_in(20, ES)]
    assert right(spark, rows) > 0.9


def test_language_repeated_ids(spark):
    for a, b in ((3, 4), (6, 8)):
        assert right(spark, [(a, t, "en") for t in texts_in(200, EN)] + [(b, t, "de") for t in texts_in(200, DE)], sample=40) > 0.9


def test_language_one_text(spark):
    """Copies are learnt from once, and a language whose rows are all equal isn't lost."""
    rows = [(None, " ".join(EN), "en")] * 50 + [(3, " ".join(DE), "de")] * 400 + [(None, t, "fr") for t in texts_in(50, FR)]
    languages, drawn = language.sampled(labelled(spark, rows).select("doc_id", "text", "lang"), 60, 5)
    assert languages == ["de", "en", "fr"] and {r.lang for r in drawn.collect()} == set(languages)
    assert right(spark, rows, sample=60, each=5) > 0.9


def test_toxicity_clashing_columns(spark):
    docs = frame(spark, [(i, f"you are a {'zorgblat' if i % 3 == 0 else 'fine'} reader, number {i}. Have a day.") for i in range(90)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(90)], "doc_id long, toxic int, text int")
    got = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(got) == 90 and np.mean([r.predicted == (r.doc_id % 3 == 0) for r in got]) > 0.9
