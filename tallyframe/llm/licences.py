"""License scans by a positional rare-token index, in DataFrame operations only.

Each template is one or more key phrases, all mandatory. The document frequency of every template word is counted over
all documents; a phrase is indexed by its ANCHORS rarest words, those of highest inverse document frequency. A document
looks up those that it has: only phrases all of whose anchors it has are candidates. Their postings give starts (place less
the word's place in the phrase); the starts that the anchors share are verified word by word.

Defined cases: a null text is empty: no words, no label, score 0, null places; overlapping places all count; rows that
repeat are each scanned; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: What stands between words once A-Z are lower-case; the upper-case letters are left out so that lower() may come before or after.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Rarest words by which a phrase is looked up.
ANCHORS = 2

#: The base phrases, then the method's own templates. None has a word with a k, the one ASCII letter that lower() makes of another character.
BASE = [("mit", ["under the mit license"]), ("apache-2", ["apache license version 2"]), ("cc-by-nc", ["cc by nc"])]
OWN = [
    ("agpl", ["gnu affero general public license"]),
    ("apache-2", ["apache org licenses license 2"]),
    ("apache-2", ["licensed under the apache license", "you may not use this file except in compliance with the license"]),
    ("bsd", ["redistribution and use in source and binary forms"]),
    ("bsd-2", ["redistributions of source code must retain the above copyright notice", "redistributions in binary form must reproduce the above copyright notice"]),
    ("bsd-3", ["redistribution and use in source and binary forms", "neither the name of"]),
    ("cc-by", ["creative commons attribution"]),
    ("cc-by-nc", ["creative commons attribution noncommercial"]),
    ("cc0", ["cc0 1 0 universal"]),
    ("gpl", ["gnu general public license"]),
    ("gpl-3", ["gnu general public license version 3"]),
    ("gpl-3", ["gnu general public license", "either version 3 of the license or"]),
    ("isc", ["permission to use copy modify and or distribute this software for any purpose", "provided that the above copyright notice and this permission notice appear in all copies"]),
    ("lgpl", ["gnu lesser general public license"]),
    ("mit", ["permission is hereby granted free of charge to any person obtaining a copy"]),
    ("mpl-2", ["mozilla public license version 2"]),
    ("mpl-2", ["this source code form is subject to the terms of the mozilla public license", "one at mozilla org mpl 2 0"]),
]


def licence_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word of the vocabulary, counted over all of them; as many rows as the vocabulary reach the driver."""
    found = docs.select(F.explode(F.array_distinct(F.filter("l_words", lambda w: w.isin(vocabulary)))).alias("w"))
    return dict.fromkeys(vocabulary, 0) | {r.w: r.n for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}


def anchors_of(phrase: str, df: dict[str, int]) -> list[str]:
    """The ANCHORS rarest words of phrase, rarest first."""
    return sorted(set(phrase.split()), key=lambda w: (df[w], w))[:ANCHORS]


def _less(w: str, i: int) -> Column:
    return F.transform(F.filter("l_post", lambda p: p.w == w), lambda p: p.at - i)


def places(phrase: str, df: dict[str, int]) -> Column:
    """The starts of phrase in l_words, from the postings l_post of the anchor words."""
    parts = phrase.split()
    starts = None
    for w in anchors_of(phrase, df):
        at = [i for i, x in enumerate(parts) if x == w]
        own = F.flatten(F.array(*[_less(w, i) for i in at]))
        starts = own if starts is None else F.array_intersect(starts, own)
    want = F.array(*map(F.lit, parts))
    return F.filter(F.array_distinct(starts), lambda s: (s >= 0) & (F.slice("l_words", F.greatest(s, F.lit(0)) + 1, len(parts)) == want))


def scan(docs: DataFrame, base=BASE, own=OWN) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of docs (doc_id, text)."""
    templates = [*base, *own]
    phrases = list(dict.fromkeys(p for _, ps in templates for p in ps))
    vocabulary = sorted({w for p in phrases for w in p.split()})
    cut = docs.select("doc_id", licence_words(F.col("text")).alias("l_words"))
    df = document_frequencies(cut, vocabulary)
    anchors = sorted({w for p in phrases for w in anchors_of(p, df)})
    posted = cut.withColumn("l_post", F.filter(F.transform("l_words", lambda w, i: F.when(w.isin(anchors), F.struct(w.alias("w"), i.alias("at")))), lambda p: p.isNotNull()))
    posted = posted.withColumn("l_rare", F.array_distinct(F.col("l_post.w")))
    none = F.array().cast("array<int>")

    def looked_up(p: str) -> Column:
        return F.when(reduce(and_, [F.array_contains("l_rare", w) for w in anchors_of(p, df)]), places(p, df)).otherwise(none)

    found = posted.withColumn("l_found", F.when(F.size("l_post") == 0, F.array(*[none for _ in phrases])).otherwise(F.array(*map(looked_up, phrases))))
    at = {p: F.element_at("l_found", i + 1) for i, p in enumerate(phrases)}
    bases = F.flatten(F.array(*[at[p] for _, ps in base for p in ps]))

    def labels(of):
        given = [F.when(F.greatest(*[F.size(at[p]) == 0 for p in ps], F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, ps in of]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*given)))), ",")

    n = F.aggregate("l_found", F.lit(0), lambda a, x: a + F.size(x))
    return found.select(
        "doc_id", F.size("l_words").cast("long").alias("n_words"), F.size(bases).cast("long").alias("n_base"), F.array_min(bases).cast("long").alias("first_word"), F.array_max(bases).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(templates).alias("labels"), F.when(labels(templates) == "", F.lit(0.0)).otherwise(1 - F.pow(F.lit(0.2), n)).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    templates = [*BASE, *OWN]
    phrases = list(dict.fromkeys(p for _, ps in templates for p in ps))
    words = ", ".join(f"({k}, {j}, '{w}', {len(p.split())})" for k, p in enumerate(phrases) for j, w in enumerate(p.split()))
    wanted = ", ".join(f"({t}, '{n}', {t < len(BASE)}, {phrases.index(p)}, {len(ps)})" for t, (n, ps) in enumerate(templates) for p in ps)
    base = ", ".join(str(phrases.index(p)) for _, ps in BASE for p in ps)
    return rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM t),
h AS (SELECT doc_id, k, i - j AS s FROM u JOIN (VALUES {words}) p(k, j, x, n) USING (x) GROUP BY doc_id, k, i - j HAVING count(*) = any_value(n)),
f AS (SELECT doc_id, count(*) AS n, count(*) FILTER (k IN ({base})) AS n_base, min(s) FILTER (k IN ({base})) AS first_word, max(s) FILTER (k IN ({base})) AS last_word FROM h GROUP BY 1),
g AS (SELECT doc_id, label, is_base FROM (SELECT DISTINCT doc_id, k FROM h) JOIN (VALUES {wanted}) v(template, label, is_base, k, n) USING (k) GROUP BY doc_id, template, label, is_base HAVING count(*) = any_value(n)),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM g GROUP BY 1)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN labels IS NULL THEN 0.0::DOUBLE ELSE 1 - pow(0.2::DOUBLE, n) END AS score FROM t LEFT JOIN f ON f.doc_id = t.doc_id LEFT JOIN l ON l.doc_id = t.doc_id
"""


SQL = _sql()
