"""Language identification in two steps: the family first, then one-versus-one linear SVMs between the family's languages.

Features are frequencies of hashed byte n-grams of the lower-cased whole text, so a text's score is the mean of its
n-grams' weights. The models learn from a sample of documents with a label, drawn evenly from the languages by a hash of
id and text: at most SAMPLE, or EACH of a language where there are too many for that; no language is left out. Each machine
learns in a task of its own from the rows that it separates; only weights reach the driver. Every text is scored.

recognised() drops documents whose text can't be told to be in one of the wanted languages: without a letter, predicted as
another, or too unsure (score under LEAST; an even chance in both steps scores 0.25).

Defined cases: null texts and texts without a letter are `und` with score 1; with no labelled document all are `und`;
a language of no known family is a family of its own; of equal margins the first language in the alphabet wins; rows that
repeat are each predicted, but learnt from once; rows without an id are learnt from like others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import arrow, svm
from .arrow import slices, text_bytes
from .blocks import SLICE_BYTES
from .common import stash, table

#: Labelled documents that the models learn from at most, but this many of each language; hashed features, sizes of n-grams in bytes.
SAMPLE, EACH, FEATURES, GRAMS = 3000, 20, 4096, (1, 2, 3)
#: Least score of a document that recognised() keeps.
LEAST = 0.3
#: Closely related languages by family, as ISO 639-1 codes.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "semitic": "ar he mt",
    "indic": "bn gu hi mr ne pa ur",
}
_FAMILY = {x: name for name, xs in FAMILIES.items() for x in xs.split()}
#: Lower-case of each byte: A-Z, and the second byte of U+00C0 to U+00DE.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def family(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """Feature of the n-gram at each place, for each n; the last n - 1 places are left out."""
    low = _LOWER[data].astype(np.uint32)
    low[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] += 32
    code = np.zeros(len(low), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        code = code[: len(low) - n + 1] * np.uint32(257) + low[n - 1 :] + np.uint32(1)
        if n in GRAMS:
            yield (code * np.uint32(2654435761) + np.uint32(n)) >> np.uint32(32 - FEATURES.bit_length() + 1)


def frequencies(text: bytes) -> np.ndarray:
    """Frequencies of the features of one text."""
    out = np.zeros(FEATURES)
    for g in grams(np.frombuffer(text, np.uint8)):
        out += np.bincount(g, minlength=FEATURES)
    return (out / max(out.sum(), 1)).astype(np.float32)


def scores(data: np.ndarray, start: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each text's n-grams: a row for each text, a column for each row of weights. n-grams that cross into the next text are not counted."""
    total, count = np.zeros((len(start), len(weights))), np.zeros(len(start))
    for n, g in zip(GRAMS, grams(data), strict=False):
        has = np.maximum(size - n + 1, 0)
        count += has
        for k, w in enumerate(weights):
            sums = np.concatenate(([0.0], np.cumsum(w[g], dtype=np.float64)))
            lo = np.minimum(start, len(sums) - 1)
            total[:, k] += np.where(has > 0, sums[np.minimum(lo + has, len(sums) - 1)] - sums[lo], 0)
    return total / np.maximum(count, 1)[:, None]


class Model:
    """families: names; groups: languages of each; weights, biases: a row for each of problems()."""

    def __init__(self, languages: list[str], weights: np.ndarray, biases: np.ndarray):
        self.languages, self.weights, self.biases = languages, weights.astype(np.float32), biases
        self.families = sorted({family(v) for v in languages})
        self.groups = [[v for v in languages if family(v) == f] for f in self.families]
        self.pairs = [p for g in self.groups for p in combinations(g, 2)]

    def decide(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row of margins (scores plus biases): the family of the largest margin, then the language of most won pairs, margins breaking ties."""
        n = len(margins)
        many = len(self.families) if len(self.families) > 1 else 0
        best = margins[:, :many].argmax(1) if many else np.zeros(n, int)
        sure = 1 / (1 + np.exp(-np.clip(2 * margins[np.arange(n), best], -30, 30))) if many else np.ones(n)
        langs = np.array([g[0] for g in self.groups], object)[best]
        for k, group in enumerate(self.groups):
            rows = np.flatnonzero(best == k)
            if len(group) < 2 or not len(rows):
                continue
            votes, least = np.zeros((len(rows), len(group))), np.full((len(rows), len(group)), np.inf)
            for i, j in combinations(range(len(group)), 2):
                m = margins[rows, many + self.pairs.index((group[i], group[j]))]
                votes[:, i] += (m >= 0) + np.tanh(m) * 1e-3
                votes[:, j] += (m < 0) - np.tanh(m) * 1e-3
                least[:, i], least[:, j] = np.minimum(least[:, i], m), np.minimum(least[:, j], -m)
            won = votes.argmax(1)
            langs[rows] = np.array(group, object)[won]
            sure[rows] *= 1 / (1 + np.exp(-np.clip(2 * least[np.arange(len(rows)), won], -30, 30)))
        return langs.tolist(), sure


def problems(languages: list[str]) -> list[tuple[list[str], list[str]]]:
    """Languages on either side of each machine: each family against the others where there are several, then each pair within a family."""
    families = sorted({family(v) for v in languages})
    groups = [[v for v in languages if family(v) == f] for f in families]
    rest = [(g, [v for v in languages if v not in g]) for g in groups] if len(groups) > 1 else []
    return rest + [([a], [b]) for g in groups for a, b in combinations(g, 2)]


def separate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the machine between rows of y = 1 and of y = -1. x is overwritten."""
    mean = x.mean(0, dtype=np.float64)
    scale = 1 / (np.sqrt(np.maximum(np.einsum("ij,ij->j", x, x, dtype=np.float64) / len(x) - mean**2, 0)) + 1e-4)
    x -= mean.astype(np.float32)
    x *= scale.astype(np.float32)
    w, b = svm.fit(x, y)
    w = w * scale
    return w, b - float(w @ mean)


def held_out() -> Column:
    return F.expr("coalesce(pmod(crc32(cast(doc_id as string)), 4) = 2, false)")


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def sampled(docs: DataFrame, sample: int = SAMPLE, each: int = EACH) -> tuple[list[str], DataFrame]:
    """The labels of documents that are not held out, and lang, mark, x (frequencies) of those drawn from each, written to the shared folder.

    mark is a hash of id and text that draws; rows that agree in both and in the label are drawn once. A language of which
    that gives fewer than each rows gives those of its least marks.
    """
    mark = F.xxhash64("doc_id", "text", F.lit(9))
    known = docs.where(~held_out() & F.col("lang").isNotNull() & has_letter()).select("lang", mark.alias("mark"), "text")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], known.limit(0).select("lang", "mark", F.lit(None).cast("binary").alias("x"))
    least, each = each, max(each, sample // len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in (x for whole in batches for x in slices(whole, 2)):
            rows = []
            for i, at in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if at not in seen:
                    seen.add(at)
                    rows.append(i)
            own = batch.take(pa.array(rows, pa.int64()))
            x = [frequencies(t.as_py().encode()).tobytes() for t in own.column(2)]
            yield pa.RecordBatch.from_arrays([own.column(0).cast(pa.string()), own.column(1), pa.array(x, pa.binary())], ["lang", "mark", "x"])

    def drawn(most: dict[str, int]) -> DataFrame:
        """Of the languages in most, each once: rows whose mark is under the language's bound, as a number from -2**63."""
        bound = F.create_map(*[F.lit(v) for lang, m in most.items() for v in (lang, m)])
        some = known.where(F.col("mark") <= F.try_element_at(bound, F.col("lang")))
        return stash(arrow.in_small_batches(some).mapInArrow(arrow.task(run), "lang string, mark long, x binary").dropDuplicates(["lang", "mark"]))

    rows = drawn({lang: min(2**63 - 1, int(min(1.0, 1.3 * each / n) * 2**64) - 2**63) for lang, n in counts.items()})
    got = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    few = [lang for lang, n in counts.items() if got.get(lang, 0) < min(least, n)]
    if few:
        ends = {lang: [r.mark for r in known.where(F.col("lang") == lang).select("mark").distinct().orderBy("mark").limit(each).collect()][-1] for lang in few}
        rows = rows.where(~F.col("lang").isin(few)).unionByName(drawn(ends))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    return sorted(counts), rows.withColumn("nth", nth).where(F.col("nth") <= each).drop("nth")


def learn(docs: DataFrame, sample: int = SAMPLE, each: int = EACH) -> Model | None:
    """The model of the labelled documents of docs (doc_id, text, lang) that are not held out."""
    languages, rows = sampled(docs.select("doc_id", "text", "lang"), sample, each)
    if not languages:
        return None
    tasks = problems(languages)
    if not tasks:
        return Model(languages, np.zeros((0, FEATURES)), np.zeros(0))

    def fit(rows: pa.Table) -> pa.Table:
        problem = rows.column("problem")[0].as_py()
        order = np.argsort(rows.column("mark").to_numpy(), kind="stable")
        y = rows.column("side").to_numpy()[order].astype(np.float64)
        # Each row goes from its Arrow buffer to its place, so that the sample is held twice at most.
        place, x, at = np.argsort(order), np.empty((len(order), FEATURES), np.float32), 0
        for chunk in rows.column("x").chunks:
            for row in chunk:
                x[place[at]] = np.frombuffer(row.as_buffer(), np.float32)
                at += 1
        del rows
        w, b = separate(x, y)
        return pa.table({"problem": pa.array([problem], pa.int32()), "w": pa.array([w.astype(np.float32).tobytes()], pa.binary()), "b": pa.array([b], pa.float64())})

    sides = [(k, lang, side) for k, task in enumerate(tasks) for side, langs in zip((1, -1), task, strict=True) for lang in langs]
    dealt = rows.join(F.broadcast(docs.sparkSession.createDataFrame(sides, "problem int, lang string, side int")), "lang")
    weights, biases = np.zeros((len(tasks), FEATURES), np.float32), np.zeros(len(tasks))
    for r in dealt.groupBy("problem").applyInArrow(arrow.group(fit), "problem int, w binary, b double").collect():
        weights[r.problem], biases[r.problem] = np.frombuffer(r.w, np.float32), r.b
    return Model(languages, weights, biases)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs (doc_id, text)."""
    cols = docs.select("doc_id", held_out().alias("held_out"), has_letter().alias("letter"), "text")
    if model is None:
        return cols.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(1.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole, 3, SLICE_BYTES)):
            margins = scores(*text_bytes(batch.column(3)), model.weights) + model.biases
            langs, sure = model.decide(margins)
            letter = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            langs = [v if ok else "und" for v, ok in zip(langs, letter, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(langs, pa.string()), pa.array(np.where(letter, sure, 1.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return arrow.in_small_batches(cols).mapInArrow(arrow.task(run), "doc_id long, held_out boolean, lang_pred string, score double")


def recognised(docs: DataFrame, languages: list[str] | None = None, least: float = LEAST) -> DataFrame:
    """docs without the rows that are rejected: no letter, predicted as none of languages (default: all learnt), or with a score under least.
    Without any label to learn from, those without a letter are rejected."""
    model, names = learn(docs), docs.columns
    plain = docs.select(*[F.col(c).alias("text" if c == "text" else f"d{i}") for i, c in enumerate(names)]).withColumn("letter", has_letter())
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole, at, SLICE_BYTES)):
            letter = batch.column(len(names)).to_numpy(zero_copy_only=False).astype(bool)
            langs, sure = model.decide(scores(*text_bytes(batch.column(at)), model.weights) + model.biases)
            wanted = np.ones(len(langs), bool) if languages is None else np.isin(np.array(langs, object).astype(str), languages)
            yield batch.filter(pa.array(letter & wanted & (sure >= least)))

    kept = plain.where("letter") if model is None else arrow.in_small_batches(plain).mapInArrow(arrow.task(run), plain.schema)
    return kept.select(*[F.col("text" if c == "text" else f"d{i}").alias(c) for i, c in enumerate(names)])


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
