"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel with Nyström landmarks.

The kernel of two words sums, over all three-letter subsequences that they share, DECAY to the power of the letters that
each spans; divided by both norms. So an insult with letters put in, left apart or respelt stays near its landmark.
Landmarks are words of the learning sentences. The machine works in the Nyström space of the landmarks and learns from
labelled sentences, each by its most toxic word (multiple-instance learning, in a few rounds). A three-letter kernel is a
dot product of explicit weights, so the landmarks and the machine fold into one weight for each subsequence: a word's
score takes the sum of its subsequences' weights, over all distinct words of every whole text. The text's score is
calibrated from its two most toxic words and its length.

It learns from a sample of at most SAMPLE labelled documents of each kind that are not held out, drawn by a hash of the id
(of rows that repeat an id one, by a hash of the text); the machine from at most SENTENCES of their sentences of each kind,
of at most SENTENCE_CHARS code points. Words of more than LONGEST letters are learnt from and scored by all their windows.

Defined cases: null, empty and wordless texts have the score of no toxic word; without labels of both kinds every score
is 0; of several labels of one document the greatest counts; rows that repeat are each scored alike; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import svm
from .arrow import in_small_batches, slices
from .common import stash, table

#: Bounds of the learning sample: labelled documents of each kind, sentences of each kind, code points of a sentence, landmarks of each kind.
SAMPLE, SENTENCES, SENTENCE_CHARS, LANDMARKS = 4000, 3000, 1000, 192
#: Kernel: weight of each spanned letter; letters and the marks of a word's start and end fold into LETTERS codes; longer words are taken in overlapping windows.
DECAY, LETTERS, LONGEST = 0.5, 64, 24
#: Weights that the subsequences hash to.
FOLDED = 1 << 16
#: Least precision (at its lower bound) and sureness of a word that marks toxic documents.
PRECISE, SURE = 0.6, 3.0
#: Words in memory in each worker; score of a text without words.
MEMORY, NOTHING = 400_000, -2.0
#: Digits and signs written for letters.
LEET = str.maketrans("013457@$!", "oieastasi")
_APART = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_OTHER = re.compile(r"[\W_\d]+")


def tokens(text: str) -> set[str]:
    """Distinct words in lower case, with letters written apart joined and signs within a word taken out or read as letters."""
    low = text.lower()
    found = set(low.split())
    found.update(re.sub(r"\s", "", m[0]) for m in _APART.finditer(low))
    return found


@functools.lru_cache(1 << 16)
def spell(token: str) -> str:
    """Letters of a token. Signs at its ends are dropped, those inside are read as the letters they stand for, then dropped."""
    if token.isalpha():
        return token
    return _OTHER.sub("", token.strip(".,;:!?()[]{}\"'«»„“”*#%&|-").translate(LEET))


def windows(word: str) -> list[str]:
    """The word, or overlapping windows of LONGEST letters that cover it."""
    if len(word) <= LONGEST:
        return [word]
    return [word[lo : lo + LONGEST] for lo in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


@functools.lru_cache(64)
def triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all three-letter subsequences of a word of that length, and their weights."""
    at = np.array(list(combinations(range(length), 3)), int).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


def codes(words: list[str]) -> np.ndarray:
    """Letters of words of one length, between marks of start and end, as codes below LETTERS, a row for each."""
    letters = np.frombuffer("".join(f"{{{w}}}" for w in words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.int64)
    return np.where((letters >= 97) & (letters <= 125), letters - 97, 29 + letters % (LETTERS - 29))


def explicit(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length: subsequence code and weight of each triple, equal ones of a word summed in the first, and norms."""
    at, weight = triples(len(words[0]) + 2)
    c = codes(words)
    key = (c[:, at[:, 0]] * LETTERS + c[:, at[:, 1]]) * LETTERS + c[:, at[:, 2]]
    key = ((key * 2654435761 & 0xFFFFFFFF) >> 16) & (FOLDED - 1)
    order = np.argsort(key, 1, kind="stable")
    ordered, w = np.take_along_axis(key, order, 1), weight[order]
    flat = (ordered + np.arange(len(words))[:, None] * FOLDED).ravel()
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    sums = np.add.reduceat(w.ravel(), first)
    norm = np.sqrt(np.bincount(first // key.shape[1], sums**2, len(words)))
    return key, weight, norm


def by_length(words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Places and words of three letters or more, by length."""
    of: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) > 2:
            of.setdefault(len(w), []).append(i)
    for rows in of.values():
        for lo in range(0, len(rows), 2048):
            yield rows[lo : lo + 2048], [words[i] for i in rows[lo : lo + 2048]]


def vectors(words: list[str]) -> np.ndarray:
    """Normalised explicit kernel vectors; zero for words of under three letters."""
    out = np.zeros((len(words), FOLDED), np.float32)
    for rows, ws in by_length(words):
        key, weight, norm = explicit(ws)
        for i, k, n in zip(rows, key, norm, strict=True):
            np.add.at(out[i], k, weight / n)
    return out


def kernel(words: list[str], fixed: np.ndarray) -> np.ndarray:
    """Kernel of each word with each row of fixed (normalised vectors)."""
    out, by_key = np.zeros((len(words), len(fixed)), np.float32), np.ascontiguousarray(fixed.T)
    for rows, ws in by_length(words):
        key, weight, norm = explicit(ws)
        for i, k, n in zip(rows, key, norm, strict=True):
            out[i] = (weight / n).astype(np.float32) @ by_key[k]
    return out


class Model:
    """weights: of each subsequence; bias; slopes: the calibration's, of a text's three figures, and its shift."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.slopes = weights.astype(np.float32), bias, np.array([1.0, 0.0, 0.0, 0.0])

    def words(self, words: list[str]) -> np.ndarray:
        """Score of each word: the greatest of its windows for one longer than LONGEST."""
        parts = [windows(w) for w in words]
        flat = [p for ps in parts for p in ps]
        got = np.full(len(flat), self.bias)
        for rows, ws in by_length(flat):
            key, weight, norm = explicit(ws)
            got[rows] = self.weights[key] @ weight / norm + self.bias
        first = np.cumsum([0, *map(len, parts)])[:-1]
        return np.maximum.reduceat(got, first) if len(flat) else got

    def texts(self, texts: list[str], known: dict[str, float]) -> np.ndarray:
        """Scores, 1 at most, of the most and second most toxic words and the logarithm of the words' number, for each text. known: words seen before."""
        found = [tokens(t) for t in texts]
        new = list(set().union(*found).difference(known))
        known.update(zip(new, self.words([spell(w) for w in new]).tolist(), strict=True))
        top = [heapq.nlargest(2, map(known.__getitem__, f)) + [NOTHING, NOTHING] for f in found]
        return np.array([(min(max(t[0], NOTHING), 1.0), min(max(t[1], NOTHING), 1.0), np.log1p(len(f))) for t, f in zip(top, found, strict=True)]).reshape(-1, 3)

    def chance(self, f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(f @ self.slopes[:-1] + self.slopes[-1], -30, 30)))


def held_out() -> Column:
    return F.expr("coalesce(pmod(crc32(cast(doc_id as string)), 5) = 0, false)")


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic, text of at most sample labelled documents of each kind that are not held out."""
    known = labels.select("doc_id", "toxic").where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return known.limit(0).withColumn("text", F.lit(""))
    rate = F.create_map(*[F.lit(v) for t, n in counts.items() for v in (t, min(1.0, sample / n))])
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < rate[F.col("toxic")] * (1 << 20))
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample)
    met = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    return met.withColumn("nth", nth).where("nth = 1").drop("nth")


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of the labels (doc_id, toxic) of docs (doc_id, text)."""
    drawn = sampled(docs, labels)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole, 2)):
            rows = [(d, t, s) for d, t, text in zip(*[c.to_pylist() for c in batch.columns], strict=True) for s in re.split(r"[.!?\n]+\s", text) if s.strip()]
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string())], ["doc_id", "toxic", "sentence"])

    drawn = stash(drawn.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"), "text"))
    sentences = drawn.mapInArrow(cut, "doc_id long, toxic int, sentence string")

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t, w) for t, s in zip(*[c.to_pylist() for c in batch.columns], strict=True) for w in {p for x in tokens(s) for p in windows(spell(x))} if len(w) > 2]
            cols = list(zip(*rows, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string())], ["toxic", "word"])

    # Words count by different sentences, so that copies of a document do not make its words tell.
    different = stash(sentences.select("toxic", "sentence").distinct())
    seen = different.mapInArrow(spelt, "toxic int, word string")
    seen = seen.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    size = {r.toxic: r.n for r in different.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return None
    odds = F.log((F.col("bad") + 0.5) / (size[1] + 1.0)) - F.log((F.col("good") + 0.5) / (size[0] + 1.0))
    sure = odds / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    ranked = seen.withColumn("sure", sure).withColumn("precise", (F.col("bad") - F.sqrt("bad")) / size[1] / ((F.col("bad") / size[1]) + F.col("good") / size[0]))
    ranked = stash(ranked)
    bad = [(r.word, r.sure) for r in ranked.where((F.col("precise") > PRECISE) & (F.col("sure") > SURE)).orderBy(F.desc("sure"), "word").limit(2 * LANDMARKS).collect()]
    bad = bad or [(r.word, r.sure) for r in ranked.where("bad > 0").orderBy(F.desc("sure"), "word").limit(LANDMARKS).collect()]
    good = [r.word for r in ranked.orderBy(F.desc(F.col("good") - F.col("bad")), "word").limit(5 * LANDMARKS).collect()]
    strong = dict(bad) or None
    if not strong:
        return None
    tell = F.col("toxic") == 1
    near = "|".join(re.escape(w) for w in strong)
    short = sentences.where(F.length("sentence") <= SENTENCE_CHARS)
    some = lambda rows: [r.sentence for r in rows.orderBy(F.xxhash64("doc_id", "sentence"), "doc_id", "sentence").limit(SENTENCES).collect()]
    model = machine(some(short.where(tell & F.lower("sentence").rlike(near))), some(short.where(~tell)), strong, good)
    if model is None:
        return None

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in (x for whole in batches for x in slices(whole, 2)):
            known.clear()
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(model.texts(batch.column(2).to_pylist(), known).tolist(), pa.list_(pa.float64()))], ["toxic", "f"])

    rows = drawn.mapInArrow(rated, "toxic int, f array<double>").collect()
    model.slopes = svm.calibrate(np.array([r.f for r in rows]), np.array([r.toxic for r in rows]))
    return model


def machine(bad: list[str], good: list[str], strong: dict[str, float], common: list[str], rounds: int = 3) -> Model | None:
    """Learn from sentences of toxic (bad) and other documents. strong: words that mark toxic documents, and how surely; the first to pick each sentence's word."""
    landmarks = list(dict.fromkeys([*list(strong)[:LANDMARKS], *common[: LANDMARKS // 3]]))
    fixed = vectors(landmarks)
    values, axes = np.linalg.eigh((fixed @ fixed.T).astype(np.float64))
    kept = values > 1e-4
    if not kept.any() or not bad or not good:
        return None
    white = axes[:, kept] / np.sqrt(values[kept])
    bags = [sorted({p for x in tokens(s) for p in windows(spell(x)) if len(p) > 2}) for s in [*bad, *good]]
    bags.append([w for w in common if len(w) > 2])
    words = sorted({w for b in bags for w in b})
    place = {w: i for i, w in enumerate(words)}
    z = kernel(words, fixed) @ white
    score = np.array([strong.get(w, 0.0) for w in words])
    model = None
    against = np.unique([place[w] for b in bags[len(bad) :] for w in b if w not in strong]).astype(int)
    open_to = np.ones(len(words), bool)
    open_to[against] = False
    for _ in range(rounds):
        picked = [max(own, key=score.__getitem__) for b in bags[: len(bad)] if (own := [i for w in b if open_to[i := place[w]]])]
        picked = np.array([i for i in picked if score[i] > 0], int)
        if not len(picked) or not len(against):
            break
        x = np.concatenate((z[picked], z[against]))
        w, b = svm.fit(x, np.concatenate((np.ones(len(picked)), -np.ones(len(against)))), ridge=1e-4, rounds=150)
        score = z @ w + b
        model = Model((white @ w) @ fixed, b)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs (doc_id, text)."""
    cols = docs.select("doc_id", held_out().alias("held_out"), "text")
    if model is None:
        return cols.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in (x for whole in batches for x in slices(whole, 2)):
            if len(known) > MEMORY:
                known.clear()
            p = model.chance(model.texts([t or "" for t in batch.column(2).to_pylist()], known))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return in_small_batches(cols).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
