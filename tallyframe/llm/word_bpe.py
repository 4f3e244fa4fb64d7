"""BPE encoding and decoding with a lexicon in a minimal acyclic transducer.

Words are counted over all documents; the most frequent ones, at most LEXICON_WORDS, are compiled into a minimal acyclic automaton
whose states share suffixes. Each edge carries the number of words before it, so the sum along a word's path is the
word's number, and a table gives its ids. The compiled form is one file of fixed size bound, broadcast; each worker maps it
from a temporary file that has no name any more, so nothing is left behind. A batch's distinct words walk the automaton
together, one step for each byte; words that it lacks are merged pair by pair, least rank first, in n log n steps.

Defined cases: a null text is empty: no ids, digests of the empty string; strings of special tokens in a text give their
ids, as in the library; rows that repeat are each encoded; other columns are ignored. Texts with characters on which
Unicode versions may differ are normalised and split by the library; their words are encoded here.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import in_small_batches, slices
from .byte_bpe import ODD, byte_letters
from .common import stash, table

#: Words of the lexicon (its file stays below 16 MiB), words in memory in each worker, distinct words counted before they are sent on.
LEXICON_WORDS, MEMORY, COUNTED = 65_536, 400_000, 400_000
#: The vocabulary's pre-tokenizer pattern (in its public file), a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordBpe:
    """Normalises, splits and merges as the vocabulary file says."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path) as f:
            said = json.load(f)
        self.library = Tokenizer.from_file(path)
        vocab, suffix = said["model"]["vocab"], said["model"]["end_of_word_suffix"]
        self.token = {i: t for t, i in vocab.items()} | {x["id"]: x["content"] for x in said["added_tokens"]}
        self.added = {x["content"]: x["id"] for x in said["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        self.letters = byte_letters()
        self.bytes_of = {c: b for b, c in enumerate(self.letters)}
        self.inner = [vocab.get(c) for c in self.letters]
        self.final = [vocab.get(c + suffix) for c in self.letters]
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(said["model"]["merges"])}
        self.find = regex.compile(PATTERN).findall

    def words(self, text: str) -> list[str]:
        if not ODD.search(text):
            return self.find(text.lower())
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.bytes_of[c] for c in w).decode(errors="surrogateescape") for w, _ in split]

    def parts(self, text: str) -> list[tuple[list[str], int | None]]:
        """Words up to the next special token, and that token's id."""
        if "<|" not in text:
            return [(self.words(text), None)]
        cut = self.split_added.split(text)
        return [(self.words(x), self.added.get(cut[k + 1]) if k + 1 < len(cut) else None) for k, x in enumerate(cut) if k % 2 == 0]

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the adjacent pair of least rank is merged, the leftmost first, until no pair has a rank."""
        raw = word.encode(errors="surrogateescape")
        ids = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        ids = [i for i in ids if i is not None]
        n, pair = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # Pairs as (rank, place of the left one, what the pair was, what it becomes); those that have changed meanwhile are passed over.
        todo = [(*r, k, a, b) for k, (a, b) in enumerate(itertools.pairwise(ids)) if (r := pair((a, b)))]
        todo = [(rank, k, a, b, made) for rank, made, k, a, b in todo]
        heapq.heapify(todo)
        while todo:
            _, k, a, b, made = heapq.heappop(todo)
            right = after[k]
            if right >= n or ids[k] != a or ids[right] != b:
                continue
            ids[k], ids[right] = made, -1
            after[k] = right = after[right]
            if right < n:
                before[right] = k
                if r := pair((made, ids[right])):
                    heapq.heappush(todo, (r[0], k, made, ids[right], r[1]))
            left = before[k]
            if left >= 0 and (r := pair((ids[left], made))):
                heapq.heappush(todo, (r[0], left, ids[left], made, r[1]))
        return [i for i in ids if i >= 0]


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The transducer of words (ascending, distinct, not empty) as bytes; ids: of each word. Minimised as words come in: what lies
    below the last word's path beyond the common prefix is final and is replaced by an equal state where there is one."""
    edges: list[dict[int, int]] = [{}]
    ends = [False]
    register: dict[tuple, int] = {}
    path = [0]
    last = b""

    def settle(down_to: int) -> None:
        while len(path) > down_to + 1:
            state = path.pop()
            key = (ends[state], tuple(edges[state].items()))
            edges[path[-1]][last[len(path) - 1]] = register.setdefault(key, state)

    for w in words:
        shared = len(os.path.commonprefix([w, last]))
        settle(shared)
        for b in w[shared:]:
            edges.append({})
            ends.append(False)
            edges[path[-1]][b] = len(edges) - 1
            path.append(len(edges) - 1)
        ends[path[-1]] = True
        last = w
    settle(0)
    count: dict[int, int] = {}
    order, todo = [], [(0, False)]
    while todo:
        s, done = todo.pop()
        if done:
            count[s] = ends[s] + sum(count[t] for t in edges[s].values())
            order.append(s)
        elif s not in count:
            count[s] = -1
            todo.append((s, True))
            todo += [(t, False) for t in edges[s].values() if t not in count]
    number = {s: k for k, s in enumerate(reversed(order))}
    rows = []
    for s in order:
        before = int(ends[s])
        for b in sorted(edges[s]):
            t = edges[s][b]
            rows.append((number[s] << 8 | b, number[t], before))
            before += count[t]
    rows.sort()
    ends_of = np.zeros(len(order), "<i8")
    ends_of[[number[s] for s in order if ends[s]]] = 1
    key, to, skip = np.array(rows, "<i8").reshape(-1, 3).T
    first = np.cumsum([0, *map(len, ids)])
    flat = [i for x in ids for i in x]
    arrays = [np.ascontiguousarray(a, "<i4") for a in (key, to, skip, ends_of, first, flat)]
    return b"".join([np.array([len(a) for a in arrays], "<i4").tobytes(), *[a.tobytes() for a in arrays]])


class Lexicon:
    """A compiled transducer, mapped from a file without a name."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            whole = np.memmap(f, "<i4", "r")
        at, got = 6, []
        for n in whole[:6]:
            got.append(whole[at : at + n])
            at += n
        self.key, self.to, self.skip, self.ends, self.first, self.flat = got

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where the lexicon has none. All words take their next step together."""
        n = len(words)
        out = np.full(n, -1)
        if not n or not len(self.key):
            return out
        sizes = np.array([len(w) for w in words])
        text = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(sizes) - sizes
        live, state, number = np.flatnonzero(sizes), np.zeros(n, np.int64), np.zeros(n, np.int64)
        step = 0
        while len(live):
            ended = sizes[live] == step
            done = live[ended]
            out[done] = np.where(self.ends[state[done]] == 1, number[done], -1)
            live = live[~ended]
            want = (state[live] << 8 | text[start[live] + step]).astype(self.key.dtype)
            e = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[e] == want
            live, e = live[hit], e[hit]
            state[live] = self.to[e]
            number[live] += self.skip[e]
            step += 1
        return out

    def ids(self, number: int) -> list[int]:
        return self.flat[self.first[number] : self.first[number + 1]].tolist()


@functools.lru_cache(2)
def bpe(path: str) -> WordBpe:
    return WordBpe(path)


_mapped: dict[bytes, tuple] = {}


def mapped(data: bytes) -> tuple[Lexicon, dict]:
    """This worker's map of the lexicon, and the words in memory."""
    name = hashlib.sha256(data).digest()
    if name not in _mapped:
        _mapped.clear()
        _mapped[name] = Lexicon(data), {}
    return _mapped[name]


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """word, n over all texts of docs: counted within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, seen = bpe(path), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array([w.encode(errors="surrogateescape") for w in seen], pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                for words, _ in b.parts(text.as_py() or ""):
                    seen.update(words)
            if len(seen) > COUNTED:
                yield out()
                seen = Counter()
        yield out()

    return in_small_batches(docs).select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list[bytes]:
    """At most that many words: all whose count is in the highest classes (eight for each doubling) that hold no more words together.

    Only the classes' sizes and the words themselves reach the driver.
    """
    classed = stash(counts.where(F.length("word") <= 64).withColumn("class", F.floor(8 * F.log2("n")).cast("int")))
    least, have = None, 0
    for r in sorted(classed.groupBy("class").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["class"]):
        have += r.n
        if have > most:
            break
        least = r["class"]
    return [] if least is None else [bytes(r.word) for r in classed.where(F.col("class") >= least).select("word").collect()]


def encode(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs (doc_id, text). path: the vocabulary's file."""
    spark = docs.sparkSession
    own = WordBpe(path)
    words = sorted(frequent_words(word_counts(docs, path), lexicon_words))
    data = spark.sparkContext.broadcast(compile_lexicon(words, [own.merge(w.decode(errors="surrogateescape")) for w in words]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(path)
        lexicon, known = mapped(data.value)

        def learn(new: list[str]) -> None:
            numbers = lexicon.numbers([w.encode(errors="surrogateescape") for w in new])
            for w, k in zip(new, numbers, strict=True):
                ids = lexicon.ids(k) if k >= 0 else b.merge(w)
                known[w] = " ".join(map(str, ids)), " ".join([b.token[i] for i in ids]), len(ids)

        for batch in (x for whole in batches for x in slices(whole, 1)):
            if len(known) > MEMORY:
                known.clear()
            rows = []
            texts = [b.parts(x.as_py() or "") for x in batch.column(1)]
            new = {w for parts in texts for words, _ in parts for w in words}.difference(known)
            learn(list(new))
            for parts in texts:
                found = []
                for words, special in parts:
                    found += [known[w] for w in words]
                    if special is not None:
                        found.append((str(special), b.token[special], 1))
                found = [x for x in found if x[2]]
                ids, decoded = " ".join([x[0] for x in found]), " ".join([x[1] for x in found])
                rows.append((sum([x[2] for x in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_small_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
