"""Order-preserving packing of documents into sequences of at most WINDOW tokens.

Each input partition is one stream of tokens in table order: a document's ids, then END. Dynamic programming chooses the
cuts among document ends, sentence ends and, within long sentences, every STRIDE tokens. A window costs its padding to
WINDOW plus a penalty by the kind of its cut; the best predecessor of each place comes from a monotone queue. Blocks of
the stream are settled as they fill, so memory does not follow the input; nothing is shuffled. The last, short remainder
of a stream is cut into sequences of powers of two, which need no padding.

Defined cases: a null text is empty and has END alone; rows that repeat are each packed; an empty partition has no
sequence; other columns are ignored. sequence_id is the partition's number and the sequence's within it.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from . import arrow
from .arrow import slices
from .byte_bpe import encoder
from .common import table

#: Tokens of a sequence, the id after each document, tokens between places to cut within a sentence, tokens of a block.
WINDOW, END, STRIDE, BLOCK = 1024, 0, 16, 1 << 18
#: Penalties in tokens of padding: a cut at a document's end, at a sentence's end, elsewhere.
AT_DOCUMENT, AT_SENTENCE, AT_TOKEN = 0.0, 2.0, 8.0
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def choose_cuts(places: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """Ends of windows: a subset of places (ascending, 0 < places, steps of window at most), the last place among them, of least cost.

    Least cost to end at place p: penalty(p) + window - p + min over starts s in [p - window, p) of cost(s) + s. The starts
    that may still be best stand in a queue, ascending in place and in cost(s) + s, so each comes and goes once.
    """
    pos, pen = places.tolist(), penalties.tolist()
    queue = deque([(0, 0.0, -1)])
    back = []
    for j, p in enumerate(pos):
        while queue[0][0] < p - window:
            queue.popleft()
        _, least, i = queue[0]
        back.append(i)
        value = pen[j] + window + least
        while queue and queue[-1][1] >= value:
            queue.pop()
        queue.append((p, value, j))
    cuts, j = [], len(pos) - 1
    while j >= 0:
        cuts.append(pos[j])
        j = back[j]
    return cuts[::-1]


def powers(length: int) -> list[int]:
    """Ends of pieces of falling powers of two that make up length."""
    ends, at = [], 0
    while at < length:
        at += 1 << ((length - at).bit_length() - 1)
        ends.append(at)
    return ends


class Stream:
    """Tokens that wait for their windows, and the documents they come from: (doc_id, doc_tokens, place in the buffer, ids before it)."""

    def __init__(self, first_id: int, ends: np.ndarray):
        self.sequence, self.ends = first_id, ends
        self.parts, self.docs, self.n = [], deque(), 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append([doc_id, len(ids), self.n, 0])
        self.parts.append(ids)
        self.n += len(ids)

    def settle(self, last: bool) -> Iterator[tuple]:
        """Rows of the windows that are settled; all of them if last."""
        if not self.n:
            return
        ids = np.concatenate(self.parts)
        places, penalties = self._places(ids)
        cuts = choose_cuts(places, penalties)
        if last:
            start = cuts[-2] if len(cuts) > 1 else 0
            cuts = cuts[:-1] + [start + x for x in powers(self.n - start)]
        else:
            cuts = [c for c in cuts if c <= self.n - 4 * WINDOW]
        at = 0
        for cut in cuts:
            yield from self._window(ids, at, cut)
            at = cut
        while self.docs and self.docs[0][2] + self.docs[0][1] - self.docs[0][3] <= at:
            self.docs.popleft()
        for d in self.docs:
            d[2] -= at
        if self.docs and self.docs[0][2] < 0:
            d = self.docs[0]
            d[2], d[3] = 0, d[3] - d[2]
        self.parts, self.n = [ids[at:]], self.n - at

    def _places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        doc_end = np.zeros(len(ids) + 1, bool)
        doc_end[[d[2] + d[1] - d[3] for d in self.docs]] = True
        kind = np.full(len(ids) + 1, AT_TOKEN)
        sentence = self.ends[ids]
        kind[1:][sentence] = AT_SENTENCE
        kind[doc_end] = AT_DOCUMENT
        take = kind < AT_TOKEN
        take[::STRIDE] = True
        take[0], take[-1] = False, True
        places = np.flatnonzero(take)
        return places, kind[places]

    def _window(self, ids: np.ndarray, at: int, cut: int) -> Iterator[tuple]:
        for doc_id, size, place, before in self.docs:
            if place >= cut:
                break
            lo, hi = max(at, place), min(cut, place + size - before)
            if lo < hi:
                yield doc_id, before + lo - place, hi - lo, zlib.crc32(ids[lo:hi].tobytes()), size, self.sequence, lo - at
        while self.docs and self.docs[0][2] + self.docs[0][1] - self.docs[0][3] <= cut:
            self.docs.popleft()
        self.sequence += 1


def sentence_ends(tokenizer) -> np.ndarray:
    """By id: whether a sentence may end with the token."""
    size = tokenizer.get_vocab_size()
    last = [(tokenizer.id_to_token(i) or "")[-1:] for i in range(size)]
    return np.isin(np.array(last), [".", "!", "?", "Ċ"])


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row for each piece of docs (doc_id, text); see SCHEMA. path: the vocabulary's file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        stream = Stream(TaskContext.get().partitionId() << 32, sentence_ends(bpe.tokenizer))
        end = np.array([END], "<u4")

        def out(rows):
            rows = list(rows)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_ARROW)

        for batch in (x for whole in batches for x in slices(whole, 1)):
            for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode_many([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                stream.add(doc_id, np.concatenate((ids, end)))
                if stream.n >= BLOCK:
                    yield from out(stream.settle(False))
        yield from out(stream.settle(True))

    return arrow.in_small_batches(docs).select("doc_id", "text").mapInArrow(arrow.task(run), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
