"""Chat formatting at token level.

Each turn is one segment: a reserved id for its role, the ids of its escaped text, a reserved id for its end. Segments are
encoded one by one where they lie; only then do turns meet by conversation, in order of turn, and are spliced as a
stream. The loss mask is the prefix sum of +1 where an assistant's text starts and -1 where it ends. Reserved ids lie
above the vocabulary, so no text can make one; control strings in a text are escaped all the same, reversibly.

Template: <|role|> NEWLINE text <|end|> NEWLINE for each turn, where the marks are the reserved ids.
Escape: a backslash is doubled and one is put after the first character of each control string.

Defined cases: a null text or role is empty; turns of one number come in order of role, then text, null turns first;
repeated rows are turns of their own; a null conv_id is a conversation; other columns are ignored. A conversation of any
length passes through as a stream: what is held is its running digests, not its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .arrow import in_small_batches, slices
from .byte_bpe import encoder
from .common import table

#: Strings that steer chat templates in use, escaped where a text holds them.
CONTROL = ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[BOS]", "[EOS]"]
_FIND = re.compile(r"\\|" + "|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
#: First reserved id, of the end of a turn; the next are a role's. Other roles write their name as text after the last one.
RESERVED = 1 << 20
ROLES = ["system", "user", "assistant"]
TURN_END, ROLE, OTHER = RESERVED, {r: RESERVED + 1 + k for k, r in enumerate(ROLES)}, RESERVED + 1 + len(ROLES)
#: What the reserved ids are in the formatted text.
MARK = {TURN_END: "<|end|>\n", **{i: f"<|{r}|>\n" for r, i in ROLE.items()}, OTHER: "<|other|>\n"}
NAME_END = RESERVED + 2 + len(ROLES)
MARK[NAME_END] = "<|text|>\n"
#: The conversation that the query adds.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def escape(text: str) -> str:
    return _FIND.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turns(conversations: DataFrame, path: str) -> DataFrame:
    """conv_id, turn, role, text and ids: the turn's segment, little-endian unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in (x for whole in batches for x in slices(whole, 3)):
            out = []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                ids = bpe.plain(escape(text or ""))
                head = [ROLE[role]] if role in ROLE else [OTHER, *bpe.plain(escape(role or "")), NAME_END]
                out.append(np.concatenate((head, ids, [TURN_END])).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(k).cast(t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))], pa.array(out, pa.binary())], ["conv_id", "turn", "role", "text", "ids"])

    return in_small_batches(conversations).select("conv_id", "turn", "role", "text").mapInArrow(run, "conv_id long, turn long, role string, text string, ids binary")


class Assembly:
    """One conversation as its segments come: ids and loss mask of each, read back into the digests."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars, self.tokens = conv_id, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: np.ndarray, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """Splice a segment; returns its ids and loss mask."""
        reserved = np.flatnonzero(segment >= RESERVED)
        start, end = (reserved[1] if segment[0] == OTHER else 0) + 1, len(segment) - 1
        steps = np.zeros(len(segment) + 1, np.int8)
        if segment[0] == ROLE["assistant"]:
            steps[start] += 1
            steps[end] -= 1
        mask = np.cumsum(steps[:-1]).astype(bool)
        role = unescape(tokenizer.decode(segment[1 : start - 1].tolist(), skip_special_tokens=False)) if segment[0] == OTHER else ROLES[int(segment[0]) - RESERVED - 1]
        body = tokenizer.decode(segment[start:end].tolist(), skip_special_tokens=False)
        text = unescape(body)
        self.turns.update(f"{role}\n{text}\n".encode())
        if mask.any():
            kept = unescape(tokenizer.decode(segment[mask].tolist(), skip_special_tokens=False))
            self.loss.update(kept.encode())
            self.loss_chars += len(kept)
        named = len(escape(role)) if segment[0] == OTHER else 0
        self.chars += len(body) + named + sum(len(MARK[int(i)]) for i in segment[reserved])
        self.n_turns += 1
        self.tokens += len(segment)
        return segment, mask

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.tokens


def in_order(conversations: DataFrame, path: str) -> DataFrame:
    """Segments dealt by conversation, each conversation's together and in order."""
    return turns(conversations, path).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "ids")


def digests(conversations: DataFrame, path: str) -> DataFrame:
    """What is read back from the formatted conversations: one row for each conv_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, now = encoder(path).tokenizer, None

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"])

        for batch in batches:
            rows = []
            for conv_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if now is None or conv_id != now.conv_id:
                    rows += [now.row()] if now else []
                    now = Assembly(conv_id)
                now.add(np.frombuffer(ids.as_py(), "<u4"), tokenizer)
            if rows:
                yield out(rows)
        if now:
            yield out([now.row()])

    return in_order(conversations, path).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long")


def formatted(conversations: DataFrame, path: str) -> DataFrame:
    """The formatted conversations themselves, one row for each turn: conv_id, part (from 0), ids and loss (a byte for each id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, now = encoder(path).tokenizer, None
        for batch in batches:
            rows = []
            for conv_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if now is None or conv_id != now.conv_id:
                    now = Assembly(conv_id)
                segment, mask = now.add(np.frombuffer(ids.as_py(), "<u4"), tokenizer)
                rows.append((conv_id, now.n_turns - 1, segment.tobytes(), mask.astype(np.uint8).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["conv_id", "part", "ids", "loss"])

    return in_order(conversations, path).mapInArrow(run, "conv_id long, part long, ids binary, loss binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return digests(rows.unionByName(probe), public_tokenizers.path("byte_bpe_50k.json")).drop("n_tokens")


def _sql() -> str:
    escaped = r"replace(coalesce({}, ''), '\', '\\')"
    text = escaped.format("text")
    for c in sorted(CONTROL, key=len, reverse=True):
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    role = text.replace("coalesce(text, '')", "coalesce(role, '')")
    known = ", ".join(f"'{r}'" for r in ROLES)
    probe = " UNION ALL ".join(f"SELECT {a}, {b}, '{c}', '{d}'" for a, b, c, d in PROBE)
    return rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL {probe}),
t AS (SELECT conv_id, turn, role AS raw_role, text AS raw_text, coalesce(role, '') AS role, coalesce(text, '') AS text,
  length({text}) + CASE WHEN role IN ({known}) THEN length(role) + 5 ELSE {len(MARK[OTHER])} + length({role}) + {len(MARK[NAME_END])} END + {len(MARK[TURN_END])} AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, raw_role NULLS FIRST, raw_text NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, raw_role NULLS FIRST, raw_text NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


SQL = _sql()
