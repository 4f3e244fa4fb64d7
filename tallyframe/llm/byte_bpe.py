"""Ids of a byte-level BPE vocabulary by word: each distinct word is merged once, then comes from a bounded memory.

Where the vocabulary's ids follow its merges, as in GPT-2's, tiktoken merges new words by the same ranks; otherwise the
tokenizers library does. Texts with characters on which Unicode versions may differ go whole to the tokenizers library.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

import numpy as np
import regex

#: The pattern of GPT-2's pre-tokenizer (public), a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters on whose classes every Unicode version and both regex libraries agree; a text with others goes whole to the library.
ODD = re.compile("[^\t\n\r\x20-\x7e¡-ſ‐-‧€]")
#: Words in memory in each Python worker.
MEMORY = 400_000


class ByteBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        added = json.loads(self.tokenizer.to_str())["added_tokens"]
        self.special = re.compile("|".join(re.escape(x["content"]) for x in added) or r"(?!)")
        self.words: dict[str, bytes] = {}
        self.find = regex.compile(PATTERN).findall
        self.piece = self._by_rank()

    def _by_rank(self):
        """tiktoken's merge of one word, or None where the ids aren't ranks."""
        import tiktoken

        model = json.loads(self.tokenizer.to_str())["model"]
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if len(vocab) != 256 + len(made) or any(x >= y for x, y in zip(made, made[1:])) or made[0] != 256 or model.get("ignore_merges"):  # noqa: B905
            return None
        of = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def learn(self, new: list[str]) -> None:
        if len(self.words) > MEMORY:
            self.words.clear()
        if self.piece:
            self.words.update([(w, array("I", self.piece(w.encode())).tobytes()) for w in new])
        else:
            self.words.update([(w, array("I", e.ids).tobytes()) for w, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True)])

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """encode() of each text; the new words of all of them are learnt at once."""
        plain = [not (ODD.search(t) or self.special.search(t)) for t in texts]
        found = [self.find(t) if ok else None for t, ok in zip(texts, plain, strict=True)]
        if len(self.words) > MEMORY:
            self.words.clear()
        self.learn(list(set().union(*[f for f in found if f]).difference(self.words)))
        known = self.words
        return [np.frombuffer(b"".join([known[w] for w in f]), "<u4") if f is not None else self.encode(t) for t, f in zip(texts, found, strict=True)]

    def encode(self, text: str) -> np.ndarray:
        """uint32 ids of text, as Tokenizer.encode(text, add_special_tokens=False) gives them."""
        if ODD.search(text) or self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self._of_words(self.find(text))

    def plain(self, text: str) -> np.ndarray:
        """uint32 ids of text with strings of special tokens taken as ordinary text: never a special id."""
        if ODD.search(text) or self.special.search(text):
            self.tokenizer.encode_special_tokens = True
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            self.tokenizer.encode_special_tokens = False
            return np.array(ids, "<u4")
        return self._of_words(self.find(text))

    def _of_words(self, found: list[str]) -> np.ndarray:
        known = self.words
        new = set(found).difference(known)
        if new:
            self.learn(list(new) if len(known) <= MEMORY else list(set(found)))
        return np.frombuffer(b"".join([known[w] for w in found]), "<u4")


def byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for each byte: printable ones stand for themselves, the others follow from U+0100."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in kept]
    of = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [of[b] for b in range(256)]


@functools.lru_cache(2)
def encoder(path: str) -> ByteBpe:
    """One for each Python worker and path."""
    return ByteBpe(path)
