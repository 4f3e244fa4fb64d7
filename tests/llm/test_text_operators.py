"""Licence scans, chat formatting, packing, fingerprints and BPE: brute force, SQL and round trips."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tallyframe.llm import byte_bpe, chat, fingerprints, licences, packing, registry, suffix_dedup, word_bpe
from tests.llm.conftest import SF, frame, prose

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = con.execute(registry.SQL[name])
    cols = [d[0] for d in got.description]
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    want = sorted((tuple(map(plain, r)) for r in got.fetchall()), key=repr)
    df = registry.QUERIES[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == want


def scan_brute(rows):
    templates = [*licences.BASE, *licences.OWN]
    out = Counter()
    for d, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = {p: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for _, ps in templates for p in ps}
        base = [i for _, ps in licences.BASE for p in ps for i in at[p]]
        labels = lambda of: ",".join(sorted({n for n, ps in of if all(at[p] for p in ps)}))  # noqa: B023, E731
        out[d, len(w), len(base), min(base, default=None), max(base, default=None), labels(licences.BASE), labels(templates)] += 1
    return out


def test_licences(spark, odd, none):
    rows = odd[0] + [(900, "Under THE MIT License; under the mit license, under the mit licenses"), (901, "apache-license   VERSION 2 apache license version 2"), (902, "CC-BY-NC 4.0 cc by"), (903, "the name of neither the name of " + "redistribution and use in source and binary forms"), (904, "under the Mİt license"), (905, "mit " * 50_000 + "under the mit license")]
    got = licences.scan(frame(spark, rows)).drop("score").collect()
    assert Counter(tuple(r) for r in got) == scan_brute(rows)
    assert licences.scan(none).collect() == []


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|end|>\\ </s> [INST] <<SYS>>"), (1, 1, "assistant", "<|end|>\\ </s> [INST] <<SYS>>"), (2, None, "system", None), (2, 0, None, ""), (2, 1, "tool<|x", "é𝄞\n\n"), (None, 0, "assistant", "a"), (3, 5, "assistant", "x" * 200_000), (3, 4, "user", "\\|<|assistant|>"), (-7, 0, "user", "own")]


def chat_brute(rows):
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append(((t is not None, t or 0), (r is not None, r or ""), (x is not None, x or "")))
    out = {}
    for c, turns in groups.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        said = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_chat(spark):
    df = spark.createDataFrame([(*r, "own") for r in CHATS], "conv_id long, turn long, role string, text string, ids string").repartition(3)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(df, BYTE).collect()}
    assert got == chat_brute(CHATS)
    assert chat.digests(df.limit(0), BYTE).collect() == []
    for text in ("</s>[INST] ok [/INST]", "\\\\<|\\", "a\\"):
        safe = chat.escape(text)
        assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROL)


def test_chat_long(spark):
    """A very long text, and a conversation of many turns, some of them alike."""
    rows = [(1, 0, "user", "q</s>"), (1, 1, "assistant", prose(1, 200_000) + " [INST]")] + [(2, k // 2, "assistant" if k % 3 else "user", f"turn {k % 50}") for k in range(6000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(df, BYTE).collect()}
    assert got == chat_brute(rows)


def test_chat_masks(spark):
    """Loss covers the assistant's text alone; reserved ids stand between turns only."""
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    tok = byte_bpe.encoder(BYTE).tokenizer
    for r in chat.formatted(df.where("conv_id = 1"), BYTE).collect():
        ids, loss = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.loss, "u1").astype(bool)
        assert ids[-1] == chat.TURN_END and not loss[ids >= chat.RESERVED].any()
        if ids[0] == chat.ROLE["assistant"]:
            assert chat.unescape(tok.decode(ids[loss].tolist(), skip_special_tokens=False)) == CHATS[1][3]


def pieces_of(docs):
    return [r.asDict() for r in packing.pack(docs, BYTE).collect()]


def test_packing(spark, odd, none):
    rows = [(i, t) for i, (_, t) in enumerate(odd[0])]
    texts = dict(rows)
    tok = byte_bpe.encoder(BYTE).tokenizer
    got = pieces_of(frame(spark, rows))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in got:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for d, ps in by_doc.items():
        ids = np.array([*tok.encode(texts[d] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert zlib.crc32(ids[p["start"] : at].tobytes()) == p["ids_crc32"]
        assert at == len(ids)
    padding = total = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
        total += at
    assert padding < 0.05 * total
    assert pieces_of(none) == []


def test_least_cost_cuts():
    rng = np.random.default_rng(3)
    for _ in range(30):
        places = np.unique(np.append(rng.integers(1, 60, 25), np.arange(8, 64, 8)))
        pen = rng.choice([0.0, 2.0, 8.0], len(places))
        cost = {0: 0.0}
        for p, c in zip(places.tolist(), pen.tolist(), strict=True):
            cost[p] = min(cost[q] + 12 - (p - q) for q in cost if p - 12 <= q < p) + c
        cuts = packing.choose_cuts(places, pen, 12)
        of = dict(zip(places.tolist(), pen.tolist(), strict=True))
        assert sum(of[c] + 12 - (c - q) for q, c in zip([0, *cuts], cuts)) == pytest.approx(cost[int(places[-1])])  # noqa: B905


def test_fingerprints(spark, odd, none):
    rows = [(i, t) for i, (_, t) in enumerate(odd[0])]
    got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, rows)).collect()}
    order = sorted(got, reverse=True)
    texts = {i: t or "" for i, t in rows}
    for k, i in enumerate(order):
        t, after = texts[i], texts[order[(k + 1) % len(order)]]
        n = len(t) // 2
        edited = t[: len(t) - n] + after[:n]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    same = defaultdict(set)
    for i, t in texts.items():
        same[t].add(got[i].fingerprint)
    assert all(len(s) == 1 for s in same.values())

    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t.lower()) if x]
        return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()

    gaps = []
    for k, i in enumerate(order):
        a, b = shingles(texts[i]), shingles(texts[order[(k + 1) % len(order)]])
        true = len(a & b) / len(a | b) if a | b else 1.0
        assert 0 <= got[i].near_edited <= 1
        if len(a) > 20 and len(b) > 20:
            gaps.append(abs(got[i].near_next - true))
    assert np.mean(gaps) < 0.05 and max(gaps) < 0.2
    assert fingerprints.fingerprints(none).collect() == []
    twice = fingerprints.fingerprints(frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "x"), (1, "other")])).collect()
    assert len(twice) == 4 and len({tuple(r) for r in twice}) == 3


def test_no_id_is_not_the_least_id(spark):
    rows = [(None, "a b c d e f"), (-(1 << 63), "a b c d e f"), (1, "g h")]
    for out in (fingerprints.fingerprints(frame(spark, rows)), suffix_dedup.report(frame(spark, rows))):
        assert sorted([r.doc_id for r in out.collect()], key=str) == [-(1 << 63), 1, None]


def murmur(values, seed=42):
    """Spark's hash() of ints."""
    for v in values:
        k = (v & 0xFFFFFFFF) * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        seed ^= k * 0x1B873593 & 0xFFFFFFFF
        seed = (seed << 13 | seed >> 19) & 0xFFFFFFFF
        seed = (seed * 5 + 0xE6546B64) & 0xFFFFFFFF
        seed ^= 4
        for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            seed = (seed ^ seed >> shift) * by & 0xFFFFFFFF
    return seed


def plain_fingerprint(text):
    """Bins, minima and densification one by one."""
    import xxhash

    words = [xxhash.xxh64(w.encode(), 42).intdigest() for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return ""
    least = {}
    for k in range(max(len(words) - 4, 1)):
        h = 42
        for w in words[k : k + 5]:
            h = xxhash.xxh64(w.to_bytes(8, "little"), h).intdigest()
        value = min(h >> 7 & (1 << 40) - 1, (1 << 40) - 2)
        least[h & 127] = min(value, least.get(h & 127, value))
    donor = lambda i: min(least, key=lambda c: (murmur([i, c]) & 0x7FFFFFFF, c))
    return "".join(f"{least[i if i in least else donor(i)] & 15:x}" for i in range(128))


def test_fingerprints_bin_by_bin(spark):
    """Fingerprints, and the likeness of digits, against plain MinHash."""
    rows = [(1, prose(1, 4000)), (2, prose(2, 200)), (3, prose(2, 200) + " more"), (4, prose(3, 12)), (5, "one two"), (6, ""), (7, None), (8, prose(4, 60))]
    order = sorted(rows, reverse=True)
    for k, r in enumerate(sorted(fingerprints.fingerprints(frame(spark, rows)).collect(), key=lambda r: -r.doc_id)):
        text, after = order[k][1] or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert (r.fingerprint, r.edited_fingerprint) == (plain_fingerprint(text), plain_fingerprint(edited))
        for other, got in ((edited, r.near_edited), (after, r.near_next)):
            a, b = plain_fingerprint(text), plain_fingerprint(other)
            same = sum(x == y for x, y in zip(a, b, strict=False)) / 128
            assert got == pytest.approx(float(a == b) if not a or not b else max(0.0, (same - 1 / 16) * 16 / 15))


SPECIAL = [(1, "<|startoftext|>Hello<|endoftext|> world"), (2, "İstanbul ﬁ ＡＢ １２ ½ ǅ"), (3, "it's we'LL 12345 !?"), (4, "a​b ć"), (5, "\x00\x1f\x7f"), (6, "日本語 العربية हिन्दी")]


def test_word_bpe(spark, odd, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD)
    tok.no_padding()
    tok.no_truncation()
    rows = odd[0][:45] + SPECIAL + [(7, "z" * 3000)]
    want = Counter()
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    for words in (word_bpe.LEXICON_WORDS, 40, 0):
        assert Counter(tuple(r) for r in word_bpe.encode(frame(spark, rows), WORD, words).collect()) == want
    assert word_bpe.encode(none, WORD).collect() == []


def test_lexicon():
    words = sorted({w.encode() for w in (prose(1, 300) + " walking talking stalking walk").split()})
    ids = [[len(w), i] for i, w in enumerate(words)]
    lex = word_bpe.Lexicon(word_bpe.compile_lexicon(words, ids))
    assert [lex.ids(k) for k in lex.numbers(words)] == ids
    assert lex.numbers([b"", b"zzzzzzzz", words[0] + b"!"]).tolist() == [-1, -1, -1]
    assert len(lex.ends) < sum(map(len, words)) / 2


def test_lexicon_leaves_no_file(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    lex = word_bpe.Lexicon(word_bpe.compile_lexicon([b"a", b"ab"], [[1], [2, 3]]))
    assert list(tmp_path.iterdir()) == [] and lex.ids(int(lex.numbers([b"ab"])[0])) == [2, 3]


def test_merge_of_very_long_words():
    """Runs of a million letters in some seconds, and ties, as the library merges them."""
    import random

    own, rng = word_bpe.WordBpe(WORD), random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10**6)), "a" * 10**6, "ab" * 5000, "z" * 777]
    words += ["".join(rng.choice("etaoinsh") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    for w in words:
        assert own.merge(w) == own.library.encode(w, add_special_tokens=False).ids


def test_byte_bpe():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(BYTE), byte_bpe.ByteBpe(BYTE)
    for t in [x or "" for _, x in SPECIAL] + [prose(3, 200), " \n\n  a", ""]:
        assert own.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids
