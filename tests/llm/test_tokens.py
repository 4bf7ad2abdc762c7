"""Re-Pair shards, packing and byte-level BPE against the tokenizer libraries themselves."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edge import TEXTS, documents
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, pretokens, repair
from tidemark.llm.pretokens import MemoEncoder, PieceMemo, slices
from tidemark.session import scratch_path

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def odd_texts(n):
    rng = random.Random(1)
    alphabet = [*"ab'srvetlmdLS 's  \n\t .,!_12²é́ß İ中文\U0001f600<|>", "'s", "'re", "'ll", "'LL", " '", "\n\n", " \n", "<|endoftext|>"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_memo_encoder_equals_library(path):
    texts = odd_texts(3000) + [t for _, t in TEXTS]
    one = library(path)
    assert [x.tolist() for x in MemoEncoder(path).encode(texts)] == [one(t) for t in texts]


def test_memo_starts_again_when_full():
    memo = PieceMemo(lambda piece: [len(piece), ord(piece[0])], limit=8)
    from tidemark.llm.pretokens import split_ids

    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(rng.randint(1, 40))) for _ in range(50)]
    got = split_ids(texts, memo, drop_spaces=True)
    assert [x.tolist() for x in got] == [[v for w in t.split() for v in (len(w), ord(w[0]))] for t in texts]


def thue_morse(n):
    """Two words of n letters that polynomial hashes modulo powers of two can't tell apart."""
    word = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[x] for x in word), "".join("ba"[x] for x in word)


def test_words_of_one_fingerprint_keep_their_ids(spark):
    texts = [w for n in (1024, 2048, 4096) for w in thue_morse(n)]
    for path in (WORDS, BYTES):
        one = library(path)
        assert [x.tolist() for x in MemoEncoder(path).encode(texts)] == [one(t) for t in texts]
    codec = bpe.RankBpe(RANKS)
    assert [codec.decode(x).decode() for x in codec.encode(texts)] == texts
    docs = documents(spark, list(enumerate(texts)))
    path = scratch_path(spark, "repair-collisions")
    repair.write_ids(docs, path, WORDS, end_id=2)
    one = library(WORDS)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in repair.read_ids(spark, path).collect()}
    assert got == {i: [*one(t), 2] for i, t in enumerate(texts)}
    one, pieces = library(BYTES), {}
    for r in packing.pack_documents(docs, BYTES, 64, 0, with_ids=True).collect():
        pieces.setdefault(r.doc_id, []).append((r.piece, bytes(r.ids)))
    for i, t in enumerate(texts):
        assert b"".join(x for _, x in sorted(pieces[i])) == np.array([*one(t), 0], "<u4").tobytes()


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_small_fingerprints_that_always_collide(path, monkeypatch):
    exact = pretokens.fingerprints
    monkeypatch.setattr(pretokens, "fingerprints", lambda *x: exact(*x) & np.uint64(0xFF) | np.uint64(1))
    texts = odd_texts(1500) + [t for _, t in TEXTS]
    one = library(path)
    encoder = MemoEncoder(path)
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(texts)] == [one(t) for t in texts]
    codec = bpe.RankBpe(RANKS)
    assert [codec.decode(x).decode() for x in codec.encode(texts)] == [t or "" for t in texts]


def test_perfect_hash_answers_for_every_token():
    codec = bpe.RankBpe(RANKS)
    codec._memo = None  # nothing may be asked of it but by what is no token
    words = [w for w in (t.decode("utf-8", "ignore") for t in list(codec.ranks)[:20000]) if w.isascii() and w.isalpha()]
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    end = np.cumsum([len(w) for w in words])
    begin = end - [len(w) for w in words]
    h = pretokens.fingerprints(points, begin, end)
    codec._memo = type("None_", (), {"ids": staticmethod(lambda *x: (np.zeros(0, np.uint32), np.zeros(len(x[2]), np.int64)))})
    ids, length = codec.ids("".join(words), points, begin, end, h)
    assert len(words) > 5000 and (length == 1).all()
    assert ids.tolist() == [codec.ranks[w.encode()] for w in words]


def test_parts_of_texts_without_blanks():
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcXYZ0123456789", k=400_000)), "\u4e2d\u6587\u3002" * 60_000]
    codec, one = bpe.codec(RANKS), library(BYTES)
    assert max(len(p) for g in slices(texts) for _, p in g) < 140_000
    assert [codec.decode(x).decode() for x in codec.encode(texts)] == texts
    assert [x.tolist() for x in MemoEncoder(BYTES).encode(texts)] == [one(t) for t in texts]


def test_long_texts_come_in_parts():
    text = "word " * 1000
    parts = [part for group in slices(["x", text, ""], limit=500) for k, part in group if k == 1]
    assert len(parts) > 5 and "".join(parts) == text and all(p.startswith(" word") for p in parts[1:])


def test_perfect_hash_is_minimal_and_exact():
    keys = [str(i * i).encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert [h.find(k) for k in keys] == list(range(5000))
    assert h.find(b"no such key") is None and bpe.PerfectHash([]).find(b"x") is None
    assert all(h.key_at)  # no place is empty


def test_byte_bpe_equals_tiktoken_and_decodes(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts(3000) + ["a" * 700, " " * 300]
    codec = bpe.codec(RANKS)
    got = codec.encode(texts)
    assert [x.tolist() for x in got] == [own.encode_ordinary(t) for t in texts]
    assert [codec.decode(x).decode() for x in got] == texts
    rows = bpe.encode_documents(documents(spark), RANKS, with_ids=True).collect()
    assert len(rows) == len(TEXTS)
    want = sorted((-1 if i is None else i, hashlib.sha256((t or "").encode()).hexdigest(), len(own.encode_ordinary(t or ""))) for i, t in TEXTS)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.decoded_sha256, r.n_tokens) for r in rows) == want
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and r.decoded.decode() is not None for r in rows)
    assert bpe.encode_documents(documents(spark, []), RANKS).count() == 0


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    docs = [np.append(rng.choice([5, 6, 7, 8, 9], n), 2).astype(np.uint32) for n in [0, 1, 2, 500, 3000, 0, 77]]
    docs.append(np.append(np.full(999, 5), 2).astype(np.uint32))  # one long run
    shard = repair.Shard(repair.pack_shard([*range(7), None], docs, base=100))
    assert len(shard.left) > 5 and len(shard.symbols) < 0.6 * sum(map(len, docs))
    assert shard.tokens().tolist() == np.concatenate(docs).tolist()
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == d.tolist()
        for a, b in [(0, 1), (3, 9), (400, 450), (len(d) - 1, len(d))]:
            assert shard.document(k, a, b).tolist() == d[a:b].tolist()
    assert (shard.lengths >= 2).all()
    with pytest.raises(ValueError):
        repair.Shard(b"????" + bytes(60))


@pytest.mark.parametrize("least", [2, 5, 16])
def test_repair_goes_on_until_no_pair_is_frequent(least):
    rng = np.random.default_rng(least)
    docs = [np.append(np.minimum(rng.zipf(1.3, int(n)), 60) + 2, 2).astype(np.uint32) for n in rng.integers(0, 900, 60)]
    docs.append(np.append(np.full(777, 9), 2).astype(np.uint32))
    flat = np.concatenate(docs)
    last = np.zeros(len(flat), bool)
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    seq, marks, left, right, lengths = repair.compress(flat, last, 100, least=least)
    assert repair.expand(seq, 100, left, right).tolist() == flat.tolist() and marks.sum() == len(docs)
    pairs = Counter((int(x), int(y)) for x, y, end in zip(seq[:-1], seq[1:], marks[:-1]) if not end)
    assert max(pairs.values()) < least
    size = lambda s: 1 if s < 100 else size(left[s - 100]) + size(right[s - 100])
    assert lengths.tolist() == [size(100 + k) for k in range(len(left))]


def test_repair_files(spark):
    one, path = library(WORDS), scratch_path(spark, "repair")
    repair.write_ids(documents(spark), path, WORDS, end_id=2, shard_tokens=64)
    rows = sorted(repair.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert len(rows) == len(TEXTS) and spark.read.parquet(path).count() >= 2
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32
        at += r.n_tokens
    want = sorted((-1 if i is None else i, np.array([*one(t), 2], "<u4").tobytes()) for i, t in TEXTS)
    assert sorted(zip(ids, (bytes(r.ids) for r in rows))) == want
    empty = scratch_path(spark, "repair-empty")
    repair.write_ids(documents(spark, []), empty, WORDS, end_id=2)
    assert repair.read_ids(spark, empty).count() == 0


def brute_fullest(items, room):
    sums = {0}
    for x in items:
        sums |= {s + x for s in sums if s + x <= room}
    return max(sums)


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(0, 8))}
        room = rng.randint(0, 90)
        got = packing.fullest(counts, room)
        assert all(k <= counts[n] for n, k in got)
        assert sum(n * k for n, k in got) == brute_fullest([n for n, k in counts.items() for _ in range(k)], room)


def test_plan_uses_every_piece_once():
    rng = random.Random(6)
    counts = {rng.randint(1, 30): rng.randint(1, 900) for _ in range(60)}
    plan = packing.plan_bins(counts, 64)
    used = {}
    for copies, uses in plan:
        assert sum(n * k for n, k in uses) <= 64
        for n, k in uses:
            used[n] = used.get(n, 0) + copies * k
    assert used == counts and len(plan) <= 64
    assert sum(c for c, _ in plan) <= 1.02 * sum(n * k for n, k in counts.items()) / 64 + 1


@pytest.mark.parametrize("n, want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (19, [(0, 3), (3, 8), (11, 8)])])
def test_cut(n, want):
    assert packing.cut(n, 8) == want


def test_packed_documents(spark):
    one = library(BYTES)
    rows = packing.pack_documents(documents(spark), BYTES, 64, 0, with_ids=True).collect()
    bins, docs = {}, {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        docs.setdefault(r.doc_id, []).append((r.piece, r.start, bytes(r.ids)))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= sum(r.length for r in rows) / 64 * 1.02 + 1
    for i in (1, 2, 3, 4, 6, 7, 8):
        text = next(t for j, t in TEXTS if j == i)
        assert b"".join(x for _, _, x in sorted(docs[i])) == np.array([*one(text), 0], "<u4").tobytes()
    assert len(docs[5]) == 2 and docs[3] == [(0, 0, b"\0\0\0\0")] and None in docs
    assert packing.pack_documents(documents(spark, []), BYTES).count() == 0


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_memo_encoder_on_every_kind_of_character(path):
    points = [p for p in [*range(0, 0x3200), *range(0xA640, 0xB000), *range(0x10000, 0x1F000, 3)] if not 0xD800 <= p < 0xE000]
    texts = [f"a{chr(p)}1{chr(p)} {chr(p)}." for p in points]
    one = library(path)
    got = MemoEncoder(path).encode(texts)
    assert [hex(p) for p, t, x in zip(points, texts, got) if x.tolist() != one(t)] == []
