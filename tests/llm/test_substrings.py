"""Removal of repeated passages against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest
from edge import LONG, TEXTS, documents

from tidemark.llm import substrings as S


def brute(rows, window):
    """(n_words, removed word numbers, kept text) of each row, in order."""
    words = [[w for w in S.split_words(t).split(b" ") if w] for _, t in rows]
    first = {}
    for (doc, _), own in zip(rows, words):
        if doc is not None:
            for k in range(len(own) - window + 1):
                key = tuple(own[k : k + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), own in zip(rows, words):
        gone = set()
        if doc is not None:
            for k in range(len(own) - window + 1):
                if first[tuple(own[k : k + window])] < doc:
                    gone |= set(range(k, k + window))
        out.append((len(own), gone, b" ".join(w for k, w in enumerate(own) if k not in gone).decode()))
    return out


def check(spark, rows, window, **options):
    got = S.repeated_passages(documents(spark, rows), window, with_text=True, **options).collect()
    key = lambda d, n, gone, text: (-1 if d is None else d, n, sorted(gone), text)
    have = [key(r.doc_id, r.n_words, {k for s in r.spans for k in range(s.begin, s.end)}, r.kept) for r in got]
    assert sorted(have) == sorted(key(d, *x) for (d, _), x in zip(rows, brute(rows, window)))
    for r in got:
        assert r.n_removed == sum(s.end - s.begin for s in r.spans) and r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest()
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:]))
    return got


@pytest.mark.parametrize("seed, window, shard", [(1, 4, 3), (2, 5, 8), (3, 9, 1 << 15)])
def test_passages_equal_brute_force(spark, seed, window, shard):
    rng = random.Random(seed)
    passages = [" ".join(rng.choices("abcdef", k=rng.randint(window - 1, 3 * window))) for _ in range(6)]
    rows = []
    for i in range(90):
        parts = [rng.choice(passages) if rng.random() < 0.6 else " ".join(rng.choices("uvwxyzabc", k=rng.randint(0, 9))) for _ in range(rng.randint(0, 5))]
        rows.append((rng.randint(0, 70), rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [rows[3], rows[5], (None, passages[0] * 2), (200, None), (201, ""), (-5, passages[1])]
    check(spark, rows, window, shard_windows=shard)


def test_awkward_rows(spark):
    check(spark, TEXTS + [(9, LONG), (10, "start " + LONG[:9000]), (11, "é x " * 60)], 50)
    assert S.repeated_passages(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        S.repeated_passages(documents(spark), 0)


def test_many_documents_share_one_passage(spark):
    """A third of all rows share a passage in surroundings of their own."""
    rng = random.Random(8)
    shared = " ".join(f"s{k}" for k in range(70))
    rows = [(i, f"{' '.join(f'a{rng.random()}' for _ in range(20))} {shared if i % 3 == 0 else ''} {' '.join(f'b{rng.random()}' for _ in range(40))}") for i in range(600)]
    got = check(spark, rows, 50, shard_windows=16)
    assert sorted(r.n_removed for r in got) == [0] * 401 + [70] * 199


def test_sliding_min_and_anchors():
    rng = np.random.default_rng(1)
    for n, width in [(1, 1), (5, 5), (50, 7), (99, 13), (14, 7)]:
        x = rng.integers(0, 1 << 60, n).astype(np.uint64)
        assert S.sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(n - width + 1)]
    words = " ".join(str(k % 700) for k in range(90_000)).encode()  # several blocks
    a = S.anchors(words, *S.word_bounds(words), 50)
    assert len(a) == 90_000 - 49 and (a[:700] == a[700:1400]).all() and (a[60_200:60_900] == a[:700]).all()
    one = (b"x" * 300_000) + b" y z"
    assert len(S.anchors(one, *S.word_bounds(one), 3)) == 1


def test_automaton_knows_every_factor():
    rng = random.Random(4)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 25))] for _ in range(12)]
    ids = rng.sample(range(100), 12)
    own = S.SuffixAutomaton()
    for d, t in zip(ids, texts):
        own.add(t, d)
    m = S.Matcher(own.pack())
    assert len(m.length) <= 2 * sum(map(len, texts))
    for _ in range(200):
        text, doc, window = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)], rng.randint(0, 100), rng.randint(1, 6)
        gone = set()
        for k in range(len(text) - window + 1):
            for d, t in zip(ids, texts):
                if d < doc and any(t[j : j + window] == text[k : k + window] for j in range(len(t) - window + 1)):
                    gone |= set(range(k, k + window))
        assert {k for a, b in m.repeats(text, doc, window) for k in range(a, b)} == gone
