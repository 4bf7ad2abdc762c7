"""Components, SimHash, embedding duplicates and top-k search against brute force."""

import math
import random

import numpy as np
import pytest
import xxhash
from edge import LONG, TEXTS, documents
from pyspark.sql import functions as F

from tidemark.llm import embeddedup, simhash, topk
from tidemark.llm.components import components
from tidemark.llm.vectors import roots


def brute_roots(n, links):
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            for x in (a, b):
                changed |= root[x] != low
                root[x] = low
    return root


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, x) for x in range(201, 260)] + [(7, 7), (9, 8), (8, 9)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(80)]
    got = dict(components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect())
    want = brute_roots(401, links)
    assert got == {x: want[x] for x in {v for a, b in links if a != b for v in (a, b)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    x, y = np.array(links).T
    assert roots(401, x, y).tolist() == want


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    rng = random.Random(8)
    base = [" ".join(rng.choice(["red", "Blue", "green", "sky", "sea", "stone"]) for _ in range(200)) for _ in range(12)]
    out = list(base)
    for t in base:
        for _ in range(6):
            w = t.split()
            w[rng.randrange(len(w))] = rng.choice(["lamp", "LAMP", "tree"])
            out.append(" ".join(w))
    return [(100 + i, t) for i, t in enumerate(out)]


def test_simhash_equals_brute_force(spark):
    rows = TEXTS[:3] + TEXTS[4:] + near_texts() + [(2000 - i, "same old copy") for i in range(30)]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    root = brute_roots(len(rows), links)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    want = sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, root)), key=key)
    assert sorted(map(tuple, got), key=key) == want
    assert len({c for _, _, c in want}) < len(rows) - 30
    kept = simhash.one_of_each(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted((least.get(r) is None, least.get(r) or 0) for r in set(root))
    assert simhash.near_duplicates(documents(spark, [])).count() == 0 and simhash.one_of_each(documents(spark, [])).count() == 0


def test_fingerprint_of_long_and_short_texts():
    for text in [LONG, "", None, "One", "one two", "ÀB c\vd\x1ce", "\x00 a"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_index_finds_every_pair(spark, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for f in list(fps)[:120]:
        for b in rng.sample(range(64), rng.randint(1, 4)):
            f ^= 1 << b
        fps.add(f)
    near = sorted({0, 1, 3, 7, 1 << 63, (1 << 64) - 1} | {1 << i for i in range(20)})
    fps = sorted(fps | set(near))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.groups(spark.createDataFrame([(f,) for f in signed], "fp long"), bits).collect()
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= bits]
    want = brute_roots(len(fps), links)
    classes, expected = {}, {}
    for r in got:
        classes.setdefault(r.root, set()).add(r.fp)
    for f, r in zip(signed, want):
        expected.setdefault(r, set()).add(f)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def vector_rows():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            v = rng.normal(size=16)
            for _ in range(rng.integers(1, 5)):
                rows.append((k, (v + rng.normal(size=16) * 0.08 * rng.random()).astype("f4").tolist(), label))
                k += 1
    same = rng.normal(size=16).tolist()
    rows += [(k + i, same, 1) for i in range(9)] + [(k + 9, [2 * x for x in same], 1), (k + 10, same, 0)]
    k += 11
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(k + i, v, 1) for i, v in enumerate(bad)] + [(k + 7, [1.0], 0), (k + 8, [3.0] + [0.0] * 15, 0), (None, same, 1), (3, rows[3][1], 0)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, class string, links int")


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("tile", [1024, 7])
def test_embedding_duplicates_equal_brute_force(spark, tile):
    rows = vector_rows()
    got = embeddedup.embedding_duplicates(frame(spark, rows), 0.98, tile=tile).collect()
    full = [np.pad(np.array(v, "f4").astype(float), (0, 16 - len(v))) if usable(v) and any(v) else None for _, v, _ in rows]
    full = [None if v is None else v / np.linalg.norm(v) for v in full]
    ok = [v is not None and r[2] is not None for v, r in zip(full, rows)]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if ok[a] and ok[b] and rows[a][2] == rows[b][2] and full[a] @ full[b] >= 0.98]
    root = brute_roots(len(rows), links)
    n, least = [0] * len(rows), {}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    for (i, _, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = [(i, n[k], least.get(root[k], i), i is None and least.get(root[k]) is None or i == least.get(root[k])) for k, (i, _, _) in enumerate(rows)]
    key = lambda r: tuple(-1 if v is None else v for v in r[:3])
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key)
    assert got == sorted((w[:3] for w in want), key=key) and len(links) > 60
    assert embeddedup.embedding_duplicates(frame(spark, [])).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(200, 33)), rng.normal(size=(50, 33)) * 1e-30, np.eye(33) * 1e30])
    q, s, e, u = embeddedup.quantise(x)
    near = embeddedup.product(q, q) * s[:, None] * s[None, :]
    assert (np.abs(near - u @ u.T) <= e[:, None] + e[None, :] + e[:, None] * e[None, :] + embeddedup.SLACK).all()
    wide = rng.integers(-127, 128, (5, 4000)).astype(np.int8)
    assert (embeddedup.product(wide, wide) == wide.astype(int) @ wide.astype(int).T).all()


@pytest.mark.parametrize("slices, block", [(2, 2048), (3, 16), (1, 32)])
def test_top_k_equals_brute_force(spark, slices, block):
    rows = vector_rows()
    got = topk.top_k(frame(spark, rows), k=5, query_every=10, slices=slices, candidate_block=block, query_block=8).collect()
    whole = [[math.floor(256 * float(np.float32(x))) for x in v] + [0] * (16 - len(v)) if usable(v) else None for _, v, _ in rows]
    want = []
    for a, (i, _, _) in enumerate(rows):
        if i is None or i % 10 or whole[a] is None:
            continue
        scores = sorted((-sum(x * y for x, y in zip(whole[a], whole[b])), rows[b][0] is None, rows[b][0] or 0) for b in range(len(rows)) if b != a and whole[b])
        want += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scores[:5])]
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_top_k_with_few_candidates_and_none(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (50, [-1.0, 0.5], 1)]
    got = sorted(map(tuple, topk.top_k(frame(spark, rows)).collect()))
    one = 256 * 256
    assert got == [(0, 1, 1, 3 * one), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 1, -one // 2)]
    assert topk.top_k(frame(spark, [])).count() == 0
    assert topk.top_k(frame(spark, [(0, [1.0], 1)])).count() == 0
