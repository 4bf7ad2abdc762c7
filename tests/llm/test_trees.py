"""Merkle manifests and conversation tries against plain recursion."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from edge import TEXTS, documents
from pyspark.sql import functions as F

from tidemark.llm import merkle as M
from tidemark.llm import trie as T

H = lambda text: hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text=None):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"] if text is None else text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels_of(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][k : k + fanout])) for k in range(0, len(out[-1]), fanout)])
    return out


def path_of(levels, k, fanout):
    out = []
    for nodes in levels[:-1]:
        a = k // fanout * fanout
        out.append(("".join(nodes[a:k]), "".join(nodes[k + 1 : a + fanout])))
        k //= fanout
    return out


def brute_manifest(rows, fanout):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[s] = (own, levels_of([leaf_of(r) for r in own], fanout))
    top = levels_of([trees[s][1][-1][0] for s in names], fanout) if names else [[]]
    out = []
    for n, s in enumerate(names):
        own, levels = trees[s]
        for k, r in enumerate(own):
            out.append((-1 if r["doc_id"] is None else r["doc_id"], s or "", levels[0][k], levels[-1][0], path_of(levels, k, fanout) + path_of(top, n, fanout)))
    return (top[-1][0] if names else None), sorted(out)


def doc_rows(n, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "é", "z", "Z", *[f"s{k}" for k in range(30)]]
    rows = []
    for i in range(n):
        s = "hot" if i % 3 == 0 else rng.choice(sources)
        rows.append({"doc_id": rng.choice([i, i, i, 7, None]), "source": s, "lang": rng.choice(["en", None]), "n_chars": rng.choice([None, 0, i]), "text": rng.choice([None, "", "Tëxt Ä B", "x" * 3000, f"Row {i}"])})
    return rows + rows[:5]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, rank long, level int, kids string"


@pytest.mark.parametrize("n, fanout", [(300, 16), (150, 2), (40, 3), (1, 16), (0, 16)])
def test_manifest_equals_plain_recursion(spark, n, fanout):
    rows = doc_rows(n, n)[: n + 5 if n > 1 else n]
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "h", 1, 2, "k") for r in rows], SCHEMA)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = M.manifest(df, fanout=fanout, claimed={"text": lower})
    root, want = brute_manifest(rows, fanout)
    proofs = made.proofs.withColumn("folded", M.folded(F.coalesce("claim", "leaf"))).withColumn("true", M.folded("leaf")).withColumn("sib", M.siblings_hash()).collect()
    assert made.root == root
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.source or "", r.leaf, r.subroot, [tuple(p) for p in r.path]) for r in proofs) == want
    by_leaf = {leaf_of(r): r for r in rows}
    for r in proofs:
        row = by_leaf[r.leaf]
        changed = row["text"] is not None and any("A" <= c <= "Z" for c in row["text"])
        acc = leaf_of(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])) if changed else r.leaf
        assert (r.claim is not None) == changed and r.true == root
        for left, right in r.path:
            acc = H(left + acc + right)
        assert r.folded == acc and (r.folded == root) == (not changed)
        assert r.sib == H("".join(a + b for a, b in r.path))
    nodes = made.nodes.collect()
    assert sum(x.hi - x.lo for x in nodes if x.tree == "source" and x.level == 0) == len(rows)


def test_manifest_needs_two_children(spark):
    with pytest.raises(ValueError):
        M.manifest(documents(spark, TEXTS).withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(1)), fanout=1)


def brute_trie(rows, base, kept):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", hashlib.md5((x or "").encode()).hexdigest(), x or ""))
    seq = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    built = {c: tuple(seq.get(base(c), [])[: kept(c)] + v[kept(c) :]) for c, v in seq.items()}
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
    out = []
    for k, v in members.items():
        ends = ",".join(map(str, sorted(c for c in v if len(built[c]) == len(k))))
        out.append((min(v), len(k), min(members[k[:-1]]) if k else None, len(v), len(kids[k]), leaves[k], saved[k], H(ends)))
    return sorted(out, key=str)


def trie_rows(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], "conv_id long, turn int, role string, text string, depth int, id string, n_convs int, a string")
    got = T.prefix_trie(df, **options)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_trie_equals_plain_recursion(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 4)
    monkeypatch.setattr(T, "PIECE", 3)
    rng = random.Random(3)
    rows = [(c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["hi", "é😀", "", None, "same"])) for c in rng.sample(range(300), 60) for t in range(rng.randint(1, 9))]
    rows += [(500, t, "user", "same") for t in range(40)] + [(c, t, "user", "same") for c in (501, 502, 503, 504) for t in range(c - 480)]
    rows += rows[:7] + [(None, 0, "user", "lost"), (900, 0, "u", "z" * 50_000)]
    crc = lambda c: zlib.crc32(str(c).encode()) % 6
    options = {"base": F.col("conv_id") - F.col("conv_id") % 100, "kept": F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6}
    assert trie_rows(spark, rows, **options) == brute_trie(rows, lambda c: c - c % 100, crc)


def test_trie_of_plain_conversations_and_none(spark):
    rows = [(1, 0, "a", "x"), (1, 1, "b", "y"), (2, 0, "a", "x"), (3, 0, "a", "x"), (3, 1, "b", "y")]
    assert trie_rows(spark, rows) == brute_trie(rows, lambda c: c, lambda c: 0)
    assert trie_rows(spark, []) == []
