"""Language ID and the quality classifier: awkward rows, held-out accuracy, hand-checked parts."""

import math
import random

import numpy as np
from edge import LONG, TEXTS, documents
from pyspark.sql import functions as F

from tidemark.llm import langid, quality
from tidemark.llm.common import fold

SF = "/root/testdata/sf0.01"


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_fold_is_crc32_of_the_id(spark):
    import zlib

    rows = spark.range(200).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
    assert spark.createDataFrame([(None,)], "id long").select(fold("id", 5)).first()[0] == 0


def test_language_on_held_out_documents(spark):
    docs = docs_of(spark)
    model = langid.fit(docs, fold("doc_id", 4) != 2, per_language=150)
    assert model.languages == ["de", "en", "es", "fr"]
    assert 0 < (model.weights != 0).mean() < 0.9  # the L1 penalty leaves weights at zero
    out = langid.identify(docs.where(fold("doc_id", 4) == 2), model).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_awkward_rows(spark):
    model = langid.fit(docs_of(spark), fold("doc_id", 4) != 2, per_language=40)
    df = documents(spark)
    got = langid.identify(df, model)
    assert got.columns == [c for c in df.columns if c != "score"] + ["lang_pred", "score"]
    rows = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in got.collect()}
    assert len(got.collect()) == len(TEXTS)
    for t in (None, "", "   \n\t  "):
        assert all(v == ("und", 0.0) for (_, u), v in rows.items() if u == t)
    assert rows[(4, LONG)][0] in model.languages
    assert langid.identify(documents(spark, []), model).count() == 0
    assert model.predict("12 34 !?") == ("und", 0.0)
    none = langid.fit(documents(spark, []), F.lit(True))
    assert none.languages == [] and none.predict("some text") == ("und", 0.0)


def test_grams_by_hand():
    one = langid.grams("Ab, c", 15)
    assert len(one) == len(langid.grams("ab c", 15)) == 6 + 5 + 4  # " ab c " gives 6, 5 and 4
    assert one.tolist() == langid.grams("AB...C", 15).tolist()
    at, tf = langid.counted("aaaa", 15)
    assert np.isclose(np.expm1(tf).sum(), 6 + 5 + 4)
    big = "xyz abc " * 3000
    at2, tf2 = langid.counted(big, 15)
    ref, count = np.unique(langid.grams(big, 15), return_counts=True)
    assert at2.tolist() == ref.tolist() and np.allclose(tf2, np.log1p(count))


def test_document_frequencies_count_every_text_once(spark):
    texts = [(t,) for t in ["ab ab ab", "ab", "cd", None, "", "1"]]
    df, n = langid.document_frequencies(spark.createDataFrame(texts, "t string").repartition(3), "t", 15)
    assert n == 6 and df[langid.grams("ab", 15)].max() >= 2
    assert df.sum() == sum(len(langid.counted(t, 15)[0]) for (t,) in texts if t)


def test_leader_equals_a_plain_coordinate_loop():
    rng = np.random.default_rng(5)
    k, size, alpha, beta, l1, l2 = 3, 40, 0.5, 1.0, 0.02, 0.5
    rows = []
    for _ in range(60):
        at = np.sort(rng.choice(size, rng.integers(1, 9), replace=False))
        rows.append((int(rng.integers(k)), at, rng.random(len(at)).astype("f4")))
    idf = 1 + rng.random(size)
    model = langid.train(langid.LanguageModel(list("abc"), 15, idf, np.zeros((size, k)), np.zeros(k)), lambda: iter(rows), 2, alpha, beta, l1, l2)
    z, n = [[0.0] * k for _ in range(size + 1)], [[0.0] * k for _ in range(size + 1)]  # the last row: the biases

    def weight(i, c):
        a, b = (l1, l2) if i < size else (0.0, 0.0)
        if abs(z[i][c]) <= a:
            return 0.0
        return -(z[i][c] - math.copysign(a, z[i][c])) / ((beta + math.sqrt(n[i][c])) / alpha + b)

    for _ in range(2):
        for r, (y, at, tf) in enumerate(rows):
            if r % 5 == 4:
                continue
            x = {int(i): float(t) * idf[i] for i, t in zip(at, tf)}
            norm = math.sqrt(sum(v * v for v in x.values()))
            x = {i: v / norm for i, v in x.items()} | {size: 1.0}
            w = {i: [weight(i, c) for c in range(k)] for i in x}
            e = [math.exp(sum(x[i] * w[i][c] for i in x)) for c in range(k)]
            for i, v in x.items():
                for c in range(k):
                    g = v * (e[c] / sum(e) - (c == y))
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / alpha * w[i][c]
                    n[i][c] += g * g
    want = np.array([[weight(i, c) for c in range(k)] for i in range(size + 1)])
    assert np.allclose(model.weights, want[:-1], atol=1e-5) and np.allclose(model.bias, want[-1], atol=1e-5)
    assert (model.weights == 0).any() and model.temperature > 0


def test_three_hundred_languages_in_chunks_or_at_once(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:03}": ["".join(rng.choices(letters, k=6)) for _ in range(4)] for k in range(300)}
    rows = [(i, " ".join(rng.choices(words[f"l{i % 300:03}"], k=12)), f"l{i % 300:03}") for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True))
    assert model.languages == sorted(words)
    right = [r.lang == r.lang_pred for r in langid.identify(docs, model).collect()]
    assert sum(right) > 0.97 * len(right)
    chunks = langid.fit(docs, F.lit(True), chunk_rows=700, chunk_bytes=0)
    assert np.allclose(chunks.weights, model.weights, atol=1e-6) and chunks.temperature == model.temperature


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(1)
    target = rng.integers(0, 3, 500)
    logits = 9.0 * (np.eye(3)[target] + rng.normal(size=(500, 3)))
    t = langid.best_temperature(logits, target)
    loss = lambda t: -np.log(langid.softmax(logits / t)[np.arange(500), target]).mean()
    assert t > 1 and loss(t) <= min(loss(1.0), loss(0.5 * t), loss(2 * t)) and langid.best_temperature(logits[:0], target[:0]) == 1.0


def test_quality_on_held_out_documents(spark):
    docs, labels = docs_of(spark), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels, fold("doc_id", 5) != 0)
    got = quality.score(docs.where(fold("doc_id", 5) == 0), model).join(labels, "doc_id").select("quality", "score").collect()
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_quality_of_awkward_rows(spark):
    docs = docs_of(spark)
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold("doc_id", 5) != 0, max_rows=60)
    df = documents(spark)
    rows = quality.score(df, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if not (r.text or "").strip()}
    assert len(blank) == 1  # null, empty and blank texts score alike
    assert quality.score(documents(spark, []), model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    empty = quality.fit(df, labels, F.lit(True))
    assert set(empty.score(["x", None, LONG]).tolist()) == {0.5}


def test_word_vectors_by_hand(spark):
    texts = [(t,) for t in ["aa bb cc", "bb aa", None, "", "dd"]]
    got = quality.word_vectors(spark.createDataFrame(texts, "text string").repartition(3))
    plus, minus = quality.index_entries()
    slot = {w: int(next(quality.slots([w]))[1][0]) for w in ("aa", "bb", "cc", "dd")}
    index = lambda w: np.bincount(plus[slot[w]], minlength=quality.WIDTH) - np.bincount(minus[slot[w]], minlength=quality.WIDTH)
    want = 2 * index("bb") + index("cc")  # the neighbours of aa
    assert np.allclose(got[slot["aa"]], want / np.linalg.norm(want), atol=1e-6)
    assert not got[slot["dd"]].any()


def test_pooling_by_hand():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1 << quality.SLOT_BITS, quality.WIDTH)).astype("f4")
    texts = ["one two three two", None, "", "four", " ".join(random.Random(3).choices(["x", "y", "z"], k=300_000))]
    got = quality.pooled(texts, vectors)
    for text, row in zip(texts, got):
        parts = [s for _, s in quality.slots([text])]
        v = vectors[np.concatenate(parts)].astype(float) if parts else np.zeros((0, quality.WIDTH))
        n = max(1, len(v))
        alike = [(v[:-g] * v[g:]).sum() / n if len(v) > g else 0 for g in (1, 2)]
        want = np.concatenate([v.mean(axis=0), v.std(axis=0), alike]) if len(v) else np.zeros(quality.INPUTS)
        assert np.allclose(row, want, atol=1e-3)
