"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three characters; everything that is no letter
counts as a blank.  Document frequencies cover all documents one may learn from.  The
weights are trained by follow-the-regularised-leader (per-coordinate steps, L1 and L2
penalties) on a bounded sample per language, and a temperature fitted on a part of
that sample which training does not see calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import ship, stored
from .pretokens import LETTER, classes

UNKNOWN = "und"
_MIX = np.uint32(2654435761)


def grams(text: str, bits: int) -> np.ndarray:
    """Hashed n-grams (n = 1, 2, 3) of a text, in order, with repeats; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = classes()[points] == LETTER
    if not letter.any():
        return np.zeros(0, np.uint32)
    p = np.zeros(len(points) + 2, np.uint32)
    p[1:-1] = np.where(letter, points, 32)
    p[0] = p[-1] = 32
    p = p[np.append(True, (p[1:] != 32) | (p[:-1] != 32))]  # one blank between words
    h1 = (p + np.uint32(1)) * np.uint32(0x9E3779B1)
    h2 = (h1[:-1] ^ np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35) + h1[1:]
    h3 = (h2[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1) + h1[2:]
    h = np.concatenate([h1, h2, h3])
    h ^= h >> np.uint32(15)
    h *= _MIX
    return h >> np.uint32(32 - bits)


def counted(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text and the logarithmic frequency of each."""
    g = grams(text, bits)
    if len(g) > 1 << bits >> 3:
        c = np.bincount(g, minlength=1 << bits)
        at = np.flatnonzero(c)
        return at, np.log1p(c[at])
    at, c = np.unique(g, return_counts=True)
    return at.astype(np.int64), np.log1p(c)


@dataclass
class LanguageModel:
    """Languages in order, inverse document frequencies, weights, biases and the temperature."""

    languages: list[str]
    bits: int
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        x = tf * self.idf[at]
        norm = np.linalg.norm(x)
        return x / norm if norm else x

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability); a text that is null or has no letter is unknown, with 0."""
        at, tf = counted(text, self.bits) if text else (np.zeros(0, np.int64), None)
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        logits = self.features(at, tf) @ self.weights[at] + self.bias
        p = softmax(logits / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def best_temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(target):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(target)), target]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(
    model: LanguageModel,
    rows: Callable[[], Iterable[tuple[int, np.ndarray, np.ndarray]]],
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.5,
) -> LanguageModel:
    """Follow the regularised leader over (language, n-grams, frequencies), in the order given, once per epoch.

    ``rows`` gives them anew each time, so they need not be held at once.  Every fifth row is not
    learned from: the temperature is fitted on those (fewer than five rows have none).
    """
    size, k = len(model.idf), len(model.languages)
    z, n = np.zeros((size, k)), np.zeros((size, k))
    zb, nb = np.zeros(k), np.zeros(k)

    def weights(z: np.ndarray, n: np.ndarray, l1: float, l2: float) -> np.ndarray:
        step = (beta + np.sqrt(n)) / alpha + l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / step)

    for _ in range(epochs):
        for i, (y, at, tf) in enumerate(rows()):
            if i % 5 == 4:
                continue
            x = model.features(at, tf)
            za, na = z[at], n[at]
            w, b = weights(za, na, l1, l2), weights(zb, nb, 0.0, 0.0)
            wrong = softmax(x @ w + b)
            wrong[y] -= 1
            g = x[:, None] * wrong
            n2 = na + g * g
            z[at] = za + g - (np.sqrt(n2) - np.sqrt(na)) / alpha * w
            n[at] = n2
            m2 = nb + wrong * wrong
            zb += wrong - (np.sqrt(m2) - np.sqrt(nb)) / alpha * b
            nb = m2
    model.weights, model.bias = weights(z, n, l1, l2), weights(zb, nb, 0.0, 0.0)
    held = [(y, model.features(at, tf) @ model.weights[at] + model.bias) for i, (y, at, tf) in enumerate(rows()) if i % 5 == 4]
    if held:
        model.temperature = best_temperature(np.stack([x for _, x in held]), np.array([y for y, _ in held]))
    return model


def document_frequencies(texts: DataFrame, text_col: str, bits: int) -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram occurs, and how many texts there are.

    Each task sums its own texts and reports a row per n-gram; what reaches the driver is at
    most 2**bits rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros((1 << bits) + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                if text:
                    df[counted(text, bits)[0]] += 1
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["gram", "n"])

    ship(texts.sparkSession)
    rows = texts.select(text_col).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((1 << bits) + 1, np.int64)
    for r in rows:
        out[r["gram"]] = r["n"]
    return out[:-1], int(out[-1])


def fit(
    docs: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = 15,
    per_language: int = 1000,
    chunk_rows: int = 500,
    chunk_bytes: int = 1 << 26,
) -> LanguageModel:
    """Fit a model on the rows where ``may_learn`` holds.

    The weights come from at most ``per_language`` rows of every language, taken by the hash of id
    and text; document frequencies cover all rows one may learn from.  The n-grams of those rows are
    written and come to the driver ``chunk_rows`` at a time, in each epoch anew (all at once where
    they have at most ``chunk_bytes``; the model is the same); the model itself has 2**bits weights for each language.  A long text is counted whole, as one array of its
    n-grams.  Null languages are not learned; texts without a letter teach nothing.  Without any
    row to learn from the model knows no language.
    """
    spark = docs.sparkSession
    open_rows = docs.where(may_learn).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("hash")
    )
    known = open_rows.where("lang IS NOT NULL")
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    languages = sorted(r["lang"] for r in counts.select("lang").collect())  # as many as the model gets columns
    df, n_docs = document_frequencies(open_rows, "text", bits)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    model = LanguageModel(languages, bits, idf, np.zeros((1 << bits, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model
    # three times the wanted rows by a bound on the hash, of these the first by the hash
    spread = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    bounds = F.broadcast(counts)  # a row per language of the model, as many as the driver has just read
    wanted = known.join(bounds, "lang").where(spread < 3.0 * per_language / F.col("n")).select("lang", "hash", "text")
    first = Window.partitionBy("lang").orderBy("hash")
    chosen = wanted.withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language).select("lang", "hash", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tf = [], []
            for text in batch.column("text").to_pylist():
                a, t = counted(text or "", bits)
                at.append(a.astype("<i4").tobytes())
                tf.append(t.astype("<f4").tobytes())
            arrays = [batch.column("lang"), batch.column("hash"), pa.array(at, pa.binary()), pa.array(tf, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "hash", "at", "tf"])

    made = stored(chosen.mapInArrow(run, "lang string, hash long, at binary, tf binary").where("length(at) > 0"), "language-rows")
    size = made.agg(F.count("*").alias("n"), F.sum(F.length("at") + F.length("tf")).alias("bytes")).first()
    n_chunks = 1 if (size["bytes"] or 0) <= chunk_bytes else -(-size["n"] // chunk_rows)
    path = scratch_path(spark, "language-order")
    made.repartitionByRange(n_chunks, "hash", "lang").sortWithinPartitions("hash", "lang").write.parquet(path)
    files = sorted(spark.read.parquet(path).inputFiles(), key=lambda f: f.rsplit("/", 1)[-1])  # numbered in the order of the ranges
    number = {lang: k for k, lang in enumerate(languages)}
    held: list[list[tuple[int, np.ndarray, np.ndarray]]] = []

    def rows() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if held:
            yield from held[0]
            return
        for f in files:
            part = spark.read.schema(made.schema).parquet(f).collect()
            own = [(number[r["lang"]], np.frombuffer(r["at"], "<i4"), np.frombuffer(r["tf"], "<f4")) for r in sorted(part, key=lambda r: (r["hash"], r["lang"]))]
            if len(files) == 1:
                held.append(own)  # one chunk needs no second reading
            yield from own

    return train(model, rows)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The rows with the predicted language and its probability; only the text decides.

    Null texts and texts without a letter are ``und`` with 0.  A long text is one array of n-grams in
    its task.  Columns of the input that have
    the new names are replaced.
    """
    ship(docs.sparkSession)
    base = docs.drop(lang_col, score_col)
    kept = base.columns
    at = kept.index(text_col)
    model.weights = model.weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column(at).to_pylist()]
            new = [pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*kept, lang_col, score_col])

    schema = T.StructType([*base.schema.fields, T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    return base.mapInArrow(run, schema)
