"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

Words, numbers and signs are hashed to a fixed number of word slots.  A slot's index
vector has a few entries of +1 and -1 that its number decides; its word vector is the
sum of the index vectors of all neighbours it has in the whole corpus.  A document is
the mean and the spread of its word vectors and how alike neighbours are.  The network (numpy: one hidden layer,
one output) is trained on a bounded sample of labelled documents; a temperature fitted
on a part of it that training does not see calibrates the score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .langid import best_temperature
from .pretokens import boundaries, fingerprints, slices

SLOT_BITS = 14
WIDTH = 32
SIGNS = 2  # entries of each sign in an index vector
WINDOW = 2
INPUTS = 2 * WIDTH + WINDOW


def index_entries() -> tuple[np.ndarray, np.ndarray]:
    """Positions of the +1 and of the -1 entries of each slot's index vector."""
    draw = np.random.default_rng(20).random((1 << SLOT_BITS, WIDTH)).argsort(axis=1)[:, : 2 * SIGNS]
    return draw[:, :SIGNS].astype(np.int64), draw[:, SIGNS:].astype(np.int64)


def slots(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text numbers, word slots), word by word in order, for groups of whole or cut-up texts."""
    for group in slices([t or "" for t in texts]):
        points = np.frombuffer("".join(part for _, part in group).encode("utf-32-le"), "<u4")
        if not len(points):
            continue
        sizes = np.array([len(part) for _, part in group])
        starts = np.cumsum(sizes) - sizes
        begin, end = boundaries(points, starts, drop_spaces=True)
        slot = (fingerprints(points, begin, end) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        filled = sizes > 0
        owner = np.array([k for k, _ in group])[filled][np.searchsorted(starts[filled], begin, "right") - 1]
        yield owner, slot


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The word vectors of all slots, each of length one, from the neighbours in all documents.

    Each task sums its own documents and reports a row per slot it met; Spark adds these up.
    The result has 2**SLOT_BITS rows whatever the corpus holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plus, minus = index_entries()
        size = (1 << SLOT_BITS) * WIDTH
        total = np.zeros(size, np.int64)
        for batch in batches:
            for owner, slot in slots(batch.column(0).to_pylist()):
                up, down = [], []
                for gap in range(1, WINDOW + 1):
                    near = owner[gap:] == owner[:-gap]
                    a, b = slot[:-gap][near], slot[gap:][near]
                    for word, other in ((a, b), (b, a)):
                        up.append((word[:, None] * WIDTH + plus[other]).ravel())
                        down.append((word[:, None] * WIDTH + minus[other]).ravel())
                total += np.bincount(np.concatenate(up), minlength=size)
                total -= np.bincount(np.concatenate(down), minlength=size)
        table = total.reshape(-1, WIDTH)
        met = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), *(pa.array(table[met, d]) for d in range(WIDTH))], names=["slot", *dims])

    ship(docs.sparkSession)
    dims = [f"d{d}" for d in range(WIDTH)]
    schema = "slot int, " + ", ".join(f"{d} long" for d in dims)
    sums = docs.select(F.col(text_col).cast("string")).mapInArrow(run, schema).groupBy("slot").agg(*[F.sum(d).alias(d) for d in dims])
    out = np.zeros((1 << SLOT_BITS, WIDTH))
    for r in sums.collect():
        out[r[0]] = r[1:]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(texts: Sequence[str | None], vectors: np.ndarray) -> np.ndarray:
    """Per text the mean and the spread of its word vectors, and the mean product of
    vectors one and two words apart; zeros without words."""
    n = np.zeros(len(texts))
    alike = np.zeros((len(texts), WINDOW))
    first, second = np.zeros((len(texts), WIDTH)), np.zeros((len(texts), WIDTH))
    for owner, slot in slots(texts):
        if not len(owner):
            continue
        at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        who = owner[at]
        v = vectors[slot]
        n[who] += np.diff(np.append(at, len(owner)))
        first[who] += np.add.reduceat(v, at, axis=0, dtype=np.float64)
        second[who] += np.add.reduceat(v * v, at, axis=0, dtype=np.float64)
        for gap in range(1, WINDOW + 1):
            near = np.flatnonzero(owner[gap:] == owner[:-gap])
            product = np.einsum("ij,ij->i", v[near], v[near + gap])
            alike[:, gap - 1] += np.bincount(owner[near], product, len(texts))
    n = np.maximum(n, 1)[:, None]
    mean = first / n
    return np.concatenate([mean, np.sqrt(np.maximum(second / n - mean * mean, 0)), alike / n], axis=1)


@dataclass
class QualityModel:
    """Word vectors, scaling of the inputs, the two layers and the temperature."""

    vectors: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.shift) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        """The calibrated probability of label 1 of each text."""
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled(texts, self.vectors)) / self.temperature, -60, 60)))


def train(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4) -> QualityModel:
    """Train by Adam on cross entropy; every fifth row only calibrates. No rows: a score of one half everywhere."""
    rng = np.random.default_rng(11)
    shift = x.mean(axis=0) if len(x) else np.zeros(INPUTS)
    scale = x.std(axis=0) + 1e-6 if len(x) else np.ones(INPUTS)
    layers = [rng.normal(0, INPUTS**-0.5, (INPUTS, hidden)), np.zeros(hidden), np.zeros(hidden), np.zeros(())]
    model = QualityModel(vectors, shift, scale, layers)
    if not len(x):
        return model
    held = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.zeros(len(x), bool)
    a, b = (x[~held] - shift) / scale, y[~held].astype(float)
    moment, square, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(a))
        for at in range(0, len(a), 256):
            i = order[at : at + 256]
            w1, b1, w2, b2 = layers
            h = np.tanh(a[i] @ w1 + b1)
            wrong = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -60, 60))) - b[i]) / len(i)
            back = wrong[:, None] * w2 * (1 - h * h)
            slopes = [a[i].T @ back + decay * w1, back.sum(axis=0), h.T @ wrong + decay * w2, wrong.sum()]
            step += 1
            for k, g in enumerate(slopes):
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                layers[k] = layers[k] - rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    model.layers = layers
    if held.any():
        z = model.logits(x[held])
        model.temperature = best_temperature(np.stack([np.zeros_like(z), z], axis=1), y[held].astype(int))
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = 20_000,
) -> QualityModel:
    """Word vectors from all documents; the network from at most ``max_rows`` labelled ones.

    Labels are taken only where ``may_learn`` (a condition on the id) holds, in the order of the
    hash of the id; other labels than 0 and 1, null ones and null ids are not learned.  A document
    with several labels counts once, by the largest.
    """
    vectors = word_vectors(docs, text_col)
    known = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col(id_col).isNotNull())
    known = known.where(may_learn).groupBy(id_col).agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    texts = docs.select(id_col, F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), id_col)  # max_rows short rows
    order = F.xxhash64(id_col, "text").alias("hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column("text").to_pylist(), vectors).astype("<f4")
            arrays = [batch.column("hash"), batch.column("label"), pa.array([row.tobytes() for row in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["hash", "label", "x"])

    found = texts.select(order, "label", "text").mapInArrow(run, "hash long, label int, x binary").orderBy("hash").limit(max_rows).collect()
    x = np.array([np.frombuffer(r["x"], "<f4") for r in found], np.float64).reshape(len(found), INPUTS)
    return train(vectors, x, np.array([r["label"] for r in found]))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The rows with the score of their text (null: empty); an input column of that name is replaced."""
    ship(docs.sparkSession)
    base = docs.drop(score_col)
    names = base.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(model.score(batch.column(at).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, score_col])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(score_col, T.DoubleType())]))
