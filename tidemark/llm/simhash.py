"""SimHash near-duplicates through an inverted index of positional bytes.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits differ in at most
that many of their 8 bytes, so they share at least ``8 - max_bits`` positional
bytes.  A single positional byte has only 256 values, far too few for a list to
stay short, so the index posts every distinct fingerprint under each combination
of that guaranteed number of positions with the bytes it has there.  Meeting in a list is
reaching the guaranteed count; the Hamming distance verifies the pair.

A list holds distinct fingerprints that agree everywhere but in ``max_bits`` bytes:
at most 2**(8 * max_bits) of them (65,536 for two bits) however many documents
there are.  Lists report a spanning forest of their links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text, ship, stored
from .components import components
from .vectors import numbered



def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text: words between ASCII white space, A-Z lower-cased,
    XXH64 of each word shingle; a bit is set if more than half of the shingles set it."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
    counts, n = np.zeros(64, np.int64), len(begins)
    stops = ends[shingle - 1 :].tolist()
    for at in range(0, n, 1 << 16):
        part = [digest(joined[a:b], seed) for a, b in zip(begins[at : at + (1 << 16)], stops[at : at + (1 << 16)])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", fp_col: str = "fp", shingle: int = 3, seed: int = 42) -> DataFrame:
    """The rows with the fingerprint of their text as a signed long; without words, or null, it is 0."""
    ship(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle, seed) for t in batch.column(at).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*names, fp_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(fp_col, T.LongType())]))


def list_links(fps: np.ndarray, max_bits: int, tile: int = 1024) -> list[tuple[int, int]]:
    """A spanning forest of the links within one list of distinct fingerprints."""
    n = len(fps)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in range(0, n, tile):
        for j in range(i, n, tile):
            xor = fps[i : i + tile, None] ^ fps[None, j : j + tile]
            x, y = np.nonzero(np.bitwise_count(xor) <= max_bits)
            x, y = x + i, y + j
            for p, q in zip(x[x < y].tolist(), y[x < y].tolist()):
                p, q = find(p), find(q)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    out.append((max(p, q), min(p, q)))
    return out


def _index_links(max_bits: int):
    """Links of each list; rows arrive sorted by list, which may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)

        def lists(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            new = np.ones(len(fp), bool)
            new[1:] = (key[1:] != key[:-1]).any(axis=1)
            edge = np.append(np.flatnonzero(new), len(fp))
            a, b = [], []
            for k in np.flatnonzero(np.diff(edge) > 1).tolist():
                own = fp[edge[k] : edge[k + 1]]
                for x, y in list_links(own.view(np.uint64), max_bits):
                    a.append(int(own[x]))
                    b.append(int(own[y]))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)], axis=1)
            key = np.concatenate([held_key, key])
            fp = np.concatenate([held_fp, batch.column(2).to_numpy(zero_copy_only=False)])
            changes = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
            done = int(changes[-1]) + 1 if len(changes) else 0
            if done:
                yield lists(key[:done], fp[:done])
            held_key, held_fp = key[done:], fp[done:]
        if len(held_fp):
            yield lists(held_key, held_fp)

    return run


def postings(fps: DataFrame, max_bits: int) -> DataFrame:
    """(positions, bytes, fp): a row for each combination of guaranteed positions."""

    def bytes_at(kept: tuple[int, ...]) -> Column:
        mask = sum(0xFF << 8 * p for p in kept)
        return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))

    combos = list(combinations(range(8), 8 - max_bits))
    rows = F.array(*[F.struct(F.lit(k).alias("positions"), bytes_at(c).alias("bytes")) for k, c in enumerate(combos)])
    return fps.select("fp", F.explode(rows).alias("p")).select("p.positions", "p.bytes", "fp")


def groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) for distinct fingerprints: those reachable from each other have the same root."""
    if not 0 <= max_bits < 8:
        raise ValueError("max_bits must be from 0 to 7")
    ship(fps.sparkSession)
    index = postings(fps, max_bits).repartition("positions", "bytes").sortWithinPartitions("positions", "bytes")
    roots = components(index.mapInArrow(_index_links(max_bits), "a long, b long"))
    joined = fps.join(roots, F.col("fp") == F.col("node"), "left")
    return stored(joined.select("fp", F.coalesce("root", "fp").alias("root")), "simhash-groups")


def near_duplicates(
    docs: DataFrame, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Rows whose fingerprints differ in at most ``max_bits`` bits (0 to 7) are linked; component_id
    is the smallest doc_id reachable over links, the row's own included.

    Texts without words (null, empty, blank) have fingerprint zero and are linked like any
    others.  Equal texts share a fingerprint and are handled as one.  A long text is hashed
    in parts of 2**16 shingles; its words are held whole in one task.  Rows that repeat an id
    are all returned.  Null ids are never a component_id, unless a component has no other.
    An empty table gives an empty result.  Other columns are ignored.
    """
    marked = stored(fingerprints(id_text(docs, id_col, text_col), shingle=shingle, seed=seed).select("doc_id", "fp"), "simhash")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = distinct.join(groups(distinct.select("fp"), max_bits), "fp")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = classes.join(least, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42
) -> DataFrame:
    """The rows of ``docs``, one of each group that :func:`near_duplicates` would link.

    The row with the smallest id stays (a null id only where there is no other), of several
    with that id one; all columns are kept as they are.
    """
    names = docs.columns
    free = "simhash"
    while any(c.lower().startswith(free) for c in names):
        free += "_"
    fp, row = f"{free}fp", f"{free}row"
    marked = numbered(fingerprints(docs, text_col, fp, shingle, seed), "simhash-rows", row)
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))).alias("first")
    distinct = marked.groupBy(F.col(fp).alias("fp")).agg(first)
    classes = distinct.join(groups(distinct.select("fp"), max_bits), "fp")
    keep = classes.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("kept"))
    return marked.join(keep, F.col(row) == F.col("kept"), "left_semi").select(*names)
