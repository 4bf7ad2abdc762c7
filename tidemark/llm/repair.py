"""Token ids on disk, compressed by Re-Pair grammars.

A shard holds the ids of whole documents.  Frequent neighbours are replaced by
new symbols until no pair of neighbours is left that occurs ``least`` times; the
rules and the expansion length of each are stored, so any token range of any
document can be decoded without the rest.  No rule spans two documents.

Each round takes many rules at once.  Its pairs never compete for a symbol: a
symbol is either first or second in the pairs of a round, or it is the repeated
symbol of one pair (x, x), which takes every other place of a run.  So all
replacements of a round are independent and the frequencies they were chosen by
are exact (but for runs).  Symbols are a linked list: a round looks only at places
whose pair was frequent in the round before or has a new symbol, since no other
pair can have become frequent.

Shard bytes, little-endian:
  magic ``RPT1``; uint32 base (first rule symbol), rules, bytes per symbol;
  uint64 documents, symbols;
  int64 document ids; uint8 flags (1: the id is null); uint64 token counts;
  uint64 symbol counts; uint32 left and right of each rule; uint32 expansion
  lengths; symbols (2 bytes each if they fit, else 4).
Shards are rows of a Parquet table (part, shard, first_doc, last_doc, n_docs,
n_tokens, start_in_part, payload), in ascending document order by (part, shard).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import dropped, id_text, ship
from .pretokens import encoder

MAGIC = b"RPT1"
HEAD = struct.Struct("<4sIIIQQ")
_BINS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _choose(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent pairs of which none competes with a more frequent one, the most frequent first."""
    order = np.lexsort((pairs, -counts))
    first, second, twice, out = set(), set(), set(), []
    for k, code in zip(order.tolist(), pairs[order].tolist()):
        x, y = code >> 32, code & 0xFFFFFFFF
        if x in twice or y in twice or x in second or y in first:
            continue
        if x == y:
            if x in first or y in second:
                continue
            twice.add(x)
        else:
            first.add(x)
            second.add(y)
        out.append(k)
    return np.array(out, np.int64)


def _slots(code: np.ndarray) -> np.ndarray:
    return (code * _SPREAD >> np.uint64(64 - _BINS)).astype(np.int32)


def compress(seq: np.ndarray, last: np.ndarray, base: int, least: int = 16):
    """Replace frequent neighbours. ``last`` marks the last token of each document.

    Returns symbols, their ``last`` marks, and left, right and expansion length of each rule.
    """
    n, n_rules = len(seq), 0
    seq, last = seq.astype(np.uint32), last.copy()
    follow, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    alive = np.ones(n, bool)
    left, right, lengths = [], [], np.zeros(0, np.uint32)
    place = np.full(1 << _BINS, -1, np.int32)  # by slot: a frequent pair of this round
    at = np.flatnonzero(~last)
    while len(at) >= least:
        code = seq[at].astype(np.uint64) << np.uint64(32) | seq[follow[at]]
        slot = _slots(code)
        if len(at) > 1 << 17:  # pairs that share a slot are counted together here, so none is missed
            often = (np.bincount(slot, minlength=1 << _BINS) >= least)[slot]
            at, code, slot = at[often], code[often], slot[often]
        pairs, counts = np.unique(code, return_counts=True)
        pairs, counts = pairs[counts >= least], counts[counts >= least]
        if not len(pairs):
            break
        chosen = _choose(pairs, counts)
        spot = _slots(pairs)
        place[spot] = np.arange(len(pairs))
        place[spot[chosen[::-1]]] = chosen[::-1]  # of chosen pairs that share a slot the more frequent one stays
        chosen = chosen[place[spot[chosen]] == chosen]
        rule_of = np.full(len(pairs), -1, np.int64)
        rule_of[chosen] = np.arange(len(chosen))
        own = place[slot]
        place[spot] = -1
        hit = own >= 0
        at, code, own = at[hit], code[hit], own[hit]
        rule = np.where(pairs[own] == code, rule_of[own], -1)
        hit = rule >= 0
        twin = hit & (code >> np.uint64(32) == code & np.uint64(0xFFFFFFFF))
        if twin.any():  # in a run of one symbol every other place
            run = np.flatnonzero(twin)
            begins = np.ones(len(run), bool)
            begins[1:] = before[at[run[1:]]] != at[run[:-1]]
            k = np.arange(len(run))
            hit[run[(k - np.maximum.accumulate(np.where(begins, k, 0))) % 2 == 1]] = False
        p = at[hit]
        q = follow[p]
        seq[p] = (base + n_rules + rule[hit]).astype(np.uint32)
        last[p] = last[q]
        alive[q] = False
        after = follow[q]
        follow[p] = after
        inside = after < n
        before[after[inside]] = p[inside]
        again = np.zeros(n, bool)
        again[at[~hit]] = again[p] = True
        again[before[p[before[p] >= 0]]] = True
        at = np.flatnonzero(again & alive & ~last)
        a, b = (pairs[chosen] >> np.uint64(32)).astype(np.uint32), (pairs[chosen] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        lengths = np.concatenate([lengths, expansion(a, lengths, base) + expansion(b, lengths, base)])
        left.append(a)
        right.append(b)
        n_rules += len(chosen)
    none = np.zeros(0, np.uint32)
    return seq[alive], last[alive], np.concatenate([none, *left]), np.concatenate([none, *right]), lengths


def expansion(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """How many tokens each symbol stands for."""
    out = np.ones(len(symbols), np.uint32)
    is_rule = symbols >= base
    out[is_rule] = lengths[symbols[is_rule] - base]
    return out


def expand(seq: np.ndarray, base: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All rules undone, a level at a time."""
    while True:
        is_rule = seq >= base
        if not is_rule.any():
            return seq
        out = np.repeat(seq, 1 + is_rule)
        at = np.flatnonzero(is_rule)
        place = at + np.arange(len(at))
        rule = seq[at] - base
        out[place], out[place + 1] = left[rule], right[rule]
        seq = out


def pack_shard(doc_ids: Sequence[int | None], docs: Sequence[np.ndarray], base: int) -> bytes:
    """The bytes of a shard of non-empty documents."""
    n_tokens = np.array([len(d) for d in docs], np.uint64)
    seq = np.concatenate(docs).astype(np.uint32)
    last = np.zeros(len(seq), bool)
    ends = np.cumsum(n_tokens.astype(np.int64)) - 1
    last[ends] = True
    seq, last, left, right, lengths = compress(seq, last, base)
    n_symbols = np.diff(np.flatnonzero(last), prepend=-1).astype(np.uint64)
    width = 2 if base + len(left) <= 1 << 16 else 4
    ids = np.array([0 if d is None else d for d in doc_ids], np.int64)
    null = np.array([d is None for d in doc_ids], np.uint8)
    head = HEAD.pack(MAGIC, base, len(left), width, len(docs), len(seq))
    parts = [ids, null, n_tokens, n_symbols, left, right, lengths, seq.astype(f"<u{width}")]
    return head + b"".join(np.ascontiguousarray(p).astype(p.dtype.newbyteorder("<")).tobytes() for p in parts)


class Shard:
    """A shard read back."""

    def __init__(self, payload: bytes):
        magic, self.base, n_rules, width, n_docs, n_symbols = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a Re-Pair shard")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.ids, self.null = take("<i8", n_docs), take("u1", n_docs)
        self.n_tokens, self.n_symbols = take("<u8", n_docs).astype(np.int64), take("<u8", n_docs).astype(np.int64)
        self.left, self.right, self.lengths = take("<u4", n_rules), take("<u4", n_rules), take("<u4", n_rules)
        self.symbols = take(f"<u{width}", n_symbols)
        self.first_symbol = np.cumsum(self.n_symbols) - self.n_symbols

    def tokens(self) -> np.ndarray:
        """All tokens of the shard."""
        return expand(self.symbols.astype(np.uint32), self.base, self.left, self.right)

    def document(self, k: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Tokens [begin, end) of the k-th document; only the symbols they need are expanded."""
        end = int(self.n_tokens[k]) if end is None else min(end, int(self.n_tokens[k]))
        if begin >= end:
            return np.zeros(0, np.uint32)
        own = self.symbols[self.first_symbol[k] : self.first_symbol[k] + self.n_symbols[k]].astype(np.uint32)
        until = np.cumsum(expansion(own, self.lengths, self.base).astype(np.int64))
        i, j = np.searchsorted(until, begin, "right"), np.searchsorted(until, end, "left") + 1
        skip = begin - (int(until[i - 1]) if i else 0)
        return expand(own[i:j], self.base, self.left, self.right)[skip : skip + end - begin]


def _encoded(tokenizer_path: str, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [np.append(x, np.uint32(end_id)).astype(kind).tobytes() for x in enc.encode(some.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def _shards(kind: str, base: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, total = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        docs: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, total, size
            known = [d for d in ids if d is not None]
            row = {
                "part": part, "shard": shard, "first_doc": min(known, default=None), "last_doc": max(known, default=None),
                "n_docs": len(ids), "n_tokens": size, "start_in_part": total, "payload": pack_shard(ids, docs, base),
            }
            shard, total, size = shard + 1, total + size, 0
            ids.clear()
            docs.clear()
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = np.frombuffer(raw.as_buffer(), kind)
                ids.append(doc_id)
                docs.append(tokens.copy())  # a view would keep its whole batch
                size += len(tokens)
                if size >= shard_tokens:
                    yield flush()
        if ids:
            yield flush()

    return run


SHARD_SCHEMA = "part int, shard int, first_doc long, last_doc long, n_docs long, n_tokens long, start_in_part long, payload binary"


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = 1 << 20,
) -> None:
    """Encode whole texts, append ``end_id`` to each and write Re-Pair shards in ascending id order.

    Tokens are made once, before any shuffle, and written to the shared folder, in 16 bits each where
    the vocabulary allows it; one range shuffle of ids and tokens puts the documents in order.  A null
    text is the empty text, rows with one id stay apart, null ids come first, an empty table gives a
    table without shards.  Other columns are ignored.  A task holds one shard: ``shard_tokens``
    tokens and its last document, so a long text makes a shard as long as its tokens.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    base = Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)
    base = max(base, end_id + 1)
    kind = "<u2" if base <= 1 << 16 else "<u4"
    ship(spark)
    scratch = scratch_path(spark, "repair-tokens")
    id_text(docs, id_col, text_col).mapInArrow(_encoded(tokenizer_path, end_id, kind), "doc_id long, ids binary").write.parquet(scratch)
    order = [F.col("doc_id"), F.xxhash64("ids")]
    rows = spark.read.schema("doc_id long, ids binary").parquet(scratch).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(_shards(kind, base, shard_tokens), SHARD_SCHEMA).write.parquet(path)
    dropped(spark, scratch)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of Re-Pair shards: doc_id, start, n_tokens, ids_crc32, and ids unless told otherwise.

    ``start`` counts the tokens of all documents before.  A task expands one shard at a time.  The parts' totals that this
    takes are one row per file of the table, so their one-task window and their
    broadcast stay small whatever the shards hold.
    """
    ship(spark)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = shards.join(F.broadcast(bases), "part").select((F.col("base") + F.col("start_in_part")).alias("start"), "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = Shard(payload.as_buffer())
                raw = memoryview(s.tokens().astype("<u4").tobytes())
                ends = np.cumsum(s.n_tokens)
                begins = ends - s.n_tokens
                own = [raw[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
                cols = {
                    "doc_id": pa.array(s.ids, mask=s.null.astype(bool)),
                    "start": pa.array(begins + start),
                    "n_tokens": pa.array(s.n_tokens),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64()),
                }
                if with_ids:
                    cols["ids"] = pa.array([bytes(x) for x in own], pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
