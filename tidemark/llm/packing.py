"""Best-fit packing by minimum bin slack.

Only the lengths of the pieces matter for packing, and there are at most
``capacity`` different ones.  Spark counts them, the driver plans bins over the
counts (a table of at most ``capacity`` rows whatever the corpus holds), and
Spark gives every piece its place by its rank among the pieces of its length.
No text and no piece is shuffled or gathered for the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_text, ship, stored
from .pretokens import encoder

Pattern = tuple[int, list[tuple[int, int]]]


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The lengths, with repeats counted, whose sum comes nearest to ``room`` from below.

    Subset sums as bits of one integer, an available length at a time, longest
    first; the search ends when the room can be filled exactly.
    """
    mask = (1 << (room + 1)) - 1
    reach, added = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            added.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    rest, taken = reach.bit_length() - 1, {}
    for length, before in reversed(added):
        if not before >> rest & 1:
            taken[length] = taken.get(length, 0) + 1
            rest -= length
    return list(taken.items())


def plan_bins(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Bins as (copies, [(length, how many)]).

    Each bin is led by the longest piece left and filled with the fullest feasible
    combination of the others; the same bin is taken as often as the counts allow,
    so every pattern uses up at least one length and there are at most ``capacity``.
    """
    left = {int(k): int(v) for k, v in counts.items() if v > 0}
    out: list[Pattern] = []
    while left:
        lead = max(left)
        others = dict(left)
        others[lead] -= 1
        if not others[lead]:
            del others[lead]
        uses = {lead: 1}
        for length, k in fullest(others, capacity - lead):
            uses[length] = uses.get(length, 0) + k
        copies = min(left[length] // k for length, k in uses.items())
        for length, k in uses.items():
            left[length] -= copies * k
            if not left[length]:
                del left[length]
        out.append((copies, sorted(uses.items(), reverse=True)))
    return out


def places(patterns: list[Pattern]) -> dict[int, tuple[list[int], list[tuple[int, int, int]]]]:
    """Per length: first ranks of its patterns, and (first sequence, pieces per bin, first offset) of each."""
    out: dict[int, tuple[list[int], list[tuple[int, int, int]]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for copies, uses in patterns:
        offset = 0
        for length, k in uses:
            ranks, rows = out.setdefault(length, ([], []))
            ranks.append(used.get(length, 0))
            rows.append((sequence, k, offset))
            used[length] = used.get(length, 0) + copies * k
            offset += k * length
        sequence += copies
    return out


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full ones after a first that may be shorter."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids")
                cols: dict[str, list] = {k: [] for k in names}
                for doc_id, ids in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        raw = ids[start : start + length].tobytes()
                        row = (doc_id, k, start, length, zlib.crc32(raw), part, int(seen[length]), raw)
                        seen[length] += 1
                        for name, value in zip(names, row):
                            cols[name].append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                n = len(names) if with_ids else len(names) - 1
                yield pa.RecordBatch.from_arrays([pa.array(cols[c], t) for c, t in zip(names[:n], kinds)], names=list(names[:n]))

    return run


def _assign(where: dict[int, tuple[list[int], list[tuple[int, int, int]]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                ranks, rows = where[length]
                k = bisect_right(ranks, rank) - 1
                first, per, at = rows[k]
                bin_, slot = divmod(rank - ranks[k], per)
                sequence.append(first + bin_)
                offset.append(at + slot * length)
            keep = [c for c in batch.schema.names if c != "rank"]
            arrays = [batch.column(c) for c in keep] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "sequence_id", "offset"])

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pack tokenised documents into sequences of at most ``capacity`` tokens.

    A document is its ids and then ``end_id``; only longer ones are cut.  Returns per
    piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with
    ``with_ids`` its ids as little-endian unsigned 32-bit integers.

    A null text is the empty text (one end id).  A long text is encoded in parts and cut into
    full pieces, so no row grows with it.  Each input row is a document of its own, also when ids repeat or are null.  An empty table gives an empty result.
    Other columns are ignored.
    """
    ship(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long" + ", ids binary" * with_ids
    pieces = stored(id_text(docs, id_col, text_col).mapInArrow(_pieces(tokenizer_path, capacity, end_id, with_ids), schema), "pack-pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth"))
    cols = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", *["ids"] * with_ids]
    out = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return ranked.select(*cols, "rank").mapInArrow(_assign(places(plan_bins(totals, capacity))), out + ", sequence_id long, offset long")
