"""Removal of repeated passages with suffix automata of reference shards.

A window is ``window`` consecutive words of one document; it is a repeat if a document
with a smaller id has it too.  Every word that a repeat covers goes.

1. Documents with the same words are one class; its smallest id stands for it, and all
   words of the others are repeats.
2. Every window names an anchor: the least hash among its word k-grams.  Equal windows
   name equal anchors, so only windows whose anchor is known from two documents can be
   repeats.  This drops nothing but windows that occur once.
3. Digests of those windows find, for each window that two documents have, its first
   document and the place there.  Windows at such places, in runs, are the reference; it
   is dealt to shards of bounded size by place.  Other occurrences are sent, in runs, to
   the shards that hold their first occurrence.
4. Each shard becomes a suffix automaton over its words, whose states know the smallest
   document they occur in.  It is sent to every task that streams runs of its shard.
   Matching statistics say how many of the last words occur in the shard; where the
   last ``window`` do, in a smaller document, the span is a repeat.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, ship, stored
from .pretokens import fingerprints

NEVER = (1 << 63) - 1
_HEAD = struct.Struct("<QQQ")
_BLOCK = 1 << 17


def split_words(text: str | None) -> bytes:
    """The words of a text (between ASCII white space) joined by single blanks."""
    return b" ".join((text or "").encode("utf-8").split())


def word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of joined words begins and ends."""
    if not joined:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return np.concatenate([[0], blank + 1]), np.append(blank, len(joined))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by running minima in blocks from both sides."""
    if width == 1 or not len(x):
        return x
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(joined: bytes, begin: np.ndarray, end: np.ndarray, window: int) -> np.ndarray:
    """For each window the least hash of its k-grams of a quarter of its words."""
    k = max(1, window // 4)
    n = len(begin) - k + 1
    if len(begin) < window:
        return np.zeros(0, np.uint64)
    points, parts, at = np.frombuffer(joined, np.uint8), [], 0
    while at < n:  # some 2**17 bytes at a time
        stop = max(at + 1, min(n, int(np.searchsorted(end, begin[at] + _BLOCK, "right")) - k + 1))
        first, last = begin[at], end[stop + k - 2]
        parts.append(fingerprints(points[first:last], begin[at:stop] - first, end[at + k - 1 : stop + k - 1] - first))
        at = stop
    return sliding_min(np.concatenate(parts), window - k + 1)


def _digest(joined: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", xxhash.xxh3_128_digest(joined))


def _summaries(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                cols: list[list] = [[] for _ in range(5)]
                for text in some.column(1):
                    joined = split_words(text.as_py())
                    begin, end = word_bounds(joined)
                    h1, h2 = _digest(joined)
                    row = (len(begin), h1, h2, hashlib.sha256(joined).hexdigest(), np.unique(anchors(joined, begin, end, window)).view(np.int64))
                    for col, value in zip(cols, row):
                        col.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
                names = ["doc_id", "n_words", "h1", "h2", "kept_sha256", "anchors"]
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined words and their digest."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            some = batch.slice(at, 1024)
            words = [split_words(t.as_py()) for t in some.column(1)]
            h = np.array([_digest(w) for w in words], np.int64).reshape(-1, 2)
            arrays = [some.column(0), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "h1", "h2", "words"])


def _windows(window: int):
    """Digests of the windows whose anchor two documents name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, words, often in zip(*(batch.column(k) for k in range(4))):
                joined = words.as_py()
                begin, end = word_bounds(joined)
                known = np.sort(np.array(often.as_py(), np.int64).view(np.uint64))
                least = anchors(joined, begin, end, window)
                hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, least), len(known) - 1)] == least)
                for at in range(0, len(hit), 1 << 14):
                    some = hit[at : at + (1 << 14)]
                    spans = zip(begin[some].tolist(), end[some + window - 1].tolist())
                    h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(joined[a:b]) for a, b in spans), "<i8").reshape(-1, 2)
                    ids = [np.full(len(some), x.as_py(), np.int64) for x in (row, doc)]
                    arrays = [*map(pa.array, ids), pa.array(some.astype(np.int32)), pa.array(h[:, 0]), pa.array(h[:, 1])]
                    yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "at", "w1", "w2"])

    return run


def _runs(window: int):
    """Runs of neighbouring windows for one shard, reference or not, with their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "ref", "row", "doc_id", "at", "n", "words"]
        kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            for row, doc, words, places, shards, refs in zip(*(batch.column(k) for k in range(6))):
                joined = words.as_py()
                begin, end = word_bounds(joined)
                at, shard, ref = (np.array(x.as_py()) for x in (places, shards, refs))
                order = np.lexsort((at, shard, ref))
                at, shard, ref = at[order], shard[order], ref[order]
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1] + 1) | (shard[1:] != shard[:-1]) | (ref[1:] != ref[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(at)) - 1
                cols: list[list] = [[] for _ in names]
                for i, j in zip(first.tolist(), last.tolist()):
                    a, b = int(at[i]), int(at[j]) + window
                    value = (int(shard[i]), bool(ref[i]), row.as_py(), doc.as_py(), a, b - a, joined[begin[a] : end[b - 1]])
                    for col, v in zip(cols, value):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return run


class SuffixAutomaton:
    """The suffix automaton of several word sequences; each state knows the smallest document it occurs in."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link, self.first = [0], [-1], [NEVER]
        self.word: dict[bytes, int] = {}

    def _state(self, edges: dict[int, int], length: int, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.first.append(NEVER)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for what ``p`` becomes by ``c``, apart from the longer strings of ``q``."""
        nexts, link = self.next, self.link
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(dict(nexts[q]), self.length[p] + 1, link[q])
        link[q] = clone
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = clone
            p = link[p]
        return clone

    def add(self, words: Sequence[bytes], doc_id: int) -> None:
        nexts, link, length, first = self.next, self.link, self.length, self.first
        at = 0
        for w in words:
            c = self.word.setdefault(w, len(self.word))
            q = nexts[at].get(c)
            if q is not None:
                at = self._split(at, c, q)
            else:
                new = self._state({}, length[at] + 1, 0)
                p = at
                while p >= 0 and c not in nexts[p]:
                    nexts[p][c] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, c, nexts[p][c])
                at = new
            if doc_id < first[at]:
                first[at] = doc_id

    def pack(self) -> bytes:
        """The automaton as arrays; what a state occurs in, its suffixes occur in as well."""
        length, link, first = (np.array(x, np.int64) for x in (self.length, self.link, self.first))
        least, up = first.tolist(), link.tolist()
        for s in np.argsort(-length, kind="stable").tolist():  # the longest first; the root has no link
            if up[s] >= 0 and least[s] < least[up[s]]:
                least[up[s]] = least[s]
        first = np.array(least, np.int64)
        edges = [(s << 32 | c, t) for s, own in enumerate(self.next) for c, t in own.items()]
        keys, to = np.array([k for k, _ in edges], np.int64), np.array([t for _, t in edges], np.int32)
        text = b"\n".join(self.word)
        head = _HEAD.pack(len(length), len(keys), len(text))
        return head + b"".join(x.tobytes() for x in (length.astype(np.int32), link.astype(np.int32), first, keys, to)) + text


class Matcher:
    """A packed automaton that texts are streamed through."""

    def __init__(self, payload: bytes):
        n, e, t = _HEAD.unpack_from(payload)
        at = _HEAD.size
        out = []
        for kind, size in (("<i4", n), ("<i4", n), ("<i8", n), ("<i8", e), ("<i4", e)):
            out.append(np.frombuffer(payload, kind, size, at).tolist())
            at += size * np.dtype(kind).itemsize
        self.length, self.link, self.first = out[:3]
        self.edge = dict(zip(out[3], out[4]))
        text = payload[at : at + t]
        self.word = {w: k for k, w in enumerate(text.split(b"\n"))} if t else {}

    def repeats(self, words: Sequence[bytes], doc_id: int, window: int) -> list[tuple[int, int]]:
        """Maximal spans of words covered by windows that a smaller document has."""
        edge, link, length, first, out = self.edge, self.link, self.length, self.first, []
        state = size = 0  # the matching statistic, up to the window
        for i, w in enumerate(words, 1):
            c = self.word.get(w)
            if c is None:
                state = size = 0
                continue
            to = edge.get(state << 32 | c)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = edge.get(state << 32 | c)
            if to is None:
                continue
            state, size = to, size + 1
            if size >= window:
                size = window
                while length[link[state]] >= window:
                    state = link[state]
                if first[state] < doc_id:
                    if out and out[-1][1] >= i - window:
                        out[-1] = (out[-1][0], i)
                    else:
                        out.append((i - window, i))
        return out


def _automata(shard_words: int):
    """Automata of the shards; rows arrive sorted by shard, and one that is too large comes in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own, n = None, SuffixAutomaton(), 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([own.pack()], pa.binary())], names=["shard", "automaton"])

        for batch in batches:
            for shard, doc, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if n and (shard != held or n >= shard_words):
                    yield packed()
                    own, n = SuffixAutomaton(), 0
                held = shard
                sequence = words.as_py().split(b" ")
                own.add(sequence, doc)
                n += len(sequence)
        if n:
            yield packed()

    return run


def _stream(window: int):
    """Runs of one shard and salt against its automata."""

    def run(key, texts: pa.Table, automata: pa.Table) -> pa.Table:
        rows, begins, ends = [], [], []
        for payload in automata.column("automaton"):
            m = Matcher(payload.as_buffer().to_pybytes())
            for row, doc, at, words in zip(*(texts.column(c).to_pylist() for c in ("row", "doc_id", "at", "words"))):
                for a, b in m.repeats(words.split(b" "), doc, window):
                    rows.append(row)
                    begins.append(at + a)
                    ends.append(at + b)
        kinds = [pa.int64(), pa.int32(), pa.int32()]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip((rows, begins, ends), kinds)], names=["row", "begin", "end"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of documents without their spans."""
    for batch in batches:
        out: list[list] = [[], [], []]
        for words, found in zip(batch.column("words"), batch.column("found").to_pylist()):
            own = words.as_py().split(b" ")
            spans: list[list[int]] = []
            for x in sorted((f["begin"], f["end"]) for f in found):
                if spans and x[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], x[1])
                else:
                    spans.append([*x])
            at, rest = 0, []
            for a, b in spans:
                rest += own[at:a]
                at = b
            text = b" ".join(rest + own[at:])
            for col, value in zip(out, (hashlib.sha256(text).hexdigest(), [{"begin": a, "end": b} for a, b in spans], text.decode("utf-8"))):
                col.append(value)
        span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        arrays = [batch.column("h1"), batch.column("h2"), *(pa.array(c, t) for c, t in zip(out, (pa.string(), span, pa.string())))]
        yield pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "own_sha256", "own_spans", "own_text"])


def repeated_passages(
    docs: DataFrame,
    window: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_windows: int = 1 << 13,
    with_text: bool = False,
) -> DataFrame:
    """What repeats in every row: doc_id, n_words, n_removed, spans, kept_sha256, and with ``with_text`` kept.

    Words lie between ASCII white space.  ``spans`` are the maximal runs of removed words, as
    struct(begin, end) of word numbers, end exclusive; ``kept`` are the other words joined by
    blanks.  A word goes if a window of ``window`` words covers it that also starts in a document
    with a smaller id; all windows are judged on the input.

    A null text has no words; texts of fewer words than a window keep all.  Rows with one id don't
    make each other repeats, equal rows have equal results.  A null id is neither smaller nor
    larger than another: such rows keep everything and remove nothing elsewhere.  A long text is
    hashed in blocks and its runs go to many shards, but its words are held whole in one task.  An
    empty table gives an empty result.  Other columns are ignored.
    """
    if window < 1:
        raise ValueError("window must be positive")
    spark = docs.sparkSession
    ship(spark)
    rows = id_text(docs, id_col, text_col)
    kinds = "doc_id long, n_words long, h1 long, h2 long, kept_sha256 string, anchors array<long>"
    every = stored(rows.mapInArrow(_summaries(window), kinds), "passage-summaries")
    able = every.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    classes = able.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.first("anchors").alias("anchors"))
    classes = stored(classes, "passage-classes")

    named = classes.select("h1", "h2", "least", F.explode("anchors").alias("anchor"))
    shared = named.groupBy("anchor").agg(F.min("least").alias("a"), F.max("least").alias("b")).where("a < b").select("anchor")
    marked = named.join(shared, "anchor").groupBy("h1", "h2", "least").agg(F.collect_list("anchor").alias("often"))
    texts = rows.where(F.col("doc_id").isNotNull()).mapInArrow(_words, "doc_id long, h1 long, h2 long, words binary")
    mine = texts.join(marked.withColumnRenamed("least", "doc_id"), ["h1", "h2", "doc_id"])
    one = mine.groupBy("h1", "h2", "doc_id").agg(F.first("words").alias("words"), F.first("often").alias("often"))
    found = stored(one.withColumn("row", F.monotonically_increasing_id()), "passage-candidates")

    windows = found.select("row", "doc_id", "words", "often").mapInArrow(_windows(window), "row long, doc_id long, at int, w1 long, w2 long")
    place = F.xxhash64("row", F.floor(F.col("at") / shard_windows))
    firsts = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.min_by(place, "doc_id").alias("place"))
    firsts = stored(firsts.where("least < most").drop("most"), "passage-firsts")
    n_shards = max(1, -(-firsts.count() // shard_windows))
    shard = F.pmod("place", F.lit(n_shards)).cast("int")
    at = windows.join(firsts, ["w1", "w2"]).withColumn("ref", F.col("doc_id") == F.col("least"))
    at = at.where(~F.col("ref") | (F.col("place") == place)).select("row", "at", shard.alias("shard"), "ref")
    lists = at.groupBy("row").agg(*(F.collect_list(c).alias(n) for c, n in (("at", "places"), ("shard", "shards"), ("ref", "refs"))))
    runs = found.select("row", "doc_id", "words").join(lists, "row").select("row", "doc_id", "words", "places", "shards", "refs")
    schema = "shard int, ref boolean, row long, doc_id long, at int, n int, words binary"
    runs = stored(runs.mapInArrow(_runs(window), schema), "passage-runs")

    refs = runs.where("ref").select("shard", "doc_id", "words").repartition("shard").sortWithinPartitions("shard")
    automata = stored(refs.mapInArrow(_automata(4 * shard_windows), "shard int, automaton binary"), "passage-automata")
    # a shard that many runs ask for is streamed by several tasks
    salts = runs.where("NOT ref").groupBy("shard").agg(F.ceil(F.sum("n") / (32 * shard_windows)).cast("int").alias("salts"))
    streamed = runs.where("NOT ref").join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("row", "at"), "salts").cast("int"))
    sent = automata.join(salts, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    grouped = streamed.select("shard", "salt", "row", "doc_id", "at", "words").groupBy("shard", "salt")
    spans = grouped.cogroup(sent.select("shard", "salt", "automaton").groupBy("shard", "salt")).applyInArrow(_stream(window), "row long, begin int, end int")
    spans = stored(spans, "passage-spans").groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("found"))
    schema = "h1 long, h2 long, own_sha256 string, own_spans array<struct<begin:int,end:int>>, own_text string"
    own = stored(found.select("row", "h1", "h2", "words").join(spans, "row").mapInArrow(_kept, schema), "passage-own")

    long = able.drop("anchors").join(classes.drop("anchors"), ["h1", "h2"]).join(own, ["h1", "h2"], "left")
    return _assembled(every, long, rows if with_text else None, window)


def _assembled(every: DataFrame, long: DataFrame, texts: DataFrame | None, window: int) -> DataFrame:
    """Result rows: short rows and rows without an id as they are, copies without words, the rest by their spans."""
    span = "array<struct<begin:int,end:int>>"
    copy = F.col("doc_id") > F.col("least")
    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("n_words").cast("int").alias("end")))
    none = F.lit(None).cast(span)
    empty = hashlib.sha256(b"").hexdigest()
    spans = F.when(copy, whole).otherwise(F.coalesce("own_spans", F.array().cast(span)))
    text: Column = F.when(copy, F.lit("")).otherwise(F.col("own_text"))
    sha = F.when(copy, F.lit(empty)).otherwise(F.coalesce("own_sha256", "kept_sha256"))
    judged = long.select("doc_id", "n_words", spans.alias("spans"), sha.alias("kept_sha256"), text.alias("kept"), "h1", "h2")
    plain = every.where((F.col("n_words") < window) | F.col("doc_id").isNull())
    plain = plain.select("doc_id", "n_words", F.coalesce(none, F.array().cast(span)).alias("spans"), "kept_sha256", F.lit(None).cast("string").alias("kept"), "h1", "h2")
    out = judged.unionByName(plain)
    removed = F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.begin)").alias("n_removed")
    cols = ["doc_id", "n_words", removed, "spans", "kept_sha256"]
    if texts is None:
        return out.select(*cols)
    words = texts.mapInArrow(_words, "doc_id long, h1 long, h2 long, words binary").groupBy("h1", "h2").agg(F.first("words").alias("words"))
    return out.join(words, ["h1", "h2"]).select(*cols, F.coalesce("kept", F.decode("words", "utf-8")).alias("kept"))


#: DuckDB SQL for the rows of the registered query, over all windows of all documents.
PASSAGES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT row, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS k FROM d WHERE doc_id IS NOT NULL),
s AS (SELECT row, doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS h FROM x),
f AS (SELECT h, min(doc_id) AS least FROM s GROUP BY h),
hit AS (SELECT s.row, s.k FROM s JOIN f USING (h) WHERE f.least < s.doc_id),
gone AS (SELECT DISTINCT row, k + j AS pos FROM hit, generate_series(0, 49) AS g(j)),
words AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM words ANTI JOIN gone USING (row, pos) GROUP BY row)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""
