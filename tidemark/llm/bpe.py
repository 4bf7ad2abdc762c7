"""Byte-level BPE with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary answers for whole
pre-tokens that are tokens themselves.  Tier two, for the others: a heap of
mergeable neighbours over a linked list of bytes.  The ranks are all there is;
no tokenizer library takes part.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import id_text, ship
from .pretokens import PieceMemo, fingerprints, same_characters, split_ids


class PerfectHash:
    """A minimal perfect hash by hash and displace: n keys, n places, two numbers per bucket of about four keys.

    ``codes`` are the 64-bit hashes of the keys (XXH3 unless given); no two keys may have the same.
    """

    def __init__(self, keys: Sequence[bytes], codes: np.ndarray | None = None):
        self.n = n = len(keys)
        if codes is None:
            codes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        self.buckets = max(1, (n + 3) // 4)
        self.step = np.zeros(self.buckets, np.int64)
        self.shift = np.zeros(self.buckets, np.int64)
        self.key_at: list[bytes] = [b""] * n
        self.value_at = np.zeros(n, np.int64)
        if not n:
            return
        b, f, g = (x.tolist() for x in self._split(codes))
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for k, bucket in enumerate(b):
            members[bucket].append(k)
        free = bytearray(b"\x01" * n)
        place = 0
        for bucket in sorted(range(self.buckets), key=lambda i: -len(members[i])):
            own = members[bucket]
            if not own:
                break
            trial = 0
            while True:  # the first key goes to the next free place, the step decides on the others
                place = free.find(1, place + 1)
                if place < 0:
                    place = free.find(1)
                step = trial // 4
                shift = (place - f[own[0]] - step * g[own[0]]) % n
                spots = [(f[k] + step * g[k] + shift) % n for k in own]
                if len(set(spots)) == len(spots) and all(free[s] for s in spots):
                    break
                trial += 1
                if trial > 100 * n:
                    raise ValueError("two keys have the same hash")
            self.step[bucket], self.shift[bucket] = step, shift
            for s, k in zip(spots, own):
                free[s] = 0
                self.key_at[s], self.value_at[s] = keys[k], k

    def _split(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket, place and stride of each hash."""
        bucket = (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)) % np.uint64(self.buckets)
        first = (h >> np.uint64(32)) % np.uint64(self.n)
        stride = np.uint64(1) + (h & np.uint64(0xFFFFFFFF)) % np.uint64(max(1, self.n - 1))
        return bucket.astype(np.int64), first.astype(np.int64), stride.astype(np.int64)

    def places(self, h: np.ndarray) -> np.ndarray:
        """The one place where a key of each hash can be."""
        b, f, g = self._split(h)
        return (f + self.step[b] * g + self.shift[b]) % self.n

    def find(self, key: bytes) -> int | None:
        """The number of a key hashed by XXH3, or None for any other string."""
        if not self.n:
            return None
        s = int(self.places(np.array([xxhash.xxh3_64_intdigest(key)], np.uint64))[0])
        return int(self.value_at[s]) if self.key_at[s] == key else None


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge neighbours, the lowest rank first and the leftmost of equals, until none can be."""
    n = len(word)
    end = list(range(1, n + 1))  # of the part that begins here; 0 once it is merged away
    before = list(range(-1, n))
    get = ranks.get
    heap = []
    for i in range(n - 1):
        r = get(word[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            r = get(word[i : end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        h = before[i]
        if h >= 0:
            r = get(word[h:stop])
            if r is not None:
                heapq.heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _token_text(token: bytes) -> str:
    """A token as characters; one that isn't a text can be no pre-token and has none."""
    try:
        return token.decode("utf-8")
    except UnicodeDecodeError:
        return ""


class RankBpe:
    """Encoder and decoder of one rank file.

    Every pre-token of a batch is looked up in the perfect hash, and its characters compared.
    Those that are no token go to the heap, through a memo of what it has merged before.
    """

    def __init__(self, path: str, limit: int = 1 << 20):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        tokens = list(self.ranks)
        texts = [_token_text(t) for t in tokens]
        size = np.array([len(t) for t in texts], np.int64)
        self._chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        start, text = np.cumsum(size) - size, size > 0
        codes = np.array([0 if t else xxhash.xxh3_64_intdigest(raw) for t, raw in zip(texts, tokens)], np.uint64)
        codes[text] = fingerprints(self._chars, start[text], (start + size)[text])
        self._hash = PerfectHash(tokens, codes)
        token_at = self._hash.value_at
        self._id = np.array(list(self.ranks.values()), np.uint32)[token_at]
        self._size, self._start = size[token_at], start[token_at]
        self._memo = PieceMemo(self.encode_piece, limit)
        size = max(self.ranks.values(), default=-1) + 1
        self._bytes = [b""] * size
        for token, r in self.ranks.items():
            self._bytes[r] = token

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one pre-token: the token it is, or else its merged bytes."""
        raw = piece.encode("utf-8")
        own = self.ranks.get(raw)
        return merge_bytes(raw, self.ranks) if own is None else [own]

    def ids(self, text: str, points: np.ndarray, begin: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slices in a row, and how many each has."""
        if not self._hash.n:
            return self._memo.ids(text, points, begin, end, h)
        size = end - begin
        place = self._hash.places(h)
        hit = np.flatnonzero(self._size[place] == size)
        hit = hit[same_characters(points, begin[hit], size[hit], self._chars, self._start[place[hit]])]
        whole = np.zeros(len(h), bool)
        whole[hit] = True
        miss = np.flatnonzero(~whole)
        merged, own = self._memo.ids(text, points, begin[miss], end[miss], h[miss])
        length = np.ones(len(h), np.int64)
        length[miss] = own
        first = np.cumsum(length) - length
        out = np.empty(int(length.sum()), np.uint32)
        out[first[hit]] = self._id[place[hit]]
        out[np.repeat(first[miss] - (np.cumsum(own) - own), own) + np.arange(len(merged))] = merged
        return out, length

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text; null is the empty text."""
        return split_ids([t or "" for t in texts], self, drop_spaces=False)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids.tolist()))


_CODECS: dict[str, RankBpe] = {}


def codec(path: str) -> RankBpe:
    """The codec of a rank file, one per Python worker."""
    if path not in _CODECS:
        _CODECS[path] = RankBpe(path)
    return _CODECS[path]


def encode_documents(
    docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode whole texts by a rank file and decode the ids again, in one pass without a shuffle.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids`` also ids
    (little-endian unsigned 32-bit integers) and decoded (bytes).

    A null text is the empty text: no ids, the digests of nothing.  Each row is encoded by
    itself, also when ids repeat or are null.  A long text is split and looked up in parts of
    about 2**17 characters; only its ids are held whole.  An empty table gives an empty result.  Other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(rank_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                cols: list[list] = [[], [], [], [], []]
                for ids in c.encode(some.column(1).to_pylist()):
                    raw, text = ids.astype("<u4").tobytes(), c.decode(ids)
                    row = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest(), raw, text)
                    for col, value in zip(cols, row):
                        col.append(value)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary()]
                names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
                keep = 5 if with_ids else 3
                arrays = [some.column(0), *(pa.array(v, t) for v, t in zip(cols[:keep], kinds))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names[:keep]])

    ship(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded binary" * with_ids
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)
