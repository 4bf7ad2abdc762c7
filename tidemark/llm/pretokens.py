"""Pre-tokens of whole batches at once, and memoised encoding on top of them.

A byte-pair encoder never merges across the boundaries its split pattern sets,
so the ids of a text are the ids of its pre-tokens, one after the other.  The
boundaries of a batch are found with array operations on its code points, every
pre-token gets a 64-bit fingerprint, and only pre-tokens not met before go to the
encoder proper, one call each.  A fingerprint only finds an entry; its characters
are compared before its ids are used.  The memo is bounded: when it is full it
starts again, which costs time and never changes a result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Where every split pattern cuts: a blank between words, a digit after an ASCII letter, a CJK comma or stop after an ideograph.
_LONG_CUT = re.compile("(?<=\\w) (?=\\w)|(?<=[A-Za-z])(?=[0-9])|(?<=[\u4e00-\u9fff])(?=[\u3001\u3002\uff0c])")
#: Longer pre-tokens are not memoised.
LONGEST = 64
_CLASSES: list[np.ndarray] = []
_NEWER: list[np.ndarray] = []
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or other."""
    if not _CLASSES:
        import regex

        table = np.full(0x110000, OTHER, np.uint8)
        patterns = [(LETTER, regex.compile(r"\p{L}+")), (NUMBER, regex.compile(r"\p{N}+")), (SPACE, regex.compile(r"\s+"))]
        for first in range(0, 0x110000, 0x1000):  # a plane's part at a time keeps the strings small
            chars = "".join(chr(c) for c in range(first, first + 0x1000) if not 0xD800 <= c < 0xE000)
            for kind, pattern in patterns:
                for m in pattern.finditer(chars):
                    table[np.frombuffer(m[0].encode("utf-32-le"), "<u4")] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def newer_characters() -> np.ndarray:
    """Marks letters, numbers and blanks of Unicode versions that this Python, and so maybe a split pattern's engine, doesn't know."""
    if not _NEWER:
        table = classes() != OTHER
        for p in np.flatnonzero(table).tolist():
            table[p] = unicodedata.category(chr(p)) == "Cn"
        _NEWER.append(table)
    return _NEWER[0]


def boundaries(points: np.ndarray, starts: np.ndarray, drop_spaces: bool) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every pre-token in the joined texts ``points``.

    ``starts`` holds where each text begins.  With ``drop_spaces`` white space
    belongs to no pre-token and every number stands alone; otherwise a single
    blank belongs to the run after it and other white space stands by itself, its
    last character apart when something follows.  The seven English contractions
    after an apostrophe are pre-tokens of their own.
    """
    n = len(points)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)  # the first character of a text; n closes the last
    first[starts[starts < n]] = True
    first[n] = True
    cut = first.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    if drop_spaces:
        cut[:n] |= kind == NUMBER
    apostrophe = np.flatnonzero((points == 39) & cut[:n] & cut[1:])
    space = kind == SPACE
    if not drop_spaces:
        last = space.copy()  # last white-space character with more of the text after it
        last[:-1] &= ~space[1:]
        last &= ~first[1:]
        at = np.flatnonzero(last)
        cut[at] = True
        blank = at[points[at] == 32]
        cut[blank + 1] = False
        if len(apostrophe):
            led = (apostrophe > 0) & ~first[apostrophe] & (points[np.maximum(apostrophe - 1, 0)] == 32)
            apostrophe = apostrophe[~led]
        # an apostrophe after a blank has lost its cut above
    if len(apostrophe):
        low = lambda i: np.where(i < n, points[np.minimum(i, n - 1)], 0)
        same = apostrophe + 1 < n
        same &= ~first[np.minimum(apostrophe + 1, n)]
        a, b = low(apostrophe + 1), low(apostrophe + 2)
        if drop_spaces:  # such vocabularies lower-case first
            a, b = (np.where((x >= 65) & (x <= 90), x + 32, x) for x in (a, b))
        inside = ~first[np.minimum(apostrophe + 2, n)]
        one = same & np.isin(a, [ord(c) for c in "stmd"])
        two = same & ~one & inside & np.isin(a * 256 + np.minimum(b, 255), [ord(x) * 256 + ord(y) for x, y in ("re", "ve", "ll")])
        for mask, size in ((one, 2), (two, 3)):
            at = apostrophe[mask]
            cut[at + 1] = False
            cut[at + size] = True
    edge = np.flatnonzero(cut)
    begin, end = edge[:-1], edge[1:]
    if drop_spaces:
        keep = ~space[begin]
        begin, end = begin[keep], end[keep]
    return begin, end


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64; those for ordinary sizes are kept."""
    if not _POWERS or n > len(_POWERS[0][0]):
        size, out = max(n, 1 << 17), []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if n > 1 << 17:
            return out[0], out[1]
        _POWERS.append((out[0], out[1]))
    return _POWERS[0]


def fingerprints(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each slice; never zero."""
    power, inverse = _powers(len(points) + 1)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], out=total[1:])
    h = (total[end] - total[begin]) * inverse[begin]
    h ^= (end - begin).astype(np.uint64) << np.uint64(52)
    h *= _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    h[h == 0] = 1
    return h


def same_characters(points: np.ndarray, begin: np.ndarray, size: np.ndarray, chars: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each slice of ``points`` equals the slice of ``chars`` of the same size."""
    until = np.cumsum(size)
    same = np.ones(len(size), bool)
    if len(size):
        run = np.arange(until[-1])
        if begin[-1] + size[-1] - begin[0] == until[-1]:  # neighbours without gaps
            left = points[begin[0] : begin[0] + until[-1]]
        else:
            left = points[np.repeat(begin - (until - size), size) + run]
        wrong = np.flatnonzero(left != chars[np.repeat(start - (until - size), size) + run])
        same[np.searchsorted(until, wrong, "right")] = False
    return same


class PieceMemo:
    """From pre-tokens to ids: an open hash table over arrays, bounded in size.

    Pre-tokens of more than ``LONGEST`` characters, and those whose fingerprint another one
    has taken, are encoded by themselves, once per call.
    """

    def __init__(self, make: Callable[[str], Sequence[int]], limit: int = 1 << 20):
        self._make = make
        self._limit = limit
        self._reset()

    def _reset(self) -> None:
        bits = max(4, (2 * self._limit - 1).bit_length())
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._keys = np.zeros(1 << bits, np.uint64)
        self._entry = np.zeros(1 << bits, np.int32)
        self._start, self._length = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self._char_start, self._size = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self._pool, self._chars = np.zeros(4096, np.uint32), np.zeros(4096, np.uint32)
        self._used = self._chars_used = self._count = 0

    def _probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The table position of each fingerprint, or of the free place where it belongs; whether it is there."""
        at = (h >> self._shift).astype(np.int64)
        found = self._keys[at]
        there = found == h
        open_ = np.flatnonzero(~there & (found != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self._mask
            found = self._keys[at[open_]]
            hit = found == h[open_]
            there[open_[hit]] = True
            open_ = open_[~hit & (found != 0)]
        return at, there

    def _add(self, text: str, points: np.ndarray, begin: np.ndarray, size: np.ndarray, h: np.ndarray) -> None:
        """Enters slices whose fingerprints are new and differ from each other."""
        make = self._make
        made = [make(text[b : b + n]) for b, n in zip(begin.tolist(), size.tolist())]
        length = np.fromiter(map(len, made), np.int64, len(made))
        ids = np.fromiter((i for own in made for i in own), np.uint32, int(length.sum()))
        first = np.cumsum(size) - size
        chars = points[np.repeat(begin - first, size) + np.arange(int(size.sum()))]
        left = np.arange(len(h))
        while len(left):  # of those that want one free place the first gets it
            at, _ = self._probe(h[left])
            place, won = np.unique(at, return_index=True)
            self._keys[place], self._entry[place] = h[left[won]], self._count + left[won]
            left = np.delete(left, won)
        k, total = self._count, self._count + len(h)
        for name, used, new in (
            ("_start", k, self._used + np.cumsum(length) - length), ("_length", k, length),
            ("_char_start", k, self._chars_used + first), ("_size", k, size),
            ("_pool", self._used, ids), ("_chars", self._chars_used, chars),
        ):
            if used + len(new) > len(getattr(self, name)):
                setattr(self, name, np.resize(getattr(self, name), 3 * (used + len(new)) // 2))
            getattr(self, name)[used : used + len(new)] = new
        self._used, self._chars_used, self._count = self._used + len(ids), self._chars_used + len(chars), total

    def ids(self, text: str, points: np.ndarray, begin: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slices in a row, and how many each has. ``points`` are the characters of ``text``."""
        size = end - begin
        short = size <= LONGEST
        at, there = self._probe(h)
        new = _firsts(h, short & ~there)
        if self._count and self._count + len(new) > self._limit:
            self._reset()
            new = _firsts(h, short)
        if len(new):
            new = new[: self._limit]
            self._add(text, points, begin[new], size[new], h[new])
            at, there = self._probe(h)
        entry = self._entry[at]
        hit = np.flatnonzero(there & short & (self._size[entry] == size))
        hit = hit[same_characters(points, begin[hit], size[hit], self._chars, self._char_start[entry[hit]].astype(np.int64))]
        known = np.zeros(len(h), bool)
        known[hit] = True
        length, start = np.where(known, self._length[entry], 0).astype(np.int64), np.where(known, self._start[entry], 0).astype(np.int64)
        rest, made = np.flatnonzero(~known).tolist(), {}
        for k in rest:
            piece = text[begin[k] : end[k]]
            if piece not in made:
                made[piece] = np.array(self._make(piece), np.uint32)
            length[k] = len(made[piece])
        until = np.cumsum(length)
        source = np.repeat(start - (until - length), length) + np.arange(until[-1] if len(until) else 0)
        out = self._pool.take(source, mode="clip")
        for k in rest:
            out[until[k] - length[k] : until[k]] = made[text[begin[k] : end[k]]]
        return out, length


def _firsts(h: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where each distinct fingerprint among the marked ones comes first."""
    at = np.flatnonzero(among)
    return at[np.sort(np.unique(h[at], return_index=True)[1])]


def slices(texts: Sequence[str], limit: int = 1 << 17) -> Iterator[list[tuple[int, str]]]:
    """Texts in order as groups of about ``limit`` characters; longer texts come in
    parts, cut where every split pattern cuts.  A text without such a place stays whole."""
    group, size = [], 0
    for k, text in enumerate(texts):
        at = 0
        while len(text) - at > limit:
            m = _LONG_CUT.search(text, at + limit // 2)
            if not m:
                break
            if group:
                yield group
                group, size = [], 0
            yield [(k, text[at : m.start()])]
            at = m.start()
        part = text[at:] if at else text
        if group and size + len(part) > limit:
            yield group
            group, size = [], 0
        group.append((k, part))
        size += len(part)
    if group:
        yield group


def split_ids(texts: Sequence[str], memo: PieceMemo, drop_spaces: bool) -> list[np.ndarray]:
    """The ids of each text through the memo."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for group in slices(texts):
        joined = "".join(part for _, part in group)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        sizes = np.array([len(part) for _, part in group])
        starts = np.cumsum(sizes) - sizes
        if not len(points):
            continue
        begin, end = boundaries(points, starts, drop_spaces)
        ids, length = memo.ids(joined, points, begin, end, fingerprints(points, begin, end))
        bounds = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(begin, np.append(starts, len(points)))]
        for (k, _), a, b in zip(group, bounds[:-1].tolist(), bounds[1:].tolist()):
            if b > a:
                out[k].append(ids[a:b])
    empty = np.zeros(0, np.uint32)
    return [x[0] if len(x) == 1 else np.concatenate(x) if x else empty for x in out]


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that
    are printable keep their character, the others take 256, 257, ... in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(keep)]
    return {**{b: chr(b) for b in keep}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class MemoEncoder:
    """Texts to ids with a byte-level BPE file of the ``tokenizers`` library.

    The library's normalizer and model encode each distinct pre-token.  Files
    with another split than the two known ones, and texts that are not in the
    file's normal form, are encoded by one library call on the whole text.
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, limit: int = 1 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        split = self.tokenizer.pre_tokenizer
        pre = json.loads(split.__getstate__()) if split else {}
        normal = self.tokenizer.normalizer
        steps = pre.get("pretokenizers", [pre])
        self.known, self.drop_spaces, self._normalize = False, False, None
        if len(steps) == 1 and steps[0].get("type") == "ByteLevel":
            self.known = not normal and steps[0].get("use_regex", True) and not steps[0].get("add_prefix_space", True)
        elif [s.get("type") for s in steps] == ["Split", "ByteLevel"] and normal:
            self.known = self.drop_spaces = bool(steps[0].get("invert")) and steps[0].get("behavior") == "Removed"
            self._normalize = normal.normalize_str
        self._letters = byte_letters()
        self._tokenize = self.tokenizer.model.tokenize
        self._memo = PieceMemo(self._piece, limit)

    def _piece(self, piece: str) -> list[int]:
        if self._normalize:
            piece = self._normalize(piece)
        return [t.id for t in self._tokenize(piece.encode("utf-8").decode("latin-1").translate(self._letters))]

    def whole(self, text: str) -> np.ndarray:
        """The ids by one call of the library on the whole text."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _plain(self, text: str) -> bool:
        """Whether normalising and splitting piece by piece surely equals doing so to the text."""
        if text.isascii():
            return True
        if "İ" in text or not unicodedata.is_normalized("NFC", text):
            return False
        return not newer_characters()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any()

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text; null is the empty text."""
        texts = [t or "" for t in texts]
        if not self.known:
            return [self.whole(t) for t in texts]
        odd = [k for k, t in enumerate(texts) if not self._plain(t)] if self._normalize else []
        wholes = {k: self.whole(texts[k]) for k in odd}
        out = split_ids(["" if k in wholes else t for k, t in enumerate(texts)], self._memo, self.drop_spaces)
        for k, ids in wholes.items():
            out[k] = ids
        return out


_ENCODERS: dict[str, MemoEncoder] = {}


def encoder(path: str) -> MemoEncoder:
    """The encoder of a file, one per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = MemoEncoder(path)
    return _ENCODERS[path]
