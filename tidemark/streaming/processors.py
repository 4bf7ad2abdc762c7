"""Stateful processors of the streaming operators, and the folds they run.

Spark pickles them by value, so neither the driver's nor the executors' Python workers need
this package to be installed.  Nothing here refers to the rest of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FINAL, CORRECTION = "final", "correction"
BAR = ["open", "high", "low", "close", "volume", "n", "first_us", "last_us", "open_seq", "close_seq"]
BAR_TYPES = "open double, high double, low double, close double, volume double, n long, first_us long, last_us long, open_seq long, close_seq long"
VALUE, NULL = "_v_symbol", "_n_symbol"
ROW_COLUMNS = [VALUE, NULL, "level", "kind", "begin_us", *BAR, "mark_us"]
ROW_TYPES = f"{VALUE} string, {NULL} boolean, level int, kind string, begin_us long, {BAR_TYPES}, mark_us long"


class _Blob:
    """A pair of arrays (long, double) as one binary value of the state store."""

    def __init__(self, state):
        self.state = state

    def get(self) -> tuple[int, np.ndarray, np.ndarray]:
        if not self.state.exists():
            return 0, np.zeros(0, np.int64), np.zeros(0)
        seen, raw = self.state.get()
        half = len(raw) // 2
        return seen, np.frombuffer(raw, "<i8", half // 8), np.frombuffer(raw, "<f8", half // 8, half)

    def set(self, seen: int, order: np.ndarray, value: np.ndarray) -> None:
        self.state.update((int(seen), order.astype("<i8").tobytes() + value.astype("<f8").tobytes()))


def trailing_means(x: np.ndarray, n: int) -> np.ndarray:
    """The mean of each ``n`` neighbours without missing ones (None if all are), at a constant cost per element.

    A frame is the end of one block of n and the beginning of the next, so nothing is
    subtracted; frames with infinities or NaN are summed by themselves.
    """
    if len(x) < n:
        return np.zeros(0)
    m = len(x) - n + 1
    missing = np.isnan(x)
    plain = np.where(missing | np.isinf(x), 0.0, x)

    def sums(v: np.ndarray) -> np.ndarray:
        padded = np.zeros(-(-len(v) // n) * n, v.dtype)
        padded[: len(v)] = v
        blocks = padded.reshape(-1, n)
        ahead = np.cumsum(blocks, axis=1).ravel()
        back = np.cumsum(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        first = np.arange(m)
        return np.where(first % n == 0, back[:m], back[:m] + ahead[n - 1 : n - 1 + m])

    count = n - sums(missing.astype(np.int64))
    with np.errstate(invalid="ignore", divide="ignore"):
        out = sums(plain) / count
        for i in np.flatnonzero(sums(np.isinf(x).astype(np.int64)) > 0):
            out[i] = np.nanmean(x[i : i + n])
    return out


class StripeSma(StatefulProcessor):
    """Frames within one stripe; ``kind`` 0: done, 1: an early row that needs the stripes before, 2: a late row that the next one may need."""

    def __init__(self, n: int, keys: list[str], order: str, value: str, carry: list[str]):
        self.n, self.keys, self.order, self.value, self.carry = n, keys, order, value, carry

    def init(self, handle) -> None:
        self.state = _Blob(handle.getValueState("tail", "seen long, rows binary"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.n
        new = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        seen, order, value = self.state.get()
        order = np.concatenate([order, new[self.order].to_numpy(np.int64)])
        value = np.concatenate([value, new[self.value].to_numpy(np.float64)])
        old = len(value) - len(new)
        mean = np.full(len(value), np.nan)
        mean[n - 1 :] = trailing_means(value, n)
        place = np.arange(len(new)) + seen  # of the new rows in their stripe
        kind = np.where(place >= n - 1, 0, 1).astype(np.int32)
        late = np.arange(max(old, len(value) - (n - 1)), len(value))
        late = late[place[late - old] >= n - 1]
        keep = max(0, len(value) - (n - 1))
        self.state.set(seen + len(new), order[keep:], value[keep:])
        at = np.concatenate([np.arange(old, len(value)), late])
        out = {k: [key[i]] * len(at) for i, k in enumerate(self.keys)}
        slot = np.concatenate([np.where(kind == 0, key[-1], -1), np.full(len(late), -1)])
        kinds = np.concatenate([kind, np.full(len(late), 2, np.int32)])
        out |= {c: new[c].array[at - old] for c in self.carry}
        yield pd.DataFrame({**out, "slot": slot, "kind": kinds, self.order: order[at], self.value: value[at], "mean": mean[at]})

    def close(self) -> None:
        pass


class SeamSma(StatefulProcessor):
    """Early rows of stripes with the last rows of the stripes before; finished rows pass."""

    def __init__(self, n: int, keys: list[str], order: str, value: str, carry: list[str]):
        self.n, self.keys, self.order, self.value, self.carry = n, keys, order, value, carry

    def init(self, handle) -> None:
        self.state = _Blob(handle.getValueState("edge", "seen long, rows binary"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = [*self.keys, *self.carry, self.order, self.value, "mean"]
        if key[-1] >= 0:
            for batch in rows:
                yield batch.assign(**dict(zip(self.keys, key)))[columns]
            return
        n = self.n
        new = pd.concat(list(rows))
        _, order, value = self.state.get()
        order = np.concatenate([order, new[self.order].to_numpy(np.int64)])
        value = np.concatenate([value, new[self.value].to_numpy(np.float64)])
        early = np.concatenate([np.zeros(len(order) - len(new), bool), new["kind"].to_numpy() == 1])
        at = np.argsort(order, kind="stable")
        old = len(order) - len(new)
        order, value, early = order[at], value[at], early[at]
        mean = np.full(len(value), np.nan)
        mean[n - 1 :] = trailing_means(value, n)
        keep = max(0, len(value) - (n - 1))
        self.state.set(0, order[keep:], value[keep:])
        done = np.flatnonzero(early & (np.arange(len(value)) >= n - 1))
        if not len(done):
            return
        out = {k: [key[i]] * len(done) for i, k in enumerate(self.keys)}
        out |= {c: new[c].array[at[done] - old] for c in self.carry}
        yield pd.DataFrame({**out, self.order: order[done], self.value: value[done], "mean": mean[done]})

    def close(self) -> None:
        pass


def fold_sorted(group: np.ndarray, ts: np.ndarray, seq: np.ndarray, price: np.ndarray, amount: np.ndarray, tie_break: str | None) -> pd.DataFrame:
    """One bar per group of trades, as arrays; ties of time by ``seq`` as the rule says."""
    sign = {"prepend": -1, "append": 1, None: 0}[tie_break]
    at = np.lexsort((seq * sign, ts, group))
    group, ts, seq, price, amount = group[at], ts[at], seq[at], price[at], amount[at]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    last = np.append(first[1:], len(group)) - 1
    return pd.DataFrame({
        "run": group[first], "open": price[first], "high": np.maximum.reduceat(price, first), "low": np.minimum.reduceat(price, first),
        "close": price[last], "volume": np.add.reduceat(amount, first), "n": last - first + 1,
        "first_us": ts[first], "last_us": ts[last], "open_seq": seq[first], "close_seq": seq[last],
    })


class StripeRuns(StatefulProcessor):
    """Consecutive rows of one interval within a stripe, folded into partial bars."""

    def __init__(self, keys: list[str], tie_break: str | None):
        self.keys, self.tie_break = keys, tie_break

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", "runs long, begin_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("seq", kind="stable")
        runs, last = self.state.get() if self.state.exists() else (0, None)
        begin = new["begin_us"].to_numpy(np.int64)
        change = np.ones(len(begin), bool)
        change[1:] = begin[1:] != begin[:-1]
        change[0] = last is None or last != begin[0]
        run = runs + np.cumsum(change)
        self.state.update((int(run[-1]), int(begin[-1])))
        bars = fold_sorted(run, *(new[c].to_numpy() for c in ("ts_us", "seq", "price", "amount")), self.tie_break)
        bars["begin_us"] = begin[np.searchsorted(run, bars["run"].to_numpy())]
        for i, k in enumerate([*self.keys, "stripe"]):
            bars[k] = [key[i]] * len(bars)
        yield bars[[*self.keys, "stripe", "begin_us", "run", *BAR]]

    def close(self) -> None:
        pass


def merge_sorted(group: np.ndarray, bars: pd.DataFrame, tie_break: str | None) -> pd.DataFrame:
    """One bar per group of bars; opens and closes by time and, of equal times, by the tie rule."""
    sign = {"prepend": -1, "append": 1, None: 0}[tie_break]
    names = [c for c in BAR if c != "n"]
    col = {c: bars[c].to_numpy() for c in [*names, "n"]}
    by_open = np.lexsort((col["open_seq"] * sign, col["first_us"], group))
    by_close = np.lexsort((col["close_seq"] * sign, col["last_us"], group))
    own = group[by_open]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    last = np.append(first[1:], len(own)) - 1
    a, b = by_open[first], by_close[last]
    add = lambda f, c: f.reduceat(col[c][by_open], first)
    return pd.DataFrame({
        "group": own[first], "open": col["open"][a], "high": add(np.maximum, "high"), "low": add(np.minimum, "low"), "close": col["close"][b],
        "volume": add(np.add, "volume"), "n": add(np.add, "n"), "first_us": col["first_us"][a], "last_us": col["last_us"][b],
        "open_seq": col["open_seq"][a], "close_seq": col["close_seq"][b],
    })


def prefold(tie_break: str | None):
    """Partial bars of each Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            keys = [VALUE, NULL, "begin_us"]
            group = rows.groupby(keys, sort=False).ngroup().to_numpy()
            bars = fold_sorted(group, *(rows[c].to_numpy() for c in ("ts_us", "seq", "price", "amount")), tie_break)
            names = rows.iloc[np.unique(group, return_index=True)[1]][keys].reset_index(drop=True)
            out = pd.concat([names, bars[BAR]], axis=1)
            out["mark_us"] = out["last_us"]
            out["level"], out["kind"] = 0, ""
            yield out

    return run


class FinalBars(StatefulProcessor):
    """Open bars of a symbol; each is emitted once, when the mark has passed its end by the delay."""

    def __init__(self, level: int, length_us: int, delay_us: int, tie_break: str | None):
        self.level, self.length, self.delay, self.tie_break = level, length_us, delay_us, tie_break

    def init(self, handle) -> None:
        self.mark = handle.getValueState(f"mark_{self.level}", "us long")
        self.open = handle.getMapState(f"open_{self.level}", "begin_us long", BAR_TYPES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        if self.level:  # rows of the level below pass
            yield new.assign(**{VALUE: key[0], NULL: key[1]})[ROW_COLUMNS]
            new = new.assign(begin_us=new["up_us"])
        before = self.mark.get()[0] if self.mark.exists() else None
        bars = merge_sorted(new["begin_us"].to_numpy(np.int64), new, self.tie_break).rename(columns={"group": "begin_us"})
        mark = int(new["mark_us"].max()) if before is None else max(before, int(new["mark_us"].max()))
        self.mark.update((mark,))
        closed = self._closed(bars["begin_us"], before)
        held = [(b, *self.open.getValue((b,))) for b in bars["begin_us"][~closed].tolist() if self.open.containsKey((b,))]
        both = pd.concat([pd.DataFrame(held, columns=["begin_us", *BAR]), bars[~closed]]) if held else bars[~closed]
        if len(both):
            both = merge_sorted(both["begin_us"].to_numpy(np.int64), both, self.tie_break).rename(columns={"group": "begin_us"})
        done = self._closed(both["begin_us"], mark)
        for row in both[~done].itertuples(index=False):
            self.open.updateValue((int(row.begin_us),), tuple(v.item() if isinstance(v, np.generic) else v for v in row[1:]))
        for b in both["begin_us"][done].tolist():
            self.open.removeKey((b,))
        over = [(k[0], *v) for k, v in self.open.iterator() if k[0] + self.length + self.delay <= mark]
        for b, *_ in over:
            self.open.removeKey((b,))
        rest = pd.DataFrame(over, columns=["begin_us", *BAR]) if over else both[:0]
        for kind, part in ((CORRECTION, bars[closed]), (FINAL, both[done]), (FINAL, rest)):
            if len(part):
                yield part.assign(**{VALUE: key[0], NULL: key[1], "level": self.level, "kind": kind, "mark_us": mark})[ROW_COLUMNS]

    def _closed(self, begin: pd.Series, mark: int | None) -> np.ndarray:
        if mark is None:
            return np.zeros(len(begin), bool)
        return begin.to_numpy(np.int64) + self.length + self.delay <= mark

    def close(self) -> None:
        pass


GAP_COLUMNS = ["n", "n_gaps", "sum_us", "min_us", "max_us", "first_seq", "first_us", "last_seq", "last_us"]
GAP_TYPES = ", ".join(f"{c} long" for c in GAP_COLUMNS)


class StripeGaps(StatefulProcessor):
    """What a batch adds to the gaps of a stripe: the gap to the batch before is among them."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("seq", kind="stable")
        seq, ts = new["seq"].to_numpy(np.int64), new["ts_us"].to_numpy(np.int64)
        gaps = np.diff(ts, prepend=[self.state.get()[0]] if self.state.exists() else [])
        self.state.update((int(ts[-1]),))
        least, most = (int(gaps.min()), int(gaps.max())) if len(gaps) else (0, 0)
        row = [len(ts), len(gaps), int(gaps.sum()), least, most, int(seq[0]), int(ts[0]), int(seq[-1]), int(ts[-1])]
        yield pd.DataFrame([[*key, *row]], columns=[*self.keys, "stripe", *GAP_COLUMNS])

    def close(self) -> None:
        pass


CHUNK = 1 << 16  # characters of rows that travel as one
BUNDLE = 4  # 2**4 consecutive stripes of a key share a group and its state


def _packed(rows: list[str]) -> Iterator[tuple[int, int, str]]:
    """Rows (JSON, so without line feeds) as chunks of bounded size: where each starts, how many rows it has, its text."""
    if not rows:
        return
    label = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows))) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        yield a, b - a, "\n".join(rows[a:b])


def _unpacked(texts) -> list[str]:
    return "\n".join(texts).split("\n") if len(texts) else []


def pack_stripes(keys: list[str]):
    """Chunks of the rows that an Arrow batch has of a stripe, with their order values."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            group = batch.groupby(keys, sort=False).ngroup().to_numpy()
            at = np.argsort(group, kind="stable")
            order = batch["ord"].to_numpy(np.int64)[at].astype("<i8")
            rows = batch["row"].to_numpy()[at].tolist()
            cuts = [0, *(np.flatnonzero(np.diff(group[at])) + 1).tolist(), len(rows)]
            out = [(at[a], order[a + i : a + i + n].tobytes(), text) for a, b in zip(cuts, cuts[1:]) for i, n, text in _packed(rows[a:b])]
            first, ords, texts = zip(*out)
            yield batch.iloc[list(first)][keys].reset_index(drop=True).assign(ords=list(ords), rows=list(texts))

    return run


class CountStripe(StatefulProcessor):
    """Chunks of a stripe's rows in order with the place of their first one, and a message (slot -1) with how many rows it got."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle) -> None:
        self.state = handle.getValueState("seen", "newest long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = dict(zip(self.keys, key))
        slot = names.pop("bundle") % (1 << 62)  # never negative: -1 marks messages
        newest, total = self.state.get() if self.state.exists() else (None, 0)
        out = []
        for stripe, own in pd.concat(list(rows)).groupby("stripe"):
            order, texts = np.frombuffer(b"".join(own["ords"]), "<i8"), _unpacked(own["rows"])
            if (np.diff(order) < 0).any():
                texts = [texts[i] for i in np.argsort(order, kind="stable").tolist()]
            if newest is not None and stripe < newest:
                raise ValueError("a row came after rows of a later stripe")
            seen = total if stripe == newest else 0
            out += [(stripe, slot, seen + i, n, text) for i, n, text in _packed(texts)] + [(stripe, -1, 0, len(texts), None)]
            newest, total = int(stripe), seen + len(texts)
        self.state.update((newest, total))
        yield pd.DataFrame(out, columns=["stripe", "slot", "place", "n", "rows"]).assign(**names)

    def close(self) -> None:
        pass


class OffsetStripe(StatefulProcessor):
    """For each stripe that has got its first rows how many rows the stripes before it have; chunks pass."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle) -> None:
        self.total = handle.getValueState("total", "n long, newest long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = dict(zip(self.keys, key))
        columns = [k for k in self.keys if k != "slot"] + ["stripe", "place", "n", "rows"]
        if names["slot"] >= 0:
            for batch in rows:
                yield batch.assign(**{k: v for k, v in names.items() if k != "slot"})[columns]
            return
        total, newest = self.total.get() if self.total.exists() else (0, None)
        out = []
        for stripe, n in pd.concat(list(rows)).sort_values("stripe")[["stripe", "n"]].itertuples(index=False):
            if newest is None or stripe > newest:
                out.append((int(stripe), -1 - total))  # below zero: an offset and not a place
                newest = int(stripe)
            elif stripe < newest:
                raise ValueError("a row came after rows of a later stripe")
            total += int(n)
        self.total.update((total, newest))
        if out:
            frame = pd.DataFrame(out, columns=["stripe", "place"])
            yield frame.assign(n=0, rows=None, **{k: v for k, v in names.items() if k != "slot"})[columns]

    def close(self) -> None:
        pass


class PlaceStripe(StatefulProcessor):
    """Chunks of stripes with the position of their first row in the whole key, cut where blocks of positions end."""

    def __init__(self, keys: list[str], block: int):
        self.keys, self.block = keys, block

    def init(self, handle) -> None:
        self.state = handle.getValueState("offset", "newest long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        told = new.loc[new["place"] < 0, ["stripe", "place"]]
        offsets = dict([self.state.get()] if self.state.exists() else [])  # only the newest stripe can get more rows
        if len(told):
            offsets |= {int(stripe): int(-1 - place) for stripe, place in told.itertuples(index=False)}
            newest = max(offsets)
            self.state.update((newest, offsets[newest]))
        out = []
        for stripe, place, n, text in new.loc[new["place"] >= 0, ["stripe", "place", "n", "rows"]].itertuples(index=False):
            pos = first = offsets[stripe] + int(place)
            end = first + int(n)
            if pos // self.block == (end - 1) // self.block:
                out.append((pos // self.block, pos, text))
                continue
            texts = text.split("\n")
            while pos < end:
                cut = min(end, (pos // self.block + 1) * self.block)
                out.append((pos // self.block, pos, "\n".join(texts[pos - first : cut - first])))
                pos = cut
        if out:
            names = {k: v for k, v in zip(self.keys, key) if k != "bundle"}
            yield pd.DataFrame(out, columns=["block", "pos", "rows"]).assign(**names)

    def close(self) -> None:
        pass


class PairBlock(StatefulProcessor):
    """Rows of both sides at one position; the side that comes first waits.

    Positions of a side come without gaps, so only one side waits, from the first unpaired position on: as
    chunks, each written once and read when the other side has rows.  A block that is full has no state.
    """

    def __init__(self, keys: list[str], block: int):
        self.keys, self.block = keys, block

    def init(self, handle) -> None:
        self.state = handle.getValueState("at", "done long, side int, skip long, n long")
        self.waiting = handle.getListState("waiting", "rows string")

    def _wait(self, rows: list[str]) -> None:
        if rows:
            self.waiting.appendList([(text,) for _, _, text in _packed(rows)])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("pos")
        sides = [_unpacked(new.loc[new["side"] == side, "rows"]) for side in (0, 1)]
        names = dict(zip(self.keys, key))
        start = names.pop("block") * self.block
        done, ahead, skip, n = self.state.get() if self.state.exists() else (start, 0, 0, 0)  # skip: rows of the first chunks that are paired
        if n and not sides[1 - ahead]:
            self._wait(sides[ahead])
            self.state.update((done, ahead, skip, n + len(sides[ahead])))
            return
        if n:
            sides[ahead] = _unpacked([text for (text,) in self.waiting.get()])[skip:] + sides[ahead]
        paired = min(map(len, sides))
        if paired < n:
            rest, skip = sides[ahead][n:], skip + paired
            n += len(rest) - paired
        else:
            if n:
                self.waiting.clear()
            ahead = int(len(sides[1]) > len(sides[0]))
            rest, skip = sides[ahead][paired:], 0
            n = len(rest)
        self._wait(rest)
        if done + paired < start + self.block:
            self.state.update((done + paired, ahead, skip, n))
        else:
            self.state.clear()
        if paired:
            pos = np.arange(done + 1, done + paired + 1)
            yield pd.DataFrame({"pos": pos, "left": sides[0][:paired], "right": sides[1][:paired]}).assign(**names)

    def close(self) -> None:
        pass
