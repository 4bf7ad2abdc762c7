"""Plain-Python references used by the tests (brute force, one element at a time)."""

from __future__ import annotations

import os

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def fold(trades, rule="prepend"):
    """The reference fold of (ts, price, amount) in arrival order -> bar dict (or None)."""
    bar = None
    for ts, price, amount in trades:
        if bar is None:
            bar = dict(open=price, high=price, low=price, close=price, volume=amount, n=1, first=ts, last=ts)
            continue
        hi, lo = max(bar["high"], price), min(bar["low"], price)
        if rule == "prepend":
            if ts <= bar["first"]:
                bar.update(open=price, first=ts)
            elif ts > bar["last"]:
                bar.update(close=price, last=ts)
        else:
            if ts < bar["first"]:
                bar.update(open=price, first=ts)
            elif ts >= bar["last"]:
                bar.update(close=price, last=ts)
        bar.update(high=hi, low=lo, volume=bar["volume"] + amount, n=bar["n"] + 1)
    return bar


def runs(keys):
    """Consecutive-run ids (1-based) of a sequence of interval keys."""
    out, rid, prev = [], 0, object()
    for k in keys:
        if k != prev:
            rid += 1
        out.append(rid)
        prev = k
    return out
