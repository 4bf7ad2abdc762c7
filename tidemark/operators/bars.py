"""Open-high-low-close-volume bars.

A bar is the fold of a group of trades.  The two tie rules of the fold are
expressed as ``min_by`` / ``max_by`` ordered by ``(ts, +-seq)``:

* ``prepend``: open is the *last arrived* trade among the earliest
  timestamps, close the *first arrived* among the latest (the rule the bar
  queries use);
* ``append``: the mirror image;
* ``None``: order by ``ts`` alone.  Only valid when ``(symbol, ts)`` is
  unique; it plans as a HashAggregate instead of a SortAggregate.

Both plans aggregate partially before the shuffle, so a hot symbol or a hot
interval only ever ships one partial bar per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import Period, earlier_interval, overlapping_days, parse_period, period_begin, period_end, whole_hour_offsets
from ..plans import sequence

TIE_RULES = (None, "prepend", "append")

BAR_COLUMNS = ["open", "high", "low", "close", "volume", "n", "first_ts", "last_ts"]
SEQ_COLUMNS = ["open_seq", "close_seq"]


def _check_tie(tie_break: str | None) -> None:
    if tie_break not in TIE_RULES:
        raise ValueError(f"tie_break must be one of {TIE_RULES}, got {tie_break!r}")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _low_sql(col: str, nan_compat: bool) -> str:
    # JVM min propagates NaN; Spark's min skips it.
    if not nan_compat:
        return f"min({col})"
    return f"CASE WHEN bool_or(isnan({col})) THEN CAST('NaN' AS DOUBLE) ELSE min({col}) END"


def _volume_sql(col: str, stable: bool) -> str:
    # whole 2**-20 parts and the rest in 2**-52 parts: integer sums, whatever the order
    if not stable:
        return f"sum({col})"
    odd = f"(isnan({col}) OR abs({col}) = double('infinity'))"
    scaled = f"(CASE WHEN {odd} THEN 0D ELSE {col} * 1048576D END)"
    whole, rest = f"CAST(floor({scaled}) AS BIGINT)", f"CAST(floor(({scaled} - floor({scaled})) * 4294967296D) AS BIGINT)"
    special = f"sum(CASE WHEN {odd} THEN {col} WHEN {col} IS NOT NULL THEN 0D END)"
    return f"(sum({whole}) + sum({rest}) / 4294967296D) / 1048576D + {special}"


def _order_keys(tie_break: str | None, t: str, s: str | None) -> tuple[str, str]:
    if tie_break is None or s is None:
        return t, t
    sign = "-" if tie_break == "prepend" else ""
    k = f"named_struct('t', {t}, 's', {sign}{s})"
    return k, k


def ohlcv_aggs(
    tie_break: str | None = "prepend",
    *,
    ts: str = "ts",
    seq: str = "seq",
    price: str = "price",
    amount: str = "amount",
    with_seq: bool = False,
    nan_compat: bool = True,
    stable_volume: bool = False,
) -> list[Column]:
    """Aggregate expressions of one bar (A1 ``prepend``, A2 ``append``).

    ``stable_volume`` sums amounts in fixed point, to 2**-52, so that a volume is the same
    to the last bit however rows are dealt; a sum beyond 2**43 fails instead of losing digits.
    """
    _check_tie(tie_break)
    t, s, p, a = _q(ts), _q(seq), _q(price), _q(amount)
    ok, ck = _order_keys(tie_break, t, s)
    exprs = [
        f"min_by({p}, {ok}) AS open",
        f"max({p}) AS high",
        f"{_low_sql(p, nan_compat)} AS low",
        f"max_by({p}, {ck}) AS close",
        f"{_volume_sql(a, stable_volume)} AS volume",
        "count(1) AS n",
        f"min({t}) AS first_ts",
        f"max({t}) AS last_ts",
    ]
    if with_seq:
        exprs += [f"min_by({s}, {ok}) AS open_seq", f"max_by({s}, {ck}) AS close_seq"]
    return [F.expr(e) for e in exprs]


def ohlcv(
    trades: DataFrame,
    keys: Sequence[str | Column] = ("symbol",),
    tie_break: str | None = "prepend",
    *,
    with_seq: bool = False,
    nan_compat: bool = True,
    stable_volume: bool = False,
) -> DataFrame:
    """One bar per group of ``keys`` (A1/A2/A3).  No group, no bar.

    Without keys this is a global fold; Spark returns one all-null row for an
    empty global aggregate, which is dropped (no trade, no bar).
    """
    out = trades.groupBy(*keys).agg(*ohlcv_aggs(tie_break, with_seq=with_seq, nan_compat=nan_compat, stable_volume=stable_volume))
    return out if keys else out.where(F.col("n") > 0)


def ohlcv_by_interval(
    keyed_trades: DataFrame,
    tie_break: str | None = "prepend",
    *,
    with_seq: bool = False,
    nan_compat: bool = True,
) -> DataFrame:
    """One bar per (symbol, interval) for trades already carrying ``begin``/``end`` (A3)."""
    bars = ohlcv(keyed_trades, ["symbol", "begin", "end"], tie_break, with_seq=with_seq, nan_compat=nan_compat)
    return bars.select("symbol", "begin", "end", *BAR_COLUMNS, *(SEQ_COLUMNS if with_seq else []))


def periodic_ohlcv(
    trades: DataFrame,
    period: Period | str = "daily",
    tie_break: str | None = "prepend",
    *,
    with_seq: bool = False,
    nan_compat: bool = True,
    stable_volume: bool = False,
) -> DataFrame:
    """One bar per (symbol, period interval) (A4, the flagship).

    Output: symbol, begin, end, open, high, low, close, volume, n, first_ts,
    last_ts [, open_seq, close_seq].  Trades without a timestamp form no bar.  The shuffle key is (symbol, begin): a
    timestamp, not a window struct, so the partial sort/hash stays cheap.
    """
    p = parse_period(period) if isinstance(period, str) else period
    # a trade without a time lies in no interval (the same for every period kind)
    keyed = trades.where(F.col("ts").isNotNull()).withColumn("begin", period_begin("ts", p))
    bars = ohlcv(keyed, ["symbol", "begin"], tie_break, with_seq=with_seq, nan_compat=nan_compat, stable_volume=stable_volume)
    cols = ["symbol", "begin", period_end("begin", p).alias("end")] + BAR_COLUMNS
    if with_seq:
        cols += SEQ_COLUMNS
    return bars.select(*cols)


def merge_aggs(tie_break: str | None = "prepend", *, has_seq: bool = True, nan_compat: bool = True) -> list[Column]:
    """Aggregates that merge bars into one (A5); the fold is associative."""
    _check_tie(tie_break)
    if tie_break is None or not has_seq:
        ok, ck = "first_ts", "last_ts"
    else:
        ok, _ = _order_keys(tie_break, "first_ts", "open_seq")
        ck, _ = _order_keys(tie_break, "last_ts", "close_seq")
    exprs = [
        f"min_by(open, {ok}) AS open",
        "max(high) AS high",
        f"{_low_sql('low', nan_compat)} AS low",
        f"max_by(close, {ck}) AS close",
        "sum(volume) AS volume",
        "sum(n) AS n",
        "min(first_ts) AS first_ts",
        "max(last_ts) AS last_ts",
    ]
    if has_seq:
        exprs += [f"min_by(open_seq, {ok}) AS open_seq", f"max_by(close_seq, {ck}) AS close_seq"]
    return [F.expr(e) for e in exprs]


def merge_ohlcv(
    bars: DataFrame,
    keys: Sequence[str] = ("symbol", "begin", "end"),
    tie_break: str | None = "prepend",
    *,
    nan_compat: bool = True,
) -> DataFrame:
    """Merge bars that share ``keys`` (A5): e.g. the union of an old and a new batch.

    Bars must carry ``open_seq``/``close_seq`` to break ties between equal
    first/last times; without them the earliest/latest time decides alone.
    """
    has_seq = all(c in bars.columns for c in SEQ_COLUMNS)
    out = bars.groupBy(*keys).agg(*merge_aggs(tie_break, has_seq=has_seq, nan_compat=nan_compat))
    return out.select(*keys, *BAR_COLUMNS, *(SEQ_COLUMNS if has_seq else []))


def rollup_ohlcv(
    bars: DataFrame,
    period: Period | str = "daily",
    tie_break: str | None = "prepend",
    *,
    nan_compat: bool = True,
) -> DataFrame:
    """Roll hourly bars up into a coarser period (A5 roll-up).

    Each bar is re-keyed by the coarse period of its ``begin``.  This is exact
    when the hours nest in the coarse intervals, i.e. the zone is always a
    whole number of hours from UTC; other zones (e.g. +05:30) raise
    ``ValueError``: build their days from trades, or stream them with
    ``streaming.bars.stream_ohlcv_zoned`` (which keys hours by zoned day).
    """
    p = parse_period(period) if isinstance(period, str) else period
    if not whole_hour_offsets(p):
        raise ValueError(f"hourly bars do not nest in {p.label}: its offset is not a whole number of hours")
    keyed = bars.withColumn("begin", period_begin("begin", p)).drop("end")
    has_seq = all(c in bars.columns for c in SEQ_COLUMNS)
    out = keyed.groupBy("symbol", "begin").agg(*merge_aggs(tie_break, has_seq=has_seq, nan_compat=nan_compat))
    cols = ["symbol", "begin", period_end("begin", p).alias("end")] + BAR_COLUMNS
    return out.select(*cols, *(SEQ_COLUMNS if has_seq else []))


def assign_runs(
    trades: DataFrame,
    period: Period | str = "daily",
    *,
    order_col: str = "seq",
    block_size: int = sequence.DEFAULT_BLOCK,
    seed_col: str | None = None,
    keep_contained: bool = False,
) -> DataFrame:
    """Split arrival-ordered trades into consecutive runs of equal interval.

    Adds ``begin`` and ``run_id`` (1, 2, ... per symbol in arrival order).  A
    run ends when a trade's interval differs from the previous trade's.  Trades
    without a timestamp lie in no interval and belong to no run.
    Lag and running count use the blocked sequence plan, so one symbol is
    spread over many tasks.  ``seed_col`` (streaming tails) is added into the
    running count, so a carried-over row can continue an earlier run id.
    ``keep_contained`` lets a trade stay in the current interval while that one contains it, as
    a single pass over the trades would (see :func:`kept_intervals`).
    """
    p = parse_period(period) if isinstance(period, str) else period
    keyed = trades.where(F.col("ts").isNotNull()).withColumn("begin", period_begin("ts", p))
    if keep_contained and overlapping_days(p):
        keyed = kept_intervals(keyed, p, order_col=order_col, block_size=block_size)
    return sequence.segment_ids(keyed, ["symbol"], order_col, "begin", "run_id", block_size=block_size,
                                seed_col=seed_col)


def kept_intervals(keyed: DataFrame, period: Period, *, order_col: str = "seq", block_size: int = sequence.DEFAULT_BLOCK) -> DataFrame:
    """``begin`` under the rule that a trade stays in the current interval while that contains it.

    A day's interval spans 24 hours, so after a day of 23 hours it contains the next day's first
    hour too.  As a function from the current interval to the next one, a trade outside
    such an hour is constant: its own interval.  One inside keeps either of its two intervals
    and maps all others to its own.  Runs of such trades in one hour compose to one of them, so what
    matters is the interval of the newest trade that is constant, or first of its hour: a
    value carried along the blocks of the sequence plan, with no pass over a whole symbol.
    """
    own, other = F.col("begin"), F.col("_other")
    d = keyed.withColumn("_other", earlier_interval(F.col("ts"), own, period))
    d = sequence.with_previous(d, ["symbol"], order_col, ["begin", "_other"], block_size=block_size, prefix="_before_")
    first = other.isNull() | ~(F.col("_before__other").eqNullSafe(other) & F.col("_before_begin").eqNullSafe(own))
    # a trade that comes first in its hour keeps the interval of a constant trade right before it
    kept = F.when(other.isNotNull() & F.col("_before__other").isNull() & (F.col("_before_begin") == other), other).otherwise(own)
    d = sequence.with_latest(d, ["symbol"], order_col, kept, first, "_kept", block_size=block_size)
    return d.withColumn("begin", F.col("_kept")).drop("_other", "_before_begin", "_before__other", "_kept")


def ohlcv_runs(
    trades: DataFrame,
    period: Period | str = "daily",
    tie_break: str | None = "prepend",
    *,
    order_col: str = "seq",
    block_size: int = sequence.DEFAULT_BLOCK,
    nan_compat: bool = True,
    keep_contained: bool = False,
) -> DataFrame:
    """One bar per consecutive run (the reference's split-when semantics).

    Equal to :func:`periodic_ohlcv` when trades arrive in time order; with
    unordered arrivals one interval can yield several bars.
    """
    p = parse_period(period) if isinstance(period, str) else period
    runs = assign_runs(trades, p, order_col=order_col, block_size=block_size, keep_contained=keep_contained)
    bars = ohlcv(runs, ["symbol", "run_id", "begin"], tie_break, nan_compat=nan_compat)
    return bars.select("symbol", "run_id", "begin", period_end("begin", p).alias("end"), *BAR_COLUMNS)
