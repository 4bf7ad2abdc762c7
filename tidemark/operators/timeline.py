"""Arrival timelines and inter-arrival statistics (R1, R2) as table operators."""

from __future__ import annotations

from collections.abc import Sequence
import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import micros_ntz, ntz_micros
from ..plans import sequence


def _ts_lit(start) -> Column:
    if isinstance(start, Column):
        return start
    if isinstance(start, _dt.datetime):
        start = start.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(start)).cast("timestamp_ntz")


def arrival_timeline(
    df: DataFrame,
    gap_col: str,
    start,
    *,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "seq",
    out: str = "arrival_ts",
    block_size: int = sequence.DEFAULT_BLOCK,
) -> DataFrame:
    """Event times from gaps (R1): ``start + running sum of gap seconds``.

    Gaps are rounded to whole microseconds before summing, so the running
    sum is exact integer arithmetic however it is split across blocks.
    """
    gap_us = F.round(F.col(gap_col).cast("double") * F.lit(1e6)).cast("long")
    d = sequence.prefix_sum(df, keys, order_col, gap_us, "_elapsed_us", block_size=block_size)
    arrival = micros_ntz(ntz_micros(_ts_lit(start)) + F.col("_elapsed_us"))
    return d.withColumn(out, arrival).drop("_elapsed_us")


def interarrival_gaps(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "seq",
    ts_col: str = "ts",
    out: str = "gap_s",
    block_size: int = sequence.DEFAULT_BLOCK,
) -> DataFrame:
    """Gap in seconds between each event and the previous one in arrival order (null first)."""
    d = sequence.with_previous(df, keys, order_col, [ts_col], block_size=block_size, prefix="_prev_")
    gap = F.timestamp_diff("MICROSECOND", F.col(f"_prev_{ts_col}"), F.col(ts_col)) / F.lit(1e6)
    return d.withColumn(out, gap).drop(f"_prev_{ts_col}")


def interarrival_stats(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "seq",
    ts_col: str = "ts",
    block_size: int = sequence.DEFAULT_BLOCK,
) -> DataFrame:
    """Per key: events, gaps, mean/min/max gap in seconds (R2)."""
    g = interarrival_gaps(df, keys=keys, order_col=order_col, ts_col=ts_col, block_size=block_size)
    return g.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("gap_s").alias("n_gaps"),
        F.avg("gap_s").alias("mean_gap_s"),
        F.min("gap_s").alias("min_gap_s"),
        F.max("gap_s").alias("max_gap_s"),
    )
