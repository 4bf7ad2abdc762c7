"""Inter-arrival gaps of a stream (R2) as summaries that merge, and a check against a rate.

A stripe of a symbol (see ``stateful``) reports for each batch how many gaps it adds, their sum and
extremes, and its first and last time; the store keeps its last time, so the gap between two
batches counts.  Gaps between stripes are found from those first and last times when
the summaries are read, so they are the same however the stream was cut into batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.periods import ntz_micros
from ..functions.rates import mean_gap_s
from .processors import GAP_TYPES, StripeGaps
from .stateful import STRIPE, start, with_state_keys


def gaps_stream(events: DataFrame, order_col: str = "seq", ts_col: str = "ts", stripe: int = STRIPE) -> DataFrame:
    """Summaries of the gaps between events (symbol, order column, time) in arrival order.

    Events without a time are left out; one without an order value fails.
    """
    order = F.when(F.col(order_col).isNull(), F.raise_error(F.lit(f"an event without {order_col}"))).otherwise(F.col(order_col).cast("long"))
    rows = events.where(F.col(ts_col).isNotNull()).select("symbol", order.alias("seq"), ntz_micros(ts_col).alias("ts_us"))
    rows, names = with_state_keys(rows, ["symbol"])
    rows = rows.withColumn("stripe", F.floor(F.col("seq") / stripe)).drop("symbol")
    schema = f"{names[0]} string, {names[1]} boolean, stripe long, {GAP_TYPES}"
    out = rows.groupBy(*names, "stripe").transformWithStateInPandas(StripeGaps([*names]), schema, "append", "none")
    return out.withColumn("symbol", F.when(~F.col(names[1]), F.col(names[0]))).drop(*names)


def stream_gaps(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, partitions: int | None = None, **kw):
    """Start the summaries; returns the ``StreamingQuery``. Read them with :func:`read_gap_stats`."""
    return start(gaps_stream(events, **kw), path, checkpoint, trigger, partitions)


def merge_gaps(summaries: DataFrame) -> DataFrame:
    """(symbol, n, n_gaps, sum_us, min_us, max_us) from the summaries of all stripes and batches."""
    least = F.min(F.when(F.col("n_gaps") > 0, F.col("min_us"))).alias("min_us")
    most = F.max(F.when(F.col("n_gaps") > 0, F.col("max_us"))).alias("max_us")
    sums = [F.sum(c).alias(c) for c in ("n", "n_gaps", "sum_us")]
    ends = [F.min_by("first_us", "first_seq").alias("first_us"), F.max_by("last_us", "last_seq").alias("last_us")]
    stripes = summaries.groupBy("symbol", "stripe").agg(*sums, least, most, *ends)
    seam = F.col("first_us") - F.lag("last_us").over(Window.partitionBy("symbol").orderBy("stripe"))
    rows = stripes.withColumn("seam", seam)
    return rows.groupBy("symbol").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n_gaps") + F.when(F.col("seam").isNotNull(), 1).otherwise(0)).alias("n_gaps"),
        F.sum(F.col("sum_us") + F.coalesce("seam", F.lit(0))).alias("sum_us"),
        F.least(F.min("min_us"), F.min("seam")).alias("min_us"),
        F.greatest(F.max("max_us"), F.max("seam")).alias("max_us"),
    )


def read_gap_stats(spark: SparkSession, path: str) -> DataFrame:
    """Per symbol: events, gaps, mean/min/max gap in seconds so far, as the batch statistics give them."""
    m = merge_gaps(spark.read.parquet(path))
    return m.select("symbol", "n", "n_gaps", F.try_divide(F.col("sum_us") / 1e6, F.col("n_gaps")).alias("mean_gap_s"),
                    (F.col("min_us") / 1e6).alias("min_gap_s"), (F.col("max_us") / 1e6).alias("max_gap_s"))


def meets_rate(quantity: float, duration_s: float, tolerance: float = 0.1, mean_gap: str = "mean_gap_s") -> Column:
    """Whether a mean gap is that of ``quantity`` events per ``duration_s``, within a share of it; null without a gap."""
    target = mean_gap_s(quantity, duration_s)
    return F.abs(F.col(mean_gap) - target) <= target * tolerance
