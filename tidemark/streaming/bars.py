"""Streaming bars (ST1, ST2, ST6) that are emitted once, when complete, on Spark's state store.

Each task folds its rows into partial bars first, so a hot symbol sends a few rows to
its state and not its trades.  The state of a symbol is its open bars and its event-time
mark, the latest time seen.  A bar is final when the mark has passed its end by ``delay``; it
is written once and leaves the state.  A trade that comes later still is folded into
a correction row.  Bars merge exactly (A5), so finals, corrections and the bars still open
in the state make the bars of all trades: none is lost, with or without a symbol.

``rollup`` chains a second stateful operator to the first: hourly rows, final or correction, are
folded into bars of a coarser period in the same query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import Period, micros_ntz, ntz_micros, parse_period, period_begin, whole_hour_offsets
from ..operators.bars import BAR_COLUMNS, SEQ_COLUMNS, merge_ohlcv
from .processors import BAR_TYPES, FINAL, NULL, ROW_TYPES, VALUE, FinalBars, prefold
from .stateful import start, with_state_keys

KEYS = ["symbol", "begin", "end"]
_HOUR = 3_600_000_000


def _length(period: Period) -> int:
    return _HOUR if period.kind == "hourly" else 24 * _HOUR


def bars_stream(trades: DataFrame, period: Period | str = "hourly", tie_break: str | None = "prepend", delay_s: int = 0,
                rollup: Period | str | None = None) -> DataFrame:
    """Bars of a stream of trades (symbol, seq, ts, price, amount) as they become final, and corrections.

    Columns: period (its spec), kind (``final`` or ``correction``), symbol, begin, end, the bar
    and open_seq, close_seq.  Trades without a timestamp form no bar; prices and amounts are
    doubles without nulls.  ``rollup`` adds bars of a coarser period that hours nest in.
    """
    p = parse_period(period) if isinstance(period, str) else period
    up = parse_period(rollup) if isinstance(rollup, str) else rollup
    if up and (p.kind != "hourly" or not whole_hour_offsets(up)):
        raise ValueError(f"hourly bars do not nest in {up.label}, or the bars are not hourly")
    rows = trades.where(F.col("ts").isNotNull()).withColumn("begin", period_begin("ts", p))
    rows = rows.select("symbol", F.col("seq").cast("long").alias("seq"), ntz_micros("ts").alias("ts_us"), ntz_micros("begin").alias("begin_us"),
                       F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"))
    rows, names = with_state_keys(rows, ["symbol"])
    partial = f"{VALUE} string, {NULL} boolean, begin_us long, {BAR_TYPES}, mark_us long, level int, kind string"
    rows = rows.drop("symbol").mapInPandas(prefold(tie_break), partial)
    out = rows.groupBy(*names).transformWithStateInPandas(FinalBars(0, _length(p), delay_s * 1_000_000, tie_break), ROW_TYPES, "append", "none")
    if up:
        out = out.withColumn("begin", micros_ntz(F.col("begin_us")))
        out = out.withColumn("up_us", ntz_micros(period_begin("begin", up))).drop("begin")
        out = out.groupBy(*names).transformWithStateInPandas(FinalBars(1, _length(up), delay_s * 1_000_000, tie_break), ROW_TYPES, "append", "none")
    return _rows(out, F.col("level"), F.col("kind"), [p, *([up] if up else [])])


def _rows(out: DataFrame, level, kind, periods: list[Period]) -> DataFrame:
    symbol = F.when(~F.col(NULL), F.col(VALUE)).alias("symbol")
    name, length = F.lit(periods[0].label), F.lit(_length(periods[0]))
    if len(periods) > 1:
        name, length = F.when(level == 0, name).otherwise(periods[1].label), F.when(level == 0, length).otherwise(_length(periods[1]))
    times = [micros_ntz(c).alias(t) for c, t in ((F.col("begin_us"), "begin"), (F.col("begin_us") + length, "end"))]
    ends = [micros_ntz(F.col(c)).alias(t) for c, t in (("first_us", "first_ts"), ("last_us", "last_ts"))]
    return out.select(name.alias("period"), kind.alias("kind"), symbol, *times, "open", "high", "low", "close", "volume", "n", *ends, *SEQ_COLUMNS)


def stream_ohlcv(trades: DataFrame, path: str, checkpoint: str, period: Period | str = "hourly", tie_break: str | None = "prepend",
                 trigger: dict | None = None, delay_s: int = 0, rollup: Period | str | None = None, partitions: int | None = None):
    """Start streaming bars (ST1, ST2; with ``rollup`` ST6 in the same query); returns the ``StreamingQuery``.

    :func:`read_final_bars` gives the bars emitted so far, :func:`read_bars` those of all trades so far.
    """
    return start(bars_stream(trades, period, tie_break, delay_s, rollup), path, checkpoint, trigger, partitions)


def read_final_bars(spark: SparkSession, path: str, period: Period | str = "hourly") -> DataFrame:
    """The bars of a period that are complete, each once."""
    p = parse_period(period) if isinstance(period, str) else period
    rows = spark.read.parquet(path).where((F.col("period") == p.label) & (F.col("kind") == FINAL))
    return rows.select(*KEYS, *BAR_COLUMNS, *SEQ_COLUMNS)


def read_open_bars(spark: SparkSession, checkpoint: str, period: Period | str = "hourly", level: int = 0) -> DataFrame:
    """The bars of a period that a query's state holds (``level`` 1: those of its roll-up)."""
    p = parse_period(period) if isinstance(period, str) else period
    name = f"open_{level}"
    operators = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorProperties").distinct().collect()
    ids = [r["operatorId"] for r in operators if f'"{name}"' in (r["operatorProperties"] or "")]
    state = spark.read.format("statestore").option("operatorId", ids[0]).option("stateVarName", name).load(checkpoint)
    rows = state.select(F.col(f"key.{VALUE}").alias(VALUE), F.col(f"key.{NULL}").alias(NULL), "user_map_key.begin_us", "user_map_value.*")
    return _rows(rows, F.lit(0), F.lit("open"), [p]).select(*KEYS, *BAR_COLUMNS, *SEQ_COLUMNS)


def read_bars(spark: SparkSession, path: str, checkpoint: str, period: Period | str = "hourly", tie_break: str | None = "prepend",
              level: int = 0) -> DataFrame:
    """The bars of all trades so far, one per symbol and interval: finals, corrections and open ones merged.

    Of a roll-up (``level`` 1) what its hours have handed on, and the hours that are still open.
    """
    p = parse_period(period) if isinstance(period, str) else period
    rows = spark.read.parquet(path).where(F.col("period") == p.label).select(*KEYS, *BAR_COLUMNS, *SEQ_COLUMNS)
    rows = rows.unionByName(read_open_bars(spark, checkpoint, p, level))
    if level:
        hours = read_open_bars(spark, checkpoint, "hourly", 0)
        begin = period_begin("begin", p)
        hours = hours.withColumn("begin", begin).withColumn("end", F.timestamp_add("MICROSECOND", F.lit(_length(p)), F.col("begin")))
        rows = rows.unionByName(hours)
    return merge_ohlcv(rows, KEYS, tie_break)


def read_rollup(spark: SparkSession, path: str, checkpoint: str, period: Period | str = "daily", tie_break: str | None = "prepend") -> DataFrame:
    """The roll-up bars of all trades so far (ST6)."""
    return read_bars(spark, path, checkpoint, period, tie_break, level=1)
