"""Record streams (ST4): CSV or JSON lines in, trades in arrival order, JSON or CSV lines out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import records as R

#: Arrival numbers of one micro-batch: the batch id takes the bits above.
BATCH_BITS = 40


def stream_lines(spark: SparkSession, root: str, **options) -> DataFrame:
    """Stream the lines under ``root/symbol=<s>/`` with the place each was read from."""
    reader = spark.readStream.option("lineSep", "\n").options(**options)
    return reader.schema("value string, symbol string").text(root).selectExpr("*", *R.SPLIT_COLUMNS)


def stream_decode_trades(spark: SparkSession, root: str, *, strict: bool = True) -> DataFrame:
    """Stream headerless ``unixtime,price,amount`` lines under ``root/symbol=<s>/`` as trades.

    The file source discovers the ``symbol=`` partition column like the batch reader.  A map
    over lines knows no arrival order, so ``seq`` is null; :class:`OrderedTrades` has it.
    """
    lines = spark.readStream.option("lineSep", "\n").schema("value string, symbol string").text(root)
    rows = R.parse_csv(lines, strict=strict)
    return R.rows_to_trades(rows, symbol=F.col("symbol"), strict=strict)


def stream_decode_json(spark: SparkSession, root: str, *, strict: bool = True) -> DataFrame:
    """Stream JSON trades, one per line, under ``root/symbol=<s>/`` as trades; ``seq`` is null as above.

    In strict mode a line without a time, price or amount fails the stream, else it stays, flagged ``bad``.
    """
    lines = spark.readStream.option("lineSep", "\n").schema("value string, symbol string").text(root)
    rows = R.trades_from_json(lines, strict=strict, keep=["symbol"])
    return rows.select("symbol", F.lit(None).cast("long").alias("seq"), *[c for c in rows.columns if c != "symbol"])


class OrderedTrades:
    """``foreachBatch`` handler over :func:`stream_lines`: decodes a batch into trades whose ``seq`` is the
    arrival order (batch by batch, within one file by file, line by line) and hands them on."""

    def __init__(self, handler: Callable[[DataFrame, int], None], strict: bool = True):
        self.handler, self.strict = handler, strict

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        placed = R.with_arrival(batch, first=batch_id << BATCH_BITS)
        rows = R.parse_csv(placed, strict=self.strict)
        self.handler(R.rows_to_trades(rows, symbol=F.col("symbol"), strict=self.strict), batch_id)


def stream_encode_json(trades: DataFrame) -> DataFrame:
    """Trades -> JSON lines, keeping ``symbol`` for a partitioned sink."""
    return R.trades_to_json(trades, keep=["symbol"])


def stream_encode_csv(trades: DataFrame) -> DataFrame:
    """Trades -> ``timestamp, price, amount`` text columns (plus ``symbol``) for a CSV file sink.

    Use ``writeStream.format("csv").option("header", True)``: every output
    file then starts with the header, as the reference's stream does.
    """
    return R.trades_to_csv(trades, keep=["symbol"])
