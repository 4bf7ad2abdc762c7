"""Views of the driver's parquet tables in the trade/quote data model.

* ``trades``: from ``events``: symbol = event_type, seq = event_id, ts,
  price = value, amount = ``$.k`` of props.  (symbol, ts) is unique.
* ``trades_big``: from ``orders``: symbol = o_orderpriority, seq =
  o_orderkey, ts = o_orderdate, price = o_totalprice, amount = 1.0.  Many
  (symbol, ts) ties, so it exercises the tie rules.
* ``quotes``: daily bars of ``trades`` as a quote table, newest first by date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.bars import periodic_ohlcv

TRADE_COLUMNS = ["symbol", "seq", "ts", "price", "amount"]
QUOTE_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume", "adj_close"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_type AS symbol",
        "event_id AS seq",
        "ts",
        "value AS price",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS amount",
    )


def trades_from_orders(orders: DataFrame, extra: list[str] | tuple = ()) -> DataFrame:
    return orders.selectExpr(
        "o_orderpriority AS symbol",
        "o_orderkey AS seq",
        "o_orderdate AS ts",
        "o_totalprice AS price",
        "CAST(1.0 AS DOUBLE) AS amount",
        *extra,
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(table(spark, sf_dir, "events"))


def trades_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_orders(table(spark, sf_dir, "orders"))


def quotes_from_trades(t: DataFrame, tie_break: str | None = "prepend") -> DataFrame:
    bars = periodic_ohlcv(t, "daily", tie_break)
    return bars.selectExpr(
        "symbol",
        "to_date(`begin`) AS date",
        "open",
        "high",
        "low",
        "close",
        "CAST(volume AS BIGINT) AS volume",
        "close AS adj_close",
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_from_trades(trades(spark, sf_dir))
