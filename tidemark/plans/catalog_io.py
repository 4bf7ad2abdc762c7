"""Registered queries for records (S1-S9, P1), the query surface (Q1-Q5) and streams (ST1-ST6).

Writers put their files under the session's shared checkpoint folder; each
query then reads back what Spark wrote and compares with the source tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import bars as B
from ..plans import api as A
from ..session import scratch_path
from ..sources import records as R
from ..sources import testdata as TD
from ..streaming import bars as SB
from ..streaming import gaps as SG
from ..streaming import records as SR
from ..streaming import sources as SS
from ..streaming import stateful as ST
from ..streaming import zipping as SZ
from .sequence import number_rows
from .catalog import BIG_SQL, ORACLE, TRADES_SQL, ZONE, _bars_sql, _quotes_sql, _r6, _runs_sql, _sma_sql, _zoned_begin

_BAR_COLS = ["symbol", "begin", "end", *B.BAR_COLUMNS]
QUOTES_SYMBOL = "purchase"
#: Tasks that share a stream's state; the given tables have few symbols.
STATE_PARTITIONS = 4
#: Rows of a table per task, for streams whose state is spread over all tasks.
STATE_ROWS = 1_000_000
QUOTES_AS_OF = dt.date(2024, 1, 30)


# ---------------------------------------------------------------- records

def q_csv_roundtrip(spark, d):
    root = scratch_path(spark, "raw-trades")
    R.write_trades_raw(TD.trades(spark, d), root)
    return R.read_trades(spark, root).select("symbol", "ts", "price", "amount")


def q_csv_text_roundtrip(spark, d):
    t = TD.trades(spark, d)
    path = scratch_path(spark, "trades-csv")
    R.write_csv(R.trades_to_csv(t, keep=["symbol"]), path, partition_by=["symbol"])
    return R.read_trades_text(spark, path).select("symbol", "ts", "price", "amount")


def q_json_roundtrip(spark, d):
    path = scratch_path(spark, "trades-json")
    R.trades_to_json(TD.trades(spark, d), keep=["symbol"]).write.partitionBy("symbol").text(path)
    return R.trades_from_json(spark.read.text(path), keep=["symbol"])


def _write_in_files(trades, root):
    """Raw lines in arrival order, in files of doubling size."""
    ordered = trades.withColumn("f", F.floor(F.log2(F.col("seq") + 1))).repartitionByRange(20, "f")
    R.write_trades_raw(ordered.sortWithinPartitions("symbol", "seq"), root)


def q_trades_multifile(spark, d):
    root = scratch_path(spark, "raw-files")
    _write_in_files(TD.trades(spark, d), root)
    t = number_rows(R.read_trades(spark, root), ["symbol"], "seq", "rn")
    return t.select("symbol", "rn", "ts", "price", "amount")


def q_quotes_header_order(spark, d):
    q, path = TD.quotes(spark, d), scratch_path(spark, "quotes-headers")
    text = q.select("symbol", *[F.col(c).cast("string").alias(h) for c, h in zip(R.QUOTE_COLUMNS, R.QUOTE_HEADER)])
    odd = F.dayofmonth(F.to_date("Date")) % 2 == 1
    turned = text.select("symbol", F.lit("x").alias("Note"), *[F.col(h) for h in reversed(R.QUOTE_HEADER)])
    R.write_csv(text.where(~odd), path, partition_by=["symbol"])
    R.write_csv(turned.where(odd), path, partition_by=["symbol"], mode="append")
    return R.read_quotes(spark, path).drop("seq")


def q_records_permissive(spark, d):
    """Every line stays: good, bad (wrong width or number) or over the cap."""
    t = TD.trades(spark, d)
    line = F.concat_ws(",", F.lit("1442335124"), F.col("price").cast("string"), F.lit("1.5"))
    value = F.when(F.col("seq") % 10 == 0, F.lit("x,1")).when(F.col("seq") % 10 == 1, F.concat(line, F.repeat(F.lit(" "), 100))).when(
        F.col("seq") % 10 == 2, F.lit("1442335124,abc,1")).otherwise(line)
    path = scratch_path(spark, "permissive")
    t.select("symbol", value.alias("value")).write.partitionBy("symbol").option("lineSep", "\n").text(path)
    return R.read_trades(spark, path, strict=False, max_line_bytes=64).groupBy("symbol", "bad", "too_long").agg(F.count("*").alias("n"))


def q_format_rows(spark, d):
    return R.format_rows(TD.trades(spark, d), ["symbol", "seq", "amount"])


def q_bars_csv(spark, d):
    bars = B.periodic_ohlcv(TD.trades(spark, d), "daily", "prepend")
    return R.bars_to_csv(bars, keep=["symbol"])


def q_bars_json_roundtrip(spark, d):
    bars = B.periodic_ohlcv(TD.trades(spark, d), "daily", "prepend")
    path = scratch_path(spark, "bars-json")
    R.bars_to_json(bars, keep=["symbol"]).write.partitionBy("symbol").text(path)
    return R.bars_from_json(spark.read.text(path), keep=["symbol"]).select(*_BAR_COLS)


def q_quotes_csv_roundtrip(spark, d):
    q = TD.quotes(spark, d)
    path = scratch_path(spark, "quotes-csv")
    text = q.select("symbol", *[F.col(c).cast("string").alias(h) for c, h in zip(R.QUOTE_COLUMNS, R.QUOTE_HEADER)])
    R.write_csv(text, path, partition_by=["symbol"])
    return R.read_quotes(spark, path).drop("seq")


def q_select_col(spark, d):
    return R.select_col(TD.quotes(spark, d), "adj_close")


def q_raw_passthrough(spark, d):
    root = scratch_path(spark, "raw-trades")
    R.write_trades_raw(TD.trades(spark, d), root)
    return A.raw_trades(spark, root, "pur", "chase")


# ---------------------------------------------------------------- query surface

def q_bars_api(spark, d):
    return A.bars(TD.trades(spark, d), "Daily", "pur", "chase")


def q_quotes_api(spark, d):
    out = A.quotes(TD.quotes(spark, d), QUOTES_SYMBOL, "10d", "sma(3),sma(5)", QUOTES_AS_OF)
    return out.withColumn("adj_close_sma_3", _r6(F.col("adj_close_sma_3"))).withColumn(
        "adj_close_sma_5", _r6(F.col("adj_close_sma_5")))


def q_quotes_raw(spark, d):
    return A.raw_quotes(TD.quotes(spark, d), QUOTES_SYMBOL, "P1W", QUOTES_AS_OF)


# ---------------------------------------------------------------- streams

def _events_stream(spark, d):
    ev = TD.table(spark, d, "events")
    return TD.trades_from_events(SS.parquet_stream(spark, d, "events.parquet", schema=ev.schema))


def _orders_stream(spark, d):
    o = TD.table(spark, d, "orders")
    return TD.trades_from_orders(SS.parquet_stream(spark, d, "orders.parquet", schema=o.schema))


def _state_partitions(table):
    """Tasks for a state that grows with the table."""
    return max(STATE_PARTITIONS, -(-table.count() // STATE_ROWS))


def _unordered_batches(spark, d):
    """The trades as many files in no order of time, some without a symbol, two files to a micro-batch."""
    t = TD.trades(spark, d).withColumn("symbol", F.expr("CASE WHEN seq % 17 != 0 THEN symbol END"))
    path = scratch_path(spark, "unordered")
    t.repartition(8, F.hash("seq")).write.parquet(path)
    return SS.parquet_stream(spark, path, schema=t.schema, max_files_per_trigger=2)


def _stream_bars(spark, d, period, rollup=None):
    out, state = scratch_path(spark, "stream-bars"), scratch_path(spark, "stream-ckpt")
    SB.stream_ohlcv(_unordered_batches(spark, d), out, state, period, rollup=rollup, partitions=STATE_PARTITIONS).awaitTermination()
    return out, state


def q_stream_ohlcv(spark, d):
    return SB.read_bars(spark, *_stream_bars(spark, d, "hourly")).select(*_BAR_COLS)


def q_stream_ohlcv_zoned(spark, d):
    period = f"daily({ZONE})"
    return SB.read_bars(spark, *_stream_bars(spark, d, period), period).select(*_BAR_COLS)


def q_stream_rollup(spark, d):
    """Hours and days from one query; the days."""
    return SB.read_rollup(spark, *_stream_bars(spark, d, "hourly", "daily"), "daily").select(*_BAR_COLS)


def q_stream_ohlcv_final(spark, d):
    """Bars that the stream has closed, each of them emitted once, with what came later merged in, and those still open."""
    out, state = _stream_bars(spark, d, "hourly")
    final = SB.read_final_bars(spark, out)
    rest = spark.read.parquet(out).where(F.col("kind") == "correction").select(*final.columns)
    return B.merge_ohlcv(final.unionByName(rest).unionByName(SB.read_open_bars(spark, state)), SB.KEYS).select(*_BAR_COLS)


def q_stream_sma(spark, d):
    out = scratch_path(spark, "sma-out")
    ST.stream_sma(_events_stream(spark, d), out, scratch_path(spark, "sma-ckpt"), 10, "price", partitions=STATE_PARTITIONS).awaitTermination()
    return ST.read_outputs(spark, out).withColumn("price_sma_10", _r6(F.col("price_sma_10")))


def q_stream_runs(spark, d):
    out = scratch_path(spark, "runs-out")
    ST.stream_runs(_orders_stream(spark, d), out, scratch_path(spark, "runs-ckpt"), "daily", "prepend", partitions=STATE_PARTITIONS).awaitTermination()
    return ST.finalize_runs(ST.read_outputs(spark, out))


def q_stream_csv_json(spark, d):
    root = scratch_path(spark, "raw-trades")
    R.write_trades_raw(TD.trades(spark, d), root)
    encoded = SR.stream_encode_json(SR.stream_decode_trades(spark, root))
    lines = SS.run_available_now(encoded)
    return R.trades_from_json(lines, keep=["symbol"])


def q_stream_json_csv(spark, d):
    """Decode a stream of JSON lines, encode it as CSV files, read those."""
    root, out, state = (scratch_path(spark, x) for x in ("json-lines", "csv-lines", "csv-ckpt"))
    R.trades_to_json(TD.trades(spark, d), keep=["symbol"]).write.partitionBy("symbol").option("lineSep", "\n").text(root)
    encoded = SR.stream_encode_csv(SR.stream_decode_json(spark, root))
    w = encoded.writeStream.format("csv").option("header", True).option("path", out).option("checkpointLocation", state)
    w.trigger(availableNow=True).start().awaitTermination()
    back = spark.read.option("header", True).schema(", ".join(f"`{c}` string" for c in encoded.columns)).csv(out)
    return back.select("symbol", R.parse_iso_instant(F.col("timestamp")).alias("ts"), F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"))


def q_stream_zip(spark, d):
    """All trades beside every third one, as two streams."""
    events = _events_stream(spark, d)
    right = events.where("seq % 3 = 0").select("symbol", F.col("seq").alias("at"), "amount")
    out = scratch_path(spark, "zip-out")
    SZ.stream_zip(events.select("symbol", "seq", "price"), right, out, scratch_path(spark, "zip-ckpt"), right_order="at",
                  stripe=4096, partitions=_state_partitions(TD.table(spark, d, "events"))).awaitTermination()
    return spark.read.parquet(out)


def q_stream_gap_stats(spark, d):
    out = scratch_path(spark, "gaps-out")
    SG.stream_gaps(_events_stream(spark, d), out, scratch_path(spark, "gaps-ckpt"), partitions=STATE_PARTITIONS, stripe=1024).awaitTermination()
    s = SG.read_gap_stats(spark, out)
    return s.select("symbol", "n", "n_gaps", *(_r6(F.col(c)).alias(c) for c in ("mean_gap_s", "min_gap_s", "max_gap_s")))


def q_stream_csv_runs(spark, d):
    """Decode CSV files, split the trades into runs in arrival order, fold each run."""
    root = scratch_path(spark, "raw-files")
    _write_in_files(TD.trades_big(spark, d), root)
    folder, out = scratch_path(spark, "numbered"), scratch_path(spark, "runs-out")
    SS.run_foreach_batch(SR.stream_lines(spark, root), SR.OrderedTrades(ST.to_folder(folder)))
    numbered = SS.parquet_stream(spark, folder)
    ST.stream_runs(numbered, out, scratch_path(spark, "runs-ckpt"), "daily", "prepend", partitions=STATE_PARTITIONS).awaitTermination()
    return ST.finalize_runs(ST.read_outputs(spark, out))


# ---------------------------------------------------------------- oracles

_SECOND_TRADES = (
    f"SELECT symbol, date_trunc('second', ts) AS ts, price, amount FROM ({TRADES_SQL})"
)
_TRADES_NOSEQ = f"SELECT symbol, ts, price, amount FROM ({TRADES_SQL})"


_SPARSE_TRADES = (
    "SELECT CASE WHEN seq % 17 <> 0 THEN symbol END AS symbol, * EXCLUDE (symbol) "
    f"FROM ({TRADES_SQL})"
)


_DAILY_BARS = _bars_sql(TRADES_SQL, "date_trunc('day', ts)", "1 DAY", "prepend")


def _iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%SZ')"


ORACLE_IO: dict[str, str] = {
    "csv_roundtrip": _SECOND_TRADES,
    "csv_text_roundtrip": _TRADES_NOSEQ,
    "json_roundtrip": _TRADES_NOSEQ,
    "bars_csv": (
        "SELECT symbol, " + _iso('"begin"') + ' AS "Begin", ' + _iso('"end"') + ' AS "End", '
        
        "printf('%.2f', open) AS \"Open\", printf('%.2f', high) AS \"High\", printf('%.2f', low) AS \"Low\", "
        "printf('%.2f', close) AS \"Close\", printf('%.2f', volume) AS \"Volume\" "
        f"FROM ({_DAILY_BARS})"
    ),
    "bars_json_roundtrip": _bars_sql(TRADES_SQL, "date_trunc('day', ts)", "1 DAY", "prepend"),
    "quotes_csv_roundtrip": _quotes_sql(),
    "select_col": f"SELECT adj_close FROM ({_quotes_sql()})",
    "raw_passthrough": (
        "SELECT CAST(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS VARCHAR) || ',' || CAST(price AS VARCHAR) "
        f"|| ',' || CAST(amount AS VARCHAR) AS value FROM ({TRADES_SQL}) WHERE symbol = 'purchase'"
    ),
    "bars_api": (
        f"SELECT * FROM ({_DAILY_BARS}) "
        "WHERE symbol = 'purchase'"
    ),
    "quotes_api": (
        f"WITH q AS (SELECT * FROM ({_quotes_sql()}) WHERE symbol = '{QUOTES_SYMBOL}' "
        f"AND date BETWEEN DATE '2024-01-20' AND DATE '{QUOTES_AS_OF.isoformat()}'), s AS (SELECT *, "
        "row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS pos, "
        "count(*) OVER (PARTITION BY symbol) AS len, "
        "avg(adj_close) OVER (PARTITION BY symbol ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS m3, "
        "avg(adj_close) OVER (PARTITION BY symbol ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS m5 "
        "FROM q) SELECT symbol, date, open, high, low, close, volume, adj_close, round(m3, 6) AS adj_close_sma_3, "
        "round(m5, 6) AS adj_close_sma_5 FROM s WHERE pos <= len - 6"
    ),
    "quotes_raw": (
        f"SELECT * FROM ({_quotes_sql()}) WHERE symbol = '{QUOTES_SYMBOL}' "
        f"AND date BETWEEN DATE '2024-01-23' AND DATE '{QUOTES_AS_OF.isoformat()}'"
    ),
    "stream_ohlcv": _bars_sql(_SPARSE_TRADES, "date_trunc('hour', ts)", "1 HOUR", "prepend"),
    "stream_ohlcv_final": _bars_sql(_SPARSE_TRADES, "date_trunc('hour', ts)", "1 HOUR", "prepend"),
    "stream_ohlcv_zoned": _bars_sql(_SPARSE_TRADES, _zoned_begin("ts", ZONE), "24 HOUR", "prepend"),
    "stream_rollup": _bars_sql(_SPARSE_TRADES, "date_trunc('day', ts)", "1 DAY", "prepend"),
    "stream_sma": _sma_sql(10),
    "stream_runs": _runs_sql(BIG_SQL, "date_trunc('day', ts)", "1 DAY"),
    "stream_csv_json": _SECOND_TRADES,
    "stream_json_csv": f"SELECT symbol, ts, price, amount FROM ({TRADES_SQL})",
    "stream_gap_stats": ORACLE["interarrival_stats"],
    "stream_zip": (
        f"WITH t AS ({TRADES_SQL}), l AS (SELECT symbol, seq, price, row_number() OVER (PARTITION BY symbol ORDER BY seq) AS rn FROM t), "
        "r AS (SELECT symbol, seq, amount, row_number() OVER (PARTITION BY symbol ORDER BY seq) AS rn FROM t WHERE seq % 3 = 0) "
        "SELECT l.symbol, CAST(l.rn AS BIGINT) AS rn, l.seq AS l_seq, l.price AS l_price, r.seq AS r_at, r.amount AS r_amount "
        "FROM l JOIN r ON l.symbol = r.symbol AND l.rn = r.rn"
    ),
    "stream_csv_runs": _runs_sql(BIG_SQL, "date_trunc('day', ts)", "1 DAY"),
    "trades_multifile": (
        "SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY seq) AS BIGINT) AS rn, "
        f"date_trunc('second', ts) AS ts, price, amount FROM ({TRADES_SQL})"
    ),
    "quotes_header_order": _quotes_sql(),
    "records_permissive": (
        "SELECT symbol, seq % 10 < 3 AS bad, seq % 10 = 1 AS too_long, count(*) AS n "
        f"FROM ({TRADES_SQL}) GROUP BY symbol, seq % 10 < 3, seq % 10 = 1"
    ),
    "format_rows": (
        "SELECT symbol || ',' || CAST(seq AS VARCHAR) || ',' || CAST(amount AS VARCHAR) AS value "
        f"FROM ({TRADES_SQL})"
    ),
}

QUERIES_IO = {
    "csv_roundtrip": q_csv_roundtrip,
    "csv_text_roundtrip": q_csv_text_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "bars_csv": q_bars_csv,
    "bars_json_roundtrip": q_bars_json_roundtrip,
    "quotes_csv_roundtrip": q_quotes_csv_roundtrip,
    "select_col": q_select_col,
    "raw_passthrough": q_raw_passthrough,
    "bars_api": q_bars_api,
    "quotes_api": q_quotes_api,
    "quotes_raw": q_quotes_raw,
    "stream_ohlcv": q_stream_ohlcv,
    "stream_ohlcv_final": q_stream_ohlcv_final,
    "stream_ohlcv_zoned": q_stream_ohlcv_zoned,
    "stream_rollup": q_stream_rollup,
    "stream_sma": q_stream_sma,
    "stream_runs": q_stream_runs,
    "stream_csv_json": q_stream_csv_json,
    "stream_csv_runs": q_stream_csv_runs,
    "stream_json_csv": q_stream_json_csv,
    "stream_gap_stats": q_stream_gap_stats,
    "stream_zip": q_stream_zip,
    "trades_multifile": q_trades_multifile,
    "quotes_header_order": q_quotes_header_order,
    "records_permissive": q_records_permissive,
    "format_rows": q_format_rows,
}
