"""Registered queries: one Spark callable and (where SQL can say it) one oracle SQL each.

Every query reads the driver's whole tables (or data Spark derives from
them).  Computed doubles that depend on summation order are rounded to 6
decimals on both sides; everything else is compared exactly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import interval_contains
from ..functions.rates import duration_for, quantity_for
from ..operators import bars as B
from ..operators import indicators as I
from ..operators import timeline as TL
from ..operators.zipping import zip_join
from ..sources import testdata as TD
from .sequence import lag_change, number_rows

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
ZONE = "America/New_York"
AS_OF = dt.date(2024, 1, 30)
LOOKBACK = "10D"
TIMELINE_START = "2024-01-01 00:00:00"
SYMBOL_EXCHANGE, SYMBOL_CURRENCY = "pur", "chase"
INTERVAL_BEGIN, INTERVAL_END = "2024-01-15 00:00:00", "2024-01-16 00:00:00"
RATE = (None, 0.25)  # quantity (per row: amount + 1) per 250 ms
EMIT_RATE = (4.0, 1.0)  # four units per second

_BAR_COLS = ["symbol", "begin", "end", *B.BAR_COLUMNS]


def _r6(c) -> "F.Column":
    return F.round(c, 6)


# ---------------------------------------------------------------- Spark side

def q_ohlcv_daily(spark, d):
    return B.periodic_ohlcv(TD.trades(spark, d), "daily", "prepend")


def q_ohlcv_daily_hash(spark, d):
    # (symbol, ts) is unique in trades, so the HashAggregate path is exact here.
    return B.periodic_ohlcv(TD.trades(spark, d), "daily", None)


def q_ohlcv_hourly(spark, d):
    return B.periodic_ohlcv(TD.trades(spark, d), "hourly", "prepend")


def q_ohlcv_daily_zoned(spark, d):
    return B.periodic_ohlcv(TD.trades(spark, d), f"daily({ZONE})", "prepend")


def q_ohlcv_daily_offset(spark, d):
    return B.periodic_ohlcv(TD.trades(spark, d), "daily(+05:30)", "prepend")


def q_ohlcv_prepend(spark, d):
    return B.periodic_ohlcv(TD.trades_big(spark, d), "daily", "prepend")


def q_ohlcv_append(spark, d):
    return B.periodic_ohlcv(TD.trades_big(spark, d), "daily", "append")


def q_ohlcv_symbol(spark, d):
    return B.ohlcv(TD.trades_big(spark, d), ["symbol"], "prepend")


def q_ohlcv_rollup(spark, d):
    hourly = B.periodic_ohlcv(TD.trades(spark, d), "hourly", "prepend", with_seq=True)
    return B.rollup_ohlcv(hourly, "daily", "prepend").select(*_BAR_COLS)


def q_ohlcv_merge(spark, d):
    # partial bars per order-status batch, then merged into one bar per day (A5)
    from ..functions.periods import period_begin, period_end

    t = TD.trades_from_orders(TD.table(spark, d, "orders"), extra=["o_orderstatus"])
    keyed = t.withColumn("begin", period_begin("ts", "daily"))
    partial = B.ohlcv(keyed, ["symbol", "begin", "o_orderstatus"], "prepend", with_seq=True)
    partial = partial.withColumn("end", period_end("begin", "daily"))
    return B.merge_ohlcv(partial, ["symbol", "begin", "end"], "prepend").select(*_BAR_COLS)


def q_ohlcv_runs(spark, d):
    return B.ohlcv_runs(TD.trades_big(spark, d), "daily", "prepend")


def q_ohlcv_runs_hourly(spark, d):
    return B.ohlcv_runs(TD.trades(spark, d), "hourly", "prepend")


def q_sma_10(spark, d):
    out = I.sma(TD.trades(spark, d), "price", 10, order_col="seq", newest_first=True)
    return out.withColumn("price_sma_10", _r6(F.col("price_sma_10")))


def q_sma_200(spark, d):
    out = I.sma(TD.trades(spark, d), "price", 200, order_col="seq", newest_first=True)
    return out.withColumn("price_sma_200", _r6(F.col("price_sma_200")))


def q_sma_chain(spark, d):
    out = I.calculated(TD.quotes(spark, d), "sma(3),sma(5)")
    return out.select(*TD.QUOTE_COLUMNS, _r6(F.col("adj_close_sma_3")).alias("adj_close_sma_3"),
                      _r6(F.col("adj_close_sma_5")).alias("adj_close_sma_5"))


def q_sma_exact_chain(spark, d):
    # not rounded: the running sum differs from the mean in the last bits
    return I.calculated(TD.quotes(spark, d), "sma(3),sma(5)", exact_running_sum=True)


def q_sma_2000(spark, d):
    out = I.sma(TD.trades(spark, d), "price", 2000, order_col="seq", newest_first=True)
    return out.withColumn("price_sma_2000", _r6(F.col("price_sma_2000")))


def q_sma_col(spark, d):
    # text in, formatted text out; whole numbers of hundredths, so that rounding is the same everywhere
    t = TD.trades(spark, d).select("symbol", "seq", F.col("amount").cast("string").alias("amount"))
    return I.sma_col(t, "amount", 4, order_col="seq").withColumnRenamed("amount SMA(4)", "amount_sma_4")


def q_append_sma(spark, d):
    q = I.append_sma(TD.quotes(spark, d), 3, fmt=None)
    return q.withColumn("adj_close_sma_3", _r6(F.col("adj_close_sma_3")))


def q_ohlcv_by_interval(spark, d):
    from ..functions.periods import period_begin, period_end

    t = TD.trades_big(spark, d).withColumn("begin", period_begin("ts", "daily"))
    return B.ohlcv_by_interval(t.withColumn("end", period_end("begin", "daily")), "append")


def q_ohlcv_runs_zoned(spark, d):
    t = TD.trades(spark, d).withColumn("ts", F.expr("CASE WHEN seq % 13 != 0 THEN ts END"))
    return B.ohlcv_runs(t, f"daily({ZONE})", "prepend")


def q_compound_index(spark, d):
    t = TD.trades(spark, d).withColumn("shock", (F.col("amount") - F.lit(50.0)) / F.lit(10000.0))
    out = I.compound_index(t, "shock", 100.0)
    return out.select("symbol", "seq", "ts", _r6(F.col("index")).alias("index"))


def q_row_position(spark, d):
    return number_rows(TD.trades(spark, d), ["symbol"], "seq", "rn").select("symbol", "seq", "rn")


def q_row_position_ts(spark, d):
    return number_rows(TD.trades(spark, d), ["symbol"], "ts", "rn", descending=True).select("symbol", "seq", "rn")


def q_row_position_sparse(spark, d):
    t = TD.trades(spark, d).withColumn("wide", F.col("seq") * F.lit(1 << 22))
    return number_rows(t, ["symbol"], "wide", "rn", with_total="n", even=True).select("symbol", "wide", "rn", "n")


def q_lag_change(spark, d):
    t = TD.trades_big(spark, d)
    return lag_change(t, ["symbol"], "seq", "ts").select("symbol", "seq", "changed")


def q_zip_join(spark, d):
    """All trades beside all hourly bars of their symbol, newest bar first; the shorter table ends the pairs."""
    left = TD.trades(spark, d).select("symbol", "seq", "price")
    right = B.periodic_ohlcv(TD.trades(spark, d), "hourly", "prepend").select("symbol", "begin", "n")
    return zip_join(left, right, right_order="begin", right_descending=True)


def q_arrival_timeline(spark, d):
    t = TD.trades(spark, d).withColumn("gap_s", F.col("amount") / F.lit(100.0))
    return TL.arrival_timeline(t, "gap_s", TIMELINE_START).select("symbol", "seq", "arrival_ts")


def q_ohlcv_runs_contained(spark, d):
    """Runs in a zone whose clocks go forward within the data, a trade staying in its interval while that contains it."""
    t = TD.trades(spark, d).withColumn("ts", F.col("ts") + F.expr("INTERVAL 60 DAYS"))
    return B.ohlcv_runs(t, f"daily({ZONE})", keep_contained=True)


def q_sma_decimal(spark, d):
    t = TD.trades(spark, d).withColumn("exact", F.col("price").cast("decimal(18,4)"))
    out = I.sma(t, "exact", 7)
    return out.select("symbol", "seq", F.col("exact").cast("string").alias("exact"), F.col("exact_sma_7").cast("string").alias("exact_sma_7"))


def q_ohlcv_stable(spark, d):
    """Daily bars whose volumes don't depend on how rows are dealt; the rows are dealt anew."""
    t = TD.trades(spark, d).repartition(11, "seq")
    return B.periodic_ohlcv(t, "daily", "prepend", stable_volume=True)


def q_interarrival_stats(spark, d):
    s = TL.interarrival_stats(TD.trades(spark, d))
    return s.select("symbol", "n", "n_gaps", _r6(F.col("mean_gap_s")).alias("mean_gap_s"),
                    _r6(F.col("min_gap_s")).alias("min_gap_s"), _r6(F.col("max_gap_s")).alias("max_gap_s"))


def q_rate_quantities(spark, d):
    t = TD.trades(spark, d)
    q = F.col("amount") + F.lit(1.0)
    return t.select(
        "symbol", "seq",
        quantity_for(q, RATE[1], F.col("price")).alias("qty_for"),
        duration_for(EMIT_RATE[0], EMIT_RATE[1], q).alias("dur_for"),
    )


def q_quotes_lookback(spark, d):
    from ..plans.api import lookback

    return lookback(TD.quotes(spark, d), LOOKBACK, AS_OF)


def q_trades_symbol(spark, d):
    from ..plans.api import trades as trades_api

    return trades_api(TD.trades(spark, d), SYMBOL_EXCHANGE, SYMBOL_CURRENCY)


def q_interval_filter(spark, d):
    t = TD.trades(spark, d)
    b, e = F.lit(INTERVAL_BEGIN).cast("timestamp_ntz"), F.lit(INTERVAL_END).cast("timestamp_ntz")
    return t.where(interval_contains(b, e, "ts"))


# ---------------------------------------------------------------- oracle SQL

TRADES_SQL = (
    "SELECT event_type AS symbol, event_id AS seq, ts, value AS price, "
    "CAST(json_extract_string(props, '$.k') AS DOUBLE) AS amount FROM events"
)
BIG_SQL = (
    "SELECT o_orderpriority AS symbol, o_orderkey AS seq, o_orderdate AS ts, o_totalprice AS price, "
    "CAST(1.0 AS DOUBLE) AS amount FROM orders"
)


def _tie_keys(tie: str | None) -> tuple[str, str]:
    if tie is None:
        return "ts", "ts"
    s = "-seq" if tie == "prepend" else "seq"
    k = "{'t': ts, 's': " + s + "}"
    return k, k


def _bar_aggs(tie: str | None) -> str:
    ok, ck = _tie_keys(tie)
    return (
        f"arg_min(price, {ok}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {ck}) AS close, "
        "sum(amount) AS volume, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts"
    )


def _zoned_begin(ts: str, zone: str) -> str:
    return (
        f"timezone('UTC', timezone('{zone}', date_trunc('day', timezone('{zone}', timezone('UTC', {ts})))))"
    )


def _bars_sql(source: str, begin: str, length: str, tie: str | None) -> str:
    return (
        f"WITH t AS ({source}), k AS (SELECT *, {begin} AS b FROM t) "
        f"SELECT symbol, b AS \"begin\", b + INTERVAL {length} AS \"end\", {_bar_aggs(tie)} "
        "FROM k GROUP BY symbol, b"
    )


def _runs_sql(source: str, begin: str, length: str) -> str:
    return (
        f"WITH t AS ({source}), k AS (SELECT *, {begin} AS b FROM t), "
        "l AS (SELECT *, CASE WHEN lag(b) OVER (PARTITION BY symbol ORDER BY seq) IS NOT DISTINCT FROM b "
        "THEN 0 ELSE 1 END AS chg FROM k), "
        "r AS (SELECT *, sum(chg) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND CURRENT ROW) AS run_id FROM l) "
        f"SELECT symbol, CAST(run_id AS BIGINT) AS run_id, b AS \"begin\", b + INTERVAL {length} AS \"end\", "
        f"{_bar_aggs('prepend')} FROM r GROUP BY symbol, run_id, b"
    )


def _quotes_sql() -> str:
    return (
        f"WITH t AS ({TRADES_SQL}), k AS (SELECT *, date_trunc('day', ts) AS b FROM t), "
        f"bars AS (SELECT symbol, b, {_bar_aggs('prepend')} FROM k GROUP BY symbol, b) "
        "SELECT symbol, CAST(b AS DATE) AS date, open, high, low, close, CAST(volume AS BIGINT) AS volume, "
        "close AS adj_close FROM bars"
    )


def _sma_sql(n: int) -> str:
    return (
        f"WITH t AS ({TRADES_SQL}), s AS (SELECT *, "
        f"avg(price) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS m, "
        f"count(*) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c "
        f"FROM t) SELECT symbol, seq, ts, price, amount, round(m, 6) AS price_sma_{n} FROM s WHERE c = {n}"
    )


#: Trades with the begin of the interval they stay in: the day before where that is the one the trade before left.
_KEPT_SQL = (
    f"WITH k AS (SELECT * REPLACE (ts + INTERVAL 60 DAY AS ts) FROM ({TRADES_SQL})), "
    f"i AS (SELECT *, {_zoned_begin('ts', ZONE)} AS own FROM k), "
    f"o AS (SELECT *, {_zoned_begin('(own - INTERVAL 1 MICROSECOND)', ZONE)} AS day_before FROM i), "
    "a AS (SELECT *, CASE WHEN day_before + INTERVAL 24 HOUR > ts THEN day_before END AS other FROM o), "
    "p AS (SELECT *, lag(own) OVER w AS own1, lag(other) OVER w AS other1 FROM a WINDOW w AS (PARTITION BY symbol ORDER BY seq)), "
    "v AS (SELECT *, CASE WHEN other IS NULL THEN own WHEN other1 = other AND own1 = own THEN NULL "
    "WHEN other1 IS NULL AND own1 = other THEN other ELSE own END AS kept FROM p) "
    "SELECT symbol, seq, ts, price, amount, last_value(kept IGNORE NULLS) OVER "
    "(PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kept_begin FROM v"
)

ORACLE: dict[str, str] = {
    "ohlcv_daily": _bars_sql(TRADES_SQL, "date_trunc('day', ts)", "1 DAY", "prepend"),
    "ohlcv_daily_hash": _bars_sql(TRADES_SQL, "date_trunc('day', ts)", "1 DAY", None),
    "ohlcv_hourly": _bars_sql(TRADES_SQL, "date_trunc('hour', ts)", "1 HOUR", "prepend"),
    "ohlcv_daily_zoned": _bars_sql(TRADES_SQL, _zoned_begin("ts", ZONE), "24 HOUR", "prepend"),
    "ohlcv_daily_offset": _bars_sql(
        TRADES_SQL, "date_trunc('day', ts + INTERVAL 330 MINUTE) - INTERVAL 330 MINUTE", "24 HOUR", "prepend"
    ),
    "ohlcv_prepend": _bars_sql(BIG_SQL, "date_trunc('day', ts)", "1 DAY", "prepend"),
    "ohlcv_append": _bars_sql(BIG_SQL, "date_trunc('day', ts)", "1 DAY", "append"),
    "ohlcv_symbol": f"WITH t AS ({BIG_SQL}) SELECT symbol, {_bar_aggs('prepend')} FROM t GROUP BY symbol",
    "ohlcv_rollup": _bars_sql(TRADES_SQL, "date_trunc('day', ts)", "1 DAY", "prepend"),
    "ohlcv_merge": _bars_sql(BIG_SQL, "date_trunc('day', ts)", "1 DAY", "prepend"),
    "ohlcv_runs": _runs_sql(BIG_SQL, "date_trunc('day', ts)", "1 DAY"),
    "ohlcv_runs_hourly": _runs_sql(TRADES_SQL, "date_trunc('hour', ts)", "1 HOUR"),
    "sma_10": _sma_sql(10),
    "sma_200": _sma_sql(200),
    "sma_chain": (
        f"WITH q AS ({_quotes_sql()}), s AS (SELECT *, "
        "row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS pos, "
        "count(*) OVER (PARTITION BY symbol) AS len, "
        "avg(adj_close) OVER (PARTITION BY symbol ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS m3, "
        "avg(adj_close) OVER (PARTITION BY symbol ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS m5 "
        "FROM q) SELECT symbol, date, open, high, low, close, volume, adj_close, round(m3, 6) AS adj_close_sma_3, "
        "round(m5, 6) AS adj_close_sma_5 FROM s WHERE pos <= len - 6"
    ),
    "compound_index": (
        f"WITH t AS ({TRADES_SQL}) SELECT symbol, seq, ts, round(100.0 * exp(sum(ln(abs(1 + (amount - 50.0) / 10000.0))) "
        "OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS \"index\" FROM t"
    ),
    "row_position": (
        f"WITH t AS ({TRADES_SQL}) SELECT symbol, seq, "
        "CAST(row_number() OVER (PARTITION BY symbol ORDER BY seq) AS BIGINT) AS rn FROM t"
    ),
    "row_position_ts": (
        f"WITH t AS ({TRADES_SQL}) SELECT symbol, seq, "
        "CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS BIGINT) AS rn FROM t"
    ),
    "row_position_sparse": (
        f"WITH t AS ({TRADES_SQL}) SELECT symbol, seq * 4194304 AS wide, "
        "CAST(row_number() OVER (PARTITION BY symbol ORDER BY seq) AS BIGINT) AS rn, "
        "count(*) OVER (PARTITION BY symbol) AS n FROM t"
    ),
    "lag_change": (
        f"WITH t AS ({BIG_SQL}) SELECT symbol, seq, "
        "lag(ts) OVER (PARTITION BY symbol ORDER BY seq) IS DISTINCT FROM ts AS changed FROM t"
    ),
    "zip_join": (
        f"WITH t AS ({TRADES_SQL}), b AS ({_bars_sql(TRADES_SQL, "date_trunc('hour', ts)", "1 HOUR", "prepend")}), "
        "l AS (SELECT symbol, seq, price, row_number() OVER (PARTITION BY symbol ORDER BY seq) AS rn FROM t), "
        'r AS (SELECT symbol, "begin", n, row_number() OVER (PARTITION BY symbol ORDER BY "begin" DESC) AS rn FROM b) '
        'SELECT l.symbol, CAST(l.rn AS BIGINT) AS rn, l.seq AS l_seq, l.price AS l_price, r."begin" AS r_begin, r.n AS r_n '
        "FROM l JOIN r ON l.symbol = r.symbol AND l.rn = r.rn"
    ),
    "sma_2000": _sma_sql(2000),
    "sma_col": (
        f"WITH t AS ({TRADES_SQL}), s AS (SELECT *, "
        "avg(amount) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS m, "
        "count(*) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS c FROM t) "
        "SELECT symbol, seq, CAST(amount AS VARCHAR) AS amount, printf('%.2f', m) AS amount_sma_4 FROM s WHERE c = 4"
    ),
    "append_sma": (
        f"WITH q AS ({_quotes_sql()}), s AS (SELECT *, count(*) OVER w AS c, avg(adj_close) OVER w AS m FROM q "
        "WINDOW w AS (PARTITION BY symbol ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) "
        "SELECT * EXCLUDE (c, m), round(m, 6) AS adj_close_sma_3 FROM s WHERE c = 3"
    ),
    "ohlcv_by_interval": _bars_sql(BIG_SQL, "date_trunc('day', ts)", "1 DAY", "append"),
    "ohlcv_runs_zoned": _runs_sql(
        f"SELECT * FROM ({TRADES_SQL}) WHERE seq % 13 <> 0", _zoned_begin("ts", ZONE), "24 HOUR"
    ),
    "ohlcv_runs_contained": _runs_sql(_KEPT_SQL, "kept_begin", "24 HOUR"),
    "ohlcv_stable": _bars_sql(TRADES_SQL, "date_trunc('day', ts)", "1 DAY", "prepend"),
    "sma_decimal": (
        f"WITH t AS (SELECT symbol, seq, CAST(price AS DECIMAL(18,4)) AS exact FROM ({TRADES_SQL})), s AS (SELECT *, "
        "CAST(sum(exact) OVER w * 10000 AS HUGEINT) * 10000 AS total, count(*) OVER w AS c FROM t "
        "WINDOW w AS (PARTITION BY symbol ORDER BY seq ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)), "
        "u AS (SELECT *, (2 * total + 7) // 14 AS m FROM s WHERE c = 7) "
        "SELECT symbol, seq, CAST(exact AS VARCHAR) AS exact, CAST(m // 100000000 AS VARCHAR) || '.' || "
        "lpad(CAST(m % 100000000 AS VARCHAR), 8, '0') AS exact_sma_7 FROM u"
    ),
    "arrival_timeline": (
        f"WITH t AS ({TRADES_SQL}) SELECT symbol, seq, TIMESTAMP '{TIMELINE_START}' + to_microseconds(CAST("
        "sum(CAST(round(amount / 100.0 * 1000000) AS BIGINT)) OVER (PARTITION BY symbol ORDER BY seq "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)) AS arrival_ts FROM t"
    ),
    "interarrival_stats": (
        f"WITH t AS ({TRADES_SQL}), g AS (SELECT symbol, "
        "(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY symbol ORDER BY seq))) / 1e6 AS gap FROM t) "
        "SELECT symbol, count(*) AS n, count(gap) AS n_gaps, round(avg(gap), 6) AS mean_gap_s, "
        "round(min(gap), 6) AS min_gap_s, round(max(gap), 6) AS max_gap_s FROM g GROUP BY symbol"
    ),
    "rate_quantities": (
        f"WITH t AS ({TRADES_SQL}) SELECT symbol, seq, (amount + 1.0) * (price / {RATE[1]}) AS qty_for, "
        f"{EMIT_RATE[1]} * ((amount + 1.0) / {EMIT_RATE[0]}) AS dur_for FROM t"
    ),
    "quotes_lookback": (
        f"SELECT * FROM ({_quotes_sql()}) WHERE date BETWEEN DATE '2024-01-20' AND DATE '{AS_OF.isoformat()}'"
    ),
    "trades_symbol": f"SELECT * FROM ({TRADES_SQL}) WHERE symbol = '{SYMBOL_EXCHANGE}{SYMBOL_CURRENCY}'",
    "interval_filter": (
        f"SELECT * FROM ({TRADES_SQL}) WHERE ts >= TIMESTAMP '{INTERVAL_BEGIN}' AND ts < TIMESTAMP '{INTERVAL_END}'"
    ),
}

QUERIES: dict[str, QueryFn] = {
    "ohlcv_daily": q_ohlcv_daily,
    "ohlcv_daily_hash": q_ohlcv_daily_hash,
    "ohlcv_hourly": q_ohlcv_hourly,
    "ohlcv_daily_zoned": q_ohlcv_daily_zoned,
    "ohlcv_daily_offset": q_ohlcv_daily_offset,
    "ohlcv_prepend": q_ohlcv_prepend,
    "ohlcv_append": q_ohlcv_append,
    "ohlcv_symbol": q_ohlcv_symbol,
    "ohlcv_rollup": q_ohlcv_rollup,
    "ohlcv_merge": q_ohlcv_merge,
    "ohlcv_runs": q_ohlcv_runs,
    "ohlcv_runs_hourly": q_ohlcv_runs_hourly,
    "sma_10": q_sma_10,
    "sma_200": q_sma_200,
    "sma_chain": q_sma_chain,
    "sma_exact_chain": q_sma_exact_chain,
    "compound_index": q_compound_index,
    "row_position": q_row_position,
    "zip_join": q_zip_join,
    "row_position_ts": q_row_position_ts,
    "row_position_sparse": q_row_position_sparse,
    "lag_change": q_lag_change,
    "sma_2000": q_sma_2000,
    "sma_col": q_sma_col,
    "append_sma": q_append_sma,
    "ohlcv_by_interval": q_ohlcv_by_interval,
    "ohlcv_runs_zoned": q_ohlcv_runs_zoned,
    "arrival_timeline": q_arrival_timeline,
    "interarrival_stats": q_interarrival_stats,
    "ohlcv_runs_contained": q_ohlcv_runs_contained,
    "sma_decimal": q_sma_decimal,
    "ohlcv_stable": q_ohlcv_stable,
    "rate_quantities": q_rate_quantities,
    "quotes_lookback": q_quotes_lookback,
    "trades_symbol": q_trades_symbol,
    "interval_filter": q_interval_filter,
}

# the running sum as a recursion over positions, newest first: sum + x - head, in this order
ORACLE["sma_exact_chain"] = (
    f"WITH RECURSIVE q AS ({_quotes_sql()}), p AS (SELECT *, row_number() OVER w AS pos, "
    "count(*) OVER (PARTITION BY symbol) AS len, lag(adj_close, 3) OVER w AS h3, lag(adj_close, 5) OVER w AS h5 "
    "FROM q WINDOW w AS (PARTITION BY symbol ORDER BY date DESC)), r AS ("
    "SELECT symbol, pos, adj_close AS s3, adj_close AS s5 FROM p WHERE pos = 1 UNION ALL "
    "SELECT p.symbol, p.pos, CASE WHEN h3 IS NULL THEN s3 + adj_close ELSE s3 + adj_close - h3 END, "
    "CASE WHEN h5 IS NULL THEN s5 + adj_close ELSE s5 + adj_close - h5 END "
    "FROM r JOIN p ON p.symbol = r.symbol AND p.pos = r.pos + 1) "
    "SELECT p.* EXCLUDE (pos, len, h3, h5), a.s3 / 3 AS adj_close_sma_3, b.s5 / 5 AS adj_close_sma_5 FROM p "
    "JOIN r AS a ON a.symbol = p.symbol AND a.pos = p.pos + 2 JOIN r AS b ON b.symbol = p.symbol AND b.pos = p.pos + 4 "
    "WHERE p.pos <= p.len - 6"
)
