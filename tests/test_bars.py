import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import fold, runs
from tidemark.operators import bars as B
from tidemark.sources import testdata as TD

T0 = dt.datetime(2015, 9, 15, 12, 0, 0)
SCHEMA = "symbol string, seq long, ts timestamp_ntz, price double, amount double"

# Fold tables (FIXTURES F4): (ts offset s, price, amount) -> state after each trade
PREPEND = [
    ((0, 100, 50), (100, 100, 100, 100, 50, 1, 0, 0)),
    ((0, 90, 50), (90, 100, 90, 100, 100, 2, 0, 0)),
    ((-1, 80, 50), (80, 100, 80, 100, 150, 3, -1, 0)),
    ((-2, 110, 50), (110, 110, 80, 100, 200, 4, -2, 0)),
    ((3, 130, 50), (110, 130, 80, 130, 250, 5, -2, 3)),
]
APPEND = [
    ((0, 100, 50), (100, 100, 100, 100, 50, 1, 0, 0)),
    ((0, 90, 50), (100, 100, 90, 90, 100, 2, 0, 0)),
    ((1, 80, 50), (100, 100, 80, 80, 150, 3, 0, 1)),
    ((2, 110, 50), (100, 110, 80, 110, 200, 4, 0, 2)),
    ((-3, 130, 50), (130, 130, 80, 110, 250, 5, -3, 2)),
]


def _prefix_frame(spark, table):
    rows = []
    for k in range(1, len(table) + 1):
        for seq, ((off, price, amount), _) in enumerate(table[:k]):
            rows.append((f"p{k}", seq, T0 + dt.timedelta(seconds=off), float(price), float(amount)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("rule,table", [("prepend", PREPEND), ("append", APPEND)])
def test_fold_tables(spark, rule, table):
    got = {r["symbol"]: r for r in B.ohlcv(_prefix_frame(spark, table), ["symbol"], rule).collect()}
    for k, (_, exp) in enumerate(table, start=1):
        r = got[f"p{k}"]
        o, h, lo, c, v, n, first, last = exp
        assert (r.open, r.high, r.low, r.close, r.volume, r.n) == (o, h, lo, c, v, n)
        assert r.first_ts == T0 + dt.timedelta(seconds=first)
        assert r.last_ts == T0 + dt.timedelta(seconds=last)


@pytest.mark.parametrize("rule", ["prepend", "append"])
def test_fold_parity_random_ties(spark, rule):
    rnd = random.Random(7)
    rows, groups = [], {}
    seq = 0
    for g in range(300):
        for _ in range(rnd.randint(1, 12)):
            ts = T0 + dt.timedelta(seconds=rnd.randint(0, 3))
            price = float(rnd.randint(1, 50))
            rows.append((f"g{g}", seq, ts, price, 1.0))
            groups.setdefault(f"g{g}", []).append((ts, price, 1.0))
            seq += 1
    rnd.shuffle(rows)  # arrival order is seq, not row order
    got = {r["symbol"]: r for r in B.ohlcv(spark.createDataFrame(rows, SCHEMA), ["symbol"], rule).collect()}
    for g, trades in groups.items():
        exp = fold(trades, rule)
        r = got[g]
        assert (r.open, r.high, r.low, r.close, r.n) == (exp["open"], exp["high"], exp["low"], exp["close"], exp["n"])
        assert (r.first_ts, r.last_ts) == (exp["first"], exp["last"])


def test_nan_propagates_to_high_and_low(spark):
    rows = [("a", 0, T0, 1.0, 1.0), ("a", 1, T0 + dt.timedelta(seconds=1), float("nan"), 1.0),
            ("a", 2, T0 + dt.timedelta(seconds=2), 3.0, 1.0)]
    r = B.ohlcv(spark.createDataFrame(rows, SCHEMA), ["symbol"]).first()
    assert math.isnan(r.high) and math.isnan(r.low)
    assert r.open == 1.0 and r.close == 3.0


def test_empty_input_gives_no_bar(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert B.periodic_ohlcv(empty, "daily").count() == 0
    assert B.ohlcv(empty, []).count() == 0


def test_merge_law_with_ties(spark):
    t = TD.trades_big(spark, "/root/testdata/sf0.001")
    direct = B.periodic_ohlcv(t, "daily", "prepend", with_seq=True)
    x = B.periodic_ohlcv(t.where(F.col("price") < 250000), "daily", "prepend", with_seq=True)
    y = B.periodic_ohlcv(t.where(F.col("price") >= 250000), "daily", "prepend", with_seq=True)
    merged = B.merge_ohlcv(x.unionByName(y), ["symbol", "begin", "end"], "prepend")
    cols = ["symbol", "begin", "end", *B.BAR_COLUMNS, *B.SEQ_COLUMNS]
    assert sorted(map(tuple, merged.select(*cols).collect())) == sorted(map(tuple, direct.select(*cols).collect()))


def test_hourly_rollup_equals_daily(spark):
    t = TD.trades(spark, "/root/testdata/sf0.001")
    hourly = B.periodic_ohlcv(t, "hourly", "prepend", with_seq=True)
    rolled = B.rollup_ohlcv(hourly, "daily")
    direct = B.periodic_ohlcv(t, "daily", "prepend", with_seq=True)
    cols = ["symbol", "begin", "end", *B.BAR_COLUMNS]
    assert sorted(map(tuple, rolled.select(*cols).collect())) == sorted(map(tuple, direct.select(*cols).collect()))


def test_runs_follow_arrival_order_across_blocks(spark):
    rnd = random.Random(3)
    rows = []
    for sym, n in (("hot", 400), ("cold", 60)):
        for i in range(n):
            ts = T0 + dt.timedelta(hours=rnd.choice([0, 0, 1, 5, 30]))
            rows.append((sym, i * 3 + rnd.randint(0, 2), ts, float(rnd.randint(1, 9)), 1.0))
    df = spark.createDataFrame(rows, SCHEMA)
    got = B.assign_runs(df, "hourly", block_size=16).select("symbol", "seq", "run_id").collect()
    got = {(r.symbol, r.seq): r.run_id for r in got}
    for sym in ("hot", "cold"):
        ordered = sorted((r for r in rows if r[0] == sym), key=lambda r: r[1])
        keys = [r[2].replace(minute=0, second=0) for r in ordered]
        for r, rid in zip(ordered, runs(keys)):
            assert got[(sym, r[1])] == rid
    bars = B.ohlcv_runs(df, "hourly", block_size=16)
    assert bars.agg(F.sum("n")).first()[0] == len(rows)


def test_tie_break_none_is_hash_aggregate(spark):
    t = TD.trades(spark, "/root/testdata/sf0.001")
    plan = B.periodic_ohlcv(t, "daily", None)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rollup_refuses_half_hour_zones(spark):
    from tidemark.functions.periods import parse_period, whole_hour_offsets

    assert whole_hour_offsets(parse_period("daily(America/New_York)"))
    assert not whole_hour_offsets(parse_period("daily(Asia/Kolkata)"))
    assert not whole_hour_offsets(parse_period("daily(+05:30)"))
    t = TD.trades(spark, "/root/testdata/sf0.001")
    hourly = B.periodic_ohlcv(t, "hourly", "prepend", with_seq=True)
    with pytest.raises(ValueError):
        B.rollup_ohlcv(hourly, "daily(Asia/Kolkata)")
    ny = B.rollup_ohlcv(hourly, "daily(America/New_York)").select("symbol", "begin", "n")
    direct = B.periodic_ohlcv(t, "daily(America/New_York)").select("symbol", "begin", "n")
    assert sorted(map(tuple, ny.collect())) == sorted(map(tuple, direct.collect()))


def test_ohlcv_by_interval(spark):
    from tidemark.functions.periods import period_begin, period_end

    t = TD.trades(spark, "/root/testdata/sf0.001")
    keyed = t.withColumn("begin", period_begin("ts", "hourly")).withColumn("end", period_end("begin", "hourly"))
    a = B.ohlcv_by_interval(keyed).collect()
    b = B.periodic_ohlcv(t, "hourly").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("period", ["hourly", "daily", "daily(+05:30)", "daily(America/New_York)"])
def test_null_time_forms_no_bar(spark, period):
    rows = [("a", 0, T0, 1.0, 1.0), ("a", 1, None, 2.0, 1.0)]
    bars = B.periodic_ohlcv(spark.createDataFrame(rows, SCHEMA), period).collect()
    assert len(bars) == 1 and bars[0].n == 1 and bars[0].begin is not None


def test_trades_without_a_time_belong_to_no_run(spark):
    rows = [("a", 1, dt.datetime(2024, 1, 1, 6)), ("a", 2, None), ("a", 3, dt.datetime(2024, 1, 1, 7)), ("a", 4, dt.datetime(2024, 1, 2, 7)), ("b", 5, None)]
    df = spark.createDataFrame([(*r, 1.0, 1.0) for r in rows], "symbol string, seq long, ts timestamp_ntz, price double, amount double")
    for period in ("daily", "daily(America/New_York)", "daily(+05:30)"):
        bars = B.ohlcv_runs(df, period).orderBy("run_id").collect()
        assert [(r.symbol, r.run_id, r.n) for r in bars] == [("a", 1, 2), ("a", 2, 1)] and all(r.begin for r in bars)


def _single_pass(trades, zone):
    """The rule of one pass over the trades: stay while the current interval contains the trade."""
    from zoneinfo import ZoneInfo

    tz, day, out, cur, run = ZoneInfo(zone), dt.timedelta(days=1), [], None, 0
    for ts in trades:
        if cur is None or not cur <= ts < cur + day:
            local = ts.replace(tzinfo=dt.timezone.utc).astimezone(tz).replace(hour=0, minute=0, second=0, microsecond=0)
            new = local.astimezone(dt.timezone.utc).replace(tzinfo=None)
        else:
            new = cur
        run += new != cur
        cur = new
        out.append((run, cur))
    return out


@pytest.mark.parametrize("order", ["ascending", "descending", "shuffled"])
@pytest.mark.parametrize("block", [2, 5, 16])
def test_runs_that_keep_contained_trades(spark, order, block):
    import random

    zone, rng = "America/New_York", random.Random(block)
    spring, autumn = dt.datetime(2024, 3, 10, 5), dt.datetime(2024, 11, 3, 4)
    times = [d + dt.timedelta(minutes=rng.choice([rng.randint(-1500, 3000), rng.randint(22 * 60, 25 * 60), rng.randint(23 * 60, 24 * 60)])) for d in [spring, autumn, dt.datetime(2023, 3, 12, 5)] for _ in range(60)]
    times = {"ascending": sorted, "descending": lambda x: sorted(x, reverse=True), "shuffled": lambda x: rng.sample(x, len(x))}[order](times)
    rows = [(s, i, t, float(i), 1.0) for s in ("a", None) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "symbol string, seq long, ts timestamp_ntz, price double, amount double")
    got = B.assign_runs(df, f"daily({zone})", block_size=block, keep_contained=True).orderBy("seq").collect()
    for symbol in ("a", None):
        assert [(r.run_id, r.begin) for r in got if r.symbol == symbol] == _single_pass(times, zone)
    plain = B.assign_runs(df, f"daily({zone})", block_size=block).collect()
    if order == "ascending":
        assert {r.begin for r in plain} != {r.begin for r in got} or [r.begin for r in sorted(plain, key=lambda r: r.seq)] != [r.begin for r in got]


def test_stable_volumes_are_the_same_to_the_last_bit(spark):
    rng = random.Random(3)
    amounts = [rng.choice([1e-9, 0.1, 1e6, -3.7]) * rng.random() for _ in range(4000)]
    rows = [("a", i, dt.datetime(2024, 1, 1, i % 24), 1.0, a) for i, a in enumerate(amounts)]
    rows += [("b", 1, dt.datetime(2024, 1, 1), 1.0, float("inf")), ("c", 1, dt.datetime(2024, 1, 1), 1.0, None), ("d", 1, dt.datetime(2024, 1, 1), 1.0, float("nan"))]
    df = spark.createDataFrame(rows, "symbol string, seq long, ts timestamp_ntz, price double, amount double")
    seen = set()
    for partitions in (1, 8, 211):
        bars = B.periodic_ohlcv(df.repartition(partitions, "seq"), "daily", "prepend", stable_volume=True).collect()
        seen.add(tuple(sorted((r.symbol, repr(r.volume)) for r in bars)))
    assert len(seen) == 1
    got = dict(seen.pop())
    assert float(got["a"]) == pytest.approx(math.fsum(amounts), rel=1e-12) and got["b"] == "inf" and got["c"] == "None" and got["d"] == "nan"
