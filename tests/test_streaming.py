"""Streams equal batch: bars, SMA and runs over several micro-batches, whatever order the input comes in."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from tidemark.operators import bars as B
from tidemark.operators import indicators as I
from tidemark.session import scratch_path
from tidemark.sources import testdata as TD
from tidemark.streaming import bars as SB
from tidemark.streaming import sources as SS
from tidemark.streaming import stateful as ST
from tidemark.streaming.processors import trailing_means

COLS = ["symbol", "begin", "end", *B.BAR_COLUMNS]


def _sorted(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _ordered_batches(spark, t, days):
    """Write trades in arrival order as one directory of files, one write per day."""
    path = scratch_path(spark, "ordered")
    for d in days:
        t.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.mode("append").parquet(path)
    return path


def _unordered(spark, files=9):
    """Trades without order over many files, some without a symbol or a time; one is far older than the rest."""
    t = TD.trades(spark, SF_SMALL).withColumn("symbol", F.expr("CASE WHEN seq % 7 != 0 THEN symbol ELSE IF(seq % 2 = 0, '__end__', NULL) END"))
    t = t.withColumn("ts", F.expr("CASE WHEN seq = 3 THEN timestamp_ntz '1999-01-01 01:00:00' WHEN seq % 31 != 0 THEN ts END"))
    path = scratch_path(spark, "unordered")
    t.repartition(files, F.hash("seq")).write.parquet(path)
    return t, path


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every state partition starts a Python worker per batch; two are enough to see rows spread."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("period", ["hourly", "daily(+05:30)", "daily(America/New_York)"])
def test_stream_bars_keep_every_trade(spark, period):
    t, path = _unordered(spark, 4)
    stream = SS.parquet_stream(spark, path, schema=t.schema, max_files_per_trigger=1)
    out, ck = scratch_path(spark, "bars"), scratch_path(spark, "ck")
    SB.stream_ohlcv(stream, out, ck, period).awaitTermination()
    got = SB.read_bars(spark, out, ck, period)
    assert _sorted(got.fillna("null"), COLS) == _sorted(B.periodic_ohlcv(t, period).fillna("null"), COLS)
    assert got.agg(F.sum("n")).first()[0] == t.where("ts IS NOT NULL").count()


def test_final_bars_come_once_and_corrections_hold_the_rest(spark):
    """In order of time nothing is corrected but what a file's border cuts; with a delay nothing at all."""
    t = TD.trades(spark, SF_SMALL).where("ts IS NOT NULL")
    days = sorted({r[0] for r in t.select(F.to_date("ts")).distinct().collect()})[:5]
    t = t.where(F.to_date("ts").isin(days))
    path = _ordered_batches(spark, t, days)
    stream = SS.parquet_stream(spark, path, schema=t.schema, max_files_per_trigger=1)
    out, ck = scratch_path(spark, "bars"), scratch_path(spark, "ck")
    SB.stream_ohlcv(stream, out, ck, "hourly", delay_s=2 * 86400, rollup="daily").awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.where("kind = 'correction'").count() == 0
    finals, whole = SB.read_final_bars(spark, out), B.periodic_ohlcv(t, "hourly")
    assert finals.count() == finals.select("symbol", "begin").distinct().count() > 0
    assert set(_sorted(finals, COLS)) < set(_sorted(whole, COLS))
    open_ = SB.read_open_bars(spark, ck, "hourly")
    assert _sorted(finals.unionByName(open_), COLS) == _sorted(whole, COLS)
    daily = SB.read_final_bars(spark, out, "daily")
    assert daily.count() > 0 and set(_sorted(daily, COLS)) <= set(_sorted(B.periodic_ohlcv(t, "daily"), COLS))


def test_one_query_for_hours_and_days_starts_again_where_it_stopped(spark):
    t, path = _unordered(spark, 1)
    inbox, out, ck = (scratch_path(spark, x) for x in ("inbox", "bars", "ck"))
    for k in range(2):  # two runs of one query
        spark.read.schema(t.schema).parquet(path).where(f"seq % 2 = {k}").repartition(2).write.mode("append").parquet(inbox)
        stream = SS.parquet_stream(spark, inbox, schema=t.schema, max_files_per_trigger=1)
        SB.stream_ohlcv(stream, out, ck, "hourly", rollup="daily").awaitTermination()
    for got, period in ((SB.read_bars(spark, out, ck), "hourly"), (SB.read_rollup(spark, out, ck), "daily")):
        assert _sorted(got.fillna("null"), COLS) == _sorted(B.periodic_ohlcv(t, period).fillna("null"), COLS)
    finals = SB.read_final_bars(spark, out)
    assert finals.count() == finals.select("symbol", "begin").distinct().count()
    with pytest.raises(ValueError):
        SB.bars_stream(stream, "hourly", rollup="daily(Asia/Kolkata)")


@pytest.fixture(scope="module")
def multi_batch(spark):
    t = TD.trades(spark, SF_SMALL)
    days = sorted({r[0] for r in t.select(F.to_date("ts")).distinct().collect()})[:11]
    t = t.where(F.to_date("ts").isin(days))
    return t, _ordered_batches(spark, t, days)


def _means(df):
    return {(r.symbol, r.seq): r.price_sma_5 for r in df.collect()}


def test_stream_sma_over_batches_and_a_restart(spark, multi_batch):
    t, path = multi_batch
    out, ck = scratch_path(spark, "o"), scratch_path(spark, "ck")
    stream = SS.parquet_stream(spark, path, schema=t.schema, max_files_per_trigger=1)
    ST.stream_sma(stream, out, ck, 5, "price", stripe=64).awaitTermination()
    more = t.withColumn("seq", F.col("seq") + 1_000_000).coalesce(1)
    more.write.mode("append").parquet(path)
    ST.stream_sma(stream, out, ck, 5, "price", stripe=64).awaitTermination()  # goes on from the checkpoint
    got, want = _means(ST.read_outputs(spark, out)), _means(I.sma(t.unionByName(more), "price", 5))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert ST.read_outputs(spark, out).count() == len(want)


def test_stream_runs_over_batches(spark, multi_batch):
    t, path = multi_batch
    t = spark.read.schema(t.schema).parquet(path)
    stream = SS.parquet_stream(spark, path, schema=t.schema, max_files_per_trigger=1)
    out = scratch_path(spark, "o")
    ST.stream_runs(stream, out, scratch_path(spark, "ck"), "hourly", stripe=128).awaitTermination()
    got = ST.finalize_runs(ST.read_outputs(spark, out))
    cols = ["symbol", "run_id", "begin", "end", *B.BAR_COLUMNS]
    assert _sorted(got, cols) == _sorted(B.ohlcv_runs(t, "hourly"), cols)


@pytest.mark.parametrize("n, stripe", [(1, 7), (3, 4), (9, 4)])
def test_sma_of_symbols_that_come_and_go(spark, n, stripe):
    """Null symbols, missing and infinite values, stripes with fewer rows than a frame."""
    t = spark.range(60).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id < 20 OR id > 50 THEN 'x' ELSE 'y' END AS symbol", "id AS seq",
        "CASE WHEN id % 11 = 5 THEN NULL WHEN id = 33 THEN double('inf') ELSE id * 1.5D END AS price")
    path = scratch_path(spark, "gaps")
    for i in range(4):
        t.where(f"seq >= {15 * i} AND seq < {15 * i + 15}").coalesce(1).write.mode("append").parquet(path)
    stream = SS.parquet_stream(spark, path, schema=t.schema, max_files_per_trigger=1)
    out = scratch_path(spark, "o")
    ST.stream_sma(stream, out, scratch_path(spark, "ck"), n, out="price_sma_5", stripe=stripe).awaitTermination()
    got, want = _means(ST.read_outputs(spark, out)), _means(I.moving_averages(t, "price", [n], names=["price_sma_5"]))
    same = lambda a, b: a == b or a is None and b != b or b is None and a != a or abs(a - b) < 1e-9
    assert got.keys() == want.keys() and all(same(got[k], want[k]) for k in want)


@pytest.mark.parametrize("n", [1, 2, 5, 7])
def test_trailing_means_equal_plain_sums(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=40) * 10.0 ** rng.integers(-8, 8, 40)
    x[[3, 17]] = np.nan
    x[25] = np.inf
    got = trailing_means(x, n)
    assert len(got) == 41 - n and len(trailing_means(x[: n - 1], n)) == 0
    for i, g in enumerate(got):
        own = [v for v in x[i : i + n] if v == v]
        assert (g != g) if not own else g == pytest.approx(sum(own) / len(own), rel=1e-12)


def test_csv_stream_in_arrival_order(spark):
    from tidemark.sources import records as R
    from tidemark.streaming import records as SR

    root, folder, out = (scratch_path(spark, x) for x in ("raw", "numbered", "o"))
    hours = [5, 5, 6, 5, 7, 7, 5]
    for k, part in enumerate([hours[:3], hours[3:4], hours[4:]]):
        lines = [(f"{1442016000 + 3600 * h},{i}.0,1",) for i, h in enumerate(part)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").option("lineSep", "\n").text(f"{root}/symbol=s/f={k}")
    read = spark.readStream.option("lineSep", "\n").schema("value string, symbol string, f int").text(root)
    SS.run_foreach_batch(read.selectExpr("value", "symbol", *R.SPLIT_COLUMNS), SR.OrderedTrades(ST.to_folder(folder)))
    numbered = SS.parquet_stream(spark, folder)
    ST.stream_runs(numbered, out, scratch_path(spark, "ck"), "hourly").awaitTermination()
    bars = ST.finalize_runs(ST.read_outputs(spark, out)).orderBy("run_id").collect()
    assert [(r.run_id, r.begin.hour, r.n) for r in bars] == [(1, 5, 2), (2, 6, 1), (3, 5, 1), (4, 7, 2), (5, 5, 1)]
    ST.to_folder(folder)(spark.range(3), 0)  # a batch that was written stays as it is
    assert spark.read.parquet(folder).count() == 7


def test_gap_summaries_merge_however_the_stream_is_cut(spark):
    from tidemark.operators import timeline as TL
    from tidemark.streaming import gaps as SG

    t = spark.range(90).selectExpr("CASE WHEN id % 4 = 0 THEN NULL ELSE concat('s', id % 3) END AS symbol", "id AS seq",
                                   "CASE WHEN id % 13 != 5 THEN timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, (id * 37 % 50) * 1.5) END AS ts")
    want = {r.symbol: tuple(r)[1:] for r in TL.interarrival_stats(t.where("ts IS NOT NULL")).collect()}
    for cuts, stripe in (([0, 1, 30, 31, 90], 8), ([0, 90], 1000)):
        path, out = scratch_path(spark, "gaps"), scratch_path(spark, "o")
        for a, b in zip(cuts, cuts[1:]):
            t.where(f"seq >= {a} AND seq < {b}").coalesce(1).write.mode("append").parquet(path)
        stream = SS.parquet_stream(spark, path, schema=t.schema, max_files_per_trigger=1)
        SG.stream_gaps(stream, out, scratch_path(spark, "ck"), stripe=stripe).awaitTermination()
        got = {r.symbol: tuple(r)[1:] for r in SG.read_gap_stats(spark, out).collect()}
        assert got.keys() == want.keys()
        assert all(a == pytest.approx(b, abs=1e-9) for k in want for a, b in zip(got[k], want[k]))
    df = spark.createDataFrame([(9.5,), (12.0,), (None,)], "mean_gap_s double")
    assert [r[0] for r in df.select(SG.meets_rate(6, 60)).collect()] == [True, False, None]


def test_json_stream(spark):
    from tidemark.streaming import records as SR

    good = '{"timestamp":"2015-09-12T00:00:01.5Z","price":2.5,"amount":3}'
    for lines, strict, bad in (([good, good], True, None), ([good, "{}"], False, [False, True]), ([good, '{"price":1}'], True, "fails")):
        root, out = scratch_path(spark, "json"), scratch_path(spark, "o")
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/symbol=a")
        stream = SR.stream_decode_json(spark, root, strict=strict)
        if bad == "fails":
            with pytest.raises(Exception, match="JSON record without|Malformed|STREAM_FAILED"):
                SS.run_available_now(stream, out)
            continue
        rows = SS.run_available_now(stream, out).collect()
        assert [r.symbol for r in rows] == ["a", "a"] and rows[0].seq is None
        if bad is not None:
            assert sorted(r.bad for r in rows) == bad
        assert sum(r.price or 0 for r in rows) == 2.5 * sum(x == good for x in lines)


def test_two_streams_of_unequal_pace_pair_by_position(spark):
    from tidemark.operators.zipping import zip_join
    from tidemark.streaming import zipping as SZ

    t = spark.range(120).selectExpr("CASE WHEN id % 5 = 0 THEN NULL ELSE concat('s', id % 2) END AS symbol", "id AS seq",
                                    "timestamp_ntz'2024-01-01 00:00:00.000123' + make_dt_interval(0, 0, 0, id) AS ts", "IF(id % 9 = 2, NULL, id / 7.0D) AS price")
    u = spark.range(50).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE concat('s', id % 2) END AS symbol", "id * 3 AS at", "IF(id = 4, double('nan'), double(id)) AS v")
    a, b, out = (scratch_path(spark, x) for x in ("left", "right", "o"))
    for k in range(4):
        t.where(f"seq >= {30 * k} AND seq < {30 * k + 30}").coalesce(1).write.mode("append").parquet(a)
    for k in range(2):
        u.where(f"at >= {75 * k} AND at < {75 * k + 75}").coalesce(1).write.mode("append").parquet(b)
    left, right = (SS.parquet_stream(spark, p, schema=df.schema, max_files_per_trigger=1) for p, df in ((a, t), (b, u)))
    SZ.stream_zip(left, right, out, scratch_path(spark, "ck"), right_order="at", stripe=16, block=8).awaitTermination()
    got = spark.read.parquet(out)
    want = zip_join(t, u, right_order="at")
    rows = lambda df: sorted(str(tuple(r)) for r in df.select("symbol", "rn", "l_seq", "l_ts", "l_price", "r_at", "r_v").collect())
    assert rows(got) == rows(want) and got.count() > 30


def test_rows_wait_for_a_slow_stream_as_few_entries_of_the_state(spark):
    from tidemark.operators.zipping import zip_join
    from tidemark.streaming import zipping as SZ

    def batches(name, sizes):
        path, at = scratch_path(spark, name), -700  # orders below zero, batches that end within a stripe
        for n in sizes:
            rows = spark.range(at, at + n).selectExpr("IF(pmod(id, 3) = 0, NULL, 's') AS symbol", "id AS seq", "concat(id, '\\n', '\"') AS note")
            rows.orderBy(F.desc("seq")).coalesce(1).write.mode("append").parquet(path)
            at += n
        return spark.read.parquet(path), SS.parquet_stream(spark, path, schema=rows.schema, max_files_per_trigger=1)

    (t, left), (u, right) = batches("left", [700, 10, 1500, 20]), batches("right", [30, 40, 900, 300])
    out = scratch_path(spark, "o")
    q = SZ.stream_zip(left, right, out, scratch_path(spark, "ck"), stripe=32, block=64, partitions=2)
    q.awaitTermination()
    got, want = spark.read.parquet(out), zip_join(t, u)
    rows = lambda df: sorted(str(tuple(r)) for r in df.select("symbol", "rn", "l_seq", "l_note", "r_seq", "r_note").collect())
    assert rows(got) == rows(want) and got.count() == 1270
    waiting = [x["stateOperators"] for x in q.recentProgress][-1]
    assert sum(op["numRowsTotal"] for op in waiting) < 200  # 960 rows of the left stream wait


def test_tasks_of_a_state_that_grows_with_its_table(spark):
    from tidemark.plans import catalog_io as C

    assert [C._state_partitions(spark.range(n)) for n in (0, 100_000, 6_000_001)] == [C.STATE_PARTITIONS, C.STATE_PARTITIONS, 7]
