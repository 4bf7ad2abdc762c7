import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.formatting import format_2dp, iso_instant, parse_iso_instant
from tidemark.sources import records as R

SPLITS = [
    ("a,b,c", ["a", "b", "c"]),
    ("a , b,  c", ["a", "b", "c"]),
    ("a,b,,", ["a", "b"]),
    ("a,b, , ", ["a", "b"]),
    (" a,b ", [" a", "b "]),
    (",a", ["", "a"]),
    (",,,", []),
    ("", [""]),
    ("a,b\r", ["a", "b\r"]),
    ("a,b,\r", ["a", "b"]),
]


def test_split_row_jvm_rules(spark):
    df = spark.createDataFrame([(s,) for s, _ in SPLITS], "value string")
    got = [r[0] for r in df.select(R.split_row("value")).collect()]
    assert got == [e for _, e in SPLITS]


def _write_text(spark, path, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)


def test_read_trades_file_edges(spark, tmpdir_spark):
    p = tmpdir_spark + "/t"
    _write_text(spark, p, "1442335124,230.1,0.02684316\n1442335125,230.2,1.5\n1442335126,1.0E7,2")
    t = R.read_trades(spark, p, "bitstampUSD").orderBy("seq").collect()
    assert [r.ts for r in t] == [dt.datetime(2015, 9, 15, 16, 38, 44 + i) for i in range(3)]
    assert [r.price for r in t] == [230.1, 230.2, 1.0e7] and t[0].amount == 0.02684316
    assert {r.symbol for r in t} == {"bitstampUSD"}


def test_line_cap_and_bad_rows(spark, tmpdir_spark):
    ok = "1," + "1" * 252 + ",1"  # 256 bytes
    long = ok + "1"  # 257 bytes
    p1, p2, p3 = tmpdir_spark + "/ok", tmpdir_spark + "/long", tmpdir_spark + "/blank"
    _write_text(spark, p1, ok)
    _write_text(spark, p2, long)
    _write_text(spark, p3, "1442335124,1,1\n\n1442335125,1,1")
    assert R.parse_csv(R.read_lines(spark, p1), max_line_bytes=256).count() == 1
    assert R.parse_csv(R.read_lines(spark, p2)).first().row is not None  # no cap unless asked for
    with pytest.raises(Exception):
        R.parse_csv(R.read_lines(spark, p2), max_line_bytes=256).collect()
    quarantined = R.parse_csv(R.read_lines(spark, p2), strict=False, max_line_bytes=256).first()
    assert quarantined.too_long and quarantined.row is None
    kept = R.read_trades(spark, p2, strict=False, max_line_bytes=256).collect()
    assert [(r.bad, r.too_long) for r in kept] == [(True, True)]
    with pytest.raises(Exception):
        R.read_trades(spark, p3).collect()
    lenient = R.read_trades(spark, p3, strict=False).collect()
    assert sorted(r.bad for r in lenient) == [False, False, True]


def test_trades_csv_header_even_when_empty(spark, tmpdir_spark):
    empty = spark.createDataFrame([], "ts timestamp_ntz, price double, amount double")
    R.write_csv(R.trades_to_csv(empty), tmpdir_spark + "/e")
    lines = [r.value for r in spark.read.text(tmpdir_spark + "/e").collect()]
    assert lines == ["timestamp,price,amount"]


def test_text_forms(spark):
    rows = [(dt.datetime(2015, 9, 15), 100.0), (dt.datetime(2015, 9, 15, 0, 0, 1, 123000), 1.0e7),
            (dt.datetime(2015, 9, 15, 0, 0, 1, 123456), 0.125)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double")
    got = df.select(iso_instant("ts").alias("i"), F.col("x").cast("string").alias("s"),
                    format_2dp("x").alias("f")).collect()
    assert [r.i for r in got] == ["2015-09-15T00:00:00Z", "2015-09-15T00:00:01.123Z", "2015-09-15T00:00:01.123456Z"]
    assert [r.s for r in got] == ["100.0", "1.0E7", "0.125"]
    assert [r.f for r in got] == ["100.00", "10000000.00", "0.13"]
    back = df.select(parse_iso_instant(iso_instant("ts")).alias("t")).collect()
    assert [r.t for r in back] == [r[0] for r in rows]


def test_json_round_trip_trade_and_bar(spark):
    t = spark.createDataFrame([(dt.datetime(2015, 9, 15, 1, 2, 3), 100.0, 200.0)], "ts timestamp_ntz, price double, amount double")
    js = R.trades_to_json(t)
    obj = json.loads(js.first().value)
    assert obj == {"timestamp": "2015-09-15T01:02:03Z", "price": 100.0, "amount": 200.0}
    assert [tuple(r) for r in R.trades_from_json(js).collect()] == [tuple(r) for r in t.collect()]
    from tidemark.operators.bars import periodic_ohlcv

    bars = periodic_ohlcv(t.withColumn("symbol", F.lit("s")).withColumn("seq", F.lit(1)), "daily")
    back = R.bars_from_json(R.bars_to_json(bars))
    cols = ["begin", "end", "open", "high", "low", "close", "volume", "n", "first_ts", "last_ts"]
    assert back.select(*cols).collect() == bars.select(*cols).collect()
    bad = spark.createDataFrame([('{"timestamp": 5, "price": 1.0, "amount": 1.0}',)], "value string")
    with pytest.raises(Exception):
        R.trades_from_json(bad).collect()


def test_select_col_and_format_rows(spark):
    df = spark.createDataFrame([("2014-12-31", 24.84)], "`Date` string, `Adj Close` double")
    assert R.select_col(df, "Adj Close").columns == ["Adj Close"]
    with pytest.raises(ValueError):
        R.select_col(df, "Nope")
    assert R.select_col(df, "Nope", strict=False).count() == 0
    assert R.format_rows(df).first().value == "2014-12-31,24.84"


def test_raw_passthrough_prunes_partitions(spark, tmpdir_spark):
    t = spark.createDataFrame(
        [("a", 1, dt.datetime(2015, 9, 15), 1.0, 2.0), ("b", 2, dt.datetime(2015, 9, 15), 3.0, 4.0)],
        "symbol string, seq long, ts timestamp_ntz, price double, amount double")
    R.write_trades_raw(t, tmpdir_spark + "/raw")
    raw = R.raw_passthrough(spark, tmpdir_spark + "/raw", "b")
    assert [r.value for r in raw.collect()] == ["1442275200,3.0,4.0"]
    assert "PartitionFilters: [isnotnull(symbol" in raw._jdf.queryExecution().executedPlan().toString()


def test_lenient_json_flags_bad_records(spark):
    lines = spark.createDataFrame([('{"timestamp": "2015-09-15T00:00:00Z", "price": 1.0, "amount": 2.0}',),
                                   ('{"timestamp": "yesterday", "price": 1.0, "amount": 2.0}',), ("not json",)], "value string")
    got = [r.bad for r in R.trades_from_json(lines, strict=False).collect()]
    assert got == [False, True, True]


def test_stream_encode_csv_with_header(spark, tmpdir_spark):
    from tidemark.streaming import records as SR
    from tidemark.streaming import sources as SS

    t = spark.createDataFrame([("s", 1, dt.datetime(2015, 9, 15), 1.0, 2.0)],
                              "symbol string, seq long, ts timestamp_ntz, price double, amount double")
    R.write_trades_raw(t, tmpdir_spark + "/raw")
    enc = SR.stream_encode_csv(SR.stream_decode_trades(spark, tmpdir_spark + "/raw"))
    q = (enc.writeStream.format("csv").option("header", True).option("path", tmpdir_spark + "/csv")
         .option("checkpointLocation", tmpdir_spark + "/ck").partitionBy("symbol").trigger(availableNow=True).start())
    q.awaitTermination()
    lines = [r.value for r in spark.read.text(tmpdir_spark + "/csv/symbol=s").collect()]
    assert lines == ["timestamp,price,amount", "2015-09-15T00:00:00Z,1.0,2.0"]


def test_iso_parse_nanos_and_errors(spark):
    df = spark.createDataFrame([("2015-09-15T00:00:01.123456000Z",), ("2015-09-15T00:00:01Z",)], "s string")
    got = [r.t for r in df.select(parse_iso_instant("s").alias("t")).collect()]
    assert got == [dt.datetime(2015, 9, 15, 0, 0, 1, 123456), dt.datetime(2015, 9, 15, 0, 0, 1)]
    for text in ("2015-09-15 00:00:01", "2015-09-15T00:00:01.123456789Z"):  # nanoseconds don't fit
        bad = spark.createDataFrame([(text,)], "s string")
        with pytest.raises(Exception):
            bad.select(parse_iso_instant("s")).collect()
        assert bad.select(parse_iso_instant("s", strict=False).alias("t")).first().t is None


def test_read_quotes_as_stream(spark, tmpdir_spark):
    src = tmpdir_spark + "/q"
    spark.createDataFrame([("Date, Open, High, Low, Close, Volume, Adj Close\n2014-12-31, 25.3, 25.3, 24.19, 24.84, 1438600, 24.84",)],
                          "value string").coalesce(1).write.text(src)
    s = R.read_quotes(spark, src, "yhoo", stream=True)
    q = (s.writeStream.format("parquet").option("path", tmpdir_spark + "/out")
         .option("checkpointLocation", tmpdir_spark + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    r = spark.read.parquet(tmpdir_spark + "/out").first()
    assert (r.symbol, str(r.date), r.adj_close, r.volume) == ("yhoo", "2014-12-31", 24.84, 1438600)


def test_strict_parse_fails_without_ansi(spark, tmpdir_spark):
    p = tmpdir_spark + "/bad"
    _write_text(spark, p, "1442335124,abc,1")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            R.read_trades(spark, p).collect()
        assert R.read_trades(spark, p, strict=False).first().bad
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_arrival_order_over_files_of_unequal_size(spark, tmpdir_spark):
    for k, n in enumerate([3, 4000, 1, 700]):  # the small file comes first, whatever tasks read first
        lines = spark.range(n).selectExpr(f"concat('{k},', id, ',1') AS value").coalesce(1)
        lines.write.mode("append").option("lineSep", "\n").text(f"{tmpdir_spark}/f/part={k}")
    t = R.read_trades(spark, tmpdir_spark + "/f", "s").orderBy("seq").collect()
    assert [r.seq for r in t] == list(range(4704))
    assert [(r.ts.second, r.price) for r in t] == [(k, float(i)) for k, n in enumerate([3, 4000, 1, 700]) for i in range(n)]


def test_quotes_follow_each_files_header(spark, tmpdir_spark):
    _write_text(spark, tmpdir_spark + "/q/a=1", "Date,Open,High,Low,Close,Volume,Adj Close\n2014-12-31,1,2,3,4,5,6\n")
    _write_text(spark, tmpdir_spark + "/q/a=2", "Date , Adj Close,Volume,Close,Low,High,Open, More\n2014-12-30,6, 5,4,3,2,1,\"x\"\n\n")
    rows = R.read_quotes(spark, tmpdir_spark + "/q", "s").orderBy("seq").collect()
    assert [(r.open, r.high, r.low, r.close, r.volume, r.adj_close) for r in rows] == [(1.0, 2.0, 3.0, 4.0, 5, 6.0)] * 2
    for k, text in enumerate(["Date,Open\n2014-12-31,1", "Date,Open,High,Low,Close,Volume,Adj Close\n2014-12-31,1,2", "Date,Open,High,Low,Close,Volume,Adj Close\n2014-12-31,1,2,3,4,x,6"]):
        _write_text(spark, f"{tmpdir_spark}/bad{k}", text)
        with pytest.raises(Exception):
            R.read_quotes(spark, f"{tmpdir_spark}/bad{k}", "s").collect()


def test_quote_stream_refuses_another_header(spark, tmpdir_spark):
    _write_text(spark, tmpdir_spark + "/q", "Date,Adj Close,Open,High,Low,Close,Volume\n2014-12-31,1,2,3,4,5,6")
    s = R.read_quotes(spark, tmpdir_spark + "/q", "s", stream=True)
    q = (s.writeStream.format("parquet").option("path", tmpdir_spark + "/out")
         .option("checkpointLocation", tmpdir_spark + "/ck").trigger(availableNow=True).start())
    with pytest.raises(Exception):
        q.awaitTermination()


@pytest.mark.parametrize("text", ['{"price": 1.0}', '{"timestamp": "2015-09-15T00:00:00Z", "price": null, "amount": 1.0}',
                                  '{"timestamp": "2015-09-15T00:00:00Z", "amount": 1.0}', "{}", None])
def test_strict_json_needs_every_field(spark, text):
    lines = spark.createDataFrame([(text,)], "value string")
    with pytest.raises(Exception):
        R.trades_from_json(lines).collect()
    assert R.trades_from_json(lines, strict=False).first().bad


@pytest.mark.parametrize("text", ['[{"begin": "2015-09-15T00:00:00Z"}, {"open": 1.0}]', "[]", '[{"begin": null, "end": null}]'])
def test_strict_json_bars_need_every_field(spark, text):
    with pytest.raises(Exception):
        R.bars_from_json(spark.createDataFrame([(text,)], "value string")).collect()


def test_partitioned_csv_without_rows_has_a_header(spark, tmpdir_spark):
    empty = spark.createDataFrame([], "symbol string, ts timestamp_ntz, price double, amount double")
    R.write_csv(R.trades_to_csv(empty, keep=["symbol"]), tmpdir_spark + "/e", partition_by=["symbol"])
    assert [r.value for r in spark.read.text(tmpdir_spark + "/e").collect()] == ["timestamp,price,amount"]


def test_csv_lines_in_order(spark, tmpdir_spark):
    t = spark.range(500).selectExpr("CAST(499 - id AS STRING) AS a", "lpad(CAST((id * 37) % 500 AS STRING), 3, '0') AS b").repartition(5)
    R.write_csv(t, tmpdir_spark + "/s", header=False, sort_by=["b"])
    lines = [r.value for r in R.arrival_lines(spark, tmpdir_spark + "/s").orderBy("seq").collect()]
    assert [x.split(",")[1] for x in lines] == sorted(x.split(",")[1] for x in lines) and len(lines) == 500
