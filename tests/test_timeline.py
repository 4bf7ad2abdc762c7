import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.rates import duration_for, mean_gap_s, quantity_for
from tidemark.operators import timeline as TL

T0 = dt.datetime(2024, 1, 1)


def test_rate_algebra(spark):
    df = spark.range(1).select(
        quantity_for(10.0, 1.0, F.lit(1.0)).alias("q"), duration_for(10.0, 1.0, F.lit(10.0)).alias("d"),
        duration_for(4.0, 1.0, F.lit(1.0)).alias("d4"))
    r = df.first()
    assert (r.q, r.d, r.d4) == (10.0, 1.0, 0.25)
    for bad in (0.0, -1.0, float("inf")):
        with pytest.raises(Exception):
            spark.range(1).select(duration_for(10.0, 1.0, F.lit(bad))).collect()
    with pytest.raises(ValueError):
        quantity_for(1.0, 0.0, F.lit(1.0))


def test_arrival_timeline_and_gaps(spark):
    rnd = random.Random(2)
    rows = [(k, i * 3, rnd.randint(0, 99) / 100.0) for k, n in (("a", 500), ("b", 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, seq long, gap double")
    out = TL.arrival_timeline(df, "gap", T0, block_size=32)
    got = {(r.symbol, r.seq): r.arrival_ts for r in out.collect()}
    acc = {}
    for k, s, g in rows:
        acc[k] = acc.get(k, 0) + round(g * 1e6)
        assert got[(k, s)] == T0 + dt.timedelta(microseconds=acc[k])
    stats = {r.symbol: r for r in TL.interarrival_stats(out.withColumnRenamed("arrival_ts", "ts"), block_size=32).collect()}
    a = [g for k, _, g in rows if k == "a"]
    assert stats["a"].n == 500 and stats["a"].n_gaps == 499
    assert stats["a"].mean_gap_s == pytest.approx(sum(a[1:]) / 499, abs=1e-6)
    assert stats["b"].min_gap_s == pytest.approx(min(g for k, _, g in rows if k == "b" and _ > 0), abs=1e-6)


def test_mean_gap_of_a_steady_rate(spark):
    rows = [("a", i, T0 + dt.timedelta(milliseconds=250 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, seq long, ts timestamp_ntz")
    stats = TL.interarrival_stats(df).withColumn("target", mean_gap_s(1.0, 0.25)).first()
    assert stats.mean_gap_s == pytest.approx(stats.target)
