import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidemark.functions import periods as P

UTC = dt.timezone.utc


def _ntz(instant: dt.datetime) -> dt.datetime:
    return instant.astimezone(UTC).replace(tzinfo=None)


def _eval(spark, ts_list, period):
    df = spark.createDataFrame([(t,) for t in ts_list], "ts timestamp_ntz")
    out = df.select("ts", P.period_begin("ts", period).alias("b")).select(
        "ts", "b", P.period_end("b", period).alias("e"))
    return {r.ts: (r.b, r.e) for r in out.collect()}


def test_interval_contains_half_open(spark):
    t = dt.datetime(2015, 9, 15, 12)
    ms = dt.timedelta(milliseconds=1)
    df = spark.createDataFrame([(t, t, t), (t, t + ms, t), (t - ms, t, t)], "b timestamp_ntz, e timestamp_ntz, t timestamp_ntz")
    got = [r[0] for r in df.select(P.interval_contains("b", "e", "t")).collect()]
    assert got == [False, True, False]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "+05:30", "GMT-03:00"])
def test_midnight_begins_a_day(spark, zone):
    tz = ZoneInfo(zone) if "/" in zone or zone == "UTC" else None
    if tz is None:
        off = P._fixed_offset_seconds(zone)
        tz = dt.timezone(dt.timedelta(seconds=off))
    midnight = dt.datetime(2015, 9, 15, tzinfo=tz)
    m = _ntz(midnight)
    before = m - dt.timedelta(milliseconds=1)
    got = _eval(spark, [m, before], f"daily({zone})")
    assert got[m] == (m, m + dt.timedelta(hours=24))
    assert got[before][1] == m  # the earlier day ends where this one begins


def test_hourly_truncates_and_touches(spark):
    t = dt.datetime(2015, 9, 15, 12, 34, 56, 789000)
    got = _eval(spark, [t, t + dt.timedelta(hours=1)], "hourly")
    b, e = got[t]
    assert b == dt.datetime(2015, 9, 15, 12) and e == dt.datetime(2015, 9, 15, 13)
    assert got[t + dt.timedelta(hours=1)][0] == e


def test_period_specs():
    assert P.parse_period("hourly") == P.HOURLY and P.parse_period("Hourly") == P.HOURLY
    assert P.parse_period("daily").zone == "UTC" and P.parse_period("Daily").kind == "daily"
    assert P.parse_period("daily(America/New_York)").zone == "America/New_York"
    assert P.parse_period("DAILY(+05:30)").fixed_offset_s == 19800
    assert P.parse_period("daily", default_zone="Europe/Paris").zone == "Europe/Paris"
    for bad in ["weekly", "hourly ", "daily(Not/AZone)", "daily()", "dailyx"]:
        with pytest.raises(ValueError):
            P.parse_period(bad)


def test_dst_days_new_york(spark):
    ny = ZoneInfo("America/New_York")
    short_day = dt.datetime(2015, 3, 8, tzinfo=ny)  # 23 h
    long_day = dt.datetime(2015, 11, 1, tzinfo=ny)  # 25 h
    late_short = _ntz(dt.datetime(2015, 3, 8, 23, 30, tzinfo=ny))
    late_long = _ntz(dt.datetime(2015, 11, 1, 23, 30, tzinfo=ny))
    got = _eval(spark, [late_short, late_long], "daily(America/New_York)")
    assert got[late_short] == (_ntz(short_day), _ntz(short_day) + dt.timedelta(hours=24))
    assert got[late_long][0] == _ntz(long_day)
    # 24 elapsed hours: the last hour of the 25 h day lies outside [begin, end) yet keys to it
    assert got[late_long][1] < late_long + dt.timedelta(hours=1)


def test_fixed_offset_path_matches_region_path(spark):
    instants = [dt.datetime(2015, 9, 15, h, m) for h in range(24) for m in (0, 29, 30, 59)]
    a = _eval(spark, instants, "daily(+05:30)")
    b = _eval(spark, instants, "daily(Asia/Kolkata)")
    assert a == b


def test_session_zone_does_not_matter(spark):
    t = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 1, 1, 23, 59)]
    before = _eval(spark, t, "daily(America/New_York)"), _eval(spark, t, "hourly")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        after = _eval(spark, t, "daily(America/New_York)"), _eval(spark, t, "hourly")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after


def test_ntz_micros_roundtrip(spark):
    df = spark.createDataFrame([(dt.datetime(2015, 9, 15, 0, 0, 0, 123456),)], "ts timestamp_ntz")
    r = df.select(P.ntz_micros("ts").alias("us"), P.micros_ntz(P.ntz_micros("ts")).alias("back")).first()
    assert r.us == 1442275200123456 and r.back == dt.datetime(2015, 9, 15, 0, 0, 0, 123456)
    assert df.select(P.seconds_ntz(F.lit(1442335124)).alias("x")).first().x == dt.datetime(2015, 9, 15, 16, 38, 44)
