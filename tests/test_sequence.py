"""The blocked sequence plan against plain per-key Python loops, with tiny blocks and chunks."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import sequence as S

SCHEMA = "k string, o long, v double"


def _data(spark, seed=1):
    rnd = random.Random(seed)
    rows = []
    # one hot key with most rows, sparse and dense stretches of the order column
    for key, n in (("hot", 700), ("warm", 120), ("cold", 9), ("one", 1)):
        o = rnd.randint(-50, 50)
        for _ in range(n):
            o += rnd.choice([1, 1, 1, 2, 5, 40])
            rows.append((key, o, float(rnd.randint(-20, 20)) / 4))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def _by_key(rows, descending=False):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], -r[1] if descending else r[1])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("block", [3, 16, 1 << 20])
@pytest.mark.parametrize("descending", [False, True])
def test_number_rows_and_prefix_sum(spark, block, descending):
    rows, df = _data(spark)
    got = S.prefix_sums(df, ["k"], "o", {"rn": F.lit(1).cast("long"), "cs": F.col("v")}, descending=descending,
                        block_size=block, with_total="len").collect()
    got = {(r.k, r.o): (r.rn, r.cs, r.len) for r in got}
    assert len(got) == len(rows)
    for k, seq in _by_key(rows, descending).items():
        acc = 0.0
        for i, r in enumerate(seq, start=1):
            acc += r[2]
            rn, cs, ln = got[(k, r[1])]
            assert rn == i and abs(cs - acc) < 1e-9 and ln == len(seq)


@pytest.mark.parametrize("block", [4, 1 << 20])
def test_with_previous_crosses_blocks(spark, block):
    rows, df = _data(spark, seed=2)
    got = {(r.k, r.o): r.prev_v for r in S.with_previous(df, ["k"], "o", ["v"], block_size=block).collect()}
    for k, seq in _by_key(rows).items():
        prev = None
        for r in seq:
            assert got[(k, r[1])] == prev
            prev = r[2]


@pytest.mark.parametrize("chunk", [5, 64])
def test_frame_aggregates_with_halo(spark, chunk):
    rows, df = _data(spark, seed=3)
    pos = S.number_rows(df, ["k"], "o", "pos", block_size=8)
    frames = {"m3": (3, F.avg("v")), "s10": (10, F.sum("v")), "c10": (10, F.count("v"))}
    got = {(r.k, r.o): r for r in S.frame_aggregates(pos, ["k"], "pos", frames, chunk_rows=chunk).collect()}
    assert len(got) == len(rows)
    for k, seq in _by_key(rows).items():
        vals = [r[2] for r in seq]
        for i, r in enumerate(seq):
            g = got[(k, r[1])]
            w3, w10 = vals[i:i + 3], vals[i:i + 10]
            assert abs(g.m3 - sum(w3) / len(w3)) < 1e-9
            assert abs(g.s10 - sum(w10)) < 1e-9 and g.c10 == len(w10)


def test_order_column_types(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, d), dt.datetime(2024, 1, d, 5)) for d in (3, 1, 2)], "k string, d date, t timestamp_ntz")
    by_date = {r.d.day: r.rn for r in S.number_rows(df, ["k"], "d", descending=True).collect()}
    by_ts = {r.t.day: r.rn for r in S.number_rows(df, ["k"], "t").collect()}
    assert by_date == {3: 1, 2: 2, 1: 3} and by_ts == {1: 1, 2: 2, 3: 3}
    with pytest.raises(TypeError):
        S.number_rows(df.withColumn("s", F.lit("x")), ["k"], "s")


ORDERS = {
    "dense": "id",
    "sparse": "id * 4194304",
    "clumped": "IF(id % 2 = 0, id, 4611686018427387904 - id)",
    "negative": "-id * 7919",
}


@pytest.mark.parametrize("kind", list(ORDERS))
def test_no_window_grows_with_the_key(spark, kind, monkeypatch):
    # one symbol; data windows hold at most a block, summary windows at most FAN_OUT blocks or ranges
    df = spark.range(20_000).selectExpr("'hot' AS k", f"CAST({ORDERS[kind]} AS BIGINT) AS o", "id")
    d, pk = S.with_blocks(df, "o", keys=["k"])
    assert d.groupBy(*pk, S.BLK).count().agg(F.max("count")).first()[0] <= S.DEFAULT_BLOCK
    ranges, levels = d.select(F.col(S.BLK).alias("b")).distinct(), S.levels(1 << 40, S.DEFAULT_BLOCK)
    for _ in range(levels):
        up = F.expr(f"(b - pmod(b, {S.FAN_OUT}L)) div {S.FAN_OUT}L")
        assert ranges.groupBy(up).count().agg(F.max("count")).first()[0] <= S.FAN_OUT
        ranges = ranges.select(up.alias("b")).distinct()
    assert levels == 2 and ranges.count() <= S.FAN_OUT
    monkeypatch.setattr(S, "FAN_OUT", 64)  # many blocks, as of a far larger table
    out = S.lag_change(S.number_rows(df, ["k"], "o", "rn", with_total="n"), ["k"], "o", "id")
    want = df.selectExpr("id", "row_number() OVER (PARTITION BY k ORDER BY o) AS rn", "lag(id) OVER (PARTITION BY k ORDER BY o) IS DISTINCT FROM id AS c")
    both = out.join(want, "id")
    assert both.count() == 20_000 and out.where("n != 20000").count() == 0
    assert out.select("id", "rn", "changed").exceptAll(want.select("id", "rn", "c")).count() == 0


@pytest.mark.parametrize("kind", [*ORDERS, "one far value", "all equal", "exponential"])
@pytest.mark.parametrize("descending", [False, True])
def test_even_blocks_hold_their_share(spark, kind, descending):
    order = {**ORDERS, "one far value": "IF(id = 7, -9223372036854775807, id)", "all equal": "5", "exponential": "CAST(exp(id / 1000.0) * 1000 AS BIGINT) * 20000 + id"}[kind]
    df = spark.range(20_000).selectExpr("'hot' AS k", f"CAST({order} AS BIGINT) AS o", "id")
    d, pk = S.with_blocks(df, "o", descending, block_size=250, keys=["k"], even=True)
    sizes = [r["count"] for r in d.groupBy(*pk, S.BLK).count().collect()]
    if kind != "all equal":
        assert len(sizes) <= 2 * 20_000 / 250 + 2 and max(sizes) <= (1000 if kind != "exponential" else 10_000)
        sign = "DESC" if descending else "ASC"
        want = df.selectExpr("id", f"row_number() OVER (PARTITION BY k ORDER BY o {sign}) AS rn")
        out = S.number_rows(df, ["k"], "o", "rn", descending=descending, block_size=250, even=True)
        assert out.select("id", "rn").exceptAll(want).count() == 0
    blocks = d.groupBy(S.BLK).agg(F.min(S.ORD).alias("a"), F.max(S.ORD).alias("b")).orderBy(S.BLK).collect()
    assert all(x.b < y.a for x, y in zip(blocks, blocks[1:]))  # blocks follow the order


def test_even_blocks_of_times_and_nulls(spark):
    t = "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 3 = 0 THEN timestamp_ntz'1971-01-01' + make_dt_interval(id) ELSE timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) END"
    df = spark.range(3000).selectExpr("IF(id % 2 = 0, 'a', NULL) AS k", f"{t} AS t", "id")
    out = S.number_rows(df, ["k"], "t", "rn", block_size=64)
    want = df.where("t IS NOT NULL").selectExpr("id", "row_number() OVER (PARTITION BY k ORDER BY t) + 300 * int(id % 2 = 0) AS rn")
    assert out.where("t IS NOT NULL").select("id", "rn").exceptAll(want).count() == 0
    assert S.number_rows(df.where("t IS NULL"), ["k"], "t", "rn").count() == 300
    assert S.number_rows(df.where("id < 0"), ["k"], "t", "rn").count() == 0


def test_timestamp_order_is_split_too(spark):
    df = spark.range(5000).selectExpr("'hot' AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, CAST(id * 3.7 AS DECIMAL(18,6))) AS t", "id")
    got = S.number_rows(df, ["k"], "t").where("rn != id + 1").count()
    assert got == 0


def test_null_orders_are_spread_over_blocks(spark):
    df = spark.range(5000).selectExpr("'hot' AS k", "CAST(NULL AS BIGINT) AS o", "id")
    d, pk = S.with_blocks(df, "o", keys=["k"])
    assert d.select(S.BLK).distinct().count() > 1000
    rn = [r.rn for r in S.number_rows(df, ["k"], "o").collect()]
    assert sorted(rn) == list(range(1, 5001))


def test_kept_blocks_of_another_order_are_replaced(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 8), ("a", 3, 7)], "k string, o long, p long")
    first = S.number_rows(df, ["k"], "o", "x", keep_blocks=True)
    both = S.number_rows(first, ["k"], "p", "y", keep_blocks=True)
    assert sorted((r.x, r.y) for r in both.collect()) == [(1, 3), (2, 2), (3, 1)]
    down = S.number_rows(both, ["k"], "p", "z", descending=True)
    assert sorted((r.y, r.z) for r in down.collect()) == [(1, 3), (2, 2), (3, 1)]
    assert S.ORD not in down.columns


def test_segments_with_null_values(spark):
    rows = [("a", 1, None), ("a", 2, None), ("a", 3, 1.0), ("a", 4, None), ("a", 5, 1.0), ("a", 6, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for block in (1, 2, 100):
        got = sorted((r.o, r.run_id) for r in S.segment_ids(df, ["k"], "o", "v", block_size=block).collect())
        assert [x for _, x in got] == [1, 1, 2, 3, 4, 4]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 64, 90])
def test_frame_means_equal_plain_frames(spark, n):
    df = spark.range(200).selectExpr("'a' AS k", "id + 1 AS pos", "IF(id % 11 = 0, NULL, CAST(id * id % 97 AS DOUBLE)) AS v")
    got = {r.pos: r.m for r in S.frame_means(df, ["k"], "pos", "v", {"m": n, "w": 5}, chunk_rows=64).collect()}
    vals = {r.pos: r.v for r in df.collect()}
    for pos in range(1, 202 - n):
        own = [vals[i] for i in range(pos, pos + n) if vals[i] is not None]
        assert (got[pos] is None) == (not own) and (not own or abs(got[pos] - sum(own) / len(own)) < 1e-9)


def test_null_keys_are_kept_exact(spark):
    rows = [(None, i, float(i)) for i in range(5)] + [("a", i, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.k, r.o): (r.rn, r.prev_v) for r in S.with_previous(
        S.number_rows(df, ["k"], "o", block_size=2), ["k"], "o", ["v"], block_size=2).collect()}
    assert len(got) == 8
    assert [got[(None, i)] for i in range(5)] == [(1, None), (2, 0.0), (3, 1.0), (4, 2.0), (5, 3.0)]
    assert got[("a", 2)] == (3, 1.0)
    runs = {(r.k, r.o): r.run_id for r in S.segment_ids(df, ["k"], "o", "v", block_size=2).collect()}
    assert [runs[(None, i)] for i in range(5)] == [1, 2, 3, 4, 5] and runs[("a", 2)] == 1


def test_summary_join_reuses_window_partitioning(spark):
    # with broadcasting off, the sort-merge join must not shuffle the big side a second time
    rows, df = _data(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = S.number_rows(df.withColumn("wide", F.lit("x")), ["k"], "o")
        out.write.format("noop").mode("overwrite").save()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    # the first exchange below the joins is the data's own; every other one carries summaries, and the
    # join of the data with its summary adds none
    final = plan.split("Initial Plan")[0]
    assert "SortMergeJoin" in final
    data_side = final[final.index("SortMergeJoin") :]
    assert data_side[: data_side.index("Window")].count("Exchange") == 0, final


def test_null_order_values_come_first(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", 5, 2.0), ("a", 7, 3.0)], SCHEMA)
    got = sorted((r.rn, r.v) for r in S.number_rows(df, ["k"], "o").collect())
    assert got == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_lag_change_and_row_position(spark):
    rows = [("a", i, v) for i, v in enumerate([1.0, 1.0, 2.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.o, r.changed, r.rn) for r in S.row_position(S.lag_change(df, ["k"], "o", "v", block_size=2),
                                                               ["k"], "o", block_size=2).collect())
    assert [(c, rn) for _, c, rn in got] == [(True, 1), (False, 2), (True, 3), (True, 4), (False, 5)]


def test_hot_symbol_spreads_over_partitions(spark):
    # 90% of the rows in one symbol: its window work lands in many partitions, not one
    hot = spark.range(90_000).selectExpr("'hot' AS k", "id AS o", "CAST(id % 7 AS DOUBLE) AS v")
    cold = spark.range(10_000).selectExpr("concat('c', CAST(id % 10 AS STRING)) AS k", "id AS o", "1.0D AS v")
    df = hot.unionByName(cold)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = S.number_rows(df, ["k"], "o", block_size=4096).withColumn("pid", F.spark_partition_id())
        parts = out.where("k = 'hot'").select("pid").distinct().count()
        top = out.where("k = 'hot'").agg(F.max("rn")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert top == 90_000
    assert parts >= 6  # 22 blocks of 4096 rows hashed over 8 shuffle partitions
