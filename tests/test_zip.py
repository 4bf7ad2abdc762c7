import pytest

from tidemark.operators.zipping import zip_join


def test_zip_pairs_by_position_and_stops_at_shorter(spark):
    left = spark.createDataFrame([("a", i, float(i)) for i in range(5)] + [(None, 1, 9.0)], "symbol string, seq long, x double")
    right = spark.createDataFrame([("a", 10 - i, f"t{i}") for i in range(3)] + [(None, 7, "n")], "symbol string, seq long, y string")
    got = sorted(((r.symbol or ""), r.rn, r.l_x, r.r_y) for r in zip_join(left, right, block_size=2).collect())
    # right in seq order: seq 8 (t2), 9 (t1), 10 (t0)
    assert got == [("", 1, 9.0, "n"), ("a", 1, 0.0, "t2"), ("a", 2, 1.0, "t1"), ("a", 3, 2.0, "t0")]
