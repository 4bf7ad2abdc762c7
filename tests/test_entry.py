"""The driver contract: entry() smoke run, and every registered query against its oracle SQL."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from helpers import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["symbol", "begin", "end", "open", "high", "low", "close", "volume", "n", "first_ts", "last_ts"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E.QUERIES) | set(E.QUERIES_IO) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    so = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = Counter(tuple(_norm(r[i]) for i in so) for r in df.collect())
    b = Counter(tuple(_norm(r[i]) for i in do) for r in res.fetchall())
    assert a == b
