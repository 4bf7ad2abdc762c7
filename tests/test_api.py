import datetime as dt

import pytest

from helpers import SF_SMALL
from tidemark.plans import api as A
from tidemark.sources import testdata as TD


def test_lookback_period_arithmetic():
    assert A.parse_lookback("1Y") == (1, 0, 0) and A.parse_lookback("p2w3d") == (0, 0, 17)
    assert A.parse_lookback("P1Y2M") == (1, 2, 0)
    assert A.minus_period(dt.date(2024, 2, 29), 1, 0, 0) == dt.date(2023, 2, 28)
    assert A.minus_period(dt.date(2024, 3, 31), 0, 1, 0) == dt.date(2024, 2, 29)
    assert A.minus_period(dt.date(2024, 1, 30), 0, 0, 10) == dt.date(2024, 1, 20)
    for bad in ("", "1X", "P", "1Y 2M"):
        with pytest.raises(ValueError):
            A.parse_lookback(bad)


def test_error_contract(spark):
    q = TD.quotes(spark, SF_SMALL)
    t = TD.trades(spark, SF_SMALL)
    with pytest.raises(ValueError, match="Invalid calculated column sma\\(0\\)"):
        A.quotes(q, "purchase", calculated="sma(10),sma(0)")
    with pytest.raises(ValueError):
        A.bars(t, "weekly", "pur", "chase")
    with pytest.raises(A.SymbolNotFound):
        A.quotes(q, "NotFound", check_symbol=True)
    with pytest.raises(A.SymbolNotFound):
        A.trades(t, "Not", "Found", check_symbol=True)
    assert A.bars(t, "daily", "pur", "chase", check_symbol=True).count() > 0


def test_quotes_rows(spark):
    q = TD.quotes(spark, SF_SMALL)
    raw = A.raw_quotes(q, "click", "10D", dt.date(2024, 1, 30))
    out = A.quotes(q, "click", "10D", "sma(3)", dt.date(2024, 1, 30))
    assert out.count() == max(0, raw.count() - 2)
    assert "adj_close_sma_3" in out.columns
