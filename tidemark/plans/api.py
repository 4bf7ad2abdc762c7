"""The reference's query surface as functions (Q1-Q6); no server.

* :func:`bars`        -- ``/bitcoin/price/{period}/{exchange}/{currency}``
* :func:`trades`      -- ``/bitcoin/trades/{exchange}/{currency}``
* :func:`raw_trades`  -- the same with ``raw=true``
* :func:`quotes`      -- ``/stock/price/daily/{symbol}?period=&calculated=``
* :func:`raw_quotes`  -- the same with ``raw=true``

Errors follow the reference's contract: an invalid calculated column or
period raises ``ValueError`` (400) before any job runs; an unknown symbol
raises :class:`SymbolNotFound` (404) only when ``check_symbol=True``, since
the check costs a job; everything else propagates.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import parse_period
from ..operators import bars as B
from ..operators import indicators as I

# Default look-back and calculated columns of the quote query.
DEFAULT_LOOKBACK = "1Y"
DEFAULT_CALCULATED = I.DEFAULT_CALCULATED

_PERIOD = re.compile(r"([-+]?)P(?:([-+]?\d+)Y)?(?:([-+]?\d+)M)?(?:([-+]?\d+)W)?(?:([-+]?\d+)D)?", re.I)


class SymbolNotFound(LookupError):
    """Unknown symbol (the reference answers 404)."""


def parse_lookback(text: str) -> tuple[int, int, int]:
    """ISO-8601 period, leading ``P`` optional, either case -> (years, months, days)."""
    s = text.strip()
    if not s:
        raise ValueError("empty period")
    if s[0] not in "Pp":
        s = "P" + s
    m = _PERIOD.fullmatch(s)
    if not m or not any(m.group(i) for i in range(2, 6)):
        raise ValueError(f"invalid period: {text}")
    sign = -1 if m.group(1) == "-" else 1
    y, mo, w, d = (int(m.group(i) or 0) for i in range(2, 6))
    return sign * y, sign * mo, sign * (w * 7 + d)


def minus_period(day: dt.date, years: int, months: int, days: int) -> dt.date:
    """``LocalDate.minus(Period)``: months first (clamped to month end), then days."""
    total = years * 12 + months
    if total:
        idx = day.year * 12 + (day.month - 1) - total
        y, m = divmod(idx, 12)
        last = calendar.monthrange(y, m + 1)[1]
        day = dt.date(y, m + 1, min(day.day, last))
    return day - dt.timedelta(days=days)


def symbol_of(exchange: str, currency: str) -> str:
    """Trade symbol = exchange + currency, concatenated without separator."""
    return f"{exchange}{currency}"


def filter_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """``where(symbol = ...)``; pushed to the scan, pruned on a ``symbol=`` layout."""
    return df.where(F.col("symbol") == F.lit(symbol))


def lookback(q: DataFrame, period: str = DEFAULT_LOOKBACK, as_of: dt.date | None = None,
             date_col: str = "date") -> DataFrame:
    """Rows dated from ``as_of - period`` to ``as_of``, both inclusive.

    The bounds are driver-side constants, so the predicate reaches the scan.
    """
    as_of = as_of or dt.date.today()
    start = minus_period(as_of, *parse_lookback(period))
    return q.where(F.col(date_col).between(F.lit(start), F.lit(as_of)))


def _check_symbol(df: DataFrame, symbol: str) -> None:
    if not df.where(F.col("symbol") == F.lit(symbol)).limit(1).count():
        raise SymbolNotFound(symbol)


def bars(t: DataFrame, period: str, exchange: str, currency: str, tie_break: str | None = "prepend",
         check_symbol: bool = False) -> DataFrame:
    """Q1: bars of one symbol per period (P2 -> A4); format with ``records.bars_to_csv``."""
    p = parse_period(period)
    symbol = symbol_of(exchange, currency)
    if check_symbol:
        _check_symbol(t, symbol)
    return B.periodic_ohlcv(filter_symbol(t, symbol), p, tie_break)


def trades(t: DataFrame, exchange: str, currency: str, check_symbol: bool = False) -> DataFrame:
    """Q2: the trades of one symbol (P2); format with ``records.trades_to_csv``."""
    symbol = symbol_of(exchange, currency)
    if check_symbol:
        _check_symbol(t, symbol)
    return filter_symbol(t, symbol)


def raw_trades(spark: SparkSession, root: str, exchange: str, currency: str) -> DataFrame:
    """Q3: untransformed record text of one symbol from a ``symbol=`` partitioned layout."""
    from ..sources.records import raw_passthrough

    return raw_passthrough(spark, root, symbol_of(exchange, currency))


def quotes(q: DataFrame, symbol: str, period: str = DEFAULT_LOOKBACK, calculated: str = DEFAULT_CALCULATED,
           as_of: dt.date | None = None, check_symbol: bool = False, fmt: str | None = None,
           exact_running_sum: bool = False) -> DataFrame:
    """Q4: quotes of one symbol over the look-back with chained calculated columns (P2 -> P3 -> W4).

    ``exact_running_sum=True`` reproduces the reference's running-sum drift.
    """
    sizes = I.parse_calculated(calculated)  # 400 before any job
    parse_lookback(period)
    if check_symbol:
        _check_symbol(q, symbol)
    window = lookback(filter_symbol(q, symbol), period, as_of)
    if not sizes:
        return window
    return I.moving_averages(window, "adj_close", sizes, order_col="date", newest_first=True, chained=True, fmt=fmt,
                             exact_running_sum=exact_running_sum)


def raw_quotes(q: DataFrame, symbol: str, period: str = DEFAULT_LOOKBACK, as_of: dt.date | None = None,
               check_symbol: bool = False) -> DataFrame:
    """Q5: quotes of one symbol over the look-back, no calculation."""
    parse_lookback(period)
    if check_symbol:
        _check_symbol(q, symbol)
    return lookback(filter_symbol(q, symbol), period, as_of)
