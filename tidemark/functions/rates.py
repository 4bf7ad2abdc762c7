"""Rate algebra on columns.

A rate is ``quantity`` per ``duration`` seconds (duration > 0).  Rates may be
Python numbers or columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def _check_duration(duration) -> None:
    if not isinstance(duration, (Column, str)) and float(duration) <= 0:
        raise ValueError("duration must be positive")


def quantity_for(rate_quantity, rate_duration_s, duration_s) -> Column:
    """Quantity emitted during ``duration_s``: ``q * (duration / rate.duration)``."""
    _check_duration(rate_duration_s)
    return _c(rate_quantity) * (_c(duration_s) / _c(rate_duration_s))


def duration_for(rate_quantity, rate_duration_s, quantity) -> Column:
    """Seconds needed to emit ``quantity``: ``rate.duration * (quantity / q)``.

    The quantity must be positive and finite; otherwise the query fails.
    """
    _check_duration(rate_duration_s)
    q = _c(quantity)
    ok = (q > 0) & ~F.isnan(q) & (q != F.lit(float("inf")))
    return F.when(ok, _c(rate_duration_s) * (q / _c(rate_quantity))).otherwise(
        F.raise_error(F.lit("requirement failed: quantity must be positive and finite"))
    )


def mean_gap_s(rate_quantity, rate_duration_s) -> Column:
    """Seconds between two units at a rate."""
    _check_duration(rate_duration_s)
    return _c(rate_duration_s) / _c(rate_quantity)
