"""Text forms of values: two-decimal doubles and ISO instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .periods import ntz_micros

# Fixed value: the reference's double format (half-up on the shortest decimal form).
TWO_DP = "%1.2f"

_ISO = r"^(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2})(\.\d{1,9})?Z$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_2dp(c, dtype: T.DataType | None = None) -> Column:
    """Doubles as ``%1.2f`` text; other types by their plain string form."""
    col = _col(c)
    if dtype is None or isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.format_string(TWO_DP, col)
    return col.cast("string")


def iso_instant(ts) -> Column:
    """NTZ (UTC) timestamp -> ``2015-09-15T00:00:00Z``; fraction digits in groups of 3, none when zero.

    Built from the zone-free string cast, so the session time zone never
    shifts the wall clock.
    """
    t = _col(ts)
    base = F.regexp_replace(F.substring(t.cast("string"), 1, 19), " ", "T")
    us = F.pmod(ntz_micros(t), F.lit(1_000_000))
    frac = (
        F.when(us == 0, F.lit(""))
        .when(us % 1000 == 0, F.format_string(".%03d", (us / 1000).cast("int")))
        .otherwise(F.format_string(".%06d", us.cast("int")))
    )
    return F.when(t.isNull(), F.lit(None)).otherwise(F.concat(base, frac, F.lit("Z")))


def parse_iso_instant(s, strict: bool = True) -> Column:
    """ISO instant text (``...Z``) -> NTZ timestamp in UTC.

    Bad text, and instants between two microseconds, fail in strict mode, else they are null.
    """
    text = _col(s)
    ok = text.rlike(_ISO)
    # Spark timestamps hold microseconds: further fraction digits must be zeros
    normalized = F.regexp_replace(F.regexp_replace(text, r"(\.\d{6})0+Z$", "$1Z"), "Z$", "")
    ok = ok & ~normalized.rlike(r"\.\d{7,}$")
    value = F.to_timestamp_ntz(F.when(ok, normalized))
    if strict:
        return F.when(text.isNull(), F.lit(None)).when(ok, value).otherwise(
            F.raise_error(F.concat(F.lit("invalid Instant string: "), text))
        )
    return F.when(ok, value)
