"""Time segmentation (hourly, daily in a zone) as NTZ column expressions.

All timestamps are ``timestamp_ntz`` holding UTC wall time, so results do not
depend on the session time zone.  ``date_trunc`` is never used: on NTZ input
it returns a session-zone timestamp.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US

# Accepted spellings of a period specification (full match,
# case-insensitive) and the default zone of a plain daily period.
HOURLY_SPEC = r"(?i)hourly"
DAILY_SPEC = r"(?i)daily"
ZONED_DAILY_SPEC = r"(?i)daily\(([^)]+)\)"
DEFAULT_ZONE = "UTC"

# Zone ids of the form Z, +hh, +hh:mm, +hhmm, +hh:mm:ss, optionally prefixed
# by UTC, GMT or UT; a bare prefix means offset zero.
_OFFSET = re.compile(
    r"^(?:(?P<prefix>UTC|GMT|UT)(?P<rest>[+-].*)?|(?P<z>Z)|(?P<bare>[+-].*))$"
)
_OFFSET_BODY = re.compile(r"^([+-])(\d{1,2})(?::?(\d{2}))?(?::?(\d{2}))?$")


@dataclass(frozen=True)
class Period:
    """An aligned periodic segmentation of the time line."""

    kind: str  # "hourly" or "daily"
    zone: str = DEFAULT_ZONE
    fixed_offset_s: int | None = 0  # seconds east of UTC, None for region zones

    @property
    def length_us(self) -> int:
        return HOUR_US if self.kind == "hourly" else DAY_US

    @property
    def label(self) -> str:
        return "hourly" if self.kind == "hourly" else f"daily({self.zone})"


HOURLY = Period("hourly")


def _fixed_offset_seconds(zone: str) -> int | None:
    m = _OFFSET.match(zone)
    if not m:
        return None
    if m.group("z"):
        return 0
    body = m.group("rest") if m.group("prefix") else m.group("bare")
    if body is None:
        return 0
    b = _OFFSET_BODY.match(body)
    if not b:
        raise ValueError(f"invalid zone offset: {zone}")
    sign = -1 if b.group(1) == "-" else 1
    h, mnt, sec = int(b.group(2)), int(b.group(3) or 0), int(b.group(4) or 0)
    if h > 18 or mnt > 59 or sec > 59:
        raise ValueError(f"invalid zone offset: {zone}")
    total = sign * (h * 3600 + mnt * 60 + sec)
    if abs(total) > 18 * 3600:
        raise ValueError(f"invalid zone offset: {zone}")
    return total


def zone_period(zone: str) -> Period:
    """``Daily(zone)``; raises ``ValueError`` for an unknown zone id."""
    zone = zone.strip()
    offset = _fixed_offset_seconds(zone)
    if offset is not None:
        return Period("daily", zone, offset)
    try:
        info = ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError, IsADirectoryError) as exc:
        raise ValueError(f"unknown time zone: {zone}") from exc
    if zone in ("UTC", "Etc/UTC", "Etc/UCT", "UCT", "Etc/GMT", "GMT", "Etc/Universal", "Universal", "Zulu", "Etc/Zulu"):
        return Period("daily", zone, 0)
    del info
    return Period("daily", zone, None)


def parse_period(spec: str, default_zone: str = DEFAULT_ZONE) -> Period:
    """``hourly`` | ``daily`` | ``daily(<zone>)`` (case-insensitive, full match).

    A bad zone means no match; both raise ``ValueError``.
    """
    if isinstance(spec, Period):
        return spec
    if re.fullmatch(HOURLY_SPEC, spec):
        return HOURLY
    if re.fullmatch(DAILY_SPEC, spec):
        return zone_period(default_zone)
    m = re.fullmatch(ZONED_DAILY_SPEC, spec)
    if m:
        return zone_period(m.group(1))
    raise ValueError(f"invalid period: {spec}")


def whole_hour_offsets(period: Period) -> bool:
    """True when the period's zone is always a whole number of hours from UTC.

    Region zones are sampled every 6 hours from 1970 to 2100 (about 190,000
    driver-side lookups once per zone, no job); hourly bars nest in its days only then.
    """
    if period.kind == "hourly":
        return True
    if period.fixed_offset_s is not None:
        return period.fixed_offset_s % 3600 == 0
    return _zone_in_whole_hours(period.zone)


@functools.cache
def _zone_in_whole_hours(name: str) -> bool:
    import datetime as _dt

    zone = ZoneInfo(name)
    t = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
    step, end = _dt.timedelta(hours=6), _dt.datetime(2100, 1, 1, tzinfo=_dt.timezone.utc)
    while t < end:
        off = t.astimezone(zone).utcoffset()
        if off is not None and off.total_seconds() % 3600:
            return False
        t += step
    return True


def overlapping_days(period: Period) -> bool:
    """Whether a day of the zone may be shorter than the 24 hours its interval spans (clocks set forward)."""
    return period.kind != "hourly" and period.fixed_offset_s is None


@functools.cache
def _short_days_apart(name: str) -> bool:
    """No two days in a row are shorter than 24 hours (looked up from 1970 to 2100, once per zone)."""
    import datetime as _dt

    zone, day = ZoneInfo(name), _dt.date(1970, 1, 1)
    last, short = None, False
    while day.year < 2100:
        begin = _dt.datetime(day.year, day.month, day.day, tzinfo=zone).timestamp()
        now = last is not None and begin - last < 86400
        if now and short:
            return False
        last, short, day = begin, now, day + _dt.timedelta(days=1)
    return True


def earlier_interval(ts: Column, begin: Column, period: Period) -> Column:
    """Begin of the day before, where its 24-hour interval contains ``ts`` too; null otherwise.

    That is so in the first hour after a day on which clocks are set forward.
    """
    if not overlapping_days(period):
        return F.lit(None).cast("timestamp_ntz")
    if not _short_days_apart(period.zone):
        raise ValueError(f"{period.zone} has days of less than 24 hours in a row")
    before = period_begin(F.timestamp_add("MICROSECOND", F.lit(-1), begin), period)
    return F.when(period_end(before, period) > ts, before)


def period_begin(ts: Column | str, period: Period | str) -> Column:
    """Begin of the aligned interval that contains ``ts`` (NTZ in, NTZ out)."""
    period = parse_period(period) if isinstance(period, str) else period
    if isinstance(ts, str):
        return F.expr(_begin_sql("`" + ts.replace("`", "``") + "`", period))
    if period.kind == "hourly":
        return F.window(ts, "1 hour").start
    if period.fixed_offset_s is not None:
        start_s = (-period.fixed_offset_s) % 86400
        return F.window(ts, "1 day", "1 day", f"{start_s} seconds").start
    zone, utc = F.lit(period.zone), F.lit("UTC")
    local_day = F.to_date(F.convert_timezone(utc, zone, ts))
    return F.convert_timezone(zone, utc, local_day.cast("timestamp_ntz"))


def _begin_sql(ts: str, period: Period) -> str:
    if period.kind == "hourly":
        return f"window({ts}, '1 hour').start"
    if period.fixed_offset_s is not None:
        # local midnight at offset +o is UTC (-o) mod 24h: a shifted tumbling window
        start_s = (-period.fixed_offset_s) % 86400
        return f"window({ts}, '1 day', '1 day', '{start_s} seconds').start"
    zone = period.zone.replace("'", "")
    return (f"convert_timezone('{zone}', 'UTC', "
            f"CAST(to_date(convert_timezone('UTC', '{zone}', {ts})) AS TIMESTAMP_NTZ))")


def period_end(begin: Column | str, period: Period | str) -> Column:
    """End of the interval: begin + 1 hour, or begin + 24 elapsed hours."""
    period = parse_period(period) if isinstance(period, str) else period
    step = "INTERVAL 1 HOUR" if period.kind == "hourly" else "INTERVAL 24 HOURS"
    if isinstance(begin, str):
        return F.expr(f"`{begin}` + {step}")
    return begin + F.expr(step)


def interval_contains(begin: Column | str, end: Column | str, ts: Column | str) -> Column:
    """Half-open ``begin <= ts < end``; an empty interval contains nothing."""
    b = F.col(begin) if isinstance(begin, str) else begin
    e = F.col(end) if isinstance(end, str) else end
    t = F.col(ts) if isinstance(ts, str) else ts
    return (b <= t) & (t < e)


_EPOCH = "1970-01-01 00:00:00"


def ntz_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of an NTZ timestamp, independent of the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts)


def micros_ntz(us: Column) -> Column:
    """Inverse of :func:`ntz_micros`."""
    return F.timestamp_add("MICROSECOND", us.cast("bigint"), F.lit(_EPOCH).cast("timestamp_ntz"))


def seconds_ntz(epoch_seconds: Column) -> Column:
    """Epoch seconds (bigint) to an NTZ instant in UTC."""
    return F.timestamp_add("SECOND", epoch_seconds.cast("bigint"), F.lit(_EPOCH).cast("timestamp_ntz"))
