"""Time buckets and day-range predicates.

Day filters are rewritten to half-open ranges on the raw instant column
with literal bounds (`created >= 'd0 00:00' and created < 'd1+1 00:00'`),
so they are pushed to the Parquet scan instead of evaluating date() per
row. Local-time days (America/New_York) are converted to their UTC instants
on the driver with the IANA rules, DST included, which keeps the filter on
the raw column; only the bucketing expression shifts the zone.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = ZoneInfo("UTC")


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def ts_lit(value) -> Column:
    """A timestamp_ntz literal (the facts hold UTC wall-clock instants)."""
    if isinstance(value, dt.datetime):
        s = value.strftime("%Y-%m-%d %H:%M:%S")
    else:
        s = _as_date(value).isoformat() + " 00:00:00"
    return F.lit(s).cast("timestamp_ntz")


def local_ts(c, tz: str | None) -> Column:
    """`t at time zone tz` for a UTC instant held as timestamp_ntz."""
    c = F.col(c) if isinstance(c, str) else c
    if tz is None or tz.upper() == "UTC":
        return c
    return F.from_utc_timestamp(c.cast("timestamp"), tz).cast("timestamp_ntz")


def local_day(c, tz: str | None = None) -> Column:
    """date(t) or date(t at time zone tz)."""
    return F.to_date(local_ts(c, tz))


def in_days(c, d0=None, d1=None, tz: str | None = None, end_inclusive: bool = True) -> Column:
    """date(t [at time zone tz]) between d0 and d1 as a pushdown-friendly range.

    Either bound may be None (open). end_inclusive=False reproduces `< d1`.
    """
    c = F.col(c) if isinstance(c, str) else c
    zone = ZoneInfo(tz) if tz else UTC
    cond = F.lit(True)
    if d0 is not None:
        lo = dt.datetime.combine(_as_date(d0), dt.time(), zone).astimezone(UTC)
        cond = cond & (c >= ts_lit(lo.replace(tzinfo=None)))
    if d1 is not None:
        last = _as_date(d1) if end_inclusive else _as_date(d1) - dt.timedelta(days=1)
        hi = dt.datetime.combine(last + dt.timedelta(days=1), dt.time(), zone).astimezone(UTC)
        cond = cond & (c < ts_lit(hi.replace(tzinfo=None)))
    return cond


def whole_days_between(start: Column, end: Column) -> Column:
    """date_diff('day', start, end) on timestamps: whole 24-hour days."""
    return F.timestamp_diff("DAY", start, end)
