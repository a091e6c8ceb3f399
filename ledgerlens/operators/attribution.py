"""Period-fee attribution (J16 / R5f) without a cross join.

The source spreads each fee over the calendar by crossing calendar x fees
and testing `day between start and end`. A fee counts on day d when
start <= d 00:00 <= end, i.e. from the first midnight at or after `start`
through date(end), clipped to the report range; its daily share is the
billing amount divided by the whole 24-hour days between start and end
(n+1 days share n parts when both ends sit at midnight, as in the source),
and a zero-day period divides to null instead of failing.

Plan: a difference array. Each fee emits +share on its first day and
-share on the day after its last; events are summed per day (map-side
partial aggregation, so any number of fees reduces to at most two rows per
calendar day), and a running sum over the calendar gives each day's total.
Work is 2 events per fee instead of fees x days (or fees x calendar), and
the only single-partition step is the running sum over the calendar, whose
size is the length of the requested range. Decimal addition is exact, so
the totals equal the per-day sums of the source.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timebuckets import ts_lit, whole_days_between
from .calendars import calendar_days


def _d(x):
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x))


def attributed_daily(icplus: DataFrame, d0, d1, amount: str = "billing_amount",
                     out: str = "attr_interchange") -> DataFrame:
    """Per calendar day d0..d1: sum of the shares of every period fee covering it."""
    d0, d1 = _d(d0), _d(d1)
    s, e = F.col("attribution_start_time"), F.col("attribution_end_time")
    # the overlap test on the raw columns, so that it reaches the scan
    fees = icplus.where((e >= ts_lit(d0)) & (s < ts_lit(d1 + dt.timedelta(days=1))))
    first = F.when(s == F.to_date(s).cast("timestamp_ntz"), F.to_date(s)) \
             .otherwise(F.date_add(F.to_date(s), 1))
    spans = fees.select(F.greatest(first, F.lit(d0)).alias("_lo"),
                        F.least(F.to_date(e), F.lit(d1)).alias("_hi"),
                        F.try_divide(F.col(amount), whole_days_between(s, e)).alias("_share")) \
                .where(F.col("_lo") <= F.col("_hi"))
    # both events of a fee in one pass
    events = spans.select(F.explode(F.array(
        F.struct(F.col("_lo").alias("day"), F.col("_share").alias("_delta")),
        F.struct(F.date_add("_hi", 1).alias("day"), (-F.col("_share")).alias("_delta")))).alias("e")).select("e.*")
    deltas = events.groupBy("day").agg(F.sum("_delta").alias("_delta"))
    cal = calendar_days(icplus.sparkSession, d0, d1)
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cal.join(deltas, "day", "left").select("day", F.sum("_delta").over(running).alias(out))
