"""Calendar spines (S2, S3) and the first-activity gate.

A calendar is generated from its two literal bounds, so its size is the
length of the requested range, never a function of the data; joins against
it broadcast the calendar (or the per-day measure, both bounded by days).
It is generated over several partitions, so the joins streamed over it run
in parallel rather than in a single task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def _parts(spark: SparkSession, n: int) -> int:
    # The spine is the streamed side of the joins hung on it; give it one
    # partition per core (never more than rows) so those joins run in parallel.
    return max(1, min(n, spark.sparkContext.defaultParallelism))


def calendar_days(spark: SparkSession, d0, d1, name: str = "day") -> DataFrame:
    """One row per day d0..d1, both ends included."""
    d0, d1 = _date(d0), _date(d1)
    n = (d1 - d0).days + 1
    if n <= 0:
        return spark.range(0).select(F.lit(d0).alias(name))
    return spark.range(0, n, 1, _parts(spark, n)).select(
        F.date_add(F.lit(d0), F.col("id").cast("int")).alias(name))


def month_range(spark: SparkSession, m0: str, m1: str, name: str = "month") -> DataFrame:
    """Months m0..m1 ('YYYY-MM', inclusive) as first-of-month dates."""
    a = dt.date.fromisoformat(m0 + "-01")
    b = dt.date.fromisoformat(m1 + "-01")
    n = (b.year - a.year) * 12 + b.month - a.month + 1
    if n <= 0:
        return spark.range(0).select(F.lit(a).alias(name))
    return spark.range(0, n, 1, _parts(spark, n)).select(
        F.add_months(F.lit(a), F.col("id").cast("int")).alias(name))


def month_bounds(m0: str, m1: str) -> tuple[dt.date, dt.date]:
    """First day of m0 and the first day after m1: a half-open pushdown range."""
    a = dt.date.fromisoformat(m0 + "-01")
    b = dt.date.fromisoformat(m1 + "-01")
    nxt = dt.date(b.year + (b.month == 12), b.month % 12 + 1, 1)
    return a, nxt


def first_activity(measure: DataFrame, col: str = "day") -> Column:
    """Scalar subquery `(select min(col) from measure)`; null when measure is empty."""
    return measure.select(F.min(col)).scalar()


def gate(spine: DataFrame, measure: DataFrame, col: str = "day") -> DataFrame:
    """Keep spine days on or after the first day the measure has a row."""
    return spine.where(F.col(col) >= first_activity(measure, col))


def gate_joined(joined: DataFrame, marker: str, col: str = "day") -> DataFrame:
    """P18 for a calendar-grain result already joined to its measure.

    `marker` is a measure column that is non-null exactly where the measure
    had a row. The first such day comes from a window over the joined result
    instead of a second evaluation of the measure. The window has a single
    partition, so use it only where the result is bounded by the calendar
    (one or a few rows per requested day), never per merchant.
    """
    first = F.min(F.when(F.col(marker).isNotNull(), F.col(col))).over(
        Window.partitionBy(F.lit(0)))
    return joined.withColumn("_first_day", first) \
                 .where(F.col(col) >= F.col("_first_day")).drop("_first_day")
