"""Days that a measure has rows on, as a bitmap inside the plan.

A per-merchant report needs two facts about its own aggregate: the first day of
its gate measure, and the days without any row, which it shows once. Both come
from a scalar subquery over that same aggregate: a bitmap with one bit per day
of the requested range (4 KB for 89 years) and a minimum. The subquery reads
every column of the aggregate, so its shuffle is the report's own one, which
Spark then runs once and reads twice; the sources are scanned once, and no job
runs while the plan is built.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendars import calendar_days

#: Bits of one bitmap of `bitmap_construct_agg`.
_BITS = 32_768


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def _place(day: Column, d0) -> Column:
    return F.datediff(day, F.lit(_date(d0))).cast("bigint")


def days_seen(rows: DataFrame, d0, d1, present: Column | None = None, gate: Column | None = None) -> Column:
    """Scalar subquery over `rows` (a result of groupBy, with `day`): struct of `days`, the bitmaps of the
    days from d0 to d1 that have a `present` row, and `first`, the first day of a `gate` row."""
    n = (_date(d1) - _date(d0)).days + 1
    place = _place(F.col("day"), d0)
    counts = (F.lit(True) if present is None else present) & place.between(0, n - 1)
    maps = [F.bitmap_construct_agg(F.when(counts & (F.floor(place / _BITS) == k), place % _BITS)) for k in range(-(-max(n, 1) // _BITS))]
    first = F.min("day" if gate is None else F.when(gate, F.col("day")))
    # reads all columns: with fewer of them the shuffle below would be another one
    whole = F.bit_xor(F.xxhash64(*rows.columns))
    found = rows.agg(*[m.alias(f"m{k}") for k, m in enumerate(maps)], first.alias("first"), whole.alias("whole"))
    return found.select(F.struct(F.array(*[f"m{k}" for k in range(len(maps))]).alias("days"), "first", "whole")).scalar()


def is_seen(seen: Column, day: Column, d0) -> Column:
    """Whether the bit of `day` is set in the bitmaps of `days_seen`."""
    place = _place(day, d0)
    bitmap = F.element_at(seen.getField("days"), (F.floor(place / _BITS) + 1).cast("int"))
    one = F.substring(bitmap, (F.floor(place % _BITS / 8) + 1).cast("int"), F.lit(1))
    byte = F.conv(F.hex(one), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def days_unseen(spark, seen: Column, d0, d1) -> DataFrame:
    """The days from d0 to d1 without a row."""
    return calendar_days(spark, d0, d1).where(~is_seen(seen, F.col("day"), d0))
