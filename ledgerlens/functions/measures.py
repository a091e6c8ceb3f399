"""Column builders for the report measures.

All are native Catalyst expressions, so they stay inside whole-stage codegen
and aggregate partially on the map side before any shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_if(pred: Column, value) -> Column:
    """sum(case when p then x else 0 end): 0, not null, when nothing matches."""
    value = value if isinstance(value, Column) else F.lit(value)
    return F.sum(F.when(pred, value).otherwise(F.lit(0)))


def count_if(pred: Column) -> Column:
    return F.count_if(pred)


def distinct_counts(df: DataFrame, keys: list, value: str, **flags: Column) -> DataFrame:
    """Exact count(distinct value) per `keys` for the rows of each flag, in two levels and without an expand.

    A value is reduced to one row per group on the map side first, with all its
    flags in it; the second level adds them up. Groups whose values are all
    null have no row.
    """
    once = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*[F.max(F.when(p, 1).otherwise(0)).alias(n) for n, p in flags.items()])
    names = [c for c in once.columns if c != value and c not in flags]
    return once.groupBy(*names).agg(*[F.sum(n).alias(n) for n in flags])


def minor_to_major(c) -> Column:
    """Integer minor units to a double in major units, one division at the end."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double") / F.lit(100.0)


def zero_major(c) -> Column:
    """coalesce(x / 100.0, 0) after an outer join: no row becomes 0."""
    return F.coalesce(minor_to_major(c), F.lit(0.0))


# ISO 4217 currencies without a minor unit (exponent 0).
ZERO_DECIMAL_CURRENCIES = (
    "bif", "clp", "djf", "gnf", "jpy", "kmf", "krw", "mga", "pyg", "rwf", "ugx", "vnd", "vuv",
    "xaf", "xof", "xpf",
)


def decimalize(currency: Column, amount: Column, digits: int | None = None) -> Column:
    """X1 decimalize_amount: minor units / 10^exponent(currency), optionally rounded.

    Computed in exact decimals (x * 0.01, not a double division) so that the
    rounding to `digits` is HALF_UP on the true value; returned as double.
    """
    zero = F.lower(currency).isin(*ZERO_DECIMAL_CURRENCIES)
    # 22 digits before the point hold every bigint; 10 after it, every fee here
    exact = amount.cast("decimal(32,10)")
    val = F.when(zero, exact).otherwise(exact * F.lit(Decimal("0.01")))
    scale = 2 if digits is None else digits
    if digits is not None:
        val = F.round(val, digits)
    # fix the scale before the double conversion so both engines convert the
    # same small unscaled integer (exactly representable, one rounding)
    return F.when(currency.isNotNull() & amount.isNotNull(),
                  val.cast(f"decimal(38,{scale})").cast("double"))
