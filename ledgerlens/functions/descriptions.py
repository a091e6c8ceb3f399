"""Fee-description parsing.

Fee ledger rows carry their service period as text:
``Name (YYYY-MM-DD): ...`` or ``Name (YYYY-MM-DD - YYYY-MM-DD): ...``.
Two parsers exist in the reports: a regex form (validated pattern, start
and end extracted) and a position form (10 characters after the first
``(`` / before the first ``)``). Both are native column expressions; text
that does not parse yields null instead of failing (try_cast).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The period-text pattern, the period extractors and the
# prefixes that mark interchange-plus fee rows.
PERIOD_TEXT = r"^[\w\(\)\+ ]+ \(\d{4}-\d{2}-\d{2}( - \d{4}-\d{2}-\d{2})?\): .+$"
PERIOD_START = r"\((\d{4}-\d{2}-\d{2})"
PERIOD_END = r"(\d{4}-\d{2}-\d{2})\)"
ICPLUS_PREFIX = r"^(Card payments|IC\+|Interchange plus)"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def has_period(desc) -> Column:
    return _c(desc).rlike(PERIOD_TEXT)


def _extract(desc, pattern) -> Column:
    # regexp_extract gives '' on no match; the source engine gives null.
    return F.nullif(F.regexp_extract(_c(desc), pattern, 1), F.lit(""))


def period_start(desc) -> Column:
    """Start of the service period as a timestamp (midnight), null if absent."""
    return _extract(desc, PERIOD_START).try_cast("timestamp_ntz")


def period_end(desc) -> Column:
    return _extract(desc, PERIOD_END).try_cast("timestamp_ntz")


def is_icplus(desc) -> Column:
    return _c(desc).rlike(ICPLUS_PREFIX)


def date_after_open_paren(desc) -> Column:
    """date(substr(d, position('(' in d) + 1, 10)); null when it is not a date."""
    d = _c(desc)
    return d.substr(F.locate("(", d) + F.lit(1), F.lit(10)).try_cast("date")


def date_before_close_paren(desc) -> Column:
    """date(substr(d, position(')' in d) - 10, 10)); null when it is not a date."""
    d = _c(desc)
    return d.substr(F.locate(")", d) - F.lit(10), F.lit(10)).try_cast("date")
