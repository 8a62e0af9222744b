"""Age and rounded-age expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: age uses 365-day years (seconds / 60 / 60 / 24 / 365).
DAYS_PER_YEAR = 365.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(c) -> Column:
    """FN7: seconds since the epoch of a date (midnight UTC in any session)."""
    return F.unix_date(_c(c).cast("date")).cast("long") * 86_400


def age_years(later, earlier) -> Column:
    """FN8: fractional years between two dates, 365-day years.

    For DATE inputs the epoch-second difference divided by 86,400 is the
    whole-day difference in a UTC session, so ``datediff`` is used: the same
    value, independent of the session time zone, and it stays inside codegen.
    """
    return F.datediff(_c(later), _c(earlier)) / F.lit(DAYS_PER_YEAR)


def rounded_age_floor(c) -> Column:
    """FN9: FLOOR(age) -> integer age (first dashboard)."""
    return F.floor(_c(c)).cast("int")


def rounded_age_ceil(c) -> Column:
    """FN10: CEILING(age) -> integer age (second dashboard)."""
    return F.ceil(_c(c)).cast("int")
