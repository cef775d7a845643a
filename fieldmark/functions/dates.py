"""Calendar expressions.  Reference months are dates, always the first of the month."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Months that belong to the summer season.
SUMMER_MONTHS = (9, 10, 11, 12, 1)


def parse_date(col: Column) -> Column:
    """ISO date text to a date; unreadable text becomes null."""
    return col.try_cast("date")


def ref_month(col: Column) -> Column:
    return F.trunc(col, "MM")


def relative_duration(days: Column) -> Column:
    return days.cast("double") / F.lit(365.0)


def summer_flag(col: Column) -> Column:
    return F.when(F.month(col).isin(*SUMMER_MONTHS), 1).otherwise(0)


def month_sin(month: Column) -> Column:
    return F.sin(month * F.lit(2 * math.pi / 12))


def month_cos(month: Column) -> Column:
    return F.cos(month * F.lit(2 * math.pi / 12))
