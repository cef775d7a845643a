"""Numeric casts and ratios that return null instead of raising under ANSI."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def to_int(col: Column) -> Column:
    """Integer from text that may read ``1`` or ``1.0``; anything else is null."""
    return col.try_cast("double").try_cast("int")


def from_decimal_comma(col: Column) -> Column:
    """``1.234,56`` to 1234.56."""
    plain = F.replace(F.replace(F.trim(col), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast("double")


def ratio(top: Column, bottom: Column, when_zero: float | None = None) -> Column:
    """``top / bottom`` in double; a zero denominator gives ``when_zero``."""
    divided = top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    if when_zero is None:
        return divided
    return F.when(bottom == 0, F.lit(float(when_zero))).otherwise(divided)


def signed_degrees(deg: Column, minute: Column, second: Column, hemisphere: Column, negative: str) -> Column:
    """Degrees, minutes, seconds and a hemisphere letter to signed decimal degrees."""
    size = to_double(deg) + to_double(minute) / 60.0 + to_double(second) / 3600.0
    return F.when(F.upper(hemisphere) == negative, -size).otherwise(size)
