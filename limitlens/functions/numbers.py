"""Guarded arithmetic for ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column, digits: int = 3) -> Column:
    """Rounded ratio; NULL when the divisor is 0."""
    return F.round(F.try_divide(part, whole), digits)


def guarded_average(total: Column, count: Column) -> Column:
    """``total / count``, or 0 when nothing was counted."""
    return F.coalesce(F.try_divide(total, count), F.lit(0.0))


def megabytes(size: Column) -> Column:
    return size / F.lit(1024 * 1024)


def numeric_limit(text: Column) -> Column:
    """Limit text to a double; anything that is not a finite number gives NULL."""
    value = F.trim(text.cast("string")).try_cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)
