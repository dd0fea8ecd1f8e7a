"""Date arithmetic. Dates stay DATE and times stay TIMESTAMP_NTZ; text only at the edges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_or(text: Column, fallback: Column) -> Column:
    """Parse ``yyyy-MM-dd`` text; bad or missing text gives ``fallback``."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), fallback)


def window_start(end: Column, days: int) -> Column:
    """First day of the inclusive ``days``-day window that ends on ``end``."""
    return F.date_sub(end, days - 1)


def window_days(end: Column, days: int) -> Column:
    """Array of the window's dates, newest first."""
    return F.reverse(F.sequence(window_start(end, days), end))


def in_window(day: Column, end: Column, days: int) -> Column:
    return day.between(window_start(end, days), end)


def is_expired(day: Column, end: Column, days: int) -> Column:
    """Strictly older than the window."""
    return day < window_start(end, days)


def past_time_text(now: Column, days_back: int) -> Column:
    """``now`` minus whole days, as ``yyyy-MM-dd HH:mm:ss`` text (fractions cut off)."""
    past = now - F.make_dt_interval(F.lit(days_back))
    return F.substring(past.cast("string"), 1, 19)


def range_from_text(now: Column, days_back: int) -> Column:
    return F.date_sub(now.cast("date"), days_back).cast("string")


def range_to_text(now: Column) -> Column:
    return now.cast("date").cast("string")


def day_closed(day: Column, run_date: Column) -> Column:
    """1 when the calendar day was already over on the run date, else 0."""
    return (day < run_date).cast("int")


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(day, F.dayofweek(day) - 1)
