"""Fiscal work weeks (Sunday to Saturday)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from limitlens.functions.dates import week_start


def build_calendar(spans: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Calendar rows that cover ``first``..``last`` (one row in, one row per week out).

    ``year_ww`` counts weeks within the year of the week's Saturday.
    """
    weeks = spans.select(
        F.explode(
            F.sequence(
                week_start(F.col(first)), week_start(F.col(last)), F.expr("interval 7 days")
            )
        ).alias("ww_start_date")
    )
    end = F.date_add("ww_start_date", 6)
    week = F.floor((F.dayofyear(end) - 1) / 7) + 1
    return weeks.select(
        F.col("ww_start_date"),
        end.alias("ww_end_date"),
        F.concat(
            F.year(end).cast("string"), F.lit("-"), F.lpad(week.cast("string"), 2, "0")
        ).alias("year_ww"),
    )


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per calendar day, so a lookup is an equi join and not a range join."""
    return calendar.select(
        F.explode(F.sequence("ww_start_date", "ww_end_date")).alias("day"), "year_ww"
    ).groupBy("day").agg(F.min("year_ww").alias("year_ww"))


def with_work_week(
    rows: DataFrame, calendar: DataFrame, when: Column, out: str = "year_ww"
) -> DataFrame:
    """Work week of a date or time; NULL outside the calendar.

    The time is cut to its date first, so the whole last day belongs to its week. A calendar
    has at most one row per day of its years, which bounds the broadcast.
    """
    days = calendar_days(calendar).withColumnRenamed("year_ww", out)
    return (
        rows.withColumn("_day", when.cast("date"))
        .join(F.broadcast(days).withColumnRenamed("day", "_day"), "_day", "left")
        .drop("_day")
    )
