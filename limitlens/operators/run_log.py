"""The run log of fetched units and what is read from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limitlens.functions.numbers import guarded_average, ratio


def run_log(units: DataFrame) -> DataFrame:
    """Complete a unit's facts: how far the estimate was off, and the total time.

    ``est_over_actual`` above 1 means that the rows were over-estimated.
    """
    return units.withColumn(
        "est_over_actual", ratio(F.col("est_rows"), F.col("actual_rows"))
    ).withColumn("total_sec", F.col("fetch_sec") + F.col("write_sec"))


def _units(status: str) -> Column:
    return F.count(F.when(F.col("status") == status, 1))


def run_log_summary(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters, high-water mark and guarded averages of a run; failures also by stage."""
    minutes = F.sum("total_sec") / 60
    failed = F.col("status") == "failed"
    return log.groupBy(*by).agg(
        F.count("*").alias("checked"),
        _units("wrote").alias("uploaded"),
        _units("empty").alias("empty"),
        _units("failed").alias("failed"),
        _units("skipped_existing").alias("skipped_existing"),
        F.count(F.when(F.col("status").isin("wrote", "empty") | (failed & (F.col("stage") != "fetch")), 1)).alias("fetched"),
        F.count(F.when(failed & (F.col("stage") == "fetch"), 1)).alias("failed_fetch"),
        F.count(F.when(failed & (F.col("stage") == "upload"), 1)).alias("failed_upload"),
        F.sum("actual_rows").alias("rows"),
        F.max("actual_rows").alias("rows_high_water"),
        guarded_average(F.sum("actual_rows"), _units("wrote")).alias("avg_rows"),
        guarded_average(F.sum("fetch_sec"), F.count("fetch_sec")).alias("avg_fetch_sec"),
        guarded_average(F.sum("write_sec"), F.count("write_sec")).alias("avg_write_sec"),
        guarded_average(_units("wrote"), minutes).alias("files_per_min"),
        F.count(F.when(F.col("est_over_actual") > 1, 1)).alias("over_estimated"),
    )


def failed_units(log: DataFrame) -> DataFrame:
    """Units to run again: those whose last attempt failed.

    The last attempt is that of the latest run, and of its attempts the one with the highest
    number. Where a log has no attempt numbers, a success beats a failure of the same time.
    """
    attempt = F.col("attempt") if "attempt" in log.columns else F.lit(None).cast("int")
    order = F.struct(
        F.col("timestamp"), F.coalesce(attempt, F.lit(0)), (F.col("status") != "failed").cast("int"), "stage", "error"
    )
    last = log.groupBy("eqp_id", "d").agg(
        F.max_by(F.struct("status", "stage", "error"), order).alias("_last")
    )
    return last.where(F.col("_last.status") == "failed").select(
        "eqp_id", "d", F.col("_last.stage"), F.col("_last.error")
    )
