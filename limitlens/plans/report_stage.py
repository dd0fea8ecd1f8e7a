"""Weekly job 3: statistics, verdicts, confirmation and the published report."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from limitlens.config import Settings
from limitlens.functions.dates import in_window
from limitlens.operators.cache import completeness
from limitlens.operators.calendar import with_work_week
from limitlens.operators.heat import tools_over
from limitlens.operators.verdict import calculations, confirm
from limitlens.plans.resume import resumable_verdicts
from limitlens.sinks.tables import publish_report
from limitlens.sinks.value_runs import cached_runs, refresh_runs
from limitlens.sources.cache import cached_manifest, cached_readings
from limitlens.sources.reports import prior_week_fails
from limitlens.storage import drop_folder, partition_values, scratch_table


def work_weeks(calendar: DataFrame, end: date) -> tuple[str, str]:
    """Work week of the run date and of the date seven days earlier."""
    spark = calendar.sparkSession
    dates = spark.createDataFrame([(0, end), (1, end - timedelta(days=7))], "age INT, day DATE")
    found = {r.age: r.year_ww for r in with_work_week(dates, calendar, F.col("day")).collect()}
    if found[0] is None:
        raise ValueError(f"the calendar does not cover {end}")
    return found[0], found[1] or ""


def build(
    spark: SparkSession,
    catalog: DataFrame,
    root: str,
    manifest_root: str,
    report_root: str,
    previous_week: str,
    end: date,
    settings: Settings = Settings(),
    exclusions: DataFrame | None = None,
    hot_root: str | None = None,
    calculations_root: str | None = None,
    runs_root: str | None = None,
) -> DataFrame:
    """One plan for all tools. The manifest tells which tools could hold a large spec.

    With ``runs_root`` runs of equal values are kept there, and readings are read only of partitions that the cache has
    written since. With ``calculations_root`` verdicts are kept there, and only tools whose inputs have changed are calculated.
    """
    runs = runs_root is not None
    if runs:
        refresh_runs(spark, root, runs_root)
    rows = cached_runs(spark, runs_root) if runs else cached_readings(spark, root)
    readings = rows.where(in_window(F.col("d"), F.lit(end), settings.window_days))
    manifest = cached_manifest(spark, root, manifest_root)
    suspects = tools_over(manifest, settings.hot_rows)
    if calculations_root is None:
        verdicts = calculations(readings, catalog, settings, exclusions=exclusions, suspects=suspects, hot_root=hot_root, runs=runs)
    else:
        window = manifest.where(in_window(F.col("d"), F.lit(end), settings.window_days))
        verdicts = resumable_verdicts(
            readings, catalog, window, calculations_root, settings, f"{end}", exclusions, suspects, runs
        ).verdicts
    report = confirm(verdicts, prior_week_fails(spark, report_root, previous_week))
    return report.join(
        completeness(manifest, F.lit(end), settings.window_days), "eqp_id", "left"
    )


def run(
    spark: SparkSession,
    catalog: DataFrame,
    calendar: DataFrame,
    root: str,
    manifest_root: str,
    report_root: str,
    end: date,
    settings: Settings = Settings(),
    exclusions: DataFrame | None = None,
    replace: bool = True,
    calculations_root: str | None = None,
    runs_root: str | None = None,
) -> str:
    """Publish the report of the run date's work week; returns the week.

    With ``replace=False`` a week that is already published is not calculated again.
    """
    week, previous = work_weeks(calendar, end)
    if not replace and week in partition_values(spark, report_root, "week"):
        return week
    hot_root = scratch_table(spark, "hot_rows")
    try:
        report = build(
            spark, catalog, root, manifest_root, report_root, previous, end, settings, exclusions,
            hot_root, calculations_root, runs_root,
        )
        publish_report(report, report_root, week)
    finally:
        drop_folder(spark, hot_root)
    return week
