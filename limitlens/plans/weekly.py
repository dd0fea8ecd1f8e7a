"""The three weekly jobs in order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from limitlens import schemas
from limitlens.config import Settings
from limitlens.operators.catalog import CatalogSources
from limitlens.plans import fetch_stage, report_stage, spec_stage
from limitlens.sinks.catalog_weeks import catalog_as_of, publish_catalog_week
from limitlens.sources.catalog import scan_catalog
from limitlens.sources.tables import read_table


@dataclass(frozen=True)
class Roots:
    """Table locations on shared storage. With ``calculations`` a repeated report calculates only what has changed;
    with ``runs`` it reads only the readings that are new in the cache; with ``catalog_weeks`` the week's catalog is kept, and the report of a week joins that week's."""

    catalog: str
    readings: str
    manifest: str
    report: str
    log: str
    calculations: str | None = None
    catalog_weeks: str | None = None
    runs: str | None = None


def run(
    sources: CatalogSources,
    readings: DataFrame,
    calendar: DataFrame,
    roots: Roots,
    end: date,
    settings: Settings = Settings(),
    exclusions: DataFrame | None = None,
) -> str:
    """Catalog, cache, report. Each step can be repeated; returns the published week."""
    spark = readings.sparkSession
    spec_stage.run(sources, roots.catalog, F.lit(end), f"{end} 00:00:00", settings)
    catalog = scan_catalog(spark, roots.catalog, "fixed")
    if roots.catalog_weeks is not None:
        week, _ = report_stage.work_weeks(calendar, end)
        publish_catalog_week(read_table(spark, roots.catalog, schemas.SPEC_CATALOG), roots.catalog_weeks, week)
        catalog = catalog_as_of(spark, roots.catalog_weeks, week, "fixed").select(*catalog.columns)
    fetch_stage.run(readings, catalog, roots.readings, roots.manifest, end, settings, roots.log)
    return report_stage.run(
        spark, catalog, calendar, roots.readings, roots.manifest, roots.report, end, settings,
        exclusions, calculations_root=roots.calculations, runs_root=roots.runs,
    )
