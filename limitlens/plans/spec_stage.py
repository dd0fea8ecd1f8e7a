"""Weekly job 1: assemble and publish the spec catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from limitlens.config import Settings
from limitlens.operators.catalog import (
    CatalogSources,
    assemble_catalog,
    typed_catalog,
)
from limitlens.sinks.tables import write_catalog


def build(
    sources: CatalogSources, run_date: Column, run_time: str, settings: Settings = Settings()
) -> DataFrame:
    return typed_catalog(assemble_catalog(sources, run_date, settings), run_time)


def run(
    sources: CatalogSources,
    root: str,
    run_date: Column,
    run_time: str,
    settings: Settings = Settings(),
) -> None:
    write_catalog(build(sources, run_date, run_time, settings), root)
