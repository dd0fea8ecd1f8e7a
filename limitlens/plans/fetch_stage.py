"""Weekly job 2: trim the cached window and add what is missing."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame

from limitlens.config import Settings
from limitlens.sinks.refresh import RefreshResult, expire_days, refresh_window


def run(
    source: DataFrame,
    catalog: DataFrame,
    root: str,
    manifest_root: str,
    end: date,
    settings: Settings = Settings(),
    log_root: str | None = None,
    run_time: str | None = None,
    attempt: int = 1,
    verify: bool = False,
) -> RefreshResult:
    expire_days(source.sparkSession, root, manifest_root, end - timedelta(days=settings.window_days - 1))
    return refresh_window(source, catalog, root, manifest_root, end, settings, log_root, run_time, attempt, verify)
