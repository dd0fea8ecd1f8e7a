"""The rolling window of cached readings: what is there, what is missing, what has expired."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from limitlens.config import Settings
from limitlens.functions.dates import day_closed, in_window, is_expired, window_days, window_start
from limitlens.functions.text import key_date, key_tool


def window_dates(ends: DataFrame, end: str, days: int) -> DataFrame:
    """The ``days`` dates up to each row's end date, with their age in days (newest is 0)."""
    return ends.select(
        F.posexplode(window_days(F.col(end), days)).alias("days_back", "d")
    ).select("d", "days_back")


def dates_to_fetch(
    window: DataFrame, complete: DataFrame | None, end: Column, settings: Settings = Settings()
) -> DataFrame:
    """Window dates that are not complete yet, oldest first.

    Without ``prefill`` only the newest ``current_week_days`` days are considered.
    """
    wanted = window.select("d").distinct()
    if not settings.prefill:
        wanted = wanted.where(F.col("d") >= window_start(end, settings.current_week_days))
    if complete is not None:
        wanted = wanted.join(complete.select("d").distinct(), "d", "left_anti")
    return wanted.orderBy("d")


def specs_digest(catalog: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(eqp_id, specs_digest): each tool's specs of an allowed grade, in any order, as one text."""
    allowed = F.coalesce(F.col("grade").isin(*settings.grades), F.lit(False))
    specs = catalog.groupBy("eqp_id", "spec_id").agg(F.max(allowed).alias("allowed"))
    part = lambda h: F.sum(F.when(F.col("allowed"), h.cast("decimal(20,0)")))
    return specs.groupBy("eqp_id").agg(F.concat_ws(
        ":", F.count_if("allowed").cast("string"),
        part(F.xxhash64("spec_id")).cast("string"), part(F.xxhash64(F.lit(1), "spec_id")).cast("string"),
    ).alias("specs_digest"))


def window_length(settings: Settings) -> int:
    """Days that a refresh looks at."""
    return settings.window_days if settings.prefill else min(settings.current_week_days, settings.window_days)


def fetch_plan(
    tools: DataFrame,
    manifest: DataFrame | None,
    end: Column,
    settings: Settings = Settings(),
) -> DataFrame:
    """Every (tool, date) of the window that the manifest does not hold as a closed day.

    Each tool row unfolds its own dates: there is no cross join. A day that was still open
    when it was read is fetched again; an empty closed day is not.
    """
    wanted = tools.select("eqp_id").distinct().select(
        "eqp_id", F.explode(F.reverse(window_days(end, window_length(settings)))).alias("d")
    )
    if manifest is None:
        return wanted
    closed = manifest.where("day_closed = 1")
    return wanted.join(closed.select("eqp_id", "d"), ["eqp_id", "d"], "left_anti")


def refresh_plan(
    manifest: DataFrame, digests: DataFrame, end: Column, settings: Settings = Settings()
) -> DataFrame:
    """(eqp_id, d, read_for): tool-days of the window that are not stored as the catalog wants them.

    ``digests`` has every tool of the catalog, see :func:`specs_digest`.
    ``read_for`` is empty where the whole tool-day has to be read, and the digest of the specs that it
    was read for where only the difference matters. A change of specs touches closed days only: an open one is read anyway.
    """
    wanted = fetch_plan(digests, None, end, settings)
    closed = manifest.where("day_closed = 1 and specs_digest is not null").select("eqp_id", "d", F.col("specs_digest").alias("_was"))
    now = digests.select("eqp_id", F.col("specs_digest").alias("_now"))
    return (
        wanted.join(now, "eqp_id")
        .join(closed, ["eqp_id", "d"], "left")
        .where("_was is null or _was <> _now")
        .select("eqp_id", "d", F.coalesce("_was", F.lit("")).alias("read_for"))
    )


def specs_to_read(plan: DataFrame, allowed: DataFrame, ledger: DataFrame) -> DataFrame:
    """(eqp_id, read_for, spec_id): the allowed specs that a planned tool-day was not read for yet."""
    had = ledger.withColumnRenamed("specs_digest", "read_for")
    return (
        plan.select("eqp_id", "read_for").distinct()
        .join(allowed, "eqp_id")
        .join(had, ["eqp_id", "read_for", "spec_id"], "left_anti")
        .select("eqp_id", "read_for", "spec_id")
    )


def content_sum(columns: Sequence[str]) -> Column:
    """Sum of the rows' hashes over ``columns``: the same for the same rows in any order."""
    return F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast("decimal(38,0)")


def damaged_tool_days(manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """(eqp_id, d, status) of tool-days whose stored rows are not those that the manifest promises.

    Both sides have row_count and content_sum; status as in :func:`verify_manifest`.
    """
    found = verify_manifest(
        manifest.select("eqp_id", "d", "row_count", F.col("content_sum").alias("byte_size")),
        stored.select("eqp_id", "d", "row_count", F.col("content_sum").alias("byte_size")),
    )
    return found.where("status <> 'ok'").select("eqp_id", "d", "status")


# Stored width in bytes of the fixed-size types.
_WIDTHS = {
    T.DoubleType(): 8, T.LongType(): 8, T.TimestampNTZType(): 8, T.TimestampType(): 8,
    T.IntegerType(): 4, T.FloatType(): 4, T.DateType(): 4, T.BooleanType(): 1,
}


def row_bytes(df: DataFrame) -> Column:
    """Width of a row's non-null values. The same before and after a write, whatever the files."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = F.octet_length(field.name).cast("bigint")
        else:
            width = F.when(F.col(field.name).isNotNull(), _WIDTHS[field.dataType])
        total = total + F.coalesce(width, F.lit(0))
    return total


def day_manifest(readings: DataFrame, run_date: Column) -> DataFrame:
    """Rows, bytes and closed flag of each tool-day."""
    return (
        readings.groupBy("eqp_id", "d")
        .agg(F.count("*").alias("row_count"), F.sum(row_bytes(readings)).alias("byte_size"))
        .withColumn("day_closed", day_closed(F.col("d"), run_date))
    )


def with_empty_days(manifest: DataFrame, planned: DataFrame, run_date: Column) -> DataFrame:
    """Add a zero row for each planned tool-day without readings, so it is not asked for again."""
    return (
        planned.select("eqp_id", "d")
        .join(manifest, ["eqp_id", "d"], "left")
        .select(
            "eqp_id",
            "d",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("byte_size", F.lit(0)).alias("byte_size"),
            day_closed(F.col("d"), run_date).alias("day_closed"),
        )
    )


def verify_manifest(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Compare promised with stored tool-days.

    status: ``ok``, ``missing`` (not stored), ``unknown`` (stored but not promised) or
    ``mismatch``. Everything but ``ok`` has to be fetched again.
    """
    left = expected.select(
        "eqp_id", "d", F.col("row_count").alias("expected_rows"), F.col("byte_size").alias("expected_bytes")
    ).where("expected_rows > 0")
    right = stored.select(
        "eqp_id", "d", F.col("row_count").alias("stored_rows"), F.col("byte_size").alias("stored_bytes")
    ).where("stored_rows > 0")
    same = (F.col("expected_rows") == F.col("stored_rows")) & (
        F.col("expected_bytes") == F.col("stored_bytes")
    )
    return left.join(right, ["eqp_id", "d"], "full_outer").withColumn(
        "status",
        F.when(F.col("stored_rows").isNull(), "missing")
        .when(F.col("expected_rows").isNull(), "unknown")
        .when(same, "ok")
        .otherwise("mismatch"),
    )


def parse_keys(files: DataFrame, key: str = "key") -> DataFrame:
    """Tool and date of each stored file; other files and bad dates are left out."""
    return (
        files.withColumn("eqp_id", key_tool(F.col(key)))
        .withColumn("d", key_date(F.col(key)))
        .where(F.col("d").isNotNull())
    )


def expired_files(files: DataFrame, end: Column, days: int, key: str = "key") -> DataFrame:
    """Stored files whose date has left the window."""
    return parse_keys(files, key).where(is_expired(F.col("d"), end, days))


def pending_tools(catalog: DataFrame, *finished: DataFrame) -> DataFrame:
    """Catalog tools that appear in none of the ``finished`` frames."""
    done = finished[0].select("eqp_id")
    for more in finished[1:]:
        done = done.union(more.select("eqp_id"))
    return catalog.select("eqp_id").distinct().join(done.distinct(), "eqp_id", "left_anti")


def completeness(manifest: DataFrame, end: Column, days: int) -> DataFrame:
    """Days recorded per tool against the days expected, so a hole is visible in the report."""
    return (
        manifest.where(in_window(F.col("d"), end, days))
        .groupBy("eqp_id")
        .agg(F.count("*").alias("days_present"), F.sum("day_closed").alias("days_closed"))
        .withColumn("days_expected", F.lit(days))
    )
