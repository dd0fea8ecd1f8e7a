"""Name -> query on the given tables. Floating results are rounded so engines can be compared."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from limitlens import schemas
from limitlens.functions import dates, text
from limitlens.operators import cache, catalog, profile, run_log, stats, verdict
from limitlens.operators.calendar import build_calendar, with_work_week
from limitlens.operators.heat import tools_over
from limitlens.operators.rules import with_verdict
from limitlens.plans import fetch_stage, spec_stage, weekly
from limitlens.plans.resume import resumable_verdicts
from limitlens.queries import fixtures as fx
from limitlens.sinks import catalog_weeks as weeks
from limitlens.sinks import tables as sinks
from limitlens.sinks.refresh import verify_cache
from limitlens.sinks.value_runs import cached_runs, refresh_runs
from limitlens.storage import drop_folder, durable, scratch_table
from limitlens.sources.cache import cached_manifest, cached_readings
from limitlens.sources.catalog import scan_catalog
from limitlens.sources.readings import readings_filtered as filtered
from limitlens.sources.readings import tool_window_scan as window_scan
from limitlens.sources.reports import prior_week_fails as prior_fails
from limitlens.sources.reports import report_week
from limitlens.sources.tables import read_run_log, read_table, stored_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Decimal places that compare safely: exact interpolations keep more than sums do.
_PLACES = {
    "mean": 8, "ucl": 8, "lcl": 8,
    "q1": 9, "q3": 9, "lower_bound": 9, "upper_bound": 9,
    "p_low": 9, "median": 9, "p_high": 9, "mad": 9,
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame) -> DataFrame:
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(
        *[F.round(c, _PLACES.get(c, 6)).alias(c) if c in doubles else F.col(c) for c in df.columns]
    )


# --- statistics, rules, report ------------------------------------------------------------


def _window(spark: SparkSession, sf_dir: str, window: int) -> DataFrame:
    first, last = fx.WINDOWS[window]
    return fx.readings(spark, sf_dir).where(
        F.col("d").between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    )


def _graded_window(spark: SparkSession, sf_dir: str, window: int) -> tuple[DataFrame, DataFrame]:
    return _window(spark, sf_dir, window), fx.graded(fx.registrations(spark, sf_dir))


@query
def outlier_bounds(spark, sf_dir):
    return rounded(stats.outlier_bounds(_window(spark, sf_dir, verdict.CURRENT), settings=fx.SETTINGS))


@query
def latest_limits(spark, sf_dir):
    return stats.latest_limits(_window(spark, sf_dir, verdict.CURRENT))


@query
def spec_stats(spark, sf_dir):
    return rounded(
        stats.spec_stats(_window(spark, sf_dir, verdict.CURRENT), settings=fx.SETTINGS, spread=True)
    )


@query
def rolling_spec_stats(spark, sf_dir):
    """As ``spec_stats``, from runs by day: the second week's statistics read the readings of ``days_read`` of 23 days."""
    rows = fx.readings(spark, sf_dir)
    every = fx.registrations(spark, sf_dir).withColumn("grade", F.lit("G1"))
    root, manifest, runs = (scratch_table(spark, n) for n in ("readings", "manifest", "runs"))
    settings = replace(fx.SETTINGS, window_days=23)
    for end in (fx.date(2024, 1, 23), fx.RUN_DAY):
        fetch_stage.run(rows.where(F.col("d") <= F.lit(end)), every, root, manifest, end, settings)
        read = refresh_runs(spark, root, runs)
    days = len({part.split("/")[0] for part in read})
    found = stats.spec_stats(cached_runs(spark, runs), settings=settings, spread=True, runs=True)
    return rounded(found).withColumn("days_read", F.lit(days))


@query
def control_limits(spark, sf_dir):
    rows, specs = _graded_window(spark, sf_dir, verdict.CURRENT)
    found = verdict.calculations(rows, specs, fx.SETTINGS)
    return rounded(found.select("spec_id", "pattern", "ucl", "lcl"))


@query
def compliance_verdict(spark, sf_dir):
    rows, specs = _graded_window(spark, sf_dir, verdict.CURRENT)
    return rounded(
        verdict.calculations(rows, specs, fx.SETTINGS).select(
            "spec_id", "eqp_id", "pattern", "grade", "n_points", "mean", "std", "cv",
            "upper_spec", "lower_spec", "sigma_ratio", "relative_ratio", "cww_fail",
        )
    )


@query
def suppression_reasons(spark, sf_dir):
    settings = replace(fx.SETTINGS, min_std=25.0, few_points_floor=8)
    specs = catalog.distinct_specs(
        fx.graded(fx.registrations(spark, sf_dir)).select("eqp_id", "spec_id", "pattern"), (), stats.SPEC
    )
    found = stats.spec_stats(_window(spark, sf_dir, verdict.CURRENT), settings=settings)
    judged = with_verdict(
        found.join(specs, list(stats.SPEC)),
        settings,
        fx.carve_outs(spark, sf_dir),
    )
    return judged.select("spec_id", "n_points", "suppress_reason", "cww_fail")


@query
def prior_week_fails(spark, sf_dir):
    """Publishes the prior window's verdicts as a week and reads the flags back."""
    rows, specs = _graded_window(spark, sf_dir, verdict.PRIOR)
    root = scratch_table(spark, "report")
    sinks.publish_report(
        verdict.confirm(verdict.calculations(rows, specs, fx.SETTINGS), None), root, "2024-04"
    )
    return prior_fails(spark, root, "2024-04")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.weekly_report(
        fx.readings(spark, sf_dir), fx.graded(fx.registrations(spark, sf_dir)), fx.WINDOWS, fx.SETTINGS
    )


REPORT_COLUMNS = (
    "spec_id", "eqp_id", "pattern", "grade", "n_points", "mean", "std", "cv", "upper_spec",
    "lower_spec", "ucl", "lcl", "suppress_reason", "cww_fail", "pww_fail", "fail",
)


@query
def weekly_report(spark, sf_dir):
    return rounded(_report(spark, sf_dir).select(*REPORT_COLUMNS))


@query
def publish_report(spark, sf_dir):
    """Writes the report's week twice (the second run replaces the first) and reads it back."""
    root = scratch_table(spark, "report")
    for _ in range(2):
        sinks.publish_report(_report(spark, sf_dir), root, "2024-05")
    return rounded(report_week(spark, root, "2024-05").select(*REPORT_COLUMNS, "week"))


@query
def tool_status(spark, sf_dir):
    """Outcome per tool for the last three days, where many specs have too few points."""
    rows = fx.readings(spark, sf_dir).where(F.col("d") >= F.date_sub(fx.run_day(), 2))
    specs = fx.graded(fx.registrations(spark, sf_dir))
    settings = replace(fx.SETTINGS, min_points=3)
    return verdict.tool_status(
        fx.registrations(spark, sf_dir), rows, verdict.calculations(rows, specs, settings)
    )


@query
def weekly_job(spark, sf_dir):
    """The three jobs for two weeks in a row, each from what it has stored; the second week's report is read back."""
    roots = weekly.Roots(*(scratch_table(spark, n) for n in ("catalog", "readings", "manifest", "report", "log", "calculations")))
    rows, sources = fx.readings(spark, sf_dir), fx.reading_sources(spark, sf_dir)
    calendar = build_calendar(rows.agg(F.min("d").alias("first_day"), F.max("d").alias("last_day")))
    settings = replace(fx.SETTINGS, window_days=23)
    for end in (fx.date(2024, 1, 23), fx.RUN_DAY):
        week = weekly.run(sources, rows.where(F.col("d") <= F.lit(end)), calendar, roots, end, settings)
    return rounded(report_week(spark, roots.report, week).select(*REPORT_COLUMNS))


@query
def report_resumed(spark, sf_dir):
    """What comes of each tool in a report over the last three days, and in a repeated one for which every third tool has lost its errors."""
    specs = fx.registrations(spark, sf_dir)
    rows = fx.readings(spark, sf_dir).where(F.col("d") >= F.date_sub(fx.run_day(), 2))
    lost = (F.col("eqp_id").cast("long") % 3 == 0) & (F.col("processid") == "error")
    root, settings = scratch_table(spark, "calculations"), replace(fx.SETTINGS, min_points=3, tool_buckets=4)
    found = []
    for part in (rows, rows.where(~lost)):
        days = part.groupBy("eqp_id", "d").agg(
            F.count("*").alias("row_count"), cache.content_sum(schemas.READINGS.names).alias("content_sum")
        )
        found.append(resumable_verdicts(part, specs, days, root, settings))
    first, second = found
    verdicts = second.verdicts.groupBy("eqp_id").agg(F.count("*").alias("n"), F.sum("n_points").alias("points"))
    return (
        first.states.select("eqp_id", F.col("state").alias("first_state"))
        .join(second.states.select("eqp_id", F.col("state").alias("second_state")), "eqp_id")
        .join(verdicts, "eqp_id", "left")
        .select("eqp_id", "first_state", "second_state", F.coalesce("n", F.lit(0)).alias("specs"), F.coalesce("points", F.lit(0)).alias("points"))
    )


# --- catalog ------------------------------------------------------------------------------


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.assemble_catalog(
        fx.catalog_sources(spark, sf_dir), F.lit(fx.CATALOG_DAY), fx.CATALOG_SETTINGS
    )


@query
def catalog_assemble(spark, sf_dir):
    return _catalog(spark, sf_dir)


@query
def catalog_dedup(spark, sf_dir):
    return catalog.distinct_specs(fx.spec_limits(spark, sf_dir))


@query
def catalog_fixed(spark, sf_dir):
    return catalog.fixed_catalog(_catalog(spark, sf_dir))


@query
def catalog_auto(spark, sf_dir):
    return catalog.auto_catalog(_catalog(spark, sf_dir))


@query
def catalog_union(spark, sf_dir):
    return spec_stage.build(
        fx.catalog_sources(spark, sf_dir), F.lit(fx.CATALOG_DAY), fx.RUN_TIME, fx.CATALOG_SETTINGS
    )


@query
def spec_catalog_scan(spark, sf_dir):
    """Publishes the catalog and reads the fixed specs back."""
    root = scratch_table(spark, "catalog")
    sinks.write_catalog(catalog_union(spark, sf_dir), root)
    return scan_catalog(spark, root, "fixed")


def _next_week(specs: DataFrame) -> DataFrame:
    """A week later: every fifth parameter's specs are gone, the upper limits of those above 50 are raised, and all rows made anew."""
    raised = F.when(F.col("upper_spec") > 50, F.col("upper_spec") + 1).otherwise(F.col("upper_spec"))
    kept = specs.where(F.pmod(F.col("param_id"), F.lit(5)) != 0).withColumn("upper_spec", raised)
    return kept.withColumn("script_run_time", F.lit("2024-02-06 06:00:00"))


@query
def catalog_as_of(spark, sf_dir):
    """Two published weeks, the second one twice; what is in force before, in and between them and after."""
    root, specs = scratch_table(spark, "catalog_weeks"), durable(catalog_union(spark, sf_dir))
    weeks.publish_catalog_week(specs, root, "2024-05")
    weeks.publish_catalog_week(specs, root, "2024-08")
    weeks.publish_catalog_week(_next_week(specs), root, "2024-08")
    weeks.publish_catalog_week(specs.where("false"), root, "2024-08", replace=False)
    found = None
    for week in ("2024-04", "2024-05", "2024-07", "2024-09"):
        here = weeks.catalog_as_of(spark, root, week).select("eqp_id", "spec_id", "type", "upper_spec", F.lit(week).alias("asked"))
        found = here if found is None else found.unionByName(here)
    return found


@query
def catalog_changes(spark, sf_dir):
    """What the second of two published weeks has added, removed and changed, read from the weeks."""
    root, specs = scratch_table(spark, "catalog_weeks"), durable(catalog_union(spark, sf_dir))
    late = F.pmod(F.col("param_id"), F.lit(7)) == 0
    weeks.publish_catalog_week(specs.where(~late), root, "2024-05")
    weeks.publish_catalog_week(_next_week(specs), root, "2024-06")
    return weeks.catalog_changes(weeks.catalog_as_of(spark, root, "2024-05"), weeks.catalog_as_of(spark, root, "2024-06"))


@query
def technode_lookup(spark, sf_dir):
    plans = fx.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("plan_id")
    )
    nodes = fx.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("node"))
    return catalog.with_technode(plans, nodes, "plan_id", "n_nationkey")


# --- rolling window -----------------------------------------------------------------------


def _last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.readings(spark, sf_dir).agg(F.max("d").alias("end"))


@query
def window_dates(spark, sf_dir):
    """The window that ends on the newest reading's day."""
    return cache.window_dates(_last_day(spark, sf_dir), "end", fx.SETTINGS.window_days)


@query
def dates_to_fetch(spark, sf_dir):
    window = cache.window_dates(_last_day(spark, sf_dir), "end", fx.SETTINGS.window_days)
    return cache.dates_to_fetch(window, fx.closed_days(spark, sf_dir), fx.run_day(), fx.SETTINGS)


@query
def fetch_plan(spark, sf_dir):
    return cache.fetch_plan(
        fx.tools(spark, sf_dir), fx.cached_manifest(spark, sf_dir), fx.run_day(), fx.SETTINGS
    )


@query
def expired_partitions(spark, sf_dir):
    """Stored files outside the ten days that end on the run date."""
    return cache.expired_files(fx.object_keys(spark, sf_dir), fx.run_day(), 10)


@query
def day_manifest(spark, sf_dir):
    return cache.day_manifest(fx.readings(spark, sf_dir), fx.run_day())


@query
def manifest_verify(spark, sf_dir):
    """Promised tool-days against a store that lost the error readings and the first day."""
    rows = fx.readings(spark, sf_dir)
    stored = rows.where((F.col("processid") != "error") & (F.col("d") > F.lit(fx.FIRST_DAY)))
    promised = rows.where(F.col("d") < fx.run_day())
    return cache.verify_manifest(
        cache.day_manifest(promised, fx.run_day()), cache.day_manifest(stored, fx.run_day())
    )


@query
def window_completeness(spark, sf_dir):
    return cache.completeness(
        cache.day_manifest(fx.readings(spark, sf_dir), fx.run_day()),
        fx.run_day(),
        fx.SETTINGS.window_days,
    )


@query
def pending_tools(spark, sf_dir):
    """Tools without a reading on the last two days."""
    rows = fx.readings(spark, sf_dir)
    raw_done = rows.where(F.col("d") == fx.run_day()).select("eqp_id")
    calc_done = rows.where(F.col("d") == F.date_sub(fx.run_day(), 1)).select("eqp_id")
    return cache.pending_tools(fx.registrations(spark, sf_dir), raw_done, calc_done)


@query
def key_parse(spark, sf_dir):
    parsed = cache.parse_keys(fx.object_keys(spark, sf_dir))
    chunk = F.concat(F.col("eqp_id"), F.lit("_chunk_3.parquet.gz"))
    return parsed.select(
        "key",
        "eqp_id",
        "d",
        text.chunk_tool(chunk).alias("chunk_tool"),
        text.clean_name(F.concat_ws("/", F.lit("raw"), chunk)).alias("clean_name"),
    )


@query
def paths_per_tool(spark, sf_dir):
    found = profile.paths_per_tool(cache.parse_keys(fx.object_keys(spark, sf_dir)))
    return found.select("eqp_id", F.concat_ws(" ", "paths").alias("paths"), "n_files")


# --- calendar -----------------------------------------------------------------------------


def _calendar(spark: SparkSession, sf_dir: str, name: str, column: str) -> DataFrame:
    day = F.col(column).cast("date")
    return build_calendar(
        fx.table(spark, sf_dir, name).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    )


@query
def fiscal_calendar(spark, sf_dir):
    """All work weeks between the first and the last order."""
    return _calendar(spark, sf_dir, "orders", "o_orderdate")


@query
def work_week_lookup(spark, sf_dir):
    """Work week of each reading and of the time seven days before (NULL before the calendar)."""
    weeks = _calendar(spark, sf_dir, "events", "ts")
    rows = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    current = with_work_week(rows, weeks, F.col("ts"))
    return with_work_week(current, weeks, F.date_sub(F.col("ts").cast("date"), 7), "previous_ww")


@query
def date_helpers(spark, sf_dir):
    now = F.col("ts")
    bad = F.when(F.col("event_type") == "error", F.lit("30/01/2024")).otherwise(
        now.cast("date").cast("string")
    )
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        dates.past_time_text(now, 30).alias("past_time"),
        dates.range_from_text(now, 30).alias("date_from"),
        dates.range_to_text(now).alias("date_to"),
        dates.date_or(bad, fx.run_day()).alias("end_date"),
    )


# --- scans and profiles -------------------------------------------------------------------


@query
def tool_window_scan(spark, sf_dir):
    """All catalog tools over the last 23 days, each tool's rows by time."""
    return window_scan(
        fx.readings(spark, sf_dir),
        fx.run_day(),
        23,
        tools=fx.graded(fx.registrations(spark, sf_dir)),
        sort_by="act_time",
    )


@query
def tool_window_scan_lenient(spark, sf_dir):
    """As above under older column names; a column that the files lack is left out."""
    old = fx.readings(spark, sf_dir).withColumnsRenamed(
        {new: name for name, new in schemas.READINGS_OLD_NAMES.items()}
    )
    return window_scan(
        old,
        fx.run_day(),
        23,
        columns=("eqp_id", "spec_id", *schemas.READINGS_OLD_NAMES),
        sort_by="create_time",
        strict=False,
    )


@query
def readings_filtered(spark, sf_dir):
    first, last = fx.WINDOWS[verdict.CURRENT]
    return filtered(
        fx.readings(spark, sf_dir),
        fx.registrations(spark, sf_dir),
        F.to_date(F.lit(first)),
        F.to_date(F.lit(last)),
        fx.SETTINGS.grades,
        fx.SETTINGS.broadcast_rows,
    )


@query
def specs_by_tool(spark, sf_dir):
    found = profile.specs_by_tool(fx.registrations(spark, sf_dir))
    return found.select("eqp_id", text.quoted_list(F.col("spec_ids")).alias("spec_ids"), "n_specs")


@query
def rows_per_spec(spark, sf_dir):
    return profile.rows_per_spec(fx.readings(spark, sf_dir))


@query
def tool_size_profile(spark, sf_dir):
    return profile.tool_size_profile(
        fx.readings(spark, sf_dir), fx.graded(fx.registrations(spark, sf_dir))
    )


@query
def large_tools(spark, sf_dir):
    """Tools whose manifest adds up to more than 70 readings."""
    return tools_over(cache.day_manifest(fx.readings(spark, sf_dir), fx.run_day()), 70)


@query
def spec_chunks(spark, sf_dir):
    """Tools with 70 readings or more are split into three units."""
    rows = fx.readings(spark, sf_dir)
    return profile.spec_chunks(
        fx.registrations(spark, sf_dir), profile.tool_size_profile(rows), 70, 3
    ).withColumn("est_rows", F.round("est_rows", 6))


@query
def id_list_text(spark, sf_dir):
    """Each line's flags as quoted text, and its numbers as whole-number text."""
    flags = F.array("l_returnflag", "l_linestatus")
    numbers = F.array(F.col("l_partkey").cast("double"), "l_quantity", "l_extendedprice")
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.quoted_list(flags).alias("quoted"),
        text.integer_list(numbers).alias("numbers"),
    )


@query
def size_text_parse(spark, sf_dir):
    size = F.col("p_size").cast("string")
    rows = F.col("p_partkey").cast("string")
    planner = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("Input:"), rows, F.lit("rows(1B)")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("Output:"), rows, F.lit("row("), size, F.lit("B)")))
        .otherwise(F.concat(F.lit("Output:"), rows, F.lit(" rows("), size, F.lit(".5kB) more")))
    )
    return text.parse_size_text(
        fx.table(spark, sf_dir, "part").select("p_partkey", planner.alias("size_text")), "size_text"
    )


# --- run log ------------------------------------------------------------------------------


@query
def run_log_units(spark, sf_dir):
    return rounded(fx.unit_log(spark, sf_dir))


@query
def run_log_summary(spark, sf_dir):
    return rounded(run_log.run_log_summary(fx.unit_log(spark, sf_dir), by=["d"]))


@query
def fetch_failures(spark, sf_dir):
    return run_log.failed_units(fx.unit_log(spark, sf_dir))


# --- sinks --------------------------------------------------------------------------------


@query
def refresh_window(spark, sf_dir):
    """A first run on 2024-01-23 fills the cache; the run on 2024-01-30 adds what is missing."""
    rows = fx.readings(spark, sf_dir)
    specs = fx.graded(fx.registrations(spark, sf_dir))
    root, manifest = scratch_table(spark, "readings"), scratch_table(spark, "manifest")
    first = fx.date(2024, 1, 23)
    known = rows.where(F.col("act_time") < F.lit("2024-01-23 12:00:00").cast("timestamp_ntz"))
    fetch_stage.run(known, specs, root, manifest, first, fx.SETTINGS)
    fetch_stage.run(rows, specs, root, manifest, fx.RUN_DAY, fx.SETTINGS)
    return _cache_content(spark, root, manifest)


def _cache_content(spark: SparkSession, root: str, manifest: str) -> DataFrame:
    """Manifest and stored readings by tool-day, side by side."""
    stored, entries = cached_readings(spark, root), cached_manifest(spark, root, manifest)
    content = stored.groupBy("eqp_id", "d").agg(
        F.count("*").alias("stored_rows"),
        F.round(F.sum("param_value"), 6).alias("value_sum"),
        F.max("reading_id").alias("last_reading"),
    )
    return entries.select("eqp_id", "d", "row_count", "day_closed").join(
        content, ["eqp_id", "d"], "full_outer"
    )


# The day after the last reading: every day with readings is closed.
_AFTER = fx.date(2024, 1, 31)
_WHOLE = replace(fx.SETTINGS, window_days=31, tool_buckets=3)


def _refreshed_twice(spark: SparkSession, sf_dir: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """The cache after a run for each catalog, with what the second one read from the source."""
    rows = fx.readings(spark, sf_dir)
    root, manifest = scratch_table(spark, "readings"), scratch_table(spark, "manifest")
    fetch_stage.run(rows, before, root, manifest, _AFTER, _WHOLE)
    second = fetch_stage.run(rows, after, root, manifest, _AFTER, _WHOLE)
    return _cache_content(spark, root, manifest).withColumn("source_rows", F.lit(second.source_rows).cast("bigint"))


@query
def refresh_new_tool(spark, sf_dir):
    """A tool joins a cache whose days are all closed: its readings are read, and no others."""
    specs = fx.graded(fx.registrations(spark, sf_dir))
    joined = specs.agg(F.max("eqp_id")).first()[0]
    return _refreshed_twice(spark, sf_dir, specs.where(F.col("eqp_id") != joined), specs)


@query
def refresh_new_spec(spark, sf_dir):
    """The tools' "view" specs are new and their "signup" specs regraded: only "view" readings are read."""
    specs = fx.graded(fx.registrations(spark, sf_dir))
    pattern = F.col("pattern")
    regraded = specs.withColumn("grade", F.when(pattern == "PATTERN_D", "G5").otherwise(F.col("grade")))
    return _refreshed_twice(spark, sf_dir, specs.where(pattern != "PATTERN_B"), regraded)


@query
def refresh_verified(spark, sf_dir):
    """A data file of the cache is removed and a value in another changed; the next run finds and mends exactly that."""
    rows, specs = fx.readings(spark, sf_dir), fx.graded(fx.registrations(spark, sf_dir))
    root, manifest = scratch_table(spark, "readings"), scratch_table(spark, "manifest")
    first = fetch_stage.run(rows, specs, root, manifest, _AFTER, _WHOLE)
    names = sorted(r.file_path for r in stored_files(spark, f"{root}/data").select("file_path").collect())
    removed, changed = (spark.read.parquet(n) for n in (names[0], names[-1]))
    tool, day = changed.agg(F.min("eqp_id")).first()[0], (lambda name: name.split("/d=")[1][:10])
    hit = changed.where(F.col("eqp_id") == tool).agg(F.max("reading_id")).first()[0]
    harmed = removed.select("eqp_id", F.lit(day(names[0])).cast("date").alias("d")).distinct().unionByName(
        spark.createDataFrame([(tool, day(names[-1]))], "eqp_id STRING, d STRING").withColumn("d", F.col("d").cast("date"))
    )
    harmed = durable(harmed)
    value = F.col("param_value") + (F.col("reading_id") == hit).cast("int")
    changed.withColumn("param_value", value).write.mode("append").parquet(names[-1].rpartition("/")[0])
    for name in (names[0], names[-1]):
        drop_folder(spark, name)
    found = durable(verify_cache(spark, root, manifest).select("eqp_id", "d"))
    exactly = found.exceptAll(harmed).isEmpty() and harmed.exceptAll(found).isEmpty()
    fetch_stage.run(rows, specs, root, manifest, _AFTER, _WHOLE, verify=True)
    healed = verify_cache(spark, root, manifest).isEmpty()
    return _cache_content(spark, root, manifest).select(
        "*", F.lit(first.source_rows).cast("bigint").alias("source_rows"), F.lit(exactly).alias("found_exactly"),
        F.lit(healed).alias("healed"),
    )


@query
def run_log_real(spark, sf_dir):
    """The log of two refreshes by run and day."""
    rows, specs = fx.readings(spark, sf_dir), fx.graded(fx.registrations(spark, sf_dir))
    root, manifest, log = (scratch_table(spark, n) for n in ("readings", "manifest", "log"))
    known = rows.where(F.col("act_time") < F.lit("2024-01-23 12:00:00").cast("timestamp_ntz"))
    fetch_stage.run(known, specs, root, manifest, fx.date(2024, 1, 23), fx.SETTINGS, log)
    fetch_stage.run(rows, specs, root, manifest, fx.RUN_DAY, fx.SETTINGS, log)
    found = run_log.run_log_summary(read_run_log(spark, log), by=["timestamp", "d"])
    return found.select(
        "timestamp", "d", "checked", "uploaded", "empty", "skipped_existing", "failed", "rows",
        ((F.col("avg_fetch_sec") > 0) & (F.col("avg_write_sec") > 0)).alias("has_times"),
    )


@query
def planned_units(spark, sf_dir):
    """The tool-days that the run date's plan asks for, with the rows to expect by the manifest's history."""
    manifest = fx.cached_manifest(spark, sf_dir)
    plan = cache.fetch_plan(fx.tools(spark, sf_dir), manifest, fx.run_day(), fx.SETTINGS)
    return profile.estimated_rows(plan, manifest)


def _chunks(rows: DataFrame, source: str) -> None:
    chunk = F.pmod(F.xxhash64("spec_id"), F.lit(3)).cast("int")
    rows.withColumn("chunk_idx", chunk).write.mode("append").partitionBy("chunk_idx").parquet(source)


@query
def compact_chunks(spark, sf_dir):
    """Readings in chunk folders are rewritten per tool; the result is read back."""
    source, final = scratch_table(spark, "chunks"), scratch_table(spark, "final")
    _chunks(fx.readings(spark, sf_dir), source)
    return sinks.compact_chunks(spark, source, final)


@query
def file_size_profile(spark, sf_dir):
    """Largest stored file of each day folder."""
    root = scratch_table(spark, "readings")
    sinks.write_days(fx.readings(spark, sf_dir), root)
    found = profile.largest_file_per_folder(stored_files(spark, root))
    # Sizes depend on the writer; that every day has a file of some size does not.
    return found.select(
        F.regexp_extract("folder", r"([^/]+)$", 1).alias("folder"), (F.col("max_mb") > 0).alias("has_size")
    )


# --- what a second run and a large group must not change --------------------------------------


# Groups of more than six readings take the path of large groups.
_ALL_HOT = replace(fx.SETTINGS, hot_rows=6)


@query
def large_spec_stats(spark, sf_dir):
    """As ``spec_stats``, by the path of large groups; the manifest tells where to look for them."""
    manifest = cache.day_manifest(fx.readings(spark, sf_dir), fx.run_day())
    return rounded(
        stats.spec_stats(
            _window(spark, sf_dir, verdict.CURRENT),
            settings=_ALL_HOT,
            spread=True,
            suspects=tools_over(manifest, _ALL_HOT.hot_rows),
        )
    )


@query
def large_weekly_report(spark, sf_dir):
    """As ``weekly_report``, by the path of large groups."""
    found = verdict.weekly_report(
        fx.readings(spark, sf_dir), fx.graded(fx.registrations(spark, sf_dir)), fx.WINDOWS, _ALL_HOT
    )
    return rounded(found.select(*REPORT_COLUMNS))


@query
def shared_spec_report(spark, sf_dir):
    """The weekly report where three tools read each spec: every tool has its own verdict."""
    shared = F.concat_ws("-", F.lit("S"), (F.col("eqp_id").cast("long") / 3).cast("long").cast("string"), "_kind")
    kind = F.regexp_extract("spec_id", "[^-]+$", 0)
    rows, specs = (
        df.withColumn("_kind", kind).withColumn("spec_id", shared).drop("_kind")
        for df in (fx.readings(spark, sf_dir), fx.graded(fx.registrations(spark, sf_dir)))
    )
    found = verdict.weekly_report(rows, specs, fx.WINDOWS, replace(fx.SETTINGS, hot_rows=20))
    return rounded(found.select(*REPORT_COLUMNS))


@query
def publish_twice(spark, sf_dir):
    """A week published with all rows, then with the fails only; another week, then nothing."""
    root = scratch_table(spark, "report")
    report = _report(spark, sf_dir)
    sinks.publish_report(report, root, "2024-05")
    sinks.publish_report(report.where("cww_fail = 1"), root, "2024-05")
    sinks.publish_report(report, root, "2024-06")
    sinks.publish_report(report.where("false"), root, "2024-06")
    weeks = report_week(spark, root, "2024-05").unionByName(report_week(spark, root, "2024-06"))
    return weeks.select("eqp_id", "spec_id", "cww_fail", "week")


@query
def catalog_republish(spark, sf_dir):
    """The catalog is published again from a source without automatic specs."""
    root = scratch_table(spark, "catalog")
    whole = catalog_union(spark, sf_dir)
    sinks.write_catalog(whole, root)
    sinks.write_catalog(whole.where("type = 'fixed'"), root)
    return scan_catalog(spark, root, "fixed").withColumn("type", F.lit("fixed")).unionByName(
        scan_catalog(spark, root, "auto").withColumn("type", F.lit("auto"))
    )


def _fewer(rows: DataFrame) -> DataFrame:
    """Every third tool's readings without errors: what a second compaction replaces these tools with."""
    return rows.where((F.col("eqp_id").cast("long") % 3 == 0) & (F.col("processid") != "error"))


@query
def compact_twice(spark, sf_dir):
    """Chunks of all readings, then of every third tool again without errors, into one target."""
    final, rows = scratch_table(spark, "final"), fx.readings(spark, sf_dir)
    for part in (rows, _fewer(rows)):
        source = scratch_table(spark, "chunks")
        _chunks(part, source)
        found = sinks.compact_chunks(spark, source, final)
    return found


@query
def compact_resumed(spark, sf_dir):
    """As ``compact_twice``, but either run dies once before its version is used and once before its chunks are deleted."""
    source, final, rows = scratch_table(spark, "chunks"), scratch_table(spark, "final"), fx.readings(spark, sf_dir)
    for part in (rows, _fewer(rows)):
        _chunks(part, source)
        sinks.stage_compaction(spark, source, final)
        sinks.use_compaction(spark, final, sinks.stage_compaction(spark, source, final))
    return sinks.compact_chunks(spark, source, final)


@query
def purge_window(spark, sf_dir):
    """What is left of the stored readings after the days before 2024-01-08 were dropped."""
    root = scratch_table(spark, "readings")
    sinks.write_days(fx.readings(spark, sf_dir), root)
    sinks.purge_expired_days(spark, root, "2024-01-08")
    left = read_table(spark, root, schemas.READINGS)
    return left.groupBy("eqp_id", "d").agg(F.count("*").alias("rows"), F.max("reading_id").alias("last_reading"))


@query
def retry_failures(spark, sf_dir):
    """Failed units of the odd days are tried again the same day with success; the rest stays failed."""
    log = fx.unit_log(spark, sf_dir).withColumn("attempt", F.lit(1))
    again = log.where((F.col("status") == "failed") & (F.dayofmonth("d") % 2 == 1)).select(
        *[c for c in log.columns if c not in ("status", "attempt", "stage", "error")],
        F.lit("wrote").alias("status"), F.lit(2).alias("attempt"),
        F.lit(None).cast("string").alias("stage"), F.lit(None).cast("string").alias("error"),
    )
    return run_log.failed_units(again.unionByName(log))
