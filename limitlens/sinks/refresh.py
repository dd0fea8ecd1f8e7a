"""Incremental refresh of the cached window."""

from __future__ import annotations

import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from limitlens import schemas
from limitlens.config import Settings
from limitlens.functions.dates import day_closed
from limitlens.functions.numbers import megabytes, ratio
from limitlens.operators.cache import content_sum, damaged_tool_days, fetch_plan, refresh_plan, specs_digest, specs_to_read, window_length
from limitlens.operators.heat import broadcast_if_small
from limitlens.operators.profile import estimated_rows
from limitlens.sinks.tables import append_run_log
from limitlens.sources.cache import cache_table, cached_manifest, spec_ledger, tool_bucket
from limitlens.storage import drop_folder, durable, folder_names
from limitlens.versions import Record, VersionedTable

# A bucket of a new cache holds about so many bytes of a day.
BUCKET_BYTES = 256 << 20
_MOST_BUCKETS, _UNKNOWN_BUCKETS = 1024, 16


@dataclass(frozen=True)
class RefreshResult:
    """``days``: planned days; ``days_dropped``: those of them that could not be stored this time, which keep what
    they had. ``parts``: the (day, bucket) partitions that were replaced. ``source_rows``: rows read from the source
    for the cache."""

    planned_tool_days: int
    skipped_tool_days: int
    days: list[date]
    rows_written: int
    days_dropped: list[date]
    source_rows: int = 0
    parts: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class _Written:
    """One job's outcome for its days: a version and its proof, or the stage and message of the failure."""

    days: tuple[date, ...]
    version: str
    rows: int = 0
    source_rows: int = 0
    seconds: float = 0.0
    proof_seconds: float = 0.0
    stage: str | None = None
    error: str | None = None


def stored_tool_days(table: VersionedTable, record: Record | None = None, versions: list[str] | None = None) -> DataFrame:
    """Rows, bytes and content of each stored tool-day, in one pass over the files.

    A file's bytes are shared out by rows.
    """
    if not table.folders(record, versions=versions):
        names = "eqp_id STRING, d DATE, b INT, row_count BIGINT, byte_size BIGINT, content_sum DECIMAL(38,0)"
        return table.spark.createDataFrame([], names)
    by_file = table.read(record, versions=versions).groupBy("eqp_id", "d", "b", F.col("_metadata.file_path").alias("_f")).agg(
        F.count("*").alias("_rows"), content_sum(schemas.READINGS.names).alias("_sum"),
        F.max("_metadata.file_size").alias("_size"),
    )
    per_file = by_file.groupBy("_f").agg(F.sum("_rows").alias("_file_rows"))
    return by_file.join(per_file, "_f").groupBy("eqp_id", "d", "b").agg(
        F.sum("_rows").alias("row_count"),
        F.sum(F.col("_size") * F.col("_rows") / F.col("_file_rows")).cast("bigint").alias("byte_size"),
        F.sum("_sum").cast("decimal(38,0)").alias("content_sum"),
    )


def verify_cache(spark: SparkSession, root: str, manifest_root: str) -> DataFrame:
    """(eqp_id, d, status) of tool-days whose stored rows differ from the manifest in number or content.

    Reads the whole cache. A refresh with ``verify=True`` plans exactly these tool-days again.
    """
    table = cache_table(spark, root)
    record = table.record()
    stored = stored_tool_days(table, record)
    return damaged_tool_days(cached_manifest(spark, root, manifest_root, record), stored)


def expire_days(spark: SparkSession, root: str, manifest_root: str, oldest_kept: date) -> int:
    """Drop the cached days before ``oldest_kept``; returns how many."""
    table = cache_table(spark, root)
    record = table.record()
    gone = [p for p in record.parts if p.split("/")[0].removeprefix("d=") < f"{oldest_kept:%Y-%m-%d}"]
    if gone:
        table.commit(record, dict.fromkeys(gone))
        table.clear([manifest_root])
    return len({p.split("/")[0] for p in gone})


def _buckets(source: DataFrame, settings: Settings, days: int) -> int:
    if settings.tool_buckets:
        return settings.tool_buckets
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= source.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes():
        return _UNKNOWN_BUCKETS  # a source that cannot tell
    return max(1, min(_MOST_BUCKETS, math.ceil(size / max(1, days) / BUCKET_BYTES)))


class _Refresh:
    """What the jobs of one refresh share."""

    def __init__(self, source: DataFrame, table: VersionedTable, record: Record, buckets: int, settings: Settings,
                 plan: DataFrame, wanted: DataFrame, allowed: DataFrame, n_planned: int, n_stale: int, parts: dict[date, list[str]]):
        self.source, self.table, self.record, self.buckets, self.settings = source, table, record, buckets, settings
        self.plan = F.broadcast(plan) if n_planned <= settings.broadcast_rows else plan
        self.wanted = broadcast_if_small(wanted, settings.broadcast_rows)
        self.allowed, self.n_stale, self.parts = allowed, n_stale, parts
        # A day on which no spec is missing is not asked of the source.
        to_read = plan.join(self.wanted, ["eqp_id", "read_for"], "left_semi").select("d").distinct()
        self.days_to_read = {r.d for r in to_read.collect()}  # at most the window
        self._entries: dict[str, DataFrame] = {}

    def _content(self, days: tuple[date, ...], counted: Observation) -> DataFrame:
        names = schemas.READINGS.names
        parts = [p for d in days for p in self.parts[d]]
        stored = self.table.read(self.record, parts).select(*names)
        kept = stored.join(self.plan, ["eqp_id", "d"], "left_anti")
        if self.n_stale:
            # A spec that the catalog has dropped goes, one that is read now is not kept twice.
            stale = (
                stored.join(self.plan.where("read_for <> ''"), ["eqp_id", "d"])
                .join(self.allowed, ["eqp_id", "spec_id"], "left_semi")
                .join(self.wanted, ["eqp_id", "read_for", "spec_id"], "left_anti")
            )
            kept = kept.unionByName(stale.select(*names))
        asked = [d for d in days if d in self.days_to_read]
        if asked:
            fetched = (
                self.source.where(F.col("d").isin(*asked))
                .join(self.plan, ["eqp_id", "d"])
                .join(self.wanted, ["eqp_id", "read_for", "spec_id"], "left_semi")
                .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.READINGS.fields])
                .observe(counted, F.count("*").alias("n"))
            )
            kept = kept.unionByName(fetched)
        return kept.withColumn("b", tool_bucket(self.buckets))

    def write(self, days: tuple[date, ...]) -> _Written:
        """One job: a version of the planned partitions of these days, read back and compared."""
        version, began = self.table.new_version(), time.perf_counter()
        read, written = Observation(), Observation()
        try:
            (
                self._content(days, read)
                .observe(written, F.count("*").alias("n"), content_sum(schemas.READINGS.names).alias("s"))
                .hint("rebalance", F.col("d"), F.col("b"))
                .sortWithinPartitions("d", "b", "eqp_id", "spec_id", "act_time")
                .write.partitionBy("d", "b").option("compression", "zstd").parquet(self.table.folder(version))
            )
        except Exception as error:  # whatever the source or the file system raises: the days are left as they were
            return _Written(days, version, seconds=time.perf_counter() - began, stage="fetch", error=_short(error))
        seconds, began = time.perf_counter() - began, time.perf_counter()
        n, s = _observed(written, "n"), _observed(written, "s")
        asked = any(d in self.days_to_read for d in days)
        try:
            found = self.entries(version).agg(F.sum("row_count"), F.sum("content_sum")).first()
            same = (found[0] or 0, found[1] or 0) == (n, s)
            problem = None if same else "stored rows differ from written rows; the version is not used"
        except Exception as error:
            problem = _short(error)
        return _Written(
            days, version, n, _observed(read, "n") if asked else 0, seconds, time.perf_counter() - began,
            None if problem is None else "upload", problem,
        )

    def entries(self, version: str) -> DataFrame:
        """The tool-days of an uncommitted version, computed once."""
        found = self._entries.get(version)
        if found is None:
            found = self._entries[version] = durable(stored_tool_days(self.table, versions=[version]))
        return found


def _observed(counted: Observation, name: str):
    """0 where the plan was known to give no rows: the optimizer drops its observation, and Spark then has none to give.
    A count that is missing for any other reason differs from what is stored, so the version is not used."""
    try:
        return counted.get[name] or 0
    except Py4JError:
        return 0


def _short(error: Exception) -> str:
    lines = [x for x in str(error).splitlines() if x.strip()]
    return f"{type(error).__name__}: {lines[0] if lines else ''}"[:300]


def _outcomes(work: _Refresh, days: list[date], concurrency: int) -> list[_Written]:
    """All days in one job; if that fails, every day in a job of its own, so that a bad day stops no other."""
    whole = work.write(tuple(days))
    if whole.error is None or len(days) == 1:
        return [whole]
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        one = inheritable_thread_target(work.table.spark)(work.write)
        return list(pool.map(lambda d: one((d,)), days))


def unit_outcomes(
    plan: DataFrame, skipped: DataFrame, entries: DataFrame, outcomes: list[_Written], estimates: DataFrame, run_time: str, attempt: int = 1
) -> DataFrame:
    """Run-log rows: what became of each tool-day of the window in this attempt of the run.

    Times are the observed times of the job that fetched the day, shared out over its units by rows (a unit
    without rows counts as one). A tool-day that was stored already is ``skipped_existing``.
    """
    spark = plan.sparkSession
    jobs = spark.createDataFrame(  # one row per window day
        [(d, i, o.seconds, o.proof_seconds, o.stage, o.error) for i, o in enumerate(outcomes) for d in o.days],
        "d DATE, _job INT, _fetch DOUBLE, _write DOUBLE, stage STRING, error STRING",
    )
    failed = F.col("stage").isNotNull()
    rows = F.when(failed, 0).otherwise(F.coalesce("row_count", F.lit(0)))
    units = (
        plan.select("eqp_id", "d").join(F.broadcast(jobs), "d")
        .join(entries.select("eqp_id", "d", "row_count", "byte_size"), ["eqp_id", "d"], "left")
        .withColumn("_share", F.greatest(rows, F.lit(1)))
    )
    totals = units.groupBy("_job").agg(F.sum("_share").alias("_total"))
    share = F.col("_share") / F.col("_total")
    done = units.join(F.broadcast(totals), "_job").select(
        "eqp_id", "d", "stage", "error",
        F.when(failed, "failed").when(F.col("row_count").isNull() | (F.col("row_count") == 0), "empty").otherwise("wrote").alias("status"),
        rows.cast("bigint").alias("actual_rows"),
        F.round(megabytes(F.coalesce("byte_size", F.lit(0))), 3).alias("nbytes_mb"),
        (F.col("_fetch") * share).alias("fetch_sec"), (F.col("_write") * share).alias("write_sec"),
    )
    none = lambda kind: F.lit(None).cast(kind)
    left = skipped.select(
        "eqp_id", "d", none("string").alias("stage"), none("string").alias("error"), F.lit("skipped_existing").alias("status"),
        *[none(k).alias(c) for c, k in (("actual_rows", "bigint"), ("nbytes_mb", "double"), ("fetch_sec", "double"), ("write_sec", "double"))],
    )
    known = done.join(estimates, ["eqp_id", "d"], "left").withColumn("est_over_actual", ratio(F.col("est_rows"), F.col("actual_rows")))
    return known.unionByName(left, allowMissingColumns=True).select(
        F.lit(run_time).alias("timestamp"), F.lit(attempt).alias("attempt"),
        F.concat_ws("/", "eqp_id", F.col("d").cast("string")).alias("out_name"),
        "eqp_id", "d", "status", "est_rows", "actual_rows", "est_over_actual", "nbytes_mb", "fetch_sec", "write_sec",
        (F.col("fetch_sec") + F.col("write_sec")).alias("total_sec"), "stage", "error",
    )


def refresh_window(
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
    """Bring the cache up to date for the window that ends on ``end`` (the run date).

    Planned are tool-days that are missing, were still open, or were read for other specs than the catalog has
    now. Of the latter only the new specs are read from ``source``; readings of specs that the catalog dropped leave the cache, and
    nothing is read for them. Rewritten are only the (day, tool bucket) partitions of planned tool-days, as a
    new version with what they hold of other tool-days; all other files stay as they are. A version is read back,
    compared with what was written in number and content, and used only then, together with its manifest, in one
    step. If the job of all days fails, every day gets its own, and a day that fails again keeps what it had, is logged and is planned
    by the next run. ``verify`` first compares the whole cache with the manifest and plans the
    tool-days that differ again. With ``log_root`` every tool-day of the window adds its outcome to the run log, under
    ``run_time`` (default: the run date) and ``attempt``, so that a repeated run of one day is told apart from the first.
    """
    spark = source.sparkSession
    run_date = F.lit(end)
    table = cache_table(spark, root)
    record = table.record()
    manifest = cached_manifest(spark, root, manifest_root, record)
    believed = manifest
    if verify:
        bad = durable(damaged_tool_days(manifest, stored_tool_days(table, record)))
        believed = manifest.join(bad.select("eqp_id", "d"), ["eqp_id", "d"], "left_anti")
    allowed = catalog.where(F.col("grade").isin(*settings.grades)).select("eqp_id", "spec_id").distinct()
    digests = durable(specs_digest(catalog, settings))
    wanted_days = fetch_plan(digests, None, run_date, settings)
    tools, state = digests.agg(
        F.count("*"), F.sum(F.xxhash64("eqp_id", "specs_digest").cast("decimal(20,0)")).cast("string")
    ).first()
    n_window = tools * window_length(settings)
    buckets = record.properties.get("buckets") or _buckets(source, settings, settings.window_days)
    plan = durable(
        refresh_plan(believed, digests, run_date, settings).withColumn("b", tool_bucket(buckets))
    )
    # At most one row per window day and bucket.
    touched = plan.groupBy("d", "b").agg(F.count("*").alias("n"), F.count_if(F.col("read_for") != '').alias("stale")).collect()
    days = sorted({r.d for r in touched})
    n_planned = sum(r.n for r in touched)
    if not n_planned and log_root is None:
        return RefreshResult(0, n_window, [], 0, [])
    parts = {d: [table.part(f"{r.d:%Y-%m-%d}", r.b) for r in touched if r.d == d] for d in days}
    ledger = spec_ledger(spark, manifest_root, record)
    outcomes: list[_Written] = []
    if n_planned:
        n_stale = sum(r.stale for r in touched)
        wanted = durable(specs_to_read(plan, allowed, ledger)) if n_stale else allowed.withColumn("read_for", F.lit(""))
        work = _Refresh(source, table, record, buckets, settings, plan.drop("b"), wanted, allowed, n_planned, n_stale, parts)
        outcomes = _outcomes(work, days, settings.fetch_concurrency)
    good = [o for o in outcomes if o.error is None]
    stored_days = [d for o in good for d in o.days]
    bad_days = sorted(set(days) - set(stored_days))
    entries = spark.createDataFrame([], schemas.REFRESH_MANIFEST)
    if good:
        entries = _new_entries(work, good, plan, manifest, digests, run_date, manifest_root)
        properties = {"buckets": buckets, "catalog": state, "ledger": record.properties.get("ledger")}
        if state != record.properties.get("catalog") or n_stale:
            properties["ledger"] = _new_ledger(ledger, manifest.unionByName(entries, True), allowed, digests, manifest_root, table.new_version())
        switched = {p: o.version for o in good for d in o.days for p in parts[d]}
        table.commit(record, switched, properties)
    if log_root is not None:
        skipped = wanted_days.join(plan, ["eqp_id", "d"], "left_anti")
        estimates = estimated_rows(plan.select("eqp_id", "d"), manifest)
        append_run_log(
            unit_outcomes(plan, skipped, entries, outcomes, estimates, run_time or f"{end:%Y-%m-%d}", attempt), log_root
        )
    # What was replaced is needed up to here.
    table.clear([manifest_root])
    _clear_ledgers(spark, manifest_root, table.record())
    return RefreshResult(
        n_planned, n_window - n_planned, days, sum(o.rows for o in good), bad_days, sum(o.source_rows for o in good),
        sorted(p for d in stored_days for p in parts[d]),
    )


def _new_entries(
    work: _Refresh, good: list[_Written], plan: DataFrame, manifest: DataFrame, digests: DataFrame, run_date: Column, manifest_root: str
) -> DataFrame:
    """Write the manifest of every tool-day in the new versions, also of those without readings; returns it as stored."""
    zero = F.lit(0).cast("bigint")
    for outcome in good:
        here = plan.where(F.col("d").isin(*outcome.days))
        planned = here.join(digests, "eqp_id").select("eqp_id", "d", "b", "specs_digest")
        known = (
            manifest.join(F.broadcast(here.select("d", "b").distinct()), ["d", "b"], "left_semi")  # a row per partition
            .join(plan.select("eqp_id", "d"), ["eqp_id", "d"], "left_anti").select("eqp_id", "d", "b", "specs_digest")
        )
        (
            planned.unionByName(known).join(work.entries(outcome.version), ["eqp_id", "d", "b"], "left")
            .select(
                "eqp_id", F.coalesce("row_count", zero).alias("row_count"), F.coalesce("byte_size", zero).alias("byte_size"),
                day_closed(F.col("d"), run_date).alias("day_closed"), "specs_digest",
                F.coalesce("content_sum", F.lit(0).cast("decimal(38,0)")).alias("content_sum"), "d", "b",
            )
            .hint("rebalance", F.col("d")).write.partitionBy("d", "b").parquet(work.table.folder(outcome.version, manifest_root))
        )
    return work.table.read(versions=[o.version for o in good], root=manifest_root, schema=schemas.REFRESH_MANIFEST)


def _new_ledger(
    ledger: DataFrame, entries: DataFrame, allowed: DataFrame, digests: DataFrame, manifest_root: str, version: str
) -> str:
    """The specs of every digest that some tool-day was read for. As small as the catalog, and few digests of each tool."""
    now = allowed.join(digests, "eqp_id").select("eqp_id", "specs_digest", "spec_id")
    used = entries.select("eqp_id", "specs_digest").distinct()
    ledger.unionByName(now).distinct().join(used, ["eqp_id", "specs_digest"], "left_semi").write.parquet(
        f"{manifest_root}/ledger/{version}"
    )
    return version


def _clear_ledgers(spark: SparkSession, manifest_root: str, record: Record) -> None:
    """Of the ledgers only the one that the record names stays."""
    for name in folder_names(spark, f"{manifest_root}/ledger"):
        if name != record.properties.get("ledger"):
            drop_folder(spark, f"{manifest_root}/ledger/{name}")
