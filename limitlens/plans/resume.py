"""Verdicts that a repeated run does not calculate again.

Each tool's verdicts are kept with a digest of everything they depend on: its cached tool-days, its
catalog rows and the settings. A run calculates only the tools whose digest differs. If the job of all these tools
fails, their set is halved until the tools that fail stand alone: they get a state, the others their verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from limitlens.config import Settings
from limitlens.operators.heat import broadcast_if_small
from limitlens.operators.verdict import calculations
from limitlens.sources.cache import tool_bucket
from limitlens.storage import drop_folder, durable, scratch_table, stored
from limitlens.versions import VersionedTable

BUCKETS = 16
# After so many halvings a set of tools that still fails is taken to fail as a whole.
_MOST_HALVINGS = 40

# What can come of a tool.
CALCULATED, PROCESSED, NO_CALCULATIONS, NO_DATA, ERROR = (
    "calculated", "already processed", "no calculations", "no data", "calculation error",
)
_STATES = T.StructType([T.StructField(n, T.StringType()) for n in ("eqp_id", "digest", "state", "error")])


@dataclass(frozen=True)
class Verdicts:
    """``verdicts`` of all tools of the catalog, and ``states``: (eqp_id, state, error) of this run."""

    verdicts: DataFrame
    states: DataFrame


def tool_digests(
    catalog: DataFrame, tool_days: DataFrame, settings: Settings, window: str, exclusions: DataFrame | None = None
) -> DataFrame:
    """(eqp_id, digest, rows): what each catalog tool's verdicts depend on, order-free.

    ``tool_days`` has row_count and content_sum of each tool-day of the window.
    """
    wide = lambda h: F.sum(h.cast("decimal(20,0)")).cast("string")
    specs = catalog.groupBy("eqp_id").agg(wide(F.xxhash64("spec_id", "pattern", "grade")).alias("_specs"))
    days = tool_days.groupBy("eqp_id").agg(
        wide(F.xxhash64("d", "row_count", "content_sum")).alias("_days"), F.sum("row_count").alias("rows")
    )
    excluded = exclusions.agg(wide(F.xxhash64(*exclusions.columns))).first()[0] if exclusions is not None else None
    rules = f"{settings} {window} {excluded}"
    return specs.join(days, "eqp_id", "left").select(
        "eqp_id", F.concat_ws(":", F.xxhash64(F.lit(rules)).cast("string"), "_specs", F.coalesce("_days", F.lit("-"))).alias("digest"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def _calculated(readings: DataFrame, catalog: DataFrame, tools: DataFrame, settings: Settings, scratch: str, **more):
    """(verdicts, failures) of ``tools``, halving the set for as long as it fails."""
    spark, good, bad = tools.sparkSession, [], []
    half = lambda level: F.pmod(F.shiftright(F.xxhash64("eqp_id"), level), F.lit(2))
    open_ = [(tools, 0)]
    while open_:
        some, level = open_.pop()
        count = some.count()
        if not count:
            continue
        wanted = broadcast_if_small(some.select("eqp_id"), settings.broadcast_rows)
        folder = f"{scratch}/{len(good) + len(bad) + len(open_)}-{level}"
        try:
            found = calculations(
                readings.join(wanted, "eqp_id", "left_semi"), catalog.join(wanted, "eqp_id", "left_semi"), settings,
                hot_root=f"{folder}-hot", **more,
            )
            good.append(stored(found, folder))
        except Exception as error:  # whatever the data raises: it is narrowed down
            drop_folder(spark, folder)
            if count == 1 or level == _MOST_HALVINGS:
                lines = [x for x in str(error).splitlines() if x.strip()]
                bad.append(some.select("eqp_id", F.lit(f"{type(error).__name__}: {lines[0] if lines else ''}"[:300]).alias("error")))
            else:
                open_ += [(some.where(half(level) == side), level + 1) for side in (0, 1)]
        finally:
            drop_folder(spark, f"{folder}-hot")
    return good, bad


def _all(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for frame in frames:
        out = out.unionByName(frame)
    return out


def resumable_verdicts(
    readings: DataFrame,
    catalog: DataFrame,
    tool_days: DataFrame,
    root: str,
    settings: Settings = Settings(),
    window: str = "",
    exclusions: DataFrame | None = None,
    suspects: DataFrame | None = None,
    runs: bool = False,
) -> Verdicts:
    """Verdicts of the catalog's tools; those whose inputs are as in an earlier run come from ``root``.

    ``readings`` are the window's (with ``runs`` its runs of equal values), ``tool_days`` the cache manifest of them. Results are kept by tool bucket and replaced all at once.
    A tool whose calculation fails has no verdicts, and is tried again by the next run.
    """
    spark = catalog.sparkSession
    more = {"exclusions": exclusions, "suspects": suspects, "runs": runs}
    schema = calculations(readings, catalog, settings, exclusions=exclusions, suspects=spark.createDataFrame([], "eqp_id STRING"), runs=runs).schema
    table = VersionedTable(spark, f"{root}/verdicts", schema, (("b", T.IntegerType()),))
    states_root = f"{root}/states"
    table.clear([states_root])
    record = table.record()
    buckets = record.properties.get("buckets") or settings.tool_buckets or BUCKETS
    before = table.read(record, root=states_root, schema=_STATES)
    now = durable(tool_digests(catalog, tool_days, settings, window, exclusions).withColumn("b", tool_bucket(buckets)))
    settled = before.where(F.col("state") != ERROR).select("eqp_id", "digest")
    todo = durable(now.join(settled, ["eqp_id", "digest"], "left_anti"))
    touched = [table.part(r.b) for r in todo.select("b").distinct().collect()]  # at most one per bucket
    fresh = spark.createDataFrame([], _STATES)
    if touched:
        scratch = scratch_table(spark, "verdicts")
        try:
            good, bad = _calculated(readings, catalog, todo, settings, scratch, **more)
            found = _all(good, spark.createDataFrame([], schema))
            failed = _all(bad, spark.createDataFrame([], "eqp_id STRING, error STRING"))
            specs = found.groupBy("eqp_id").agg(F.count("*").alias("specs"))
            state = (
                F.when(F.col("error").isNotNull(), ERROR).when(F.col("rows") == 0, NO_DATA)
                .when(F.col("specs").isNull(), NO_CALCULATIONS).otherwise(CALCULATED)
            )
            fresh = durable(
                todo.join(specs, "eqp_id", "left").join(failed, "eqp_id", "left").select("eqp_id", "digest", state.alias("state"), "error")
            )
            version, gone = table.new_version(), todo.select("eqp_id")
            kept = table.read(record, touched).join(gone, "eqp_id", "left_anti").drop("b")
            also = before.where(F.concat(F.lit("b="), F.col("b")).isin(*touched)).join(gone, "eqp_id", "left_anti").drop("b")
            for rows, folder in (
                (found.unionByName(kept), table.folder(version)), (fresh.unionByName(also), table.folder(version, states_root))
            ):
                rows.withColumn("b", tool_bucket(buckets)).hint("rebalance", F.col("b")).write.partitionBy("b").parquet(folder)
            record = table.commit(record, dict.fromkeys(touched, version), {"buckets": buckets})
        finally:
            drop_folder(spark, scratch)
        table.clear([states_root])
    tools = catalog.select("eqp_id").distinct()
    states = tools.join(fresh, "eqp_id", "left").select("eqp_id", F.coalesce("state", F.lit(PROCESSED)).alias("state"), "error")
    # Tools that the catalog has dropped keep their rows, but are not reported.
    return Verdicts(table.read(record).drop("b").join(tools, "eqp_id", "left_semi"), states)
