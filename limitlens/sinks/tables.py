"""Table writers. Each replaces only the partitions that it writes, so a rerun changes nothing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from limitlens import schemas
from limitlens.operators.heat import broadcast_if_small
from limitlens.sources.tables import read_files, stored_files
from limitlens.storage import drop_partitions, partition_values, path_exists
from limitlens.versions import Record, VersionedTable

ROWS_PER_FILE = 20_000_000


# A bucket of a new compacted table holds about so many bytes of the first chunks; their number is a property of the table.
BUCKET_BYTES, MOST_BUCKETS = 256 << 20, 4096


def _overwrite(df: DataFrame, root: str, by: str, codec: str = "zstd", owned: Sequence[str] = ()) -> None:
    """Replace the partitions that ``df`` has rows for, and of the ``owned`` ones also the rest.

    A dynamic overwrite leaves a partition alone that gets no row; if the result owns it, it is
    dropped after the write, so nothing of a former run stays published.
    """
    counted = Observation()
    if owned:
        counts = [F.count(F.when(F.col(by) == value, 1)).alias(f"n{i}") for i, value in enumerate(owned)]
        df = df.observe(counted, *counts)
    (
        df.write.partitionBy(by)
        .option("compression", codec)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .mode("overwrite")
        .parquet(root)
    )
    if owned:
        found = counted.get
        drop_partitions(
            df.sparkSession, root, by, [v for i, v in enumerate(owned) if not found.get(f"n{i}")]
        )


def by_day(readings: DataFrame) -> DataFrame:
    """Rows laid out for a day-partitioned write.

    ``rebalance`` gathers a day's rows into few files and still splits a big day (or a hot
    tool in it) over many tasks. Sorting inside a task lets a tool or spec filter skip row groups.
    """
    return readings.hint("rebalance", F.col("d")).sortWithinPartitions(
        "d", "eqp_id", "spec_id", "act_time"
    )


def write_days(readings: DataFrame, root: str) -> None:
    """Write readings into ``d=`` partitions; days that are not in ``readings`` stay as they are."""
    _overwrite(by_day(readings), root, "d")


def write_manifest(manifest: DataFrame, root: str) -> None:
    """Rows per tool-day; the digest of a refresh is kept if there is one."""
    names = [c for c in schemas.REFRESH_MANIFEST.names if c in {*schemas.MANIFEST.names, *manifest.columns}]
    _overwrite(manifest.select(names).hint("rebalance", F.col("d")), root, "d")


def write_catalog(catalog: DataFrame, root: str) -> None:
    """Auto and fixed specs as two partitions of one table; a type without specs is emptied."""
    known = [c for c in schemas.SPEC_CATALOG.names if c in catalog.columns]
    rows = catalog.select(*known).hint("rebalance", F.col("type"))
    _overwrite(rows, root, "type", owned=("auto", "fixed"))


def publish_report(report: DataFrame, root: str, week: str, replace: bool = True) -> bool:
    """Write one week of the report; an empty result leaves the week empty.

    With ``replace=False`` a published week is left alone.
    """
    spark = report.sparkSession
    if not replace and week in partition_values(spark, root, "week"):
        return False
    known = [c for c in schemas.REPORT.names if c in report.columns]
    _overwrite(
        report.select(*known).withColumn("week", F.lit(week)), root, "week", "gzip", [week]
    )
    return True


def append_run_log(log: DataFrame, root: str, kind: str = "parquet") -> None:
    """Add a run's units to the log (``parquet``, or ``csv`` with a header); earlier runs stay."""
    columns = [
        F.col(f.name) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.RUN_LOG.fields
    ]
    log.select(*columns).write.mode("append").format(kind).option("header", True).save(root)


@dataclass(frozen=True)
class Compaction:
    """A written and proved, but not yet used version of the compacted table, and the chunk files that can go with its use."""

    record: Record
    version: str | None
    parts: tuple[str, ...]
    buckets: int
    chunks: tuple[str, ...]


def compacted_table(spark: SparkSession, root: str, schema: T.StructType = schemas.READINGS) -> VersionedTable:
    return VersionedTable(spark, root, schema, (("b", T.IntegerType()),))


def compacted_readings(spark: SparkSession, root: str, schema: T.StructType = schemas.READINGS) -> DataFrame:
    """What the compacted table holds; empty before the first compaction."""
    return compacted_table(spark, root, schema).read().select(*schema.names)


def stage_compaction(
    spark: SparkSession, source: str, final: str, schema: T.StructType = schemas.READINGS, broadcast_rows: int = 500_000
) -> Compaction:
    """Write the tools that have chunks under ``source``, and what their buckets hold of others, as a new version.

    Nothing that anybody reads is changed. The chunk files are listed once: files that arrive later wait
    for the next compaction.
    """
    table = compacted_table(spark, final, schema)
    record = table.record()
    listed = stored_files(spark, source).collect() if path_exists(spark, source) else []  # a row per file
    there = {r.file_path for r in listed}
    used = there & set(record.retired)  # of a former run that could not delete them yet
    files = tuple(sorted(there - used))
    size = sum(r.file_size for r in listed)
    buckets = record.properties.get("buckets") or max(1, min(MOST_BUCKETS, -(-size // BUCKET_BYTES)))
    if not files:
        return Compaction(record, None, (), buckets, ())
    bucket = F.pmod(F.xxhash64("eqp_id"), F.lit(buckets)).cast("int").alias("b")
    rows = read_files(spark, files, schema).select(*schema.names, bucket)
    touched: list[str] = []
    if record.parts:
        tools = rows.select("eqp_id", "b").distinct()
        touched = [table.part(r.b) for r in tools.select("b").distinct().collect()]  # at most one per bucket
        replaced = broadcast_if_small(tools.select("eqp_id"), broadcast_rows)
        others = table.read(record, touched).join(replaced, "eqp_id", "left_anti")
        rows = rows.unionByName(others.select(*rows.columns))
    version, counted = table.new_version(), Observation()
    (
        rows.observe(counted, F.count("*").alias("n"))
        .hint("rebalance", F.col("b"))
        .sortWithinPartitions("b", "eqp_id", "spec_id", "act_time")
        .write.partitionBy("b")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .parquet(table.folder(version))
    )
    written = {f"b={v}" for v in partition_values(spark, table.folder(version), "b")}
    if table.read(versions=[version]).count() != counted.get["n"]:
        raise ValueError(f"compaction of {source} lost rows; the version is not used and the chunks stay")
    return Compaction(record, version, tuple(sorted(written | set(touched))), buckets, (*files, *sorted(used)))


def use_compaction(spark: SparkSession, final: str, staged: Compaction, schema: T.StructType = schemas.READINGS) -> None:
    """From here on the version is what readers see, and its chunks are used up; one step."""
    table = compacted_table(spark, final, schema)
    if staged.version is not None:
        table.commit(staged.record, dict.fromkeys(staged.parts, staged.version), {"buckets": staged.buckets}, staged.chunks)


def compact_chunks(
    spark: SparkSession, source: str, final: str, schema: T.StructType = schemas.READINGS, broadcast_rows: int = 500_000
) -> DataFrame:
    """Rewrite the chunk files under ``source`` as few large files, sorted by tool, at ``final``.

    The tools that have chunks are replaced, all others keep what ``final`` holds of them: only
    the buckets of those tools are written anew, merged with their other tools' rows. A run that is
    interrupted loses nothing, wherever: before the switch the former version and all chunks are there, after
    it the record lists the chunk files that are used up, and the next run deletes exactly these before it begins.
    """
    table = compacted_table(spark, final, schema)
    table.clear()
    use_compaction(spark, final, stage_compaction(spark, source, final, schema, broadcast_rows), schema)
    table.clear()
    return compacted_readings(spark, final, schema)


def purge_expired_days(spark: SparkSession, root: str, oldest_kept: str) -> int:
    """Drop day partitions older than ``oldest_kept`` (yyyy-MM-dd); returns how many."""
    days = partition_values(spark, root, "d")
    return drop_partitions(spark, root, "d", [d for d in days if d < oldest_kept])
