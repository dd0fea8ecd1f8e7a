"""Runs of equal values per cached day: what the statistics of a moving window are added up from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from limitlens import schemas
from limitlens.operators.stats import SPEC, value_runs
from limitlens.sources.cache import KEYS, cache_table
from limitlens.versions import VersionedTable


def runs_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, schemas.VALUE_RUNS, KEYS)


def refresh_runs(spark: SparkSession, cache_root: str, runs_root: str) -> list[str]:
    """Bring the runs up to date with the cache; returns the (day, bucket) partitions whose readings were read.

    The record of the runs names the version of each cache partition that they were made from, so only
    partitions that have been written since are read, and those that left the cache go. The new
    runs count all at once; a run that dies before leaves the old ones.
    """
    cache, table = cache_table(spark, cache_root), runs_table(spark, runs_root)
    table.clear()
    now, before = cache.record(), table.record()
    made_from = before.properties.get("made_from", {})
    stale = sorted(part for part, version in now.parts.items() if made_from.get(part) != version)
    gone = [part for part in made_from if part not in now.parts]
    if not stale and not gone:
        return []
    version = table.new_version()
    if stale:
        (
            value_runs(cache.read(now, stale), ("d", "b", *SPEC))
            .hint("rebalance", "d", "b")
            .sortWithinPartitions("d", "b", *SPEC, "param_value")
            .write.partitionBy("d", "b").option("compression", "zstd").parquet(table.folder(version))
        )
    table.commit(before, dict.fromkeys(stale, version) | dict.fromkeys(gone), {"made_from": now.parts})
    table.clear()
    return stale


def cached_runs(spark: SparkSession, root: str) -> DataFrame:
    """All runs that :func:`refresh_runs` has made; empty before the first."""
    return runs_table(spark, root).read().drop("b")
