"""The cached window: readings and their manifest, partitioned by day and tool bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from limitlens import schemas
from limitlens.versions import Record, VersionedTable

KEYS = (("d", T.DateType()), ("b", T.IntegerType()))


def cache_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, schemas.READINGS, KEYS)


def tool_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("eqp_id"), F.lit(buckets)).cast("int")


def cached_readings(spark: SparkSession, root: str) -> DataFrame:
    """All readings of the cache; empty before the first refresh."""
    return cache_table(spark, root).read().select(*schemas.READINGS.names)


def cached_manifest(spark: SparkSession, root: str, manifest_root: str, record: Record | None = None) -> DataFrame:
    """Rows per tool-day of the cache, as of the same moment as :func:`cached_readings`."""
    return cache_table(spark, root).read(record, root=manifest_root, schema=schemas.REFRESH_MANIFEST)


def spec_ledger(spark: SparkSession, manifest_root: str, record: Record) -> DataFrame:
    """The specs that each digest of the manifest stands for."""
    version = record.properties.get("ledger")
    if version is None:
        return spark.createDataFrame([], schemas.SPEC_LEDGER)
    return spark.read.schema(schemas.SPEC_LEDGER).parquet(f"{manifest_root}/ledger/{version}")
