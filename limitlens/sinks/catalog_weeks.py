"""The spec catalog by work week: what was in force then, and what changed since."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from limitlens import schemas
from limitlens.storage import partition_values
from limitlens.versions import VersionedTable

KINDS = ("auto", "fixed")
_KEYS = ("eqp_id", "spec_id", "type")
# When a row was made says nothing about the spec.
_UNCOMPARED = ("script_run_time",)


def _table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, schemas.SPEC_CATALOG, (("week", T.StringType()), ("type", T.StringType())))


def published_weeks(spark: SparkSession, root: str) -> list[str]:
    return sorted(_table(spark, root).record().properties.get("weeks", []))


def publish_catalog_week(catalog: DataFrame, root: str, week: str, replace: bool = True) -> bool:
    """Keep ``catalog`` (with its ``type``) as that of ``week``; both types of the week change in one step.

    With ``replace=False`` a week that is there is left alone, and nothing is calculated for it. A catalog without rows
    is a published week, too.
    """
    spark = catalog.sparkSession
    table = _table(spark, root)
    record = table.record()
    weeks = record.properties.get("weeks", [])
    if week in weeks and not replace:
        return False
    version = table.new_version()
    known = [c for c in schemas.SPEC_CATALOG.names if c in catalog.columns]
    rows = catalog.select(*known).where(F.col("type").isin(*KINDS)).withColumn("week", F.lit(week))
    rows.hint("rebalance", F.col("type")).write.partitionBy("week", "type").parquet(table.folder(version))
    written = partition_values(spark, f"{table.folder(version)}/week={week}", "type")
    switched = {table.part(week, kind): version if kind in written else None for kind in KINDS}
    table.commit(record, switched, {"weeks": sorted({*weeks, week})})
    table.clear()
    return True


def catalog_as_of(spark: SparkSession, root: str, week: str, kind: str | None = None) -> DataFrame:
    """The catalog in force in ``week``: that of the newest published week up to it; none before the first one."""
    table = _table(spark, root)
    record = table.record()
    then = max((w for w in record.properties.get("weeks", []) if w <= week), default=None)
    parts = [table.part(then, k) for k in KINDS if kind in (None, k)] if then is not None else []
    return table.read(record, parts)


def catalog_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(eqp_id, spec_id, type, change, columns): specs that were added, removed or changed, and in which columns.

    One hash join of both catalogs, each first cut to a row per tool, spec and type: a hash of its rows'
    other columns tells a change, so a spec that is registered several times is compared as a whole.
    """
    both = [c for c in before.columns if c in after.columns and c not in (*_KEYS, "week", *_UNCOMPARED)]

    def digests(df: DataFrame, side: str) -> DataFrame:
        wide = lambda c: F.sum(F.xxhash64(F.lit(c), F.col(c)).cast("decimal(20,0)")).alias(f"{side}_{c}")
        return df.groupBy(*_KEYS).agg(F.count("*").alias(f"{side}_n"), *[wide(c) for c in both])

    old, new = digests(before, "_a"), digests(after, "_b").hint("shuffle_hash")
    joined = old.join(new, list(_KEYS), "full_outer")
    differ = F.array_compact(F.array(*[F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.lit(c)) for c in both]))
    change = (
        F.when(F.col("_a_n").isNull(), "added").when(F.col("_b_n").isNull(), "removed")
        .when((F.size(differ) > 0) | (F.col("_a_n") != F.col("_b_n")), "changed")
    )
    return joined.select(
        *_KEYS, change.alias("change"), F.when(change == "changed", F.concat_ws(",", differ)).alias("columns")
    ).where("change is not null")
