"""Size checks that come before a plan is chosen: which groups are large, which sides are small."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from limitlens.storage import durable

# Beyond this many large groups their keys stay a table and are not taken to the driver.
MAX_LISTED_GROUPS = 10_000


@dataclass(frozen=True)
class Heat:
    """Rows split by the size of their group. ``hot`` is None when no group is large.

    ``few`` tells that one row per large group may be broadcast.
    """

    cold: DataFrame
    hot: DataFrame | None
    largest: int
    few: bool = True

    def side(self, per_group: DataFrame) -> DataFrame:
        """A join side with one row per large group."""
        return F.broadcast(per_group) if self.few else per_group


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only when a count has shown at most ``max_rows`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def split_by_heat(
    df: DataFrame, keys: Sequence[str], hot_rows: int, counted: DataFrame | None = None, broadcast_rows: int = 500_000
) -> Heat:
    """Split off the groups with more than ``hot_rows`` rows. A group is never cut in two.

    Costs one pass over the key columns of ``counted`` (default: all rows), combined on the map side. At most
    total / hot_rows groups can be large, so the list is usually short and goes through the
    driver; a longer one is kept as a table, and broadcast only if a count allows it.
    """
    keys = list(keys)
    source = df if counted is None else counted
    sizes = source.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows)
    listed = sizes.orderBy(F.desc("_rows")).limit(MAX_LISTED_GROUPS + 1).collect()
    if not listed:
        return Heat(df, None, 0)
    if len(listed) <= MAX_LISTED_GROUPS:
        few, large = True, df.sparkSession.createDataFrame(listed, sizes.schema).select(*keys)
    else:
        large = durable(sizes.select(*keys))
        few = large.count() <= broadcast_rows
    if few:
        large = F.broadcast(large)
    return Heat(
        df.join(large, keys, "left_anti"),
        df.join(large, keys, "left_semi"),
        listed[0]["_rows"],
        few,
    )


def tools_over(manifest: DataFrame, hot_rows: int) -> DataFrame:
    """Tools whose cached days add up to more than ``hot_rows`` readings.

    Groups are kept by tool and spec, so only these tools can hold a large one. The manifest
    answers this without touching the readings.
    """
    return (
        manifest.groupBy("eqp_id")
        .agg(F.sum("row_count").alias("rows"))
        .where(F.col("rows") > hot_rows)
        .select("eqp_id")
    )
