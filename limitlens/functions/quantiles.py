"""Exact quantiles of groups that are too big for one task.

``percentile`` holds every distinct value of a group in one task. Here a group is never gathered: equal
values are counted where they lie, the distinct ones are sorted over the whole cluster by key
and value, and the rows counted in each (key, partition) turn a wanted rank into a place in one partition.
Only the partitions that hold a wanted rank are looked into. Nothing is estimated, so nothing can be
missed: the result equals ``percentile`` (linear interpolation) for any values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from limitlens.storage import scratch_table, stored


def _interpolate(low: Column, high: Column, position: Column) -> Column:
    floor, ceil = F.floor(position), F.ceil(position)
    between = (ceil - position) * low + (position - floor) * high
    return F.when((floor == ceil) | (low == high), low).otherwise(between)


def large_group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: Sequence[float],
    out: str,
    side: Callable[[DataFrame], DataFrame] = lambda per_group: per_group,
    root: str | None = None,
    times: Column | None = None,
) -> DataFrame:
    """One row per key with the array ``out`` of exact quantiles of ``value``; a key without values has no row.

    Callers pass only the groups that a size profile found to be large, see ``operators.heat``; ``side`` hints how
    a side with a few rows per group is joined; ``times`` tells how often a row's value counts. The sorted distinct values are kept at
    ``root`` (default: a new scratch table) until the result has been used.
    """
    keys = list(keys)
    valued = df.select(*keys, value.alias("_v"), (F.lit(1) if times is None else times).cast("bigint").alias("_c"))
    counted = valued.where("_v is not null").groupBy(*keys, "_v").agg(F.sum("_c").alias("_c"))
    # Written once: a partition's number means the same in every pass.
    dealt = stored(
        counted.repartitionByRange(*keys, "_v").withColumn("_p", F.spark_partition_id()),
        root or scratch_table(df.sparkSession, "ranks"),
    )
    group = Window.partitionBy(*keys)
    sizes = dealt.groupBy(*keys, "_p").agg(F.sum("_c").alias("_in"))
    shares = sizes.select(  # a row per key and partition
        *keys, "_p", (F.sum("_in").over(group.orderBy("_p")) - F.col("_in")).alias("_before"),
        F.col("_in"), F.sum("_in").over(group).alias("_n"),
    )
    positions = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ranks = [rank for position in positions for rank in (F.floor(position), F.ceil(position))]
    here = F.exists(F.array(*ranks), lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_in")))
    looked_into = dealt.join(side(shares.where(here).drop("_in")), [*keys, "_p"])
    inside = Window.partitionBy(*keys, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = looked_into.withColumn("_upto", F.col("_before") + F.sum("_c").over(inside))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")), F.col("_v")))

    picks = [at(rank).alias(f"_r{i}") for i, rank in enumerate(ranks)]
    found = ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), *picks)
    return found.select(
        *keys,
        F.array(*[
            _interpolate(F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}"), position) for i, position in enumerate(positions)
        ]).alias(out),
    )
