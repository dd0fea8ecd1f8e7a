"""Size profiles and work units: how much there is per spec, per tool and per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from limitlens.functions.numbers import megabytes


def rows_per_spec(readings: DataFrame) -> DataFrame:
    return readings.groupBy("spec_id").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "spec_id")


def tool_size_profile(readings: DataFrame, tools: DataFrame | None = None) -> DataFrame:
    """Readings per tool, largest first; with ``tools`` only these and only if they have rows."""
    sizes = readings.groupBy("eqp_id").agg(F.count("*").alias("rows")).where("rows > 0")
    if tools is not None:
        sizes = sizes.join(tools.select("eqp_id").distinct(), "eqp_id", "left_semi")
    return sizes.orderBy(F.desc("rows"), "eqp_id")


def specs_by_tool(catalog: DataFrame) -> DataFrame:
    """Distinct specs of each tool as one sorted list, whatever the other tools have.

    A list is as long as its tool's configuration. What has to work on very many specs joins
    the (tool, spec) rows instead.
    """
    return (
        catalog.groupBy("eqp_id")
        .agg(F.sort_array(F.collect_set("spec_id")).alias("spec_ids"))
        .withColumn("n_specs", F.size("spec_ids"))
    )


def spec_chunks(
    catalog: DataFrame, sizes: DataFrame, giant_rows: int, n_chunks: int
) -> DataFrame:
    """Work units: one per tool, or up to ``n_chunks`` near-equal ones for a giant tool.

    One row per (tool, spec) with the unit's index (NULL for a whole tool) and its estimated
    rows. Specs are ranked in two steps, by hash bucket and then inside a bucket, so that a
    tool with a large part of all specs is spread over many tasks.
    """
    specs = (
        catalog.select("eqp_id", "spec_id")
        .distinct()
        .join(sizes.select("eqp_id", "rows"), "eqp_id")
        .withColumn("_h", F.md5("spec_id"))
        .withColumn("_b", F.substring("_h", 1, 2))
    )
    giants = specs.where(F.col("rows") >= giant_rows)
    small = specs.where(F.col("rows") < giant_rows)

    before = Window.partitionBy("eqp_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        giants.groupBy("eqp_id", "_b")
        .agg(F.count("*").alias("_c"))
        .select(
            "eqp_id",
            "_b",
            F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_offset"),
            F.sum("_c").over(Window.partitionBy("eqp_id")).alias("_n"),
        )
    )
    inside = Window.partitionBy("eqp_id", "_b").orderBy("_h", "spec_id")
    rank = F.col("_offset") + F.row_number().over(inside) - 1
    # The first (n mod chunks) chunks hold one spec more than the others.
    size = F.floor(F.col("_n") / n_chunks)
    longer = F.col("_n") % n_chunks
    head = longer * (size + 1)
    chunk = F.when(F.col("_r") < head, F.floor(F.col("_r") / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(F.col("_r") - head, size))
    )
    units = (
        giants.join(offsets, ["eqp_id", "_b"])
        .withColumn("_r", rank)
        .select(
            "eqp_id",
            "spec_id",
            chunk.cast("int").alias("chunk_idx"),
            (F.col("rows") / n_chunks).alias("est_rows"),
        )
    )
    whole = small.select(
        "eqp_id",
        "spec_id",
        F.lit(None).cast("int").alias("chunk_idx"),
        F.col("rows").cast("double").alias("est_rows"),
    )
    return units.unionByName(whole)


def estimated_rows(units: DataFrame, manifest: DataFrame) -> DataFrame:
    """(eqp_id, d, est_rows): how many rows a tool-day is expected to have, before it is read.

    The tool's mean over its other closed days; of a tool without any, the mean of all tools; without history NULL.
    """
    closed = manifest.where("day_closed = 1").select("eqp_id", "d", "row_count")
    overall = closed.agg(F.avg("row_count")).first()[0]
    history = closed.groupBy("eqp_id").agg(F.sum("row_count").alias("_sum"), F.count("*").alias("_n"))
    own = closed.withColumnRenamed("row_count", "_own")
    others = F.try_divide(
        F.col("_sum") - F.coalesce("_own", F.lit(0)), F.col("_n") - F.col("_own").isNotNull().cast("int")
    )
    return (
        units.select("eqp_id", "d").join(history, "eqp_id", "left").join(own, ["eqp_id", "d"], "left")
        .select("eqp_id", "d", F.round(F.coalesce(others, F.lit(overall).cast("double"))).cast("bigint").alias("est_rows"))
    )


def paths_per_tool(files: DataFrame, path: str = "key") -> DataFrame:
    """Sorted file paths of each tool; a tool has at most a few files per window day."""
    return files.groupBy("eqp_id").agg(
        F.sort_array(F.collect_set(path)).alias("paths"), F.count("*").alias("n_files")
    )


def largest_file_per_folder(files: DataFrame) -> DataFrame:
    """Largest file of each folder in MB, from rows of (file_path, file_size)."""
    return (
        files.withColumn("folder", F.regexp_replace("file_path", r"/[^/]*$", ""))
        .groupBy("folder")
        .agg(megabytes(F.max("file_size")).alias("max_mb"))
    )
