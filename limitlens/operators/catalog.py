"""Assembly of the spec catalog from its source tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from limitlens.config import Settings
from limitlens.functions.numbers import numeric_limit
from limitlens.functions.text import canonical_name
from limitlens.operators.heat import broadcast_if_small

# Numeric class code of a parameter -> behaviour class.
PATTERN_CODES = {1: "PATTERN_A", 2: "PATTERN_B", 3: "PATTERN_C", 4: "PATTERN_D"}


@dataclass(frozen=True)
class CatalogSources:
    parameters: DataFrame
    limits: DataFrame
    tool_config: DataFrame
    equipment_names: DataFrame
    pattern_definitions: DataFrame
    overrides: DataFrame | None = None


def decode_pattern(code: Column) -> Column:
    label = F.lit("UNSUPPORTED")
    for number, name in PATTERN_CODES.items():
        label = F.when(code == number, name).otherwise(label)
    return label


def distinct_specs(
    catalog: DataFrame,
    latest_first: Sequence[str] = ("last_used", "process_unit"),
    key: str | Sequence[str] = "spec_id",
) -> DataFrame:
    """One row per key: the greatest by ``latest_first``, then by the other columns in order.

    ``max`` of a struct combines on the map side, so a spec registered many times is no hot key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lead = list(latest_first)
    rest = [c for c in catalog.columns if c not in (*keys, *lead)]
    if not lead and not rest:
        return catalog.select(*keys).distinct()
    kept = catalog.groupBy(*keys).agg(F.max(F.struct(*lead, *rest)).alias("_row"))
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in catalog.columns]
    )


def used_specs(limits: DataFrame, run_date: Column, settings: Settings) -> DataFrame:
    """Specs used at least once and recently."""
    return limits.where(
        (F.col("used_count") >= 1)
        & (F.col("last_used") >= F.date_sub(run_date, settings.recent_days))
    )


def assemble_catalog(
    sources: CatalogSources, run_date: Column, settings: Settings = Settings()
) -> DataFrame:
    """Join the source tables, keep supported specs, drop double registrations, correct patterns.

    A registration counts only if its parameter and its tool do; of those that count the newest
    stays. Every side of a join has one row per key, the greatest where a source repeats it, so
    no join multiplies specs. If a count shows that the tools are few, the specs (of which one
    tool may own a third) are not shuffled by tool at all.
    """
    parameters = sources.parameters.where(F.col("grade").isin(*settings.grades)).select(
        "param_id", "unit", "grade", canonical_name(F.col("name")).alias("param_name")
    )
    definitions = (
        sources.pattern_definitions.select(
            canonical_name(F.col("param_name")).alias("param_name"),
            decode_pattern(F.col("type_code")).alias("pattern"),
        )
        .where(F.col("pattern").isin(*settings.patterns))
    )
    definitions = distinct_specs(definitions, (), "param_name")
    parameters = distinct_specs(parameters.join(definitions, "param_name"), (), "param_id")
    tools = sources.tool_config
    if settings.excluded_areas:
        tools = tools.where(~F.col("area").isin(*settings.excluded_areas))
    names = distinct_specs(sources.equipment_names, (), "eqp_id")
    tools = distinct_specs(tools, (), "eqp_id").join(names, "eqp_id", "left")
    tools = broadcast_if_small(tools, settings.broadcast_rows)
    counted = (
        used_specs(sources.limits, run_date, settings)
        .join(parameters.select("param_id"), "param_id", "left_semi")
        .join(tools.select("eqp_id"), "eqp_id", "left_semi")
    )
    limits = distinct_specs(counted)
    catalog = limits.join(parameters, "param_id").join(tools, "eqp_id")
    return overlay_patterns(catalog, sources.overrides, settings)


def overlay_patterns(
    catalog: DataFrame, overrides: DataFrame | None, settings: Settings = Settings()
) -> DataFrame:
    """A curated pattern wins over the reported one. No table means no change."""
    if overrides is None:
        return catalog
    corrected = overrides.groupBy("param_id").agg(F.max("pattern").alias("_pattern"))
    corrected = broadcast_if_small(corrected, settings.broadcast_rows)
    return (
        catalog.join(corrected, "param_id", "left")
        .withColumn("pattern", F.coalesce("_pattern", "pattern"))
        .drop("_pattern")
    )


def fixed_catalog(catalog: DataFrame) -> DataFrame:
    """Specs whose limits are set by an operator: numeric limits and a flag that both exist."""
    both = F.col("upper_spec").isNotNull() & F.col("lower_spec").isNotNull()
    return (
        catalog.where(F.col("range_flag") == "fixed")
        .drop("range_flag")
        .withColumn("upper_spec", numeric_limit(F.col("upper_text")))
        .withColumn("lower_spec", numeric_limit(F.col("lower_text")))
        .withColumn("tolerance", F.when(both, 1).otherwise(0))
        .withColumn("type", F.lit("fixed"))
    )


def auto_catalog(catalog: DataFrame) -> DataFrame:
    """Specs whose limits are derived automatically; they carry no tolerance."""
    return (
        catalog.where(F.col("range_flag") == "auto")
        .drop("range_flag")
        .withColumn("tolerance", F.lit(0))
        .withColumn("type", F.lit("auto"))
    )


def typed_catalog(catalog: DataFrame, run_time: str) -> DataFrame:
    """Fixed and automatic specs in one pass; the same rows as ``union_catalogs`` of the two."""
    fixed = F.col("range_flag") == "fixed"
    both = F.col("upper_spec").isNotNull() & F.col("lower_spec").isNotNull()
    return (
        catalog.where(F.col("range_flag").isin("fixed", "auto"))
        .withColumn("upper_spec", F.when(fixed, numeric_limit(F.col("upper_text"))))
        .withColumn("lower_spec", F.when(fixed, numeric_limit(F.col("lower_text"))))
        .withColumn("tolerance", F.when(fixed & both, 1).otherwise(0))
        .withColumn("type", F.col("range_flag"))
        .withColumn("script_run_time", F.lit(run_time))
        .drop("range_flag")
    )


def union_catalogs(fixed: DataFrame, auto: DataFrame, run_time: str) -> DataFrame:
    """Both catalogs by column name; columns that one side lacks are NULL there."""
    return fixed.unionByName(auto, allowMissingColumns=True).withColumn(
        "script_run_time", F.lit(run_time)
    )


def with_technode(rows: DataFrame, nodes: DataFrame, plan_key: str, node_key: str) -> DataFrame:
    """Look up the technology node of a process plan; unknown plans give NULL."""
    return rows.join(nodes.withColumnRenamed(node_key, plan_key), plan_key, "left")
