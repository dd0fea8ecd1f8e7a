"""The source tables of the spec catalog, and the published catalog itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from limitlens import schemas
from limitlens.operators.catalog import CatalogSources
from limitlens.sources.tables import read_table

SPEC_COLUMNS = ("eqp_id", "spec_id", "pattern", "grade", "upper_spec", "lower_spec", "tolerance")


def load_sources(spark: SparkSession, paths: Mapping[str, str]) -> CatalogSources:
    """Declared-schema readers for the source tables.

    The override table is curated by hand; when it cannot be found, nothing is corrected.
    """
    return CatalogSources(
        parameters=spark.read.schema(schemas.PARAMETERS).parquet(paths["parameters"]),
        limits=spark.read.schema(schemas.SPEC_LIMITS).parquet(paths["limits"]),
        tool_config=spark.read.schema(schemas.TOOL_CONFIG).parquet(paths["tool_config"]),
        equipment_names=spark.read.schema(schemas.EQUIPMENT_NAMES).parquet(paths["equipment_names"]),
        pattern_definitions=spark.read.schema(schemas.PATTERN_DEFINITIONS).parquet(
            paths["pattern_definitions"]
        ),
        overrides=(
            read_table(spark, paths["overrides"], schemas.PATTERN_OVERRIDES)
            if "overrides" in paths
            else None
        ),
    )


def scan_catalog(
    spark: SparkSession, root: str, kind: str = "fixed", columns: Sequence[str] = SPEC_COLUMNS
) -> DataFrame:
    """One kind of the published catalog: only the used columns, the join key cast once."""
    return (
        read_table(spark, root, schemas.SPEC_CATALOG)
        .where(F.col("type") == kind)
        .select(*columns)
        .withColumn("spec_id", F.col("spec_id").cast("string"))
    )
