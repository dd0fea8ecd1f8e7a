"""Parquet tables with a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from limitlens import schemas
from limitlens.storage import path_exists


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table; a table that has not been written yet reads as empty."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_run_log(spark: SparkSession, root: str, kind: str = "parquet") -> DataFrame:
    """The run log of all runs so far; empty before the first one."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], schemas.RUN_LOG)
    return spark.read.schema(schemas.RUN_LOG).format(kind).option("header", True).load(root)


def read_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Read a list of files as one table."""
    return spark.read.schema(schema).parquet(*paths)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Bring older column names to the current ones; names that are absent are left alone."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per parquet file: path and size. A listing; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))
    )
