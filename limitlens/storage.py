"""Folders on the shared file system: where scratch tables go, which partitions exist."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, as the session names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="limitlens-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new path for a scratch table."""
    return f"{shared_folder(spark)}/limitlens-{uuid.uuid4().hex}/{name}"


def durable(df: DataFrame) -> DataFrame:
    """Fix a small result on shared storage, so later writes cannot change what it says."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write rows that several passes need, and read them back with only the columns of each pass."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> bool:
    system, target = file_system(spark, path)
    return system.delete(target, True)


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = file_system(spark, path)
    return system.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist."""
    system, target = file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders under a table's root; none if it does not exist."""
    return [n.split("=", 1)[1] for n in folder_names(spark, root) if n.startswith(f"{column}=")]


def drop_partitions(spark: SparkSession, root: str, column: str, values: list[str]) -> int:
    """Delete partition folders; returns how many existed.

    A folder that cannot be deleted does not keep the others: all are tried, each failure warns.
    """
    dropped = 0
    for value in values:
        path = f"{root}/{column}={value}"
        try:
            dropped += bool(drop_folder(spark, path))
        except Exception as error:  # whatever the file system raises through the gateway
            warnings.warn(f"{path} was not deleted: {error}", stacklevel=2)
    return dropped
