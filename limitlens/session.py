"""Session settings that the plans in this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks the number of reduce tasks, splits skewed joins and turns a join into a broadcast
# only after it has seen the real size of the side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, name: str = "limitlens") -> SparkSession:
    """A local session for tests and timings. On a cluster, pass SETTINGS to spark-submit."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", "8g")
    # Test tables are tiny: let their reduce stages use all cores.
    builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    spark = builder.config("spark.sql.shuffle.partitions", str(cpus)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
