"""Session settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes shuffle partitions, splits skewed joins and turns a join into a
# broadcast only after it has measured the side. Nothing in the library forces a
# broadcast, so autoBroadcastJoinThreshold is the one size bound that applies.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    # HotSpot does not compile methods above 8000 bytes of bytecode. Stages of many wide text
    # expressions exceed that; with this limit Spark splits them into methods that compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def builder(app_name: str = "tillmark") -> SparkSession.Builder:
    """A session builder with the settings above; the caller adds master and memory."""
    result = SparkSession.builder.appName(app_name)
    for key, value in CLUSTER_CONF.items():
        result = result.config(key, value)
    return result


def local_session(cores: int | str = 8, app_name: str = "tillmark", **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    result = (
        builder(app_name)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in conf.items():
        result = result.config(key, value)
    spark = result.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
