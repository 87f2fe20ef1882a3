"""Session settings shared by the tests, the benchmark and cluster jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold at every scale.  Shuffle width and memory are left to the
# cluster: AQE coalesces small shuffle partitions and splits skewed ones, and
# broadcasts are chosen by Spark from measured sizes, never forced by a hint.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # Wide rows (dozens of tag columns) generate methods the JVM will not compile;
    # above this size Spark splits them instead of running them interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

LOCAL = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.sql.files.openCostInBytes": "1048576",
    "spark.sql.files.minPartitionNum": "8",
}


def cluster_session(app: str = "millrace") -> SparkSession:
    """Session for ``spark-submit``: only the scale-free settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in COMMON.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = 8, app: str = "millrace") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**COMMON, **LOCAL}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
