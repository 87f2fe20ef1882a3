"""JDBC readers.  The database does the filtering Spark can push to it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str]) -> DataFrame:
    """Whole table through one connection; for small dimension tables."""
    return spark.read.jdbc(url, table, properties=dict(properties))


def read_partitioned(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int,
    properties: Mapping[str, str],
) -> DataFrame:
    """Parallel read: one range of ``column`` per task; the outer ranges are open."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=dict(properties),
    )
