"""Registry of named queries and the SQL text each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import workspace

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The input tables of one data folder, read lazily by attribute name."""

    def __init__(self, spark: SparkSession, root: str):
        # Files carry zone-less times; read them as instants in the session zone
        # (UTC) so that time filters still reach the scan.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
        # see millrace.session: wide generated methods are split, not interpreted
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def out(self, label: str) -> str:
        return workspace.fresh_path(self.spark, label)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name`` with its checking SQL."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return add


def printable(df: DataFrame) -> DataFrame:
    """Give dates, times, decimals and narrow numbers one comparable form."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.FloatType, T.DecimalType)):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def run(name: str, spark: SparkSession, root: str) -> DataFrame:
    return printable(REGISTRY[name].build(Tables(spark, root)))
