"""File readers whose options differ from a plain ``spark.read`` call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",",
    header: bool = True, strict: bool = False,
) -> DataFrame:
    """CSV with a declared schema, or with types inferred by one extra scan."""
    reader = spark.read.option("sep", sep).option("header", header)
    if strict:
        reader = reader.option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def with_source(df: DataFrame, ingested_at: Column) -> DataFrame:
    """Add the file each row came from and the load time given by the caller."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), ingested_at.alias("ingested_at"))


def read_preamble_csv(
    spark: SparkSession, path: str, columns: Sequence[str], types: Mapping[str, str]
) -> DataFrame:
    """CSV with free-text lines before the header, in any number of files.

    All columns are read as text under the wanted names.  Preamble lines have
    too few fields and the header repeats in each file, so both are removed by
    predicate instead of by line number, which keeps large files splittable.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(text).option("header", False).option("mode", "PERMISSIVE").csv(path)
    key, last = columns[0], columns[-1]
    typed = [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in columns]
    return raw.filter(F.col(last).isNotNull() & (F.lower(F.regexp_replace(key, " ", "_")) != key.lower())).select(*typed)


def plain_name(name: str) -> str:
    """Column name without blanks and case."""
    return name.strip().lower().replace(" ", "_")


def external_table(spark: SparkSession, name: str, path: str, kind: str, schema: str, options: Mapping[str, str]) -> None:
    """Declare a catalog table over files that stay where they are."""
    listed = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    given = f"OPTIONS ({listed})" if listed else ""
    columns = f"({schema})" if schema else ""
    spark.sql(f"CREATE TABLE {name} {columns} USING {kind} {given} LOCATION '{path}'")
