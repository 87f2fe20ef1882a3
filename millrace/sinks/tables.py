"""Table and file writes with the checks a warehouse table would make."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.streaming import ingest
from millrace.workspace import switch


def save_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """Create or replace a table; with ``path`` the files live outside the warehouse."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def overwrite_checked(df: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Replace the rows at ``path``; refuse a batch whose columns differ.

    The new rows are written beside the old ones and take their place when they are complete: a batch that breaks leaves
    the table as it was, and may itself be read from the table.
    """
    existing = spark.read.parquet(path)
    if _shape(existing) != _shape(df):
        raise ValueError(f"schema differs: table {_shape(existing)}, batch {_shape(df)}")
    staged = f"{path.rstrip('/')}-next-{uuid.uuid4().hex[:8]}"
    df.write.parquet(staged)
    switch(spark, staged, path)
    return spark.read.parquet(path)


def with_generated(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Computed column; a supplied value must equal the computed one."""
    if name not in df.columns:
        return df.withColumn(name, value)
    wrong = F.raise_error(F.lit(f"generated column {name} does not match its expression"))
    return df.withColumn(
        name, F.when(F.col(name).eqNullSafe(value), value).otherwise(wrong.cast(df.schema[name].dataType))
    )


def with_check(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """Stop the write at the first row that breaks the constraint; null passes."""
    wrong = F.raise_error(F.lit(f"check constraint {name} violated")).cast("boolean")
    return df.filter(F.when(F.coalesce(condition, F.lit(True)), F.lit(True)).otherwise(wrong))


def load_once(spark: SparkSession, folder: str, kind: str, schema: str | T.StructType, target: str, checkpoint: str) -> DataFrame:
    """Append the rows of files not loaded before; return all rows loaded so far.

    A stream over the folder that stops when it has read what is there: its checkpoint knows the
    files taken, and readers of the target see only files of finished batches. A load lost half way
    is taken again by the next run.
    """
    ingest.append(ingest.stream_files(spark, folder, schema, kind), target, checkpoint)
    return spark.read.schema(schema).parquet(target)


def promote(df: DataFrame, renamed: Mapping[str, str], casts: Mapping[str, str], blanks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Text table to typed table: rename, replace a marker word, then cast.

    ``blanks`` maps a column to (marker, replacement text).  A text that does
    not parse becomes null instead of stopping the load.
    """
    columns = []
    for c in df.columns:
        value = F.col(c)
        if c in blanks:
            marker, replacement = blanks[c]
            value = F.when(value == marker, replacement).otherwise(value)
        if c in casts:
            value = value.try_cast(casts[c])
        columns.append(value.alias(renamed.get(c, c)))
    return df.select(*columns)
