"""Incremental file ingest: every stream stops when it has read what is there.

State that a stream keeps between micro-batches is bounded by a watermark that
the caller passes; ``None`` keeps every row relevant for ever, as the batch
result does.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.newest import latest_per_key
from millrace.streaming.folding import FOLD, read_all, store_newest
from millrace.workspace import exists


def stream_files(spark: SparkSession, path: str, schema: str | T.StructType, kind: str = "json", files_per_batch: int = 1000, **options: str) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).format(kind).load(path)


def all_text(schema: T.StructType) -> T.StructType:
    """The same columns, every one read as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def hinted_schema(spark: SparkSession, path: str, kind: str, hints: Mapping[str, str], sampling: float = 1.0) -> T.StructType:
    """Types inferred once from the files that are there, some fixed by hand."""
    found = spark.read.option("samplingRatio", sampling).option("inferSchema", True).option("header", True)
    fields = found.format(kind).load(path).schema.fields
    fixed = {name: T._parse_datatype_string(kind_text) for name, kind_text in hints.items()}
    return T.StructType([T.StructField(f.name, fixed.get(f.name, f.dataType)) for f in fields])


SCHEMA_LOG = "version bigint, upto timestamp, shape string"


def logged_schema(spark: SparkSession, path: str, log: str, kind: str = "json", hints: Mapping[str, str] | None = None, **options: str) -> T.StructType:
    """The schema of a folder that is read again and again, kept from run to run in a log of versions.

    The first run finds it in the files that are there. A later run looks only at files changed since (a second of overlap), keeps
    the types it knows, and adds new columns at the end as a new version. Hinted columns have the hinted type. Without files and
    without a log the schema is that of the hints.
    """
    before = spark.read.schema(SCHEMA_LOG).parquet(log).orderBy(F.desc("version")).first() if exists(spark, log) else None
    fixed = {name: T._parse_datatype_string(text) for name, text in (hints or {}).items()}
    known = T.StructType.fromJson(json.loads(before["shape"])) if before else T.StructType([])
    files = spark.read.format("binaryFile").load(path) if exists(spark, path) else None
    upto = files.agg(F.max("modificationTime")).first()[0] if files is not None else None
    if upto is None or (before and upto == before["upto"]):
        return known if before else T.StructType([T.StructField(n, t) for n, t in fixed.items()])
    reader = spark.read.option("inferSchema", True).option("header", True).options(**options).format(kind)
    if before:
        reader = reader.option("modifiedAfter", (before["upto"] - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S"))
    fields = {f.name: f for f in known.fields}
    for f in reader.load(path).schema.fields:
        fields.setdefault(f.name, T.StructField(f.name, fixed.get(f.name, f.dataType)))
    shape = T.StructType(list(fields.values()))
    version = before["version"] + 1 if before else 1
    spark.createDataFrame([(version, upto, shape.json())], SCHEMA_LOG).coalesce(1).write.mode("append").parquet(log)
    return shape


def with_rescued(lines: DataFrame, schema: str | T.StructType, column: str = "value") -> DataFrame:
    """Parse JSON lines; what the schema does not know, or holds no value of its type for, goes to one JSON text column."""
    shape = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    parsed = lines.select(F.from_json(column, shape).alias("_row"), F.from_json(column, "map<string,string>").alias("_all"))
    lost = F.array_compact(F.array(*[F.when(F.col("_row")[n].isNull(), F.lit(n)) for n in shape.names]))
    extra = F.map_filter("_all", lambda k, v: v.isNotNull() & (~k.isin(*shape.names) | F.array_contains(lost, k)))
    rescued = F.when(F.size(extra) > 0, F.to_json(extra))
    return parsed.select("_row.*", rescued.alias("_rescued_data"))


def ingest_json(spark: SparkSession, path: str, out: str, hints: Mapping[str, str] | None = None) -> DataFrame:
    """One run over a folder of JSON lines with a living schema; returns all rows of all runs.

    Below ``out`` are the rows, the schema log and the checkpoint. Columns found later are null in earlier rows.
    """
    shape = logged_schema(spark, path, f"{out}/schema", hints=hints)
    append(with_rescued(spark.readStream.text(path), shape), f"{out}/data", f"{out}/checkpoint")
    whole = T.StructType([*shape.fields, T.StructField("_rescued_data", T.StringType())])
    return spark.read.schema(whole).parquet(f"{out}/data")


def append(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Run a stream into Parquet until the input is used up; the ended query has its progress."""
    query = (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def aggregate_updates(df: DataFrame, keys: Sequence[str], out: str, checkpoint: str, fold: int = FOLD) -> StreamingQuery:
    """Run a windowed aggregate whose state is bounded by a watermark.

    Each micro-batch stores only the windows it changed; :func:`newest_windows` reads the last value of each.
    """
    def store(batch: DataFrame, number: int) -> None:
        store_newest(batch.withColumn("_update", F.lit(number)), number, out, keys, ["_update"], fold)

    query = (
        df.writeStream.foreachBatch(store).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def newest_windows(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    return latest_per_key(read_all(spark, out), keys, ["_update"]).drop("_update")


def watermarked(df: DataFrame, column: str, delay: str | None) -> DataFrame:
    return df if delay is None else df.withWatermark(column, delay)
