"""Shards along a Hilbert curve, so that files can be skipped by several columns at once.

Each dimension is quantised to cells that hold about equally many rows, the cells of a row are a point of a
cube, and the point's place on the Hilbert curve through that cube orders the rows: rows that are near on the
curve are near in every dimension. The order is cut into runs of equal counts or equal sizes. Files written
from the runs have narrow ranges of every dimension, which a reader's minimum and maximum statistics then skip by.

Nothing but the rows themselves is shuffled, once, by range; what goes through the driver are at most
``2 ** bits`` cell limits a dimension and one total for each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.workspace import settle

_SEQ_BITS = 33  # monotonically_increasing_id: the partition above, the row below
TEXT_LEAD = 64  # texts are told apart in a dimension by their first characters


def curve_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates below ``2 ** bits`` (Skilling's transform, all rows at once)."""
    x = [np.array(c, np.int64) for c in cells]
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[-1])
    for b in range(1, bits):
        flip ^= np.where(x[-1] & (1 << b), (1 << b) - 1, 0)
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = (out << 1) | (((c ^ flip) >> b) & 1)
    return out


def in_order(rows: DataFrame, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """``rows`` with ``mr_rank`` (place in the order of ``keys``, from 0) and, if asked, ``mr_before`` (weights of all earlier rows).

    Sorted by range, written once, and counted by partition; one total a partition is added to the places inside it.
    The keys should be unique, so that no range has to hold many rows.
    """
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("mr_seq", F.monotonically_increasing_id())
    ordered = settle(ordered, "shard-ordered").withColumn("mr_part", F.shiftright("mr_seq", _SEQ_BITS))
    load = F.col(weight).cast("long") if weight else F.lit(0).cast("long")
    totals = ordered.groupBy("mr_part").agg(F.count(F.lit(1)).alias("rows"), F.sum(load).alias("load")).orderBy("mr_part").collect()
    starts, row, sum_ = [], 0, 0
    for t in totals:
        starts.append((t["mr_part"], row, sum_))
        row, sum_ = row + t["rows"], sum_ + (t["load"] or 0)
    offsets = rows.sparkSession.createDataFrame(starts, "mr_part long, mr_first long, mr_base long")
    placed = ordered.join(F.broadcast(offsets), "mr_part")  # one row a partition
    placed = placed.withColumn("mr_rank", F.col("mr_first") + F.col("mr_seq").bitwiseAND((1 << _SEQ_BITS) - 1))
    if weight:
        earlier = Window.partitionBy("mr_part").orderBy("mr_seq").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("mr_before", F.col("mr_base") + F.coalesce(F.sum(load).over(earlier), F.lit(0)))
    return placed.drop("mr_part", "mr_seq", "mr_first", "mr_base")


def _value(rows: DataFrame, column: str) -> Column:
    """The column as it is compared: numbers, dates and times as they are, everything else by the beginning of its text."""
    kind = rows.schema[column].dataType.typeName()
    if kind in ("byte", "short", "integer", "long", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz"):
        return F.col(f"`{column}`")
    return F.substring(F.col(f"`{column}`").cast("string"), 1, TEXT_LEAD)


def cells(rows: DataFrame, column: str, bits: int, total: int) -> Column:
    """The cell of a row in one dimension: ``2 ** bits`` times the share of rows with a smaller value, rounded down.

    Equal values share a cell; null is smaller than any value. The limits are exact: values are counted and summed in order.
    """
    value = _value(rows, column)
    counts = in_order(rows.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")), ["v"], "n")
    cell = F.expr(f"(mr_before * {1 << bits}) div {total}")
    limits = counts.filter("v is not null").groupBy(cell.cast("int").alias("cell")).agg(F.min("v").alias("least")).orderBy("cell").collect()
    if not limits:
        return F.lit(0)
    least = F.array(*[F.lit(r["least"]) for r in limits])
    named = F.array(*[F.lit(r["cell"]) for r in limits])
    return F.when(value.isNull(), F.lit(0)).otherwise(F.element_at(named, F.size(F.filter(least, lambda x: x <= value))))


def _curve(bits: int, points: list[Column]) -> Column:
    @F.arrow_udf("long")
    def index(point: pa.Array) -> pa.Array:
        if isinstance(point, pa.ChunkedArray):
            point = point.combine_chunks()
        return pa.array(curve_index([f.to_numpy(zero_copy_only=False) for f in point.flatten()], bits), pa.int64())

    return index(F.struct(*[p.cast("long").alias(f"p{i}") for i, p in enumerate(points)]))


def assign_shards(
    docs: DataFrame, dimensions: Sequence[str], shards: int = 24, law: str = "rows", size_column: str | None = None,
    ties: Sequence[str] = (), bits: int = 6,
) -> DataFrame:
    """All columns of ``docs`` and ``mr_curve`` (place on the curve), ``mr_shard`` (from 0), ``mr_slot`` (place in the shard, from 0).

    ``law="rows"`` cuts runs whose counts differ by at most one; ``law="bytes"`` cuts where the running sum of
    ``size_column`` (null: 0) passes equal shares, so that a shard is off its share by less than one row on either side. Rows of one place on the
    curve are ordered by ``ties``, then as they were read. Nulls are a smallest value of their own in every dimension; repeated rows are rows of
    their own; of an empty table all is empty; other columns stay as they are. Names that begin with ``mr_`` are reserved.
    """
    if len(dimensions) * bits > 62:
        raise ValueError("dimensions times bits must be at most 62")
    if law not in ("rows", "bytes") or (law == "bytes" and size_column is None):
        raise ValueError("law is rows, or bytes with a size_column")
    # the key makes every row unique, so a value that a third of the rows share is cut into ranges like any other
    rows = settle(docs.withColumn("mr_row", F.monotonically_increasing_id()), "shard-rows")
    total = rows.count()
    if not total:
        return docs.select("*", F.lit(0).cast("long").alias("mr_curve"), F.lit(0).alias("mr_shard"), F.lit(0).cast("long").alias("mr_slot"))
    points = [cells(rows, d, bits, total) for d in dimensions]
    placed = in_order(rows.withColumn("mr_curve", _curve(bits, points)), ["mr_curve", *ties, "mr_row"], size_column if law == "bytes" else None)
    if law == "rows":
        shard = F.expr(f"(mr_rank * {shards}) div {total}")
        first = F.expr(f"(mr_shard * {total} + {shards - 1}) div {shards}")
        out = placed.withColumn("mr_shard", shard.cast("int")).withColumn("mr_slot", F.col("mr_rank") - first)
    else:
        load = F.coalesce(F.col(size_column).cast("long"), F.lit(0))
        sum_ = rows.agg(F.sum(load)).first()[0] or 0
        # a row lies where its middle lies; without any size all rows are in the first shard
        placed = placed.withColumn("mr_middle", 2 * F.col("mr_before") + load)
        shard = F.expr(f"(mr_middle * {shards}) div {2 * sum_}" if sum_ else "0L")
        out = placed.withColumn("mr_shard", F.least(shard, F.lit(shards - 1)).cast("int"))
        starts = out.groupBy("mr_shard").agg(F.min("mr_rank").alias("mr_first"))
        out = out.join(F.broadcast(starts), "mr_shard").withColumn("mr_slot", F.col("mr_rank") - F.col("mr_first"))  # a row a shard
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "mr_curve", "mr_shard", "mr_slot")


def write_shards(assigned: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Parquet folders ``mr_shard=n``; files are runs of the slots, so their statistics are as narrow as the run."""
    file = F.expr(f"mr_slot div {rows_per_file}")
    # every (shard, file) is a key of bounded size; rows lie in slot order inside their file
    dealt = assigned.withColumn("mr_file", file).repartitionByRange("mr_shard", "mr_file").sortWithinPartitions("mr_shard", "mr_slot")
    dealt.drop("mr_file").write.option("maxRecordsPerFile", rows_per_file).partitionBy("mr_shard").parquet(path)
