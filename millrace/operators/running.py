"""Running totals that do not put a whole key group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, Column]
) -> DataFrame:
    """Running sums at the grain ``keys + order``; equal order values are peers.

    Rows are summed per key and order value first, so the window sees one row
    per order value (for months: a bounded number), however hot the key is.
    """
    grain = df.groupBy(*keys, *order).agg(*[F.sum(c).alias(n) for n, c in totals.items()])
    frame = Window.partitionBy(*keys).orderBy(*order)
    return grain.select(
        *keys, *order, *totals, *[F.sum(n).over(frame).alias(f"cumulative_{n}") for n in totals]
    )


def running_columns_in_blocks(
    df: DataFrame, keys: Sequence[str], order: str, block: Column, totals: Mapping[str, Column]
) -> DataFrame:
    """Every row with ``cumulative_<name>`` of each total, over an order column with many values per key.

    The order range is cut into blocks (an hour, a day, a month).  Each (key, block) is
    summed on its own; block totals are carried forward over the few blocks of
    a key and added to the running sum inside the block.  ``block`` must not
    decrease when ``order`` increases; equal order values are peers; null keys are a group.
    """
    rows = df.withColumn("_block", block)
    sums = rows.groupBy(*keys, "_block").agg(*[F.sum(v).alias(n) for n, v in totals.items()])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    by = [*keys, "_block"]
    carried = sums.select(
        *[F.col(k).alias(f"_at{i}") for i, k in enumerate(by)], *[F.sum(n).over(before).alias(f"_carry_{n}") for n in totals]
    )
    inside = Window.partitionBy(*by).orderBy(order)
    running = rows.select("*", *[F.sum(v).over(inside).alias(f"_run_{n}") for n, v in totals.items()])
    on = [F.col(k).eqNullSafe(F.col(f"_at{i}")) for i, k in enumerate(by)]
    total = lambda n: F.coalesce(F.col(f"_carry_{n}") + F.col(f"_run_{n}"), f"_carry_{n}", f"_run_{n}")
    return running.join(carried, on).select(*df.columns, *[total(n).alias(f"cumulative_{n}") for n in totals])
