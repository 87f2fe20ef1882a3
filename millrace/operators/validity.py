"""Joins on validity ranges, always behind an equality key.

A bare range condition would make Spark compare every pair of rows.  Prices
carry an item key, and contracts are spread over the months they cover, so
the join is an equality join with the exact range as a residual condition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bins tried for a validity dimension, in days, and how many bins its rows may cover on average.
WIDTHS, SPREAD = tuple(4**n for n in range(10)), 2
#: A dimension of more rows (spread over its bins) is not broadcast, whatever its files lead Spark to expect.
BROADCAST_ROWS = 100_000


def _day(time: Column) -> Column:
    return F.unix_date(F.to_date(time))


def _bin(time: Column, width: int) -> Column:
    return F.floor(_day(time) / width)


def _width(rows: DataFrame, start: Column, last: Column) -> tuple[int, int]:
    """The narrowest bin that leaves the rows at most ``SPREAD`` times as many, and the number of rows it makes."""
    bins = [F.sum(_bin(last, w) - _bin(start, w) + 1).alias(f"w{w}") for w in WIDTHS]
    told = rows.agg(F.count(F.lit(1)).alias("n"), *bins).first()
    made = {w: told[f"w{w}"] or 0 for w in WIDTHS}
    width = next((w for w in WIDTHS if made[w] <= SPREAD * told["n"]), WIDTHS[-1])
    return width, made[width]


def valid_at(
    facts: DataFrame, dimension: DataFrame, key: str, at: str, start: str = "start_date",
    end: str = "end_date", how: str = "left", width: int | None = None, until: dt.date | None = None,
) -> DataFrame:
    """Join each fact to the dimension rows of its key valid on its date; null end = open.

    Both sides meet by key and time bin (``width`` days): a dimension row stands in every bin that it covers, a
    fact in one, and the exact range decides. So a fact is compared with the rows of its key around its date and not with the key's whole
    history, and a key that holds much of the facts is spread over its bins. The width follows the ranges: short prices get
    narrow bins and prices of years get wide ones, so that the dimension grows to ``SPREAD`` times its rows at most. Open rows reach
    up to ``until``, by default the last date of the facts, which is looked up first.

    Spark expects a dimension to be as large as its compressed files and would broadcast one of millions of rows; one of
    more than ``BROADCAST_ROWS`` is merged instead.
    """
    if until is None:
        until = facts.agg(F.max(at)).first()[0]
    last = F.coalesce(F.col(end), F.lit(until).cast(dimension.schema[end].dataType))
    standing = dimension.filter(F.col(start) <= last)
    fitting, made = _width(standing, F.col(start), last)
    width = width or fitting
    covered = standing.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), width), _bin(last, width))))
    other = covered.withColumnRenamed(key, "_key")
    if made > BROADCAST_ROWS:
        other = other.hint("merge")
    on = (
        (F.col(key) == F.col("_key")) & (_bin(F.col(at), width) == F.col("_bin"))
        & (F.col(at) >= F.col(start))
        & (F.col(end).isNull() | (F.col(at) <= F.col(end)))
    )
    return facts.join(other, on, how).drop("_key", "_bin")


def current_rows(dimension: DataFrame, end: str = "end_date") -> DataFrame:
    """Rows of a validity dimension that are still open."""
    return dimension.filter(F.col(end).isNull())


def by_month(dimension: DataFrame, start: str, end: str, month: str = "valid_month") -> DataFrame:
    """One row per month start that lies inside the closed range [start, end]."""
    first = F.when(F.trunc(start, "month") == F.col(start), F.col(start)).otherwise(
        F.add_months(F.trunc(start, "month"), 1)
    )
    return (
        dimension.withColumn("_first", first)
        .filter(F.col("_first") <= F.col(end))
        .withColumn(month, F.explode(F.expr(f"sequence(_first, trunc({end}, 'month'), interval 1 month)")))
        .drop("_first")
    )
