"""Summaries kept as sketches: small, stored by day, and merged for any span of days without the rows.

Both kinds have a fixed size whatever they summarise, so a table of them by day and group is read in place of the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes: 2**12 counters give a standard error of about 1.6 %, 200 items a rank error of about 1.3 %.
DISTINCT_SIZE, QUANTILE_SIZE = 12, 200


def distinct_sketches(df: DataFrame, keys: Sequence[str | Column], column: str) -> DataFrame:
    """One sketch of the distinct values of a column for each key, such as a day and a group."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, DISTINCT_SIZE).alias("sketch"), F.count(column).alias("rows"))


def distinct_of(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """About how many distinct values all sketches of a key hold together; values met on several days count once."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"), F.sum("rows").alias("rows"))


def quantile_sketches(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """For each key one sketch of the values of each column, its count, least and largest value, all in one pass."""
    found = [
        f.alias(f"{c}_{n}") for c in columns
        for n, f in (("sketch", F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(QUANTILE_SIZE))), ("count", F.count(c)), ("min", F.min(c)), ("max", F.max(c)))
    ]
    return df.groupBy(*keys).agg(*found)


def summary_of(sketches: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A row for each column: count, min, max, and an array of about the given quantiles, from the sketches of all keys."""
    merged = sketches.agg(*[
        f.alias(f"{c}_{n}") for c in columns
        for n, f in (("sketch", F.kll_merge_agg_double(f"{c}_sketch")), ("count", F.sum(f"{c}_count")), ("min", F.min(f"{c}_min")), ("max", F.max(f"{c}_max")))
    ])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"{c}_count").alias("count"), F.col(f"{c}_min").cast("double").alias("min"), F.col(f"{c}_max").cast("double").alias("max"),
            F.array(*[F.kll_sketch_get_quantile_double(f"{c}_sketch", F.lit(s)) for s in shares]).alias("quantiles"),
        ) for c in columns
    ]
    return merged.select(F.inline(F.array(*rows)))
