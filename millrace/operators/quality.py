"""Row expectations: warn, drop or fail, and their counts.

A condition that is null counts as failed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def expect(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Keep every row and add one pass flag per rule."""
    return df.select("*", *[_holds(c).alias(name) for name, c in rules.items()])


def expect_or_drop(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    for condition in rules.values():
        df = df.filter(_holds(condition))
    return df


def expect_or_fail(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Stop the job at the first row that breaks a rule."""
    for name, condition in rules.items():
        stop = F.raise_error(F.lit(f"expectation failed: {name}")).cast("boolean")
        df = df.filter(F.when(_holds(condition), F.lit(True)).otherwise(stop))
    return df


def expectation_metrics(df: DataFrame, dataset: str, rules: Mapping[str, Column]) -> DataFrame:
    """Passed and failed row counts per rule, from one scan."""
    counts = df.agg(
        *[F.count_if(_holds(c)).alias(f"p_{i}") for i, c in enumerate(rules.values())],
        *[F.count_if(~_holds(c)).alias(f"f_{i}") for i, c in enumerate(rules.values())],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"), F.lit(name).alias("name"),
                F.col(f"p_{i}").alias("passed_records"), F.col(f"f_{i}").alias("failed_records"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))
