"""``NOT IN`` with its null rules, for lists of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows whose value is not in the list, as SQL's NOT IN decides it.

    A null in the list removes every row, an empty list none; otherwise null
    values and listed values are removed.  Spark plans a literal NOT IN as a
    broadcast of the list whatever its size.  Here it is an anti join, and two
    uncorrelated subqueries of one row say whether the list holds a null or anything at all.
    """
    values = listed.select(F.col(listed_column).alias("_listed")).distinct()
    some_null = listed.filter(F.col(listed_column).isNull()).exists()
    kept = df.join(values, F.col(column) == F.col("_listed"), "left_anti")
    return kept.filter(~some_null & (F.col(column).isNotNull() | ~listed.exists()))
