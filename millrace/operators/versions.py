"""Row versions kept as a changelog: ``keys, version, op, columns``.

``op`` is insert, update or delete; an insert or update row carries the whole
new row.  The newest entry per key decides, found by aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.newest import latest_per_key


def as_of_version(log: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Rows of the table as they stood after ``version``."""
    upto = log.filter(F.col("version") <= version)
    return latest_per_key(upto, keys, ["version"]).filter("op <> 'delete'").drop("version", "op")


def history(log: DataFrame) -> DataFrame:
    """Number of changed rows per version and operation."""
    return log.groupBy("version", "op").agg(F.count(F.lit(1)).alias("changed_rows"))


def restore(log: DataFrame, keys: Sequence[str], version: int, new_version: int) -> DataFrame:
    """Changes that bring the newest state back to ``version``, as new log rows."""
    rest = [c for c in log.columns if c not in (*keys, "version", "op")]
    # both states of a key from one pass over the log: its newest entry, and its newest one up to the version
    entry = F.struct("op", F.struct(*rest).alias("row"))
    upto = F.when(F.col("version") <= version, F.col("version"))
    states = log.groupBy(*keys).agg(F.max_by(entry, "version").alias("now"), F.max_by(entry, upto).alias("old"))
    shown = lambda c: F.when(F.col(f"{c}.op") != "delete", F.col(f"{c}.row"))
    both = states.select(*keys, shown("old").alias("_old"), shown("now").alias("_now"))
    op = (
        F.when(F.col("_now").isNull() & F.col("_old").isNull(), F.lit(None))  # gone then and now
        .when(F.col("_now").isNull(), "insert")
        .when(F.col("_old").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_now")), "update")
    )
    changed = both.withColumn("op", op).filter("op IS NOT NULL")
    return changed.select(
        *[
            F.col(c) if c in keys
            else F.lit(new_version).cast(log.schema["version"].dataType).alias("version") if c == "version"
            else F.col("op") if c == "op"
            else F.col("_old")[c].alias(c)
            for c in log.columns
        ]
    )
