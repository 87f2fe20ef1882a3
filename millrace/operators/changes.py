"""UPDATE, DELETE and MERGE as DataFrame jobs: table in, next table out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; false and null leave the row alone."""
    return df.select(
        *[
            F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove rows for which the condition is true; null keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Column] | None = None,
    update_if: Column | None = None,
    delete_if: Column | None = None,
    insert: Mapping[str, Column] | None = None,
    insert_if: Column | None = None,
    evolve: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target`` on equal keys.

    Conditions and values name target columns as ``t.x`` and source columns as
    ``s.x``.  ``update=None`` sets every target column from the source, as
    ``{}`` does nothing; the same holds for ``insert``.  Extra source columns
    are ignored, or with ``evolve`` join the target, null in its old rows.  Two source rows for one target row stop the job, as in a
    table MERGE.  The source is reduced to one row per key.  Target rows meet it
    in a left join and new keys are found by an anti join: Spark splits the hot
    keys of both, which it does not for a full outer join.  A null key matches
    nothing, so it is inserted on its own terms.
    """
    if evolve:
        new_fields = [f for f in source.schema.fields if f.name not in target.columns]
        target = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new_fields})
    columns = target.columns
    rest = [c for c in source.columns if c not in keys]
    packed = source.groupBy(*keys).agg(
        F.first(F.struct(*rest)).alias("_s") if rest else F.lit(None).alias("_s"),
        F.count(F.lit(1)).alias("_n"),
    )
    unpacked = packed.select(*keys, *[F.col("_s")[c].alias(c) for c in rest], "_n", F.lit(True).alias("_in_source"))
    on = None
    for k in keys:
        same = F.col(f"t.{k}") == F.col(f"s.{k}")
        on = same if on is None else on & same
    dealt = unpacked.hint("rebalance")  # both sides fresh from a shuffle, so that a hot target key can be split
    joined = target.alias("t").join(dealt.alias("s"), on, "left")
    both = F.col("_in_source").isNotNull()
    yes = F.lit(True)
    from_source = {c: F.col(f"s.{c}") for c in columns if c in source.columns}
    update = from_source if update is None else update
    insert = from_source if insert is None else insert
    deleting = both & F.coalesce(delete_if if delete_if is not None else F.lit(False), F.lit(False))
    updating = both & ~deleting & F.coalesce(update_if if update_if is not None else yes, F.lit(False))
    inserting = F.coalesce(insert_if if insert_if is not None else yes, F.lit(False)) if insert else F.lit(False)

    doubled = F.raise_error("merge: several source rows for one target row").cast("boolean")
    checked = F.when((deleting | updating) & (F.col("_n") > 1), doubled).otherwise(F.lit(True))
    kept = joined.filter(checked & ~deleting)
    result = []
    for c in columns:
        value = F.col(f"t.{c}")
        if c in update:
            value = F.when(updating, update[c]).otherwise(value)
        result.append(value.cast(target.schema[c].dataType).alias(c))
    if not insert:
        return kept.select(*result)
    fresh = unpacked.alias("s").join(target.select(*keys).distinct().alias("t"), on, "left_anti").filter(inserting)
    new = [(insert[c] if c in insert else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in columns]
    return kept.select(*result).unionByName(fresh.select(*new))


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str], only_if: Column | None = None) -> DataFrame:
    """Insert-only merge: add source rows whose key the target does not have."""
    fresh = source if only_if is None else source.filter(only_if)
    fresh = fresh.join(target.select(*keys).distinct(), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def update_from(
    target: DataFrame, dimension: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` of matching rows by the dimension's values, nulls included."""
    dim = dimension.select(*keys, F.struct(*columns).alias("_new"), F.lit(True).alias("_hit"))
    joined = target.join(dim, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def replace_months(target: DataFrame, batch: DataFrame, month: Sequence[str]) -> DataFrame:
    """Target without the months that the batch brings, plus the batch."""
    kept = target.join(batch.select(*month).distinct(), list(month), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def archive_absent_months(archive: DataFrame, batch: DataFrame, month: Sequence[str]) -> DataFrame:
    """Archive plus only those batch months it lacks; running it twice changes nothing."""
    fresh = batch.join(archive.select(*month).distinct(), list(month), "left_anti")
    return archive.unionByName(fresh.select(*archive.columns))
