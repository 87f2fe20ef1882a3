"""Newest-row operators written as aggregations.

A ``row_number()`` window sends every row of a key to one task and sorts it
there.  Taking the largest ``(order, value)`` per key gives the same answer
with map-side partial results, so a key that holds a third of the table
costs one small partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.workspace import settle


def _order(columns: Sequence[str | Column]) -> Column:
    return F.struct(*[c if isinstance(c, Column) else F.col(c) for c in columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` columns.

    ``order`` should end in a column that breaks ties; otherwise any of the
    tied rows may be kept.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order(order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


#: Newest values of so many keys at most are sent to every task. Other keys are dealt into slices of about so many rows each, and into so many slices at most.
BROADCAST_KEYS, SLICE_ROWS, SLICES = 10_000, 8_000_000, 8


def _value(name: str, blank_as_null: bool) -> Column:
    return F.nullif(F.col(name), F.lit("")) if blank_as_null else F.col(name)


def _newest(order: str, tie: str, columns: Sequence[str], keep_nulls: Sequence[str], blank_as_null: bool) -> list[Column]:
    aggregates = []
    for name in columns:
        value = _value(name, blank_as_null)
        entry = F.struct(F.col(order).alias("at"), F.col(tie).alias("tie"), value.alias("value"))
        newest = F.max(entry if name in keep_nulls else F.when(value.isNotNull(), entry))
        aggregates.append(newest.alias(f"_newest_{name}"))
    return aggregates


def _has_key(key: str, bypass_blank: bool) -> Column:
    return F.coalesce(F.col(key) != "", F.lit(False)) if bypass_blank else F.lit(True)


def _newest_of_few(
    df: DataFrame, key: str, order: str, tie: str, columns: Sequence[str], keep_nulls: Sequence[str], bypass_blank: bool, blank_as_null: bool,
) -> DataFrame:
    """The newest values of few keys: their times first, which hash aggregation finds, then the values among the rows of those times."""
    keyed = df.filter(_has_key(key, bypass_blank)).select(F.col(key).alias("_key"), order, tie, *columns)
    if not columns:
        return keyed.select("_key").distinct()
    time = {c: F.col(order) if c in keep_nulls else F.when(_value(c, blank_as_null).isNotNull(), F.col(order)) for c in columns}
    times = keyed.groupBy(F.col("_key").alias("_time_key")).agg(*[F.max(time[c]).alias(f"_time_{c}") for c in columns])
    near = F.lit(False)
    for c in columns:
        near = near | F.col(order).eqNullSafe(F.col(f"_time_{c}"))
    rows = keyed.join(F.broadcast(times), F.col("_key").eqNullSafe(F.col("_time_key"))).filter(near)
    return rows.groupBy("_key").agg(*_newest(order, tie, columns, keep_nulls, blank_as_null))


def newest_value_fill(
    df: DataFrame,
    key: str,
    order: str,
    tie: str,
    columns: Sequence[str],
    keep_nulls: Sequence[str] = (),
    bypass_blank: bool = True,
    blank_as_null: bool = False,
    newest: DataFrame | None = None,
) -> DataFrame:
    """Spread the newest value of each column over the rows of its key.

    Equals "first non-null value in newest-first order" with the default
    frame, in which a row sees only rows that are not older than itself: rows
    newer than the newest filled row stay null, all others get its value.
    Columns in ``keep_nulls`` take the newest row's value even when it is null.
    An empty string counts as a value unless ``blank_as_null``.

    With ``bypass_blank`` rows whose key is null or blank keep their values.
    That group is usually the largest of all and means nothing as an entity,
    so each of its rows gets a key of its own and the rows spread evenly over
    the join's tasks. ``newest`` gives the values of each key where they are known and few: no row is shuffled then.
    """
    key_column, has_key = F.col(key), _has_key(key, bypass_blank)
    if newest is not None:
        same = key_column == F.col("_key") if bypass_blank else key_column.eqNullSafe(F.col("_key"))
        joined = df.join(F.broadcast(newest), same, "left")
    elif bypass_blank:
        join_key = F.when(has_key, key_column).otherwise(F.concat(F.lit("\u0000"), F.col(tie).cast("string")))
        newest = df.filter(has_key).groupBy(key_column.alias("_key")).agg(*_newest(order, tie, columns, keep_nulls, blank_as_null))
        joined = df.withColumn("_join_key", join_key).join(newest, F.col("_join_key") == F.col("_key"), "left")
    else:
        newest = df.groupBy(key_column.alias("_key")).agg(*_newest(order, tie, columns, keep_nulls, blank_as_null))
        joined = df.join(newest, key_column.eqNullSafe(F.col("_key")), "left")
    filled = []
    for name in df.columns:
        best = F.col(f"_newest_{name}")
        if name not in columns:
            filled.append(F.col(name))
            continue
        value = best["value"] if name in keep_nulls else F.when(F.col(order) <= best["at"], best["value"])
        filled.append(F.when(has_key, value).otherwise(F.col(name)).alias(name) if bypass_blank else value.alias(name))
    return joined.select(*filled)


def newest_value_parts(
    df: DataFrame, key: str, order: str, tie: str, columns: Sequence[str], keep_nulls: Sequence[str] = (),
    bypass_blank: bool = True, blank_as_null: bool = False, slice_rows: int = SLICE_ROWS,
) -> list[DataFrame]:
    """``newest_value_fill`` as parts to be written one after the other, together the whole of it.

    Rows and keys are counted first (the keys nearly). The values of few keys are found, written and sent to the rows: one part. Otherwise
    the keys are dealt into slices, and only one slice's rows are shuffled at a time; rows without a key are dealt by ``tie``.
    """
    told = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(key).alias("keys")).first()
    how = (order, tie, columns, keep_nulls, bypass_blank, blank_as_null)
    if told["keys"] <= BROADCAST_KEYS:
        return [newest_value_fill(df, key, *how, newest=settle(_newest_of_few(df, key, *how), "newest"))]
    slices = min(SLICES, -(-told["rows"] // slice_rows))
    if slices < 2:
        return [newest_value_fill(df, key, *how)]
    dealt = F.pmod(F.xxhash64(F.when(_has_key(key, bypass_blank), F.col(key).cast("string")).otherwise(F.col(tie).cast("string"))), F.lit(slices))
    return [newest_value_fill(df.filter(dealt == n), key, *how) for n in range(slices)]


def last_value_over(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Replace ``columns`` by their value in the last row (by ``order``) of the key group."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), _order(order)).alias("_last"))
    last = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_last")
    same = None
    for k in keys:
        here = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        same = here if same is None else same & here
    joined = df.join(last, same, "left")
    return joined.select(
        *[F.col("_last")[c].alias(c) if c in columns else F.col(c) for c in df.columns]
    )
