"""Views that mask columns or rows for readers outside a group."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def redact(df: DataFrame, columns: Sequence[str], hide: bool) -> DataFrame:
    """Replace columns by a fixed word when the reader may not see them."""
    if not hide:
        return df
    return df.select(*[F.lit("REDACTED").alias(c) if c in columns else F.col(c) for c in df.columns])


def filter_rows(df: DataFrame, restricted: bool, allowed: Column) -> DataFrame:
    """Only the allowed rows for restricted readers, all rows for the others."""
    return df.filter(allowed) if restricted else df


def mask_tail(column: Column, visible: int = 2) -> Column:
    """Stars for all but the last ``visible`` characters."""
    hidden = F.greatest(F.length(column) - visible, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(column, F.lit(visible)))


def secure_view(
    df: DataFrame, groups: Collection[str], hidden_from: str, redacted: Sequence[str] = (),
    masked: Sequence[str] = (), rows: Column | None = None,
) -> DataFrame:
    """Redaction, partial masking and row limits for members of one group."""
    restricted = hidden_from in groups
    if restricted:
        df = redact(df, redacted, True)
        df = df.select(*[mask_tail(F.col(c)).alias(c) if c in masked else F.col(c) for c in df.columns])
        if rows is not None:
            df = filter_rows(df, True, rows)
    return df
