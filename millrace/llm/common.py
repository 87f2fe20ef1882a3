"""Small helpers shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: The six characters [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def sha256(text: Column) -> Column:
    """Lower-case hex digest of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def hash_pair(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds: together a 128-bit key."""
    return F.xxhash64(text), F.xxhash64(F.lit(0x5EED), text)


def pmod(column: Column, n: int) -> Column:
    return F.pmod(column, F.lit(n))


def heavy_keys(df: DataFrame, key: Column, sample_rows: int, hits: int) -> list[int]:
    """64-bit keys that hold a large share of the rows, found in a bounded sample.

    About ``sample_rows`` rows are looked at and a key must be met ``hits`` times,
    so at most ``sample_rows / hits`` keys come back. Used to deal out work only:
    a key missed or named by chance changes no result.
    """
    rows = df.count()
    if not rows:
        return []
    picked = df.sample(fraction=min(1.0, sample_rows / rows), seed=7) if rows > sample_rows else df
    found = picked.select(key.alias("k")).groupBy("k").count().filter(F.col("count") >= hits)
    return [r["k"] for r in found.orderBy(F.col("count").desc()).limit(2 * sample_rows // hits).collect()]


def apart(df: DataFrame) -> DataFrame:
    """A grouped table, dealt out again before it is joined on its group key.

    Without this the join takes the grouped side as it lies, and Spark splits the hot keys of the other
    side only if both sides come fresh from a shuffle. The grouped side is the small one.
    """
    return df.hint("rebalance")
