"""Tables that streams keep as folders of changes, folded as they grow.

Every micro-batch writes its newest row per key to a folder of its own, so a repeated one overwrites
the same rows. ``fold`` micro-batches are a generation; the first of a generation also takes over the
newest rows of the whole generation before. Generations use two slots by turns: a folder that is
overwritten is older than the complete generation in the other slot, so a reader may take the
newest row per key over all folders at any time, and there are never more than ``2 * fold`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.newest import latest_per_key

FOLD = 50


def store_newest(batch: DataFrame, number: int, out: str, keys: Sequence[str], sequence: Sequence[str], fold: int = FOLD) -> None:
    generation, place = divmod(number, fold)
    rows = latest_per_key(batch, keys, sequence)
    if place == 0 and generation:
        before = batch.sparkSession.read.schema(batch.schema).parquet(f"{out}/slot={(generation - 1) % 2}").select(batch.columns)
        rows = latest_per_key(before.unionByName(rows), keys, sequence)
    rows.write.mode("overwrite").parquet(f"{out}/slot={generation % 2}/batch={place}")


def read_all(spark: SparkSession, out: str) -> DataFrame:
    """All rows of all folders: several for a key, the newest of which counts."""
    return spark.read.parquet(out).drop("slot", "batch")
