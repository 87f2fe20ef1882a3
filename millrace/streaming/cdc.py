"""Change-data capture, type 1: the newest change per key is the row.

Every micro-batch is reduced to its newest change per key and written to its
own folder, and the folders are folded as they grow; reading the table takes the newest change over
all folders and hides deletions.  A deletion stays as a tombstone with its sequence, so an
older change that arrives later cannot revive the key.  A repeated micro-batch
overwrites its own folder, which makes restarts safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.newest import latest_per_key
from millrace.streaming.folding import FOLD, read_all, store_newest


def newest_changes(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    return latest_per_key(changes, keys, sequence)


def visible(state: DataFrame, keys: Sequence[str], sequence: Sequence[str], delete_when: Column, drop: Sequence[str] = ()) -> DataFrame:
    """Rows a reader sees: newest change per key, tombstones hidden.

    Batch form of the whole operator when ``state`` holds all changes.
    """
    newest = newest_changes(state, keys, sequence)
    return newest.filter(~F.coalesce(delete_when, F.lit(False))).drop(*drop)


def apply_changes(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], state: str, checkpoint: str, fold: int = FOLD) -> StreamingQuery:
    """Run the change stream into the state folder until the input is used up; the ended query has its progress."""
    query = (
        changes.writeStream.foreachBatch(lambda batch, number: store_newest(batch, number, state, keys, sequence, fold))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def read_state(spark: SparkSession, state: str) -> DataFrame:
    return read_all(spark, state)


def compact(spark: SparkSession, state: str, keys: Sequence[str], sequence: Sequence[str], out: str) -> DataFrame:
    """A copy of the state in one folder, tombstones kept."""
    newest_changes(read_state(spark, state), keys, sequence).write.mode("overwrite").parquet(f"{out}/batch=0")
    return read_state(spark, out)
