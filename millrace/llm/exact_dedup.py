"""Exact duplicates by sorting whole texts.

Sampled splitters deal the normalised texts into ranges (``repartitionByRange``) by their beginning and,
where many begin alike, by a hash; each range is sorted externally so that equal texts lie side by side, and a window that compares whole
neighbouring texts finds the runs. A text that holds a large share of the rows would fill one
range; such texts, met again and again in a bounded sample, are dealt by text and a part number,
and their parts are joined again afterwards through one row for each part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import common as C


def mark_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "largest",
    parts: int = 1024,
    sample_rows: int = 40_000,
    hits: int = 20,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text. Of
    equal texts the largest (or ``keep="smallest"``) identifier stays. Rows that share the
    identifier that stays are all kept; rows without an identifier lose against any other,
    and stay (with a null ``keep_id``) only if their whole group has none. Other columns are ignored.
    An empty table gives no rows. ``parts``, ``sample_rows`` and ``hits`` deal out the work and change no result.
    """
    text = C.lower_ascii(C.whole(F.col(text_column)))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("body"))
    hot = C.heavy_keys(rows, F.xxhash64("body"), sample_rows, hits)
    is_hot = F.xxhash64("body").isin(hot) if hot else F.lit(False)
    rows = rows.withColumn("part", F.when(is_hot, C.pmod(F.xxhash64("doc_id"), parts)).otherwise(-1).cast("int"))
    # splitters go through the driver, so they are the text's beginning and hash; equal texts share both
    rows = rows.withColumns({"lead": F.substring("body", 1, 32), "mark": F.xxhash64("body")}).repartitionByRange("lead", "mark", "part")

    best = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    run = Window.partitionBy("lead", "mark", "part", "body").orderBy(best)
    runs = rows.select(
        "doc_id", "part",
        F.first("doc_id").over(run).alias("head"),
        F.count(F.lit(1)).over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("size"),
        F.row_number().over(run).alias("place"),
        C.sha256(F.col("body")).alias("text_sha256"),
    )
    if hot:
        runs = _join_parts(runs, keep)
    else:
        runs = runs.withColumnsRenamed({"head": "keep_id", "size": "group_size"})
    return runs.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def _join_parts(runs: DataFrame, keep: str) -> DataFrame:
    """Unite the parts of the texts that were dealt by part: at most ``parts`` rows for each such text."""
    pick = F.max if keep == "largest" else F.min
    whole = (
        runs.filter("part >= 0 and place = 1").groupBy("text_sha256")
        .agg(pick("head").alias("keep_id"), F.sum("size").alias("group_size"), F.collect_list("part").alias("p"))
        .select("keep_id", "group_size", F.col("text_sha256").alias("whole_sha"), F.explode("p").alias("whole_part"))
    )
    # rows of a text that was not split find no partner; the part number spreads the others
    return runs.join(whole, (F.col("text_sha256") == F.col("whole_sha")) & (F.col("part") == F.col("whole_part")), "left").select(
        "doc_id", "text_sha256",
        F.when(F.col("part") < 0, F.col("head")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("part") < 0, F.col("size")).otherwise(F.col("group_size")).alias("group_size"),
    )
