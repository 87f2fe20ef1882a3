"""A corpus made ready for training: quality, repeated lines, near duplicates, benchmark passages, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, line_dedup, near_dup, quality
from millrace.llm import common as C
from millrace.llm.queries import RANKS, stays, table
from millrace.workspace import settle


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good; it is trained on the labels of these documents.

    Without labels of both classes nothing can be told, and all documents stay.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model, score_column="mr_quality")
    return scored.filter(stays(model, F.col("mr_quality"))).select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that other documents keep; n_chars follows the text."""
    cut = line_dedup.drop_repeated_lines(docs).select(docs.columns)
    return cut.withColumn("n_chars", F.char_length("text").cast("long"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by five-word shingles at 0.8 or more, the one with the smallest doc_id; among equal ids any one.

    A row is known by a key of its own: rows without doc_id come after all others and, like rows that share
    one, are documents of their own. Rows without words are linked to nothing and stay.
    """
    # the key is written once with the texts, so that every later read of them finds the same one
    keyed = settle(docs.withColumn("mr_row", F.monotonically_increasing_id()), "near-keyed")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mr_row")
    # such places are about four times as wide as the numbers that broadcast_rows is meant for
    near = near_dup.Near(broadcast_rows=250_000)
    marked = near_dup.near_duplicates(keyed.withColumn("mr_place", place), near, id_column="mr_place")
    lost = marked.filter(~F.col("kept")).select("doc_id.mr_row")
    return keyed.join(lost, "mr_row", "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("mr_spans") == 0).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the token ids, and whether decoding gives the text's bytes again."""
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = bpe.round_trip_documents(docs.select("doc_id", "text"), ranks, pattern)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), C.sha256(ids).alias("ids_sha256"),
        (F.sha2("decoded", 256) == C.sha256(C.whole(F.col("text")))).alias("round_trip"),
    )


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dup", one_of_near_copies),
    ("decontaminate", without_benchmark),
    ("tokens", tokens),
]

#: Co-training and byte-level BPE have no SQL form; tests/llm/test_pipeline.py holds the stages after the first against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
