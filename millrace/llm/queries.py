"""One query per operator, each over its whole tables, and the SQL it is checked against."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe, chat, decontaminate, exact_dedup, line_dedup, near_dup, quality, search, sharding, spelling, substrings, toxicity, warc,
)
from millrace.llm import common as C
from millrace.llm.sql import SQL
from millrace.workspace import fresh_path

RANKS = "byte_bpe_50k.tiktoken"
#: A document stays if it is likelier good than not.
QUALITY_LINE = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def stays(model: quality.CoTrained, score: Column) -> Column:
    """Whether a document of this score stays; all do where no model could be fitted."""
    return score >= QUALITY_LINE if model.fitted else F.lit(True)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(texts(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, score and whether the document stays."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model)
    return scored.select("doc_id", F.col("quality_score").alias("score"), stays(model, F.col("quality_score")).alias("kept"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_repeated_lines(texts(spark, sf_dir))
    return cut.select("doc_id", F.col("mr_lines").alias("n_lines"), F.col("mr_dropped").alias("n_dropped"), C.sha256(F.col("text")).alias("kept_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    both = bpe.round_trip_documents(texts(spark, sf_dir), ranks, pattern)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return both.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), C.sha256(ids).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    formatted = chat.format_conversations(turns.unionByName(extra))
    back = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = chat.read_learned(F.col("segments"))
    return formatted.select(
        "conv_id", F.size(back).cast("long").alias("n_turns"), C.sha256(F.array_join(back, "")).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"), C.sha256(learned).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    held_out = C.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), 3) == 1
    machine = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out), "toxic")
    scored = toxicity.score_documents(docs, machine, score_column="score")
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = fresh_path(spark, "warc")
    warc.write_archives(warc.page_records(pages), path)
    back = warc.resolve(warc.read_pages(spark, path))
    kind = pages.schema["page_id"].dataType
    return back.select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.hit_words(F.col("mr_spans"))
    return found.select(
        "doc_id", F.col("mr_words").alias("n_words"), hit.alias("n_hit"), F.size("mr_items").cast("long").alias("n_items"),
        C.sha256(F.array_join("mr_items", ",")).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(texts(spark, sf_dir), near_dup.Near(shingle=4))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(texts(spark, sf_dir))
    removed = F.aggregate("mr_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return cut.select("doc_id", F.col("mr_words").alias("n_words"), removed.alias("n_removed"), C.sha256(F.col("mr_kept")).alias("kept_sha256"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the curve through source, language and length; equal texts of one place lie side by side.

    Only these columns, the size and the checksum are sorted and written; ``sharding.write_shards`` writes whole rows.
    """
    body = F.col("text").cast("string").cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "n_chars", (F.coalesce(F.octet_length(body), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"),
    )
    placed = sharding.assign_shards(rows, ["source", "lang", "n_chars"], shards=24, law="rows", ties=["size", "text_crc32", "doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("mr_shard").alias("shard"), F.col("mr_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("mr_curve").alias("curve"),
    )


def _mistyped(doc_id: str, run: str) -> str:
    """One run in 31 loses a code point, both chosen by a checksum."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % 31 else run[:at] + run[at + 1 :]


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(texts(spark, sf_dir), change=_mistyped)
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))


OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_quality, op3_line_dedup, op4_byte_bpe, op5_chat, op6_toxicity, op7_warc, op8_decontaminate,
        op9_near_dup, op10_substrings, op11_sharding, op12_spelling, op13_search,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return OPERATORS | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
