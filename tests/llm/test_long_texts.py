"""Texts of megabytes, without a cut for some operators, and extra columns with clashing names."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, exact_dedup, line_dedup, queries, substrings
from tests.llm.test_operators import sha

LONG = "Some words of a line that is long enough to count\n" * 60_000  # 3 MB
SMALL = "/root/testdata/sf0.001"
NO_CUT = "x" * 40_000 + "é" * 40_000


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG, "k", 1, 0), (2, LONG.upper(), "k", None, 0), (3, LONG + "end", "k", 2, 0), (4, NO_CUT, None, 3, 0), (5, None, None, None, None), (5, "", "k", 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n int, part int")


def test_exact_copies_of_long_texts(docs):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.mark_copies(docs).collect()}
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    assert got == {
        (1, 2, 2, False, sha(low(LONG))), (2, 2, 2, True, sha(low(LONG))), (3, 3, 1, True, sha(low(LONG + "end"))),
        (4, 4, 1, True, sha(NO_CUT)), (5, 5, 2, True, sha("")),
    }


def test_lines_of_long_texts(docs):
    got = {(r.doc_id, r.mr_lines, r.mr_dropped, r.text) for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got == {(1, 60_001, 60_000, ""), (2, 60_001, 60_000, ""), (3, 60_001, 0, LONG + "end"), (4, 1, 0, NO_CUT), (5, 1, 0, "")}


def test_tokens_of_long_texts(docs):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    enc = bpe.encoding(ranks, pattern)
    out = bpe.decode_documents(bpe.encode_documents(docs.filter("doc_id in (3, 4)"), ranks, pattern), ranks, pattern)
    for r in out.collect():
        assert r.token_ids == enc.encode_ordinary(r.text) and bytes(r.decoded).decode() == r.text


def test_long_turns_with_other_columns(spark):
    said = "### <\\" * 200_000
    rows = [(1, 0, "user", said, "a", 1), (1, 1, "assistant", said + "!", None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, segments int")
    row = chat.format_conversations(turns).select(
        chat.read_turns(F.col("formatted")).alias("t"), chat.read_learned(F.col("segments")).alias("l"), "valid").first()
    assert [(t.role, t.text) for t in row.t] == [("user", said), ("assistant", said + "!")] and row.l == said + "!" and row.valid


def test_round_trip_is_encode_then_decode(docs):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    apart = bpe.decode_documents(bpe.encode_documents(docs, ranks, pattern), ranks, pattern)
    at_once = bpe.round_trip_documents(docs, ranks, pattern)
    assert at_once.columns == apart.columns
    assert sorted(map(str, at_once.collect())) == sorted(map(str, apart.collect()))
    assert at_once.select("doc_id", "token_ids", F.col("token_ids").alias("again"), "decoded")._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_token_queries_run_one_worker_a_task(spark):
    """Two nodes made four workers in an executor of two cores: over its memory in the pipeline."""
    import corpus_pipeline

    made = [queries.op4_byte_bpe(spark, SMALL), corpus_pipeline.tokens(spark, queries.table(spark, SMALL, "documents"), SMALL)]
    assert [q._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") for q in made] == [1, 1]


def test_batches_of_megabytes_are_coded_in_slices():
    texts = ["word " * 20_000] * 50 + [None, ""] + ["é" * 300_000]
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    parts = list(bpe.text_slices(iter([pa.array(texts), pa.array([], pa.string())]), lambda part: bpe.ids_array(enc, part, 1 << 16)))
    assert max(len(p) for p in parts) <= 7 and sum(map(len, parts)) == 53
    rows = [r for p in parts for r in p.to_pylist()]
    assert rows == [enc.encode_ordinary(t or "") for t in texts]


def test_batches_of_megabytes_are_cut_in_slices():
    words = [f"w{i}" for i in range(20_000)]
    texts, starts = [" ".join(words)] * 40 + ["", "a b"], [[0, 5, 100]] * 40 + [None, None]
    batch = (pa.array(texts), pa.array(starts, pa.list_(pa.int32())), pa.array([False] * 39 + [True, False, False]))
    parts = list(substrings.cut_slices(iter([batch]), 35))
    assert max(len(p) for p in parts) <= 7
    got = [r for p in parts for r in p.to_pylist()]
    some = {"n_words": 20_000, "kept": " ".join(words[40:100] + words[135:]), "spans": [{"start": 0, "end": 40}, {"start": 100, "end": 135}]}
    everything = {"n_words": 20_000, "kept": "", "spans": [{"start": 0, "end": 20_000}]}
    assert got == [some] * 39 + [everything, {"n_words": 0, "kept": "", "spans": []}, {"n_words": 2, "kept": "a b", "spans": []}]
