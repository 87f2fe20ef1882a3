"""Repeated passages, by Rabin-Karp hashes of every fixed-length window of words.

All windows are hashed, but only those that can repeat are shuffled: equal windows hold the same smallest
short run of words at the same place (their anchor), so a window whose anchor value occurs once in the corpus occurs
once itself. Windows that share an anchor are one row in that first count. The hashes of the remaining
windows are counted in Spark, and the repeated ones cut their words out of the texts. Of documents with
equal texts one sends its windows; the others are known to repeat. Texts without such windows, or without repeated ones, are
told by a filter of fixed size and skip the shuffles that bring windows and texts together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.llm.sieve import sieve
from millrace.llm.words import Words, by_slices, rolling
from millrace.workspace import settle

ANCHOR = 8  # words


def anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: anchor value, first window and number of windows of each run of windows with one anchor."""
    grams = rolling(hashes, gram)
    reach = window - gram + 1
    # leftmost smallest of 1, 2, 4, ... neighbours, then of the reach
    at, width = np.arange(len(grams)), 1

    def lower(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(grams[right] < grams[left], right, left)

    while width * 2 <= reach:
        at = lower(at[:-width], at[width:])
        width *= 2
    if width < reach:
        at = lower(at[: len(at) - (reach - width)], at[reach - width :])
    change = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return grams[at[change]], change, np.diff(np.append(change, len(at)))


def _anchor_rows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    def compute(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = Words(part.column("body"), lower=False)
        hashes = words.hashes()
        found = []
        for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            if b - a >= window:
                value, start, count = anchors(hashes[a:b], window, gram)
                found.append((np.full(len(value), i), value, start, count))
        if found:
            doc, value, start, count = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), part.column("d").take(pa.array(doc)), part.column("d2").take(pa.array(doc)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
                ["anchor", "d", "d2", "start", "count"],
            )

    return texts.select("d", "d2", "body").mapInArrow(lambda batches: by_slices(batches, "body", compute), "anchor long, d long, d2 long, start int, count int")


def _window_rows(texts: DataFrame, window: int) -> DataFrame:
    """hash (128 bits), place of the text and first word of each window in the text's runs."""

    def compute(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = Words(part.column("body"), lower=False)
        hashes, runs, text = (words.hashes(0), words.hashes(1)), part.column("runs"), part.column("place")
        values, places, starts = ([], []), [], []
        for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            spans = runs[i].values.flatten()
            first, count = (np.asarray(x) for x in spans)
            at = np.concatenate([np.arange(f, f + c) for f, c in zip(first, count)])
            for family in (0, 1):
                values[family].append(rolling(hashes[family][a:b], window)[at])
            places.append(np.full(len(at), text[i].as_py()))
            starts.append(at)
        if places:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.concatenate(v).view(np.int64)) for v in values), pa.array(np.concatenate(places)), pa.array(np.concatenate(starts).astype(np.int32))],
                ["hash", "hash2", "place", "start"],
            )

    return texts.select("place", "runs", "body").mapInArrow(lambda batches: by_slices(batches, "body", compute), "hash long, hash2 long, place long, start int")


CUT = "struct<n_words: long, kept: string, spans: array<struct<start: int, end: int>>>"


CUT_KIND = pa.struct([("n_words", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def cut_texts(part: pa.RecordBatch, window: int) -> pa.Array:
    """Of each text: its words, those that stay, and the spans of those that go."""
    rows = []
    for text, at, whole in zip(*part.columns):
        words = text.as_py().encode().split()
        gone = np.zeros(len(words) + 1, np.int32)
        if len(words) >= window:
            if whole.as_py():
                gone[0] += 1
            elif at.is_valid:
                first = np.asarray(at.values)
                np.add.at(gone, first, 1)
                np.add.at(gone, first + window, -1)
        inside = np.cumsum(gone)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
        kept = b" ".join([w for w, g in zip(words, inside.tolist()) if not g]).decode()
        rows.append({"n_words": len(words), "kept": kept, "spans": [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]})
    return pa.array(rows, CUT_KIND)


def cut_slices(batches: Iterator[tuple[pa.Array, ...]], window: int) -> Iterator[pa.Array]:
    """Batches of texts, starts of repeated windows and whether the whole text repeats, cut about half a megabyte at a time."""
    rows = (pa.RecordBatch.from_arrays(list(batch), ["body", "starts", "whole"]) for batch in batches)
    return by_slices(rows, "body", lambda part: iter([cut_texts(part, window)]))


def _cut_column(window: int):
    @F.arrow_udf(CUT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return cut_slices(batches, window)

    return cut


def remove_repeats(docs: DataFrame, window: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``mr_words`` (long), ``mr_spans`` (removed words, merged), ``mr_kept`` (kept words joined by one space).

    Words are runs without the six ASCII blanks, unchanged. A word goes if a window of ``window``
    words that covers it has the same words as a window that starts anywhere else, in the same text or
    another, as the texts were given. Rows with equal texts repeat each other, whatever their identifiers. Null
    and empty texts, and texts of fewer words, lose nothing. An empty table gives no rows.
    Texts and windows are known by 128-bit hashes. Names that begin with ``mr_`` are reserved.
    """
    body = C.whole(F.col(text_column))
    first, second = C.hash_pair(body)
    texts = docs.withColumns({"mr_body": body, "mr_d": first, "mr_d2": second})
    plain = texts.select(F.col(id_column).alias("id"), F.col("mr_body").alias("body"), F.col("mr_d").alias("d"), F.col("mr_d2").alias("d2"))

    copies = plain.groupBy("d", "d2").agg(F.min("id").alias("least"), (F.count(F.lit(1)) > 1).alias("copied"))
    rows = _anchor_rows(plain, window, min(ANCHOR, window))
    again = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    runs = rows.join(C.apart(again), "anchor", "left_semi").select("d", "d2", "start", "count").distinct()
    runs = runs.groupBy("d", "d2").agg(F.collect_list(F.struct("start", "count")).alias("runs"))
    places = settle(runs.join(copies, ["d", "d2"]).withColumn("place", F.monotonically_increasing_id()), "repeat-places")

    senders = plain.filter(sieve(places, "d")(F.col("d"))).join(places, ["d", "d2"]).filter(F.col("id").eqNullSafe(F.col("least")))
    sent = _window_rows(senders.select("place", "runs", "body"), window)
    twice = sent.groupBy("hash", "hash2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash", "hash2")
    starts = sent.join(C.apart(twice), ["hash", "hash2"], "left_semi").groupBy("place").agg(F.collect_set("start").alias("starts"))
    hit = places.select("d", "d2", "place", "copied").join(starts, "place", "left").filter("copied or starts is not null").drop("place")
    hit = settle(hit, "repeat-hit")

    may_be_hit = sieve(hit, "d")(F.col("mr_d"))
    key = [F.col("mr_d") == F.col("d"), F.col("mr_d2") == F.col("d2")]
    some = texts.filter(may_be_hit).join(hit, key, "left").drop("d", "d2")
    none = texts.filter(~may_be_hit).withColumns({"copied": F.lit(False), "starts": F.lit(None).cast("array<int>")})
    cut = _cut_column(window)("mr_body", "starts", F.coalesce("copied", F.lit(False)))
    parts = [part.withColumn("mr_cut", cut).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col("mr_cut.n_words").alias("mr_words"), F.col("mr_cut.spans").alias("mr_spans"), F.col("mr_cut.kept").alias("mr_kept"),
    ) for part in (some, none)]
    return parts[0].unionByName(parts[1])
