"""Benchmark passages in documents, by Wu-Manber search over words.

A pattern is a run of consecutive words of a benchmark item. Texts and patterns become word lists;
a symbol is a word and a block two of them. For the block that ends at the reading position the
shift table tells how far the position may jump; where it tells zero, the bucket of patterns that end
in that block is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.workspace import settle

#: Lower-case A-Z; bytes outside 0-9, a-z and the non-ASCII range part words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    return text.encode().translate(_TABLE).split() if text else []


class WuManber:
    """Search for patterns (tuples of words) of one length."""

    def __init__(self, patterns: list[tuple[bytes, ...]], length: int):
        self.length, self.block = length, min(2, length)
        self.most = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.most), length - end)
            self.buckets.setdefault(pattern[length - self.block :], []).append(pattern)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, pattern) of every occurrence, overlapping ones too."""
        length, block, most, shift = self.length, self.block, self.most, self.shift.get
        end, n = length, len(words)
        while end <= n:
            jump = shift((words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],), most)
            if jump:
                end += jump
                continue
            found = tuple(words[end - length : end])
            for pattern in self.buckets[found[length - block :]]:
                if pattern == found:
                    yield end - length, pattern
            end += 1


class Matcher:
    """The windows of a block of benchmark items, by length."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.items: dict[tuple[bytes, ...], set] = {}
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                self.items.setdefault(tuple(words[i : i + size]), set()).add(item)
        lengths = sorted({len(p) for p in self.items})
        self.searches = [WuManber([p for p in self.items if len(p) == n], n) for n in lengths]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged spans [start, end) of hit words, and the items with an occurring window."""
        spans, items = [], set()
        for search in self.searches:
            for start, pattern in search.search(words):
                spans.append((start, start + search.length))
                items |= self.items[pattern]
        return merge(spans), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


RESULT = "struct<n_words: bigint, spans: array<struct<start: int, end: int>>, items: array<string>>"
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())),
])


def _searched(text: Column, items: list, window: int) -> Column:
    @F.arrow_udf(RESULT)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(items, window)
        for batch in batches:
            rows = []
            for text in batch.to_pylist():
                words = words_of(text)
                spans, found = matcher.find(words)
                rows.append({
                    "n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans],
                    "items": sorted(i for i in found if i is not None),
                })
            yield pa.array(rows, _ARROW)

    return search(text)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    window: int = 10, block_bytes: int = 1 << 20,
) -> DataFrame:
    """``docs`` with ``mr_words`` (long), ``mr_spans`` (word spans covered by windows, merged) and ``mr_items`` (sorted strings).

    Windows are ``window`` words of an item; an item of fewer words, but not none, is one window.
    The benchmark is sent to the workers in blocks of at most about ``block_bytes`` of text (one item
    more at most). One block alone is searched row by row, without a shuffle. Of several, each is searched against every
    document and its finds are written to the shared folder before the next is read, so that driver and workers hold one
    block at a time; the finds are united by a key that is written with the documents. Null and empty texts have no words and
    no hits; null items hit without being listed;
    repeated items count once; an empty benchmark hits nothing.
    """
    text = F.col(text_column).cast("string")
    size = benchmark.agg(F.sum(F.octet_length(F.col(item_text).cast("string"))).alias("b")).first()["b"] or 0
    blocks = int(size // block_bytes) + 1
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(item_text).cast("string").alias("words"))
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def searched(rows: DataFrame, block: int) -> DataFrame:
        part = items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        return rows.withColumn("mr_found", _searched(text, [(r["item"], r["words"]) for r in part.distinct().collect()], window))

    if blocks == 1:
        found = F.col("mr_found")
        return searched(docs, 0).select(*columns, found["n_words"].alias("mr_words"), found["spans"].alias("mr_spans"), found["items"].alias("mr_items"))
    keyed = settle(docs.withColumn("mr_row", F.monotonically_increasing_id()), "benchmark-keyed")
    finds = []
    for b in range(blocks):
        hit = searched(keyed.select("mr_row", text.alias(text_column)), b).filter(F.size("mr_found.spans") > 0)
        finds.append(settle(hit.select("mr_row", "mr_found.spans", "mr_found.items"), "benchmark-finds"))
    every = reduce(DataFrame.unionByName, finds).groupBy("mr_row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    every = every.select("mr_row", merged_spans(F.col("spans")).alias("mr_spans"), F.col("items").alias("mr_items"))
    counted = keyed.withColumn("mr_found", _searched(text, [], window)).join(every, "mr_row", "left")
    empty = lambda c: F.coalesce(c, F.array().cast(every.schema[c].dataType))
    return counted.select(*columns, F.col("mr_found.n_words").alias("mr_words"), empty("mr_spans").alias("mr_spans"), empty("mr_items").alias("mr_items"))


def merged_spans(spans: Column) -> Column:
    """Spans of several blocks, sorted and united."""

    @F.arrow_udf("array<struct<start: int, end: int>>")
    def unite(batch: pa.Array) -> pa.Array:
        rows = [merge([(x["start"], x["end"]) for x in row or []]) for row in batch.to_pylist()]
        return pa.array([[{"start": a, "end": b} for a, b in row] for row in rows], _ARROW.field("spans").type)

    return unite(spans)


def hit_words(spans: Column) -> Column:
    """Words inside merged spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
