"""Ranked lexical search with exact skipping of geometric blocks.

Spark counts the corpus (documents, terms, documents a term) and writes one sparse vector a document: its terms
that any query asks for, with their counts. The vectors lie in slices of some thousands of documents. In a slice every
term has a posting list of documents and integer impacts (weight times saturated count). The documents of a list
are clustered by the similarity of their vectors (nearest of some pivots of the list, in a random projection), which cuts the
list into blocks, and a block keeps the largest impact of every term in it: no document of the block can score
more on a query than the sum of these over the query's terms. Lists are visited in the order of
their largest impact; a list, then each of its blocks, is passed over only where that bound stays below the tenth best score
found so far, and what is left is scored in full. A first round over a sample of the vectors gives every
task a tenth best score to begin with. The bounds are exact, so the results are those of scoring everything.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.workspace import settle

#: Bytes of terms: digits, letters (A to Z lowered) and everything beyond ASCII; all others part them.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_PIECE = 1 << 22  # bytes of a text that are split into terms at once


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a whole text in UTF-8, in lists of bounded size."""
    data = (text or "").encode()
    at = 0
    while at < len(data):
        end = at + _PIECE
        part = data[at:end].translate(_TERM)
        if end < len(data):  # a term that goes on beyond the piece is left to the next one
            cut = part.rfind(b" ") + 1
            while not cut and end < len(data):
                end += _PIECE
                part = data[at:end].translate(_TERM)
                cut = part.rfind(b" ") + 1
            if end < len(data):
                part, end = part[:cut], at + cut
        yield part.split()
        at = end


@dataclass(frozen=True)
class Ranking:
    """Scores are sums of weight * (scale * tf div (1000 * tf + saturation * length measure))."""

    best: int = 10
    scale: int = 1_000_000_000
    saturation: int = 8
    length_share: int = 90  # percent
    #: Rows of a slice and of a block; sampled rows of the first round. They deal out work and change no result.
    slice_rows: int = 4096
    block_rows: int = 64
    sample_rows: int = 20_000
    query_bytes: int = 1 << 20

    def weight(self, n: int, df: int) -> int:
        return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def document_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """id, n (all terms of the document, with repeats), terms (asked ones, ascending), counts; documents without a term have no row."""
    kind = docs.schema[id_column].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, terms, counts = [], [], [], []
            for row, text in enumerate(batch.column("body")):
                n, seen = 0, Counter()
                for part in terms_of(text.as_py()):
                    n += len(part)
                    seen.update(part)
                if not n:
                    continue
                found = sorted((vocabulary[t], c) for t, c in seen.items() if t in vocabulary)
                rows.append(row)
                sizes.append(n)
                terms.append([t for t, _ in found])
                counts.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                ["id", "n", "terms", "counts"],
            )

    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("body"))
    return texts.mapInArrow(compute, f"id {kind}, n long, terms array<int>, counts array<int>")


class Lists:
    """Posting lists of a slice: rows of sparse vectors, by row and by term."""

    def __init__(self, ids: list, first: np.ndarray, terms: np.ndarray, impacts: np.ndarray, width: int, projection: np.ndarray, block_rows: int):
        keep = impacts > 0
        row = np.repeat(np.arange(len(ids)), np.diff(first))[keep]
        self.ids, self.width, self.block_rows = ids, width, block_rows
        self.terms, self.impacts = terms[keep].astype(np.int64), impacts[keep]
        self.first = np.searchsorted(row, np.arange(len(ids) + 1))
        self.key = row * width + self.terms  # ascending
        by_term = np.argsort(self.terms, kind="stable")
        self.rows_by_term, self.start = row[by_term], np.searchsorted(self.terms[by_term], np.arange(width + 1))
        self.top = np.zeros(width, np.int64)
        np.maximum.at(self.top, self.terms, self.impacts)
        length = np.sqrt(np.bincount(row, self.impacts.astype(float) ** 2, len(ids)))
        part = (self.impacts / np.maximum(length[row], 1e-9)).astype(np.float32)
        sketch = np.zeros((len(ids) + 1, projection.shape[1]), np.float32)
        for d in range(projection.shape[1]):
            sketch[:-1, d] = np.bincount(row, part * projection[self.terms, d], len(ids))
        self.sketch = sketch

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The list's rows in the order of their block, and where blocks start."""
        rows = self.rows_by_term[self.start[term] : self.start[term + 1]]
        n = -(-len(rows) // self.block_rows)
        if n < 2:
            return rows, np.zeros(1, np.int64)
        pivots = rows[np.arange(n) * len(rows) // n]
        nearest = np.argmax(self.sketch[rows] @ self.sketch[pivots].T, axis=1)
        order = np.argsort(nearest, kind="stable")
        return rows[order], np.flatnonzero(np.append(True, np.diff(nearest[order]) > 0))

    def summary(self, rows: np.ndarray, starts: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Largest impact in each block of each of the ``asked`` terms (ascending)."""
        block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
        size = self.first[rows + 1] - self.first[rows]
        at = np.arange(size.sum()) + np.repeat(self.first[rows] - np.cumsum(size) + size, size)
        column = np.searchsorted(asked, self.terms[at])
        held = asked[np.minimum(column, len(asked) - 1)] == self.terms[at]
        out = np.zeros((len(starts), len(asked)), np.int64)
        np.maximum.at(out, (np.repeat(block, size)[held], column[held]), self.impacts[at[held]])
        return out

    def scores(self, rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Full scores of rows for the ``asked`` terms."""
        key = rows[:, None] * self.width + asked[None, :]
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.impacts[at], 0).sum(axis=1)


class Best:
    """The best rows of each query so far, and the score that a row needs to be among them."""

    def __init__(self, size: int, lines: np.ndarray):
        self.size, self.lines = size, np.maximum(lines, 1)
        self.rows: list[list[tuple]] = [[] for _ in lines]

    def add(self, query: int, scores: np.ndarray, ids: list) -> None:
        # equal scores are ordered by the identifier, rows without one last
        rows = self.rows[query] + [(-int(s), i is None, 0 if i is None else i) for s, i in zip(scores, ids)]
        self.rows[query] = rows = sorted(rows)[: self.size]
        if len(rows) == self.size:
            self.lines[query] = max(self.lines[query], -rows[-1][0])


def search_slice(lists: Lists, queries: list[np.ndarray], best: Best) -> None:
    """Bring every row of the slice that is among the best of a query into ``best``."""
    if not len(lists.key):
        return
    order = np.argsort(-lists.top, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    ordered = [q[np.argsort(place[q])] for q in queries]
    # what a row can score at most on a query's terms from each of them on
    left = [np.cumsum(lists.top[q][::-1])[::-1] for q in ordered]
    holders: dict[int, list[tuple[int, int]]] = {}
    for query, terms in enumerate(ordered):
        for at, term in enumerate(terms.tolist()):
            holders.setdefault(int(place[term]), []).append((query, at))
    scored = [np.zeros(len(lists.ids), bool) for _ in queries]
    for turn in sorted(holders):
        term = int(order[turn])
        if not lists.top[term]:
            break
        open_for = [(q, at) for q, at in holders[turn] if left[q][at] >= best.lines[q]]
        if not open_for:
            continue
        rows, starts = lists.blocks(term)
        asked = np.unique(np.concatenate([ordered[q][at:] for q, at in open_for]))
        most = lists.summary(rows, starts, asked)
        block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
        for q, at in open_for:
            # rows with an earlier term of the query were scored there, or their block's bound was too low
            bound = most[:, np.searchsorted(asked, ordered[q][at:])].sum(axis=1)
            picked = rows[(bound >= best.lines[q])[block] & ~scored[q][rows]]
            if len(picked):
                scored[q][picked] = True
                score = lists.scores(picked, ordered[q])
                good = np.flatnonzero(score >= best.lines[q])
                best.add(q, score[good], [lists.ids[picked[g]] for g in good])


def _searched(vectors: DataFrame, queries: list[np.ndarray], lines: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int, ranking: Ranking) -> DataFrame:
    """query, id, score: for each task the best rows of each query, from ``lines`` on."""
    width = len(weights)
    projection = np.random.default_rng(13).standard_normal((width, 16)).astype(np.float32)
    kind = vectors.schema["id"].dataType.simpleString()

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, ranking.slice_rows):
                part = batch.slice(at, ranking.slice_rows)
                if held and rows + part.num_rows > ranking.slice_rows:
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if held:
            yield pa.Table.from_batches(held)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(ranking.best, lines.copy())
        out_kind = None
        for table in sliced(batches):
            table = table.combine_chunks()
            out_kind = table.schema.field("id").type
            size = table.column("terms").combine_chunks()
            first = np.append(0, np.cumsum(size.value_lengths().to_numpy(zero_copy_only=False)))
            terms = size.flatten().to_numpy()
            tf = table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
            n = table.column("n").to_numpy()
            measure = (100 - ranking.length_share) + (ranking.length_share * n * n_docs) // n_terms
            impact = weights[terms] * ((ranking.scale * tf) // (1000 * tf + ranking.saturation * np.repeat(measure, np.diff(first))))
            lists = Lists(table.column("id").to_pylist(), first, terms, impact, width, projection, ranking.block_rows)
            search_slice(lists, queries, best)
        found = [(q, None if none else i, -s) for q, rows in enumerate(best.rows) for s, none, i in rows]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], out_kind), pa.array([f[2] for f in found], pa.int64())], ["query", "id", "score"])

    return vectors.mapInArrow(compute, f"query int, id {kind}, score long")


def _leaders(found: DataFrame, best: int) -> DataFrame:
    """The best rows of each query, numbered: first of a part of its rows, then of all."""
    by_score = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("query", part).orderBy(*by_score))).filter(F.col("rank") <= best)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by_score))).filter(F.col("rank") <= best)


def search(
    docs: DataFrame, queries: DataFrame, ranking: Ranking = Ranking(), id_column: str = "doc_id", text_column: str = "text",
    query_column: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score (long) of each query's best documents with a score above 0, fewer if there are not so many.

    The queries are a stated set: they go to the workers in blocks of about ``query_bytes`` of text, each against all documents.
    Equal query rows count once, rows that share an identifier but not the text are ranked on their own, and a query without a term
    has no result. Equal scores are ordered by doc_id, rows without one last; repeated documents are ranked as rows of
    their own. Null texts have no terms. Other columns are ignored; empty tables give no rows.
    """
    asked = queries.select(F.col(query_column).alias("item"), F.col(query_text).cast("string").alias("text")).distinct()
    size = asked.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = int(size // ranking.query_bytes) + 1
    results = []
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        results.append(_search_block(docs, [(r["item"], r["text"]) for r in rows], asked.schema["item"].dataType.simpleString(), ranking, id_column, text_column))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _search_block(docs: DataFrame, items: list[tuple], item_kind: str, ranking: Ranking, id_column: str, text_column: str) -> DataFrame:
    spark = docs.sparkSession
    texts = [sorted({t for part in terms_of(text) for t in part}) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in texts for t in terms}))}
    wanted = [np.array([vocabulary[t] for t in terms], np.int64) for terms in texts]
    vectors = settle(document_vectors(docs, vocabulary, id_column, text_column), "search-vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    # at most one row for each term of the block's queries
    df = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    weights = np.zeros(max(len(vocabulary), 1), np.int64)
    for r in df:
        weights[r["t"]] = ranking.weight(total["docs"], r["df"])
    held = vectors.filter(F.size("terms") > 0).select("id", "n", "terms", "counts")
    find = lambda rows, lines: _searched(rows, wanted, lines, weights, total["docs"], total["terms"] or 1, ranking)
    lines = np.zeros(len(items), np.int64)
    if total["docs"] > 4 * ranking.sample_rows:
        first = _leaders(find(held.sample(ranking.sample_rows / total["docs"], 5), lines), ranking.best)
        for r in first.filter(F.col("rank") == ranking.best).select("query", "score").collect():
            lines[r["query"]] = r["score"]  # the best of some rows are no better than those of all
    found = settle(find(held, lines), "search-found")
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], f"query int, item {item_kind}")
    ranked = _leaders(found, ranking.best).join(F.broadcast(names), "query")  # a row a query of the block
    return ranked.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
