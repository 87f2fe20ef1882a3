"""Spelling variants: words one edit apart, found by an index of variable-length grams.

1. Words are counted over all texts, summed in the tasks before they are shuffled.
2. The gram dictionary is pruned by frequency: a gram of ``shortest`` characters is lengthened, up to
   ``longest`` (and a third of the word), only while it stands in more than ``1 / lists`` of all places, so that frequent beginnings are
   told apart and rare ones stay short. Only the frequent grams have to be known to decompose a word, and there
   are at most ``lists`` of each length.
3. An edit spoils only the grams that cover its place. Of grams without a common character that is one at most: the
   bound of three such grams is one, so a word one edit away holds two of them, at their place or one further on
   behind the edit. Each word asks for the three grams that together are rarest, and lists are merged by two: the
   index holds pairs of grams with their places and the word's length, and a word meets what holds two of its three.
4. Each pair of words that meets so is verified by its edit distance.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.workspace import settle

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_NOT_LETTER = re.compile("[^A-Za-zÀ-ÿ]")
_PIECE = 1 << 20  # characters of a text that are split into words at once
_FLUSH = 200_000  # counted words that a task holds before it sends them on
HEAD, TAIL = "\x02", "\x03"
_BUCKETS = 1 << 20  # hashed counts by which grams are ordered


def runs_of(text: str, least: int = 1) -> Iterator[list[str]]:
    """Maximal runs of ``least`` letters or more of a whole text, A to Z lower-cased; lists for pieces of bounded length."""
    run, at = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}"), 0
    while at < len(text):
        cut = _NOT_LETTER.search(text, at + _PIECE)
        end = cut.start() if cut else len(text)
        yield run.findall(text[at:end].encode().translate(_LOWER).decode())
        at = end


def count_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = 7, least_count: int = 2,
    change: Callable[[str, str], str] | None = None,
) -> DataFrame:
    """word, n: how often each word of at least ``least_length`` code points stands in all texts, if ``least_count`` times or more.

    ``change(doc_id, run)`` may rewrite a run first, but not lengthen it; a null identifier is the empty text to it. Null texts have no words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for ident, text in zip(batch.column("id"), batch.column("body")):
                name = ident.as_py() or ""
                for runs in runs_of(text.as_py(), least_length):
                    for run in runs:
                        word = change(name, run) if change else run
                        if len(word) >= least_length:
                            total[word] += 1
                    if len(total) >= _FLUSH:
                        yield _counted("word", total)
        if total:
            yield _counted("word", total)

    texts = docs.select(F.col(id_column).cast("string").alias("id"), C.whole(F.col(text_column)).alias("body"))
    found = texts.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Grams:
    """Variable-length grams of a word under a pruned dictionary (its frequent grams), and those by which it is looked up."""

    def __init__(self, shortest: int, longest: int, spread: int, frequent: frozenset[str]):
        self.shortest, self.longest, self.spread, self.frequent = shortest, longest, spread, frequent

    def third(self, length: int) -> int:
        return (length + 2) // 3

    def at(self, marked: str, place: int, limit: int) -> str:
        """The gram that starts at a place: lengthened while it is frequent, up to ``limit`` and ``longest``."""
        size, limit = self.shortest, min(limit, self.longest, len(marked) - place)
        while size < limit and marked[place : place + size] in self.frequent:
            size += 1
        return marked[place : place + size]

    def windows(self, length: int) -> tuple[range, range]:
        """Where the second and the third gram of a word of this length may start."""
        q, last = self.third(length), length + 3 - self.shortest
        return range(q, min(q + self.spread, last)), range(2 * q, min(2 * q + self.spread, last))

    def asked(self, word: str, rarity: Callable[[int, str], int]) -> tuple[tuple[int, str], ...]:
        """Three grams (place, gram) that share no character, together the rarest; one edit spoils at most one of them."""
        marked, q = f"{HEAD}{word}{TAIL}", self.third(len(word))
        seconds, thirds = ([(p, g, rarity(p, g)) for p in window for g in [self.at(marked, p, q)]] for window in self.windows(len(word)))
        head = self.at(marked, 0, q)
        a = rarity(0, head)
        _, b, c = min((a * (nb + nc) + nb * nc, b, c) for b, g, nb in seconds if b >= len(head) for c, _, nc in thirds if c >= b + len(g))
        return (0, head), (b, self.at(marked, b, q)), (c, self.at(marked, c, q))

    def lookups(self, word: str, rarity: Callable[[int, str], int]) -> set[int]:
        """Keys under which words of the same length or one longer are met: two of the three grams are in them, moved on by one behind the edit."""
        (_, a), (pb, b), (pc, c) = self.asked(word, rarity)
        n = len(word)
        found = {_key(n, 0, a, pb, b), _key(n, 0, a, pc, c), _key(n, pb, b, pc, c)}
        for moved in (0, 1):
            found |= {_key(n + 1, 0, a, pb + moved, b), _key(n + 1, 0, a, pc + moved, c), _key(n + 1, pb + moved, b, pc + 1, c)}
        return found | {_key(n + 1, pb, b, pc, c)}

    def posts(self, word: str) -> set[int]:
        """Keys of all pairs of grams that a word of the same length or one shorter may ask for."""
        marked, n, found = f"{HEAD}{word}{TAIL}", len(word), set()
        for length in (n, n - 1):
            q, longer = self.third(length), n - length
            if length < 3 * self.shortest - 2:
                continue
            head = self.at(marked, 0, q)
            seconds, thirds = ([(p, self.at(marked, p, q)) for p in range(w.start, w.stop + longer)] for w in self.windows(length))
            found |= {_key(n, 0, head, p, g) for p, g in (*seconds, *thirds) if p >= len(head)}
            found |= {_key(n, b, g, c, h) for b, g in seconds for c, h in thirds if c >= b + len(g)}
        return found


def _key(length: int, p: int, g: str, r: int, h: str) -> int:
    return xxhash.xxh64_intdigest(f"{length}:{p}:{g}:{r}:{h}")


def _bucket(place: int, gram: str) -> int:
    return xxhash.xxh32_intdigest(f"{place}:{gram}") % _BUCKETS


def _counted(column: str, total: Counter) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(total.keys()), pa.array(total.values(), pa.int64())], [column, "n"])
    total.clear()
    return batch


def frequent_grams(words: DataFrame, shortest: int, longest: int, lists: int, least: int) -> frozenset[str]:
    """Grams that stand in more than ``1 / lists`` of all places (and ``least`` times): at most ``lists`` of each length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                marked = f"{HEAD}{word}{TAIL}"
                for size in range(shortest, longest):
                    total.update(marked[at : at + size] for at in range(len(marked) - size + 1))
                if len(total) >= _FLUSH:
                    yield _counted("gram", total)
        if total:
            yield _counted("gram", total)

    places = words.agg(F.sum(F.length("word") + 3 - shortest)).first()[0] or 0
    line = max(least, places // lists)
    counted = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return frozenset(r["gram"] for r in counted.filter(F.col("n") > line).select("gram").collect())


def _rarity(words: DataFrame, grams: Grams) -> np.ndarray:
    """Hashed counts of grams by their place: any choice among the grams would be right, this one keeps lists short."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            for word in batch.column("word").to_pylist():
                marked, q = f"{HEAD}{word}{TAIL}", grams.third(len(word))
                for place in (0, *(p for w in grams.windows(len(word)) for p in w)):
                    total[_bucket(place, grams.at(marked, place, q))] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    found = words.select("word").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.ones(_BUCKETS, np.int32)
    out[found.column("bucket").to_numpy()] = np.minimum(found.column("n").to_numpy(), np.iinfo(np.int32).max)
    return out


def near_words(words: DataFrame, shortest: int = 3, longest: int = 8, lists: int = 20_000, least: int = 16, spread: int = 2) -> DataFrame:
    """x, nx, y, ny: pairs of the given words (word, n; distinct) that are one inserted, deleted or replaced code point apart, once each.

    Of words of one length x is the smaller, else the shorter. A word needs ``3 * shortest - 2`` code points, so that three
    grams find room in it; shorter words are refused (ValueError).
    """
    room = 3 * shortest - 2
    if not words.filter(F.char_length("word") < room).isEmpty():
        raise ValueError(f"words of fewer than {room} code points need a smaller `shortest`")
    grams = Grams(shortest, longest, spread, frequent_grams(words, shortest, longest, lists, least))
    counts = words.sparkSession.sparkContext.broadcast(_rarity(words, grams))  # 4 MB

    def keyed(asks: bool) -> Callable:
        def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = counts.value
            rarity = lambda place, gram: int(seen[_bucket(place, gram)])
            for batch in batches:
                keys: list[int] = []
                sizes = []
                for word in batch.column("word").to_pylist():
                    found = grams.lookups(word, rarity) if asks else grams.posts(word)
                    keys += found
                    sizes.append(len(found))
                rows = batch.take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), rows.column("word"), rows.column("n")], ["key", "word", "n"])

        return compute

    schema = "key long, word string, n long"
    narrow = words.select("word", "n")
    x = narrow.mapInArrow(keyed(True), schema).select("key", F.col("word").alias("x"), F.col("n").alias("nx"))
    y = narrow.mapInArrow(keyed(False), schema).select("key", F.col("word").alias("y"), F.col("n").alias("ny"))
    once = (F.length("x") < F.length("y")) | (F.col("x") < F.col("y"))
    met = x.join(y, "key").filter(once & (F.levenshtein("x", "y", 1) == 1))
    return met.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"))


def group_variants(words: DataFrame, ratio: int = 10, **index: int) -> DataFrame:
    """One row per given word (word, n; distinct words): word, n, n_near, form, form_n, root.

    ``n_near`` counts the words one edit away. ``form`` is the one of them that stands most often (ties: the smallest in
    code-point order), if ``ratio`` times as often as the word, else null; ``root`` is what following forms leads to, the word itself if it has none. An empty table gives no rows.
    """
    words = settle(words, "spelling-words")
    pairs = settle(near_words(words, **index), "spelling-pairs")
    sides = pairs.select(F.col("x").alias("word"), F.col("y").alias("other"), F.col("ny").alias("m")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("other"), F.col("nx").alias("m")))
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    placed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.m")).alias("m"))
    named = F.col("m") >= ratio * F.col("n")
    formed = settle(placed.select("word", "n", "n_near", F.when(named, F.col("other")).alias("form"), F.when(named, F.col("m")).alias("form_n")), "spelling-formed")
    chains = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:  # the distance covered doubles; a form stands ten times as often, so chains are short
        jump = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = settle(chains.join(jump, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-chains")
        chains = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    return formed.join(chains, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
