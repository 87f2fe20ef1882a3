"""Toxicity by a factorisation machine over hashed terms.

Terms are words and the beginnings of words, hashed into buckets. The buckets that tell the classes
apart (by chi-squared, counted in Spark) are the machine's inputs: a document is the set of those it
has, whatever its length. The machine adds, to a weight for each, an interaction of each pair through short
vectors, so that two terms can mean together what neither means alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.workspace import settle

#: ASCII bytes other than letters and digits part words.
_TABLE = bytes(b if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BEGINNINGS = (4, 5, 6, 7)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 20
    #: Bound on the labelled rows that are used for fitting; a fixed hash of the identifier picks them.
    labelled_rows: int = 20_000
    inputs: int = 2048
    least_docs: int = 4
    rank: int = 4
    epochs: int = 150
    penalty: float = 1e-7


def terms(text: str, buckets: int) -> set[int]:
    """Buckets of the words of a text and of their beginnings."""
    out: set[int] = set()
    hashed = zlib.crc32
    for word in set(text.lower().encode().translate(_TABLE).split()):
        out.add(hashed(word) % buckets)
        if len(word) > 4:
            letters = word.decode()
            for n in BEGINNINGS:
                if len(letters) <= n:
                    break
                out.add(hashed(letters[:n].encode(), 1) % buckets)
    return out


@dataclass
class Machine:
    """bias + sum w_i + sum over pairs <v_i, v_j>, through the logistic function."""

    index: dict[int, int]
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, inputs: list[int]) -> float:
        z = self.bias
        if inputs:
            v = self.vectors[inputs]
            z += self.weights[inputs].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum()
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def fit(rows: list[list[int]], labels: np.ndarray, index: dict[int, int], settings: Settings) -> Machine:
    """Adagrad on the logistic loss, in passes over all rows in blocks. The bias stays at the log odds of the labels,
    so that each term has to speak for itself.
    """
    size, rng = len(index), np.random.default_rng(5)
    share = float(np.clip(labels.mean(), 1e-4, 1 - 1e-4)) if len(labels) else 1e-4
    machine = Machine(index, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, settings.rank)))
    if not len(labels) or not size:
        return machine
    sums = [np.full(size, 1e-6), np.full((size, settings.rank), 1e-6)]
    for _ in range(settings.epochs):
        order = rng.permutation(len(rows))
        for block in np.array_split(order, max(1, len(rows) // 256)):
            counts = np.array([len(rows[i]) for i in block])
            ids = np.array([j for i in block for j in rows[i]], np.int64)
            of = np.repeat(np.arange(len(block)), counts)
            v = machine.vectors[ids]
            total = np.zeros((len(block), settings.rank))
            np.add.at(total, of, v)
            square = np.zeros(len(block))
            np.add.at(square, of, (v**2).sum(axis=1))
            linear = np.bincount(of, machine.weights[ids], len(block))
            z = machine.bias + linear + 0.5 * ((total**2).sum(axis=1) - square)
            error = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels[block]) / len(block)
            g1 = np.bincount(ids, error[of], size) + settings.penalty * machine.weights
            g2 = np.zeros_like(machine.vectors)
            np.add.at(g2, ids, error[of, None] * (total[of] - v))
            g2 += settings.penalty * machine.vectors
            sums[0] += g1 * g1
            sums[1] += g2 * g2
            machine.weights -= 0.5 * g1 / np.sqrt(sums[0])
            machine.vectors -= 0.05 * g2 / np.sqrt(sums[1])
    return machine


def train(docs: DataFrame, labels: DataFrame, label: str, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> Machine:
    """Fit on the labelled documents, at most ``settings.labelled_rows`` of them.

    Null labels are left out; labels that differ for one identifier count as the larger. Without
    any label the machine gives every text the same low score.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("mr_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    known = known.orderBy(F.xxhash64("mr_id"), "mr_id").limit(settings.labelled_rows)

    @F.arrow_udf("array<int>")
    def hashed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([sorted(terms(t.as_py(), settings.buckets)) for t in batch], pa.list_(pa.int32()))

    # the broadcast side has at most labelled_rows pairs of numbers
    texts = docs.select(F.col(id_column).alias("id"), C.whole(F.col(text_column)).alias("body"))
    rows = texts.join(F.broadcast(known), F.col("id") == F.col("mr_id")).select("id", "y", hashed("body").alias("terms"))
    rows = settle(rows, "toxicity-rows")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p")).first()
    n, p = total["n"], total["p"]
    seen = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("d"), F.sum("y").alias("a"))
    expected = F.col("d") * F.lit(p / max(n, 1))
    spread = expected * F.lit(1 - p / max(n, 1)) + 1e-9
    chosen = seen.filter(F.col("d") >= settings.least_docs).withColumn("chi", (F.col("a") - expected) ** 2 / spread)
    chosen = chosen.filter("chi > 8").orderBy(F.col("chi").desc(), "term").limit(settings.inputs)
    index = {r["term"]: i for i, r in enumerate(chosen.select("term").collect())}
    used = F.array_intersect("terms", F.array(*[F.lit(t) for t in index]).cast("array<int>"))
    sample = rows.orderBy("id", "y", "terms").select("y", used.alias("t")).limit(2 * settings.labelled_rows).collect()
    return fit([[index[t] for t in r["t"]] for r in sample], np.array([r["y"] for r in sample], float), index, settings)


def score_documents(docs: DataFrame, machine: Machine, settings: Settings = Settings(), text_column: str = "text", score_column: str = "toxicity") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text; null and empty texts have no terms and get the machine's bias.

    Row by row, without a shuffle; only the text is an input.
    """

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = machine.index
        for batch in texts:
            found = (sorted(index[t] for t in terms(x.as_py(), settings.buckets) if t in index) for x in batch)
            yield pa.array([machine.score(f) for f in found], pa.float64())

    return docs.withColumn(score_column, score(C.whole(F.col(text_column))))
