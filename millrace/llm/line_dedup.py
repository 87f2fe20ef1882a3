"""Repeated lines, by levelled sorted runs of line hashes.

The store is a list of runs: tables bucketed and sorted by a 128-bit hash of the line, with the
number of documents that hold it and the largest document. A batch of documents (largest
identifiers first) is reduced to one row per line, merge-anti-joined with each run's settled lines
(those already met in enough documents) and added as a run of level 0. When a level has
``fanout`` runs they are compacted into one run of the next. Runs and batches have the same
buckets, so the joins shuffle no run; a compaction shuffles the runs it unites, once for each level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.workspace import fresh_name, fresh_path

KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    return C.lower_ascii(F.btrim(line, F.lit(C.BLANKS)))


@dataclass
class LineRuns:
    """Levelled runs of (line hash, documents, largest document)."""

    spark: SparkSession
    min_docs: int
    fanout: int = 3
    levels: dict[int, list[str]] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        # as many buckets as the session has shuffle partitions: a batch lands in its buckets by its own shuffle
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame, level: int) -> None:
        name, path = fresh_name("line_run"), fresh_path(self.spark, "line-run")
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        self.paths[name] = path
        self.levels.setdefault(level, []).append(name)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for names in self.levels.values() for n in names]

    def add(self, lines: DataFrame) -> None:
        """``lines``: a row per document and distinct line (k1, k2, doc_id), no document of an earlier batch."""
        fresh = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        for run in self.runs():
            fresh = fresh.join(run.filter(F.col("n") >= self.min_docs), KEY, "left_anti")
        self._write(fresh, 0)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            self.compact([level], level + 1)
            level += 1

    def compact(self, levels: list[int], to: int) -> None:
        names = [n for level in levels for n in self.levels.pop(level, [])]
        if names:
            # read as plain files: Spark 4.1 takes a union of bucketed scans for bucketed and then groups wrongly
            merged = self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*[self.paths[n] for n in names])
            self._write(merged.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper")), to)
            for n in names:
                self.spark.sql(f"DROP TABLE {n}")

    def repeated(self) -> DataFrame:
        """Lines met in ``min_docs`` documents or more, after a last compaction; one row each."""
        if len(self.runs()) > 1:
            self.compact(sorted(self.levels), max(self.levels) + 1)
        (name,) = [n for names in self.levels.values() for n in names]
        # as plain files, so that a join on a hot line shuffles both sides and can be split
        return self.spark.read.schema(self.spark.table(name).schema).parquet(self.paths[name]).filter(F.col("n") >= self.min_docs)


def _batch_edges(docs: DataFrame, id_column: str, batches: int) -> list:
    """Identifiers that cut the table into batches of about equal size; any cut gives the same result."""
    at = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx(id_column, at, 1000).alias("e")).first()["e"]
    return sorted(set(found or []))


def drop_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 3,
    batch_rows: int = 100_000_000,
) -> DataFrame:
    """All columns of ``docs`` with the text cut, plus ``mr_lines`` and ``mr_dropped`` (longs).

    A line is known by its text without blanks at both ends, A-Z lower-cased. Lines of ``min_chars``
    code points or more found in ``min_docs`` rows or more go from all rows but those with the
    largest identifier that hold them (a null identifier is smaller than any other). A null text is
    one empty line and comes back as the empty text. Rows with equal identifiers are documents of their own.
    An empty table gives no rows. ``batches`` is the least number of batches; a larger table has one for each
    ``batch_rows`` rows, so that a batch stays as large as it is and levels grow instead. Names that begin with ``mr_`` are reserved.
    """
    spark = docs.sparkSession
    batches = max(batches, -(-docs.count() // batch_rows))  # of files only the footers are read
    row = docs.select(F.col(id_column).alias("doc_id"), C.whole(F.col(text_column)).alias("body"))
    long_lines = F.filter(F.transform(F.split("body", "\n"), line_key), lambda k: F.char_length(k) >= min_chars)
    k1, k2 = C.hash_pair(F.col("key"))

    store = LineRuns(spark, min_docs, fanout)
    edges = _batch_edges(row, "doc_id", batches)
    above = None
    for edge in [*reversed(edges), None]:
        part = row if above is None else row.filter(F.col("doc_id").isNull() | (F.col("doc_id") <= F.lit(above)))
        part = part if edge is None else part.filter(F.col("doc_id") > F.lit(edge))
        keys = part.select("doc_id", F.explode(F.array_distinct(long_lines)).alias("key"))
        store.add(keys.select("doc_id", k1.alias("k1"), k2.alias("k2")))
        above = edge
    repeated = store.repeated().select(*KEY, "keeper")

    # a row is known by identifier and text: rows equal in both lose the same lines
    t1, t2 = C.hash_pair(F.col("body"))
    places = row.select("doc_id", t1.alias("t1"), t2.alias("t2"), F.posexplode(F.transform(F.split("body", "\n"), line_key)).alias("at", "key"))
    places = places.filter(F.char_length("key") >= min_chars)
    gone = (
        places.select("doc_id", "t1", "t2", "at", k1.alias("k1"), k2.alias("k2")).join(repeated, KEY)
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("mr_id"), F.col("t1").alias("mr_t1"), F.col("t2").alias("mr_t2"))
        .agg(F.collect_set("at").alias("mr_gone"))
    )
    text = C.whole(F.col(text_column))
    m1, m2 = C.hash_pair(text)
    joined = docs.withColumns({"mr_l1": m1, "mr_l2": m2}).join(
        C.apart(gone), F.col(id_column).eqNullSafe(F.col("mr_id")) & (F.col("mr_l1") == F.col("mr_t1")) & (F.col("mr_l2") == F.col("mr_t2")), "left",
    )
    lines = F.split(text, "\n")
    cut = joined.withColumn("mr_text", F.when(F.col("mr_gone").isNull(), text).otherwise(_without(lines, F.col("mr_gone"))))
    return cut.select(
        *[F.col("mr_text").alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns],
        F.size(lines).cast("long").alias("mr_lines"),
        F.when(F.col("mr_gone").isNull(), 0).otherwise(F.size("mr_gone")).cast("long").alias("mr_dropped"),
    )


def _without(lines: Column, gone: Column) -> Column:
    """The lines joined again without some places; linear in a long text: the places are found by a hash set."""
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    once = F.array(F.struct(lines.alias("lines"), stay.alias("stay")))  # so that the text is split once
    return F.transform(once, lambda x: F.array_join(F.transform(x["stay"], lambda i: F.get(x["lines"], i)), "\n"))[0]
