"""Near duplicates: an inverted join on the coordinates of MinHash signatures.

1. Every document gives its number of distinct shingles, a 128-bit key of its set and a signature of
   ``width`` minima. Documents with equal sets are one class from here on.
2. A coordinate and its value are a token. Tokens met in one class only can link nothing. A pair at
   the threshold agrees in ``agree`` coordinates or more (all but about four in a million do, at the
   threshold itself, with the defaults), so classes with fewer shared tokens drop out, and two classes that
   agree so often share one of their ``shared - agree + 1`` rarest tokens: only this prefix is posted.
3. Posting lists are not multiplied out. In a short list all meet; in another
   every posting meets a few leaders. Each class is first compared with the partner that it meets in most lists; what is confirmed joins
   classes into components, and of the other pairs only those between components follow. Lists that still hold several components are taken apart exactly, from whole
   sets. Classes compared with the same leader (their pivot) or with another leader of the same group have a core: the shingles that many of them hold. Two of them can be
   linked only if they share a shingle outside the core, or if their sizes allow it by what each holds of the core: near copies of one
   text that are not near each other are neither. Classes with different pivots share one of their rarest shingles. In every list only postings outside the
   largest component (or pivot) meet the rest, and of what meets only pairs stay whose odd bits, 256 for each set, do not show more differences than a link allows.
4. For each candidate pair the agreeing coordinates are counted, then the whole shingle sets are compared.

Links are few beside documents, so most steps cost what their shuffles cost, whatever they move. Each small table tells its
number of rows while it is written; up to ``few`` rows it is sent to every task, and shuffled like any other beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.llm.words import Words, mix, powers, rolling, slices
from millrace.workspace import settle, settle_told


@dataclass(frozen=True)
class Near:
    """``shingle`` words; linked if 100 * both >= ``percent`` * either."""

    shingle: int = 5
    percent: int = 80
    width: int = 64
    agree: int = 36
    leaders: int = 4
    core: int = 10
    short: int = 6
    #: A list of rows as wide as one number is broadcast up to this count (some 16 MB), and shuffled beyond it.
    broadcast_rows: int = 1_000_000
    #: So many rows of up to four numbers are broadcast (some 8 MB), and more are shuffled.
    few: int = 100_000


class Kept(NamedTuple):
    """A written table and its number of rows."""

    rows: DataFrame
    count: int

    def side(self, few: int, *columns: Column | str) -> DataFrame:
        """These columns for one side of a join, broadcast where the rows are few."""
        rows = self.rows.select(*columns) if columns else self.rows
        return F.broadcast(rows) if self.count <= few else rows


def kept(df: DataFrame, label: str) -> Kept:
    rows, told = settle_told(df, label)
    return Kept(rows, told["rows"])


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    runs = rolling(hashes, size)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            short = hashes[a:b] * powers(0xA0761D6478BD642F, b - a)
            out.append(mix(np.array([short.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of shingles."""
    n = np.uint64(len(values))
    totals = [mix(values ^ salt).sum(dtype=np.uint64) + n for salt in (np.uint64(0), np.uint64(0x5851F42D4C957F2D))]
    first, second = mix(np.array(totals, np.uint64)).view(np.int64).tolist()
    return first, second


#: 64-bit numbers of the odd bits of a set.
ODD = 4


def odd_bits(values: np.ndarray) -> np.ndarray:
    """Of each of 64 * ``ODD`` bits, whether an odd number of the shingles falls on it.

    Shingles that two sets share fall out of the bits that differ between them, and each of the others changes one
    bit: at most as many bits differ as there are shingles held by one set only.
    """
    counts = np.bincount((mix(values ^ np.uint64(0x0DD5_0DD5_0DD5_0DD5)) % np.uint64(64 * ODD)).astype(np.int64), minlength=64 * ODD)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def signature(values: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Minimum of each of the hash functions over the set."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 2048):
        part = (values[at : at + 2048, None] ^ masks) * factors
        np.minimum(out, part.min(axis=0), out=out)
    return mix(out ^ masks)  # a value names its coordinate too


def _features(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, n, key and key2 (its set), tokens of every row; no key and no tokens without words."""
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, near.width, np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(0, 1 << 63, near.width, np.uint64)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                sets = shingle_sets(part.column("body"), near.shingle)
                tokens = [signature(s, factors, masks).view(np.int64) if len(s) else None for s in sets]
                keys = [set_key(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(k, pa.int64()) for k in zip(*keys)), pa.array(tokens, pa.list_(pa.int64()))],
                    ["doc_id", "n", "key", "key2", "tokens"],
                )

    return docs.mapInArrow(compute, f"doc_id {kind}, n long, key long, key2 long, tokens array<long>")


def _sets(docs: DataFrame, near: Near) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                sets = [s for s in shingle_sets(part.column("body"), near.shingle) if len(s)]
                keys = np.array([set_key(s) for s in sets], np.int64).reshape(len(sets), 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0]), pa.array(keys[:, 1]), *(pa.array(x, pa.list_(pa.int64())) for x in ([s.view(np.int64) for s in sets], [odd_bits(s) for s in sets]))],
                    ["key", "key2", "members", "odd"],
                )

    return docs.select("body").mapInArrow(compute, "key long, key2 long, members array<long>, odd array<long>")


def _fits(a: str, b: str, percent: int):
    """Sizes that a linked pair can have."""
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _close(a: str, b: str, n: str, m: str, percent: int):
    """Whether the odd bits (a, b) of two sets of these sizes leave room for a link: ``odd_bits`` never counts more than really differ."""
    differ = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(ODD)), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col(n) + F.col(m))


def _pairs(rows: DataFrame) -> DataFrame:
    """(a, b) with the smaller node first; a pair met from both ends comes twice."""
    return rows.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


class _Search:
    def __init__(self, docs: DataFrame, features: DataFrame, near: Near):
        self.docs, self.near = docs, near
        # a class is known by a number of its own, given once, so that no two sets can share it
        classes = features.filter("n > 0").groupBy("key", "key2").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.min("doc_id").alias("least"))
        self.classes = settle(classes.withColumn("node", F.monotonically_increasing_id()), "near-all")

    def posted(self) -> DataFrame:
        """Classes that can have a partner: node, n, tokens (shared ones, rarest first)."""
        near = self.near
        posts = self.classes.select("node", "n", F.explode("tokens").alias("token"))
        shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
        met = posts.join(C.apart(shared), "token").groupBy("node").agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"), F.sum("df").alias("shared"),
        )
        return met.filter(F.size("t") >= near.agree).select("node", "n", "shared", F.transform("t", lambda x: x["token"]).alias("tokens"))

    def sets(self, wanted: Kept) -> DataFrame:
        """node, members, odd (see ``odd_bits``) of the wanted classes (node, also repeated): the whole shingle sets, from the text of one holder each."""
        near = self.near
        named = kept(self.classes.select("node", "key", "key2", "least").join(wanted.side(near.few, "node"), "node", "left_semi"), "near-wanted")
        ids = named.rows.select(F.col("least").alias("mr_id"))
        ids = F.broadcast(ids) if named.count <= near.broadcast_rows else ids.distinct()
        texts = self.docs.join(ids, F.col("doc_id").eqNullSafe(F.col("mr_id")), "left_semi")
        sets = _sets(texts, near).join(named.side(near.few, "node", "key", "key2"), ["key", "key2"])
        return sets.select("node", "members", "odd").dropDuplicates(["node"])

    def confirmed(self, pairs: Kept) -> DataFrame:
        """Of the pairs (a, b) those that agree often enough: what their whole sets have in common, and whether that links them."""
        near = self.near
        left = self.nodes.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
        right = self.nodes.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
        likely = pairs.side(near.few, "a", "b").join(left, "a").join(right, "b").filter(F.size(F.array_intersect("ta", "tb")) >= near.agree)
        likely = kept(likely.select("a", "b"), "near-likely")
        sets = settle(self.sets(Kept(likely.rows.select(F.explode(F.array("a", "b")).alias("node")), 2 * likely.count)).select("node", "members"), "near-sets")
        one = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
        two = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
        both = F.size(F.array_intersect("ma", "mb")).cast("long")
        counted = likely.side(near.few).join(one, "a").join(two, "b").select("a", "b", both.alias("both"), F.size("ma").alias("na"), F.size("mb").alias("nb"))
        linked = 100 * F.col("both") >= near.percent * (F.col("na") + F.col("nb") - F.col("both"))
        return settle(counted.withColumn("linked", linked), "near-counted")

    def stars(self, posts: DataFrame) -> DataFrame:
        """Each posting (x) with the leaders (y) of its list, in a short list with all others, and the number of lists where they meet."""
        # in the middle of a group stands what shares most tokens with most classes: even leaders are such, odd ones are any
        ranked = [
            F.struct((-F.col("shared") if r % 2 == 0 else F.lit(0)).alias("rank"), F.xxhash64(F.lit(r), "node").alias("h"), "node", "n")
            for r in range(self.near.leaders)
        ]
        heads = posts.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.array(*[F.min(h) for h in ranked]).alias("leaders"))
        leaders = F.array_distinct(F.transform("leaders", lambda x: F.struct(x["node"].alias("node"), x["n"].alias("n"))))
        heads = heads.filter("size > 1").select("token", F.when(F.col("size") > self.near.short, leaders).alias("leaders"))
        posts = settle(posts.select("token", "node", "n").join(C.apart(heads), "token"), "near-lists")
        few = posts.filter("leaders is null").groupBy("token").agg(F.collect_list(F.struct("node", "n")).alias("all"))
        few = few.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
        few = few.select(F.col("x.node").alias("x"), F.col("y.node").alias("y"), F.col("x.n").alias("n"), F.col("y.n").alias("m")).filter("x < y")
        met = posts.select(F.col("node").alias("x"), "n", F.explode("leaders").alias("leader"))
        met = met.select("x", F.col("leader.node").alias("y"), "n", F.col("leader.n").alias("m"))
        met = met.unionByName(few)
        met = met.filter((F.col("x") != F.col("y")) & _fits("n", "m", self.near.percent))
        return met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("lists"))

    def apart(self, pairs: DataFrame, components: Kept) -> DataFrame:
        """Pairs (a, b) whose classes are not in one component yet."""
        of = lambda c: components.side(self.near.few, F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        placed = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        return placed.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    def unsettled(self, posts: DataFrame, by: str, least: int = 2) -> DataFrame:
        """Postings of the lists of ``least`` or more with several values of ``by``, with the most frequent value of the list (``top``)."""
        share = posts.groupBy("token", by).agg(F.count(F.lit(1)).alias("c"))
        most = share.groupBy("token").agg(F.max(F.struct("c", by)).alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("c").alias("size"))
        most = most.filter((F.col("parts") > 1) & (F.col("size") >= least)).select("token", F.col(f"top.{by}").alias("top"))
        return posts.join(kept(most, "near-top").side(self.near.few), "token")

    def pivots(self, open_nodes: Kept, counted: DataFrame) -> Kept:
        """node, component, pivot of the classes (node, component): the partner that most others were compared with, or itself."""
        few = self.near.few
        sides = counted.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"))
        sides = sides.select(F.col("x.a").alias("node"), F.col("x.b").alias("pivot"))
        degree = kept(sides.groupBy("pivot").agg(F.count(F.lit(1)).alias("degree")), "near-degree")
        met = sides.join(degree.side(few), "pivot").unionByName(degree.rows.select(F.col("pivot").alias("node"), "pivot", "degree"))
        met = met.join(open_nodes.side(few), "node").select("node", "component", "pivot", "degree")
        alone = open_nodes.rows.select("node", "component", F.col("node").alias("pivot"), F.lit(0).cast("long").alias("degree"))
        best = met.unionByName(alone).groupBy("node").agg(F.first("component").alias("component"), F.max(F.struct("degree", "pivot")).alias("x"))
        return kept(best.select("node", "component", F.col("x.pivot").alias("pivot")), "near-pivots")

    def gathered(self, sets: DataFrame) -> Kept:
        """node, pivot: near copies of one text under one pivot, whichever partners they were compared with.

        Each shingle stands for the pivot under which most classes hold it, and a class takes the pivot that most of its shingles stand for.
        """
        held = sets.select("node", "pivot", F.explode("members").alias("token"))
        counts = held.groupBy("token", "pivot").agg(F.count(F.lit(1)).alias("c"))
        leads = counts.groupBy("token").agg(F.max(F.struct("c", "pivot")).alias("x")).filter("x.c > 1").select("token", F.col("x.pivot").alias("pivot"))
        leads = kept(leads, "near-leads")
        votes = held.select("node", "token").join(leads.side(self.near.few), "token").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("votes"))
        own = sets.select("node", "pivot", F.lit(0).cast("long").alias("votes"))
        best = votes.unionByName(own).groupBy("node").agg(F.max(F.struct("votes", "pivot")).alias("x"))
        return kept(best.select("node", F.col("x.pivot").alias("pivot")), "near-gathered")

    def rarest(self, held: DataFrame) -> DataFrame:
        """Postings by the rarest shingles of whole sets: two linked sets share one of them, whatever else they share.

        A set of n has at least ``percent`` % of n in common with any it is linked with, so all but
        that many of its shingles, and one more, are enough; those of one class only need no posting.
        """
        shared = kept(held.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "near-shared")
        ordered = held.join(shared.side(self.near.few), "token").groupBy("node").agg(
            F.first("n").alias("n"), F.first("component").alias("component"), F.first("pivot").alias("pivot"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
        n = F.col("n")
        free = n - F.ceil(n * self.near.percent / 100) + 1 - (n - F.size("t"))  # after those nobody shares
        cut = F.slice("t", F.lit(1), F.greatest(free, F.lit(0)).cast("int"))
        posts = ordered.select("node", "n", "component", "pivot", F.explode(cut).alias("x")).select("node", "n", "component", "pivot", F.col("x.token").alias("token"))
        return settle(posts, "near-rarest")

    def across(self, posts: DataFrame, by: str, odd: Kept) -> DataFrame:
        """Pairs of fitting size and odd bits (node, odd), of different components and different ``by``, in a common list.

        What has the most frequent ``by`` of its list meets only the rest of the list.
        """
        grade = F.floor(F.log(100.0 / self.near.percent, F.col("n")) + 1e-9)  # linked sets are at most one apart
        lists = self.unsettled(posts, by).withColumn("grade", grade).join(odd.side(self.near.few), "node")
        outside = lists.filter(F.col(by) != F.col("top")).select(
            "token", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("component").alias("cx"), F.col(by).alias("bx"), F.col("odd").alias("ox"),
            F.explode(F.array(F.col("grade") - 1, "grade", F.col("grade") + 1)).alias("grade"),
        )
        inside = lists.select("token", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("component").alias("cy"), F.col(by).alias("by"), F.col("odd").alias("oy"), "grade")
        met = outside.join(inside, ["token", "grade"])
        near = (F.col("cx") != F.col("cy")) & (F.col("bx") != F.col("by")) & _fits("nx", "ny", self.near.percent) & _close("ox", "oy", "nx", "ny", self.near.percent)
        return _pairs(met.filter(near))

    def contained(self, classes: DataFrame, odd: Kept) -> DataFrame:
        """Pairs of one pivot that could be linked by what they hold of its core alone, judged by sizes and odd bits (node, odd).

        If x and y share nothing outside the core, they share at most the smaller of their parts of it; to be linked, their sizes must not add up to more than (100 + percent) / percent times that.
        """
        percent, step = self.near.percent, 1.02
        bucket = lambda c: F.floor(F.log(step, c) + 1e-9)
        n = F.col("n")
        most = F.floor(F.col("common") * (100 + percent) / percent - n + 1e-9)
        least = F.greatest(F.ceil(n * percent / 100 - 1e-9), F.lit(1))
        able = classes.select(F.col("pivot").alias("token"), "node", "n", "component", most.alias("most"), least.alias("least")).filter("most >= least")
        lists = self.unsettled(able, "component").join(odd.side(self.near.few), "node")
        outside = lists.filter("component != top").select(
            "token", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("component").alias("cx"), F.col("most").alias("mx"), F.col("odd").alias("ox"),
            F.explode(F.sequence(bucket(F.col("least")), bucket(F.col("most")))).alias("bucket"),
        )
        inside = lists.select("token", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("component").alias("cy"), F.col("most").alias("my"), F.col("odd").alias("oy"), bucket(n).alias("bucket"))
        met = outside.join(inside, ["token", "bucket"])
        able = (F.col("cx") != F.col("cy")) & (F.col("ny") <= F.col("mx")) & (F.col("nx") <= F.col("my")) & _fits("nx", "ny", percent)
        return _pairs(met.filter(able & _close("ox", "oy", "nx", "ny", percent)))

    def rest(self, open_nodes: Kept, counted: DataFrame) -> DataFrame:
        """Candidate pairs, also repeated, of classes (node, component) that the leaders left in different components.

        Which class has which pivot decides how many pairs come, not which links are found. The core of a pivot's classes is what more than one in ``core`` of them hold. Two linked classes with one pivot share a
        shingle outside the core, or are linked by what they hold of it; with different pivots they share one of their rarest shingles.
        """
        near = self.near
        placed = self.pivots(open_nodes, counted)
        sets = self.sets(Kept(open_nodes.rows.select("node"), open_nodes.count))
        sets = settle(sets.join(placed.side(near.few), "node").withColumn("n", F.size("members").cast("long")), "near-open-sets")
        placed = self.gathered(sets)
        odd = Kept(sets.select("node", "odd"), placed.count)
        classes = settle(sets.drop("pivot", "odd").join(placed.side(near.few), "node"), "near-classes")
        held = classes.select("node", "n", "component", "pivot", F.explode("members").alias("token"))
        size = kept(placed.rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("size")), "near-size")
        core = held.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("c")).filter("c > 2").join(size.side(near.few), "pivot")
        core = kept(core.filter(F.col("c") * near.core > F.col("size")).select("pivot", "token", F.lit(True).alias("core")), "near-core")
        marked = held.join(core.side(near.few), ["pivot", "token"], "left").withColumn("core", F.coalesce("core", F.lit(False)))
        marked = settle(marked, "near-marked")
        outside = marked.filter("not core").select("node", "n", "component", F.xxhash64("pivot", "token").alias("token"))
        sums = marked.groupBy("node").agg(F.first("n").alias("n"), F.first("component").alias("component"), F.first("pivot").alias("pivot"), F.count_if("core").alias("common"))
        found = self.across(outside, "component", odd).unionByName(self.contained(settle(sums, "near-common"), odd))
        return found.unionByName(self.across(self.rarest(held), "pivot", odd))

    def run(self) -> Kept:
        """node, component of every class that is linked with another."""
        near = self.near
        self.nodes = settle(self.posted(), "near-nodes")
        prefix = F.slice("tokens", 1, F.size("tokens") - near.agree + 1)
        posts = settle(self.nodes.select("node", "n", "shared", F.explode(prefix).alias("token")), "near-posts")
        met = settle(self.stars(posts), "near-stars")
        # one partner of each class first; of the other pairs only those that this leaves in different components
        closest = met.groupBy("x").agg(F.max(F.struct("lists", "y")).alias("t")).select("x", F.col("t.y").alias("y"))
        first = kept(_pairs(closest).distinct(), "near-first")
        counted = self.confirmed(first)
        linked = lambda pairs: pairs.filter("linked").select("a", "b")
        components = connect(linked(counted), near.few)
        others = self.apart(_pairs(met).join(first.side(near.few), ["a", "b"], "left_anti"), components)
        others = kept(others.distinct(), "near-others")
        between = self.confirmed(others)
        components = extended(components, linked(between), near.few)
        counted = counted.unionByName(between)
        placed = posts.join(components.side(near.few), "node", "left").select("token", "node", F.coalesce("component", "node").alias("component"))
        open_nodes = kept(self.unsettled(settle(placed, "near-placed"), "component", near.short + 1).select("node", "component").distinct(), "near-open")
        # written once each: Spark would look up a pair in every list where it was met, not once
        rest = settle(self.rest(open_nodes, counted).distinct(), "near-met")
        tried = Kept(first.rows.unionByName(others.rows), first.count + others.count)  # pairs left out of both are in one component
        rest = kept(rest.join(tried.side(near.few), ["a", "b"], "left_anti"), "near-rest")
        return extended(components, linked(self.confirmed(rest)), near.few)


def connect(links: DataFrame, few: int = Near.few) -> Kept:
    """node, component (the smallest node reachable) of all nodes of the links (a, b).

    Each round takes the smallest label among a node and its neighbours and then the label of that
    label; rounds go on until nothing changes, each written to the shared folder.
    """
    both = settle(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-both")
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")), "near-labels")
    around = both.unionByName(labels.rows.select(F.col("node").alias("a"), F.col("node").alias("b")))  # a node is its own neighbour
    while True:
        near_by = around.join(labels.side(few, F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("low"), F.max(F.when(F.col("a") == F.col("b"), F.col("component"))).alias("old"))
        jump = labels.side(few, F.col("node").alias("low"), F.col("component").alias("next"))
        new = near_by.join(jump, "low").select("node", "old", F.least("low", "next").alias("component"))
        new, told = settle_told(new, "near-labels", moved=F.count_if(F.col("old") != F.col("component")))
        labels = Kept(new.select("node", "component"), labels.count)
        if not told["moved"]:
            return labels


def extended(components: Kept, links: DataFrame, few: int = Near.few) -> Kept:
    """The components (node, component) after more links: only whole components and nodes outside them are connected again."""
    of = lambda c: components.side(few, F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    ends = kept(ends.filter("a != b").distinct(), "near-ends")
    if not ends.count:
        return components
    over = connect(ends.rows, few)
    moved = components.rows.join(over.side(few, F.col("node").alias("component"), F.col("component").alias("low")), "component", "left")
    moved = moved.select("node", F.coalesce("low", "component").alias("component"))
    # a component's label is one of its nodes, so what is left are nodes that were in none
    fresh = over.rows.join(components.side(few, "node"), "node", "left_anti").select("node", "component")
    return kept(moved.unionByName(fresh), "near-components")


def near_duplicates(docs: DataFrame, near: Near = Near(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs without the six ASCII blanks, A-Z lower-cased; a text of fewer words than a shingle has one
    shingle, a null or empty one none and no links. ``component_id`` is the smallest identifier
    reachable over links, and ``kept`` says that it is the row's own. Rows without an identifier link like others
    but name no component: theirs is null, and they are kept, only if nothing they reach has one. Rows that share an identifier are documents of
    their own and are kept or lost by it. An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), C.whole(F.col(text_column)).alias("body"))
    features = settle(_features(docs, near), "near-features")
    search = _Search(docs, features, near)
    components = search.run()
    placed = search.classes.select("node", "key", "key2", "least").join(components.side(near.few), "node", "left")
    lowest = placed.filter("component is not null").groupBy("component").agg(F.min("least").alias("lowest"))
    lowest = F.broadcast(lowest) if components.count <= near.few else C.apart(lowest)
    named = placed.join(lowest, "component", "left").select("key", "key2", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("lowest")).alias("c"))
    worded = features.filter("n > 0").join(named, ["key", "key2"])
    rows = worded.select("doc_id", "n", "c").unionByName(features.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("c")))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("c")).alias("kept"),
    )
