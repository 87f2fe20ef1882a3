"""Sharding along the curve, spelling variants and ranked search against brute force, on small tables with awkward rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import search, sharding, spelling
from millrace.llm.queries import _mistyped
from millrace.workspace import fresh_path

LOW = {i: i + 32 for i in range(65, 91)}


# --- sharding --------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = sharding.curve_index(list(points.T), bits)
    assert sorted(place) == list(range(len(points)))
    walk = points[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


ROWS = [(i % 37 if i % 10 else None, f"text {i % 9}" if i % 8 else None, ["en", None, "de"][i % 3], f"s{i % 5}" if i % 4 else "s0", i * i % 91, "clash", i) for i in range(200)]
ROWS += [(None, None, None, None, None, None, None)] * 3 + [(1, "x" * 300_000, "en", "s0", 300_000, "c", 1)] * 2 + [(5, "same", "en", "s0", 4, "c", 2)] * 60
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot long"


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards(spark, law):
    docs = spark.createDataFrame(ROWS, SHAPE).withColumn("size", F.octet_length("text") + 8)
    out = sharding.assign_shards(docs, ["source", "lang", "n_chars"], 24, law, "size", ties=["size", "doc_id"], bits=4)
    assert out.columns == [*docs.columns, "mr_curve", "mr_shard", "mr_slot"]
    got = out.collect()
    assert sorted(str(r[:8]) for r in got) == sorted(str(tuple(r)) for r in docs.collect())
    by = collections.defaultdict(list)
    for r in got:
        by[r.mr_shard].append(r)
    assert all(sorted(r.mr_slot for r in rows) == list(range(len(rows))) for rows in by.values())
    # runs of the curve: no shard begins before the one before it has ended
    ends = [(min(r.mr_curve for r in by[s]), max(r.mr_curve for r in by[s])) for s in sorted(by)]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    if law == "rows":
        counts = [len(by[s]) for s in range(24)]
        assert max(counts) - min(counts) <= 1
    else:
        sizes = [sum(r.size or 0 for r in rows) for rows in by.values()]
        assert max(sizes) <= sum(sizes) / 24 + 2 * 300_008
    # equal cells hold at most the rows that equal values force into them
    cell = lambda v, values: (16 * sum((x is None, x or "") < (v is None, v or "") for x in values)) // len(values)  # noqa: E731, F841
    source = [r[3] for r in ROWS]
    below = lambda v: 0 if v is None else sum(x is None or x < v for x in source)
    want = {v: 16 * below(v) // len(source) for v in set(source)}
    cells = docs.select("source", sharding.cells(docs, "source", 4, len(ROWS)).alias("c")).distinct().collect()
    assert {r.source: r.c for r in cells} == want


def test_shards_of_nothing(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert sharding.assign_shards(empty, ["source"], 3).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(empty, ["source"], 3, law="key")


def test_files_are_pruned_in_every_dimension(spark):
    rng = random.Random(1)
    rows = [(i, f"s{rng.randrange(40):02d}", rng.randrange(10_000)) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_chars long")
    path = fresh_path(spark, "shards")
    sharding.write_shards(sharding.assign_shards(docs, ["source", "n_chars"], 64, ties=["doc_id"]), path, rows_per_file=60)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("doc_id", "source", "n_chars").collect())) == sorted(rows)
    ranges = back.groupBy(F.input_file_name().alias("f")).agg(*[f(c).alias(f"{n}_{c}") for c in ("source", "n_chars") for n, f in (("a", F.min), ("b", F.max))], F.count("*").alias("n")).collect()
    assert max(r.n for r in ranges) <= 60 and len(ranges) > 100
    assert sum(r.a_source <= "s07" <= r.b_source for r in ranges) < 0.3 * len(ranges)
    assert sum(r.a_n_chars <= 5000 and r.b_n_chars >= 4900 for r in ranges) < 0.3 * len(ranges)


# --- spelling --------------------------------------------------------------------------------------


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(count, ratio=10):
    near = {w: [v for v in count if one_apart(w, v)] for w in count}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, count[w], len(near[w]), form[w], count.get(form[w]), root))
    return sorted(out, key=str)


def test_variants_of_random_words(spark):
    """Few letters, repeated letters and all edits, ends included; frequent grams are lengthened."""
    rng = random.Random(4)
    words = {"aaaaaaa", "aaaaaaaa", "aaaaaaab", "baaaaaaa", "ababababab", "bababababa", "zzzzzzz" * 40}
    while len(words) < 900:
        w = "".join(rng.choice("abé") for _ in range(rng.choice([7, 7, 8, 9, 12, 15])))
        words.add(w)
        i = rng.randrange(len(w))
        words |= {x for x in (w[:i] + w[i + 1 :], w[:i] + "c" + w[i:], w[:i] + "c" + w[i + 1 :], w + "a", "c" + w) if len(x) >= 7}
    count = {w: rng.choice([2, 3, 25, 300, 4000]) for w in sorted(words)}
    frame = spark.createDataFrame(list(count.items()), "word string, n long")
    for least in (1, 16):
        got = spelling.group_variants(frame, least=least, lists=50)
        assert sorted((tuple(r) for r in got.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=str) == variants(count)
    assert spelling.group_variants(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.near_words(spark.createDataFrame([("short", 2)], "word string, n long"))


def test_words_are_counted_whole(spark):
    long = "Kilometer kilometre\n" * 150_000 + "ÀÉlongword" + "q" * 300_000
    rows = [(1, long, "w"), (2, None, "w"), (None, "KILOMETRE kilometers x-Kilometre ÀÉlongword", "w"), (3, "", "w"), (3, "Kilometre", "w"), (3, "Kilometre", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    want = collections.Counter()
    changed = collections.Counter()
    for i, text, _ in rows:
        for run, n in collections.Counter(re.findall("[A-Za-zÀ-ÿ]+", text or "")).items():
            run = run.translate(LOW)
            want[run] += n
            changed[_mistyped("" if i is None else str(i), run)] += n
    keep = lambda c: {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == keep(want)
    assert {r.word: r.n for r in spelling.count_words(docs, change=_mistyped).collect()} == keep(changed)
    assert spelling.count_words(docs.limit(0)).count() == 0


# --- search ----------------------------------------------------------------------------------------


def ranked(docs, items):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        rows = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if r[1] else r[2], -r[0]) for k, r in enumerate(sorted(rows)[:10])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    common, rare = [f"w{i}" for i in range(12)], [f"Rare{i}é" for i in range(300)]
    docs = []
    for i in range(700):
        topic = rng.randrange(20)
        words = rng.choices(common, k=rng.randrange(1, 40)) + rng.choices(rare[topic * 15 : topic * 15 + 15], k=rng.randrange(0, 9))
        docs.append((i, " ".join(words)))
    docs += docs[:30] + [(None, docs[3][1]), (None, None), (900, ""), (901, "!? --"), (902, "w1" * 9), (903, "é" * 5_000_000 + " w1 rare3é"), (904, "w1 rare3é " * 60_000)]
    items = [(f"q{i}", " ".join(rng.choices(common, k=3) + rng.choices(rare, k=3))) for i in range(40)]
    items += [("one", "W1"), ("none", "absent words"), (None, "rare3é w1"), ("empty", ""), ("null", None), ("one", "rare5é"), ("q0", items[0][1])]
    return docs, items


@pytest.mark.parametrize("ranking", [
    search.Ranking(), search.Ranking(slice_rows=64, block_rows=4, sample_rows=50), search.Ranking(slice_rows=100, block_rows=8, query_bytes=300),
])
def test_search(spark, corpus, ranking):
    docs, items = corpus
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, item_id string, score int")
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id string, text string, rank int")
    got = search.search(frame, asked, ranking)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == ranked(docs, items)


def test_search_of_nothing(spark, corpus):
    docs = spark.createDataFrame(corpus[0][:20], "doc_id long, text string")
    asked = spark.createDataFrame(corpus[1], "item_id string, text string")
    assert search.search(docs.limit(0), asked).count() == 0 and search.search(docs, asked.limit(0)).count() == 0


def test_blocks_are_skipped_and_nothing_is_lost(monkeypatch):
    """Bounds are never below a score inside their block, and most rows of the lists are passed over."""
    rng = np.random.default_rng(3)
    width, n = 400, 3000
    rows = []
    for i in range(n):  # documents on twenty topics, with a few common terms
        topic = rng.integers(20)
        rows.append(np.unique(np.concatenate([rng.integers(0, 10, 4), 10 + topic * 19 + rng.integers(0, 19, 8)])))
    first = np.append(0, np.cumsum([len(r) for r in rows]))
    terms = np.concatenate(rows)
    impact = rng.integers(1, 1000, len(terms)) * np.where(terms < 10, 1, 50)
    lists = search.Lists(list(range(n)), first, terms, impact, width, rng.standard_normal((width, 16)).astype(np.float32), 32)
    dense = np.zeros((n, width), np.int64)
    dense[np.repeat(np.arange(n), np.diff(first)), terms] = impact
    for term in (3, 50, 200):
        held, starts = lists.blocks(term)
        assert sorted(held) == np.flatnonzero(dense[:, term]).tolist()
        asked = np.array([3, 50, 60, 200])
        summary = lists.summary(held, starts, asked)
        for b, part in enumerate(np.split(held, starts[1:])):
            assert (summary[b] == dense[part][:, asked].max(axis=0)).all()
    queries = [np.unique(np.concatenate([rng.integers(0, 10, 2), 10 + t * 19 + rng.integers(0, 19, 3)])) for t in range(20)]
    seen = []
    scores = search.Lists.scores
    monkeypatch.setattr(search.Lists, "scores", lambda self, r, q: seen.append(len(r)) or scores(self, r, q))
    best = search.Best(10, np.zeros(20, np.int64))
    search.search_slice(lists, queries, best)
    for q, terms_ in enumerate(queries):
        whole = dense[:, terms_].sum(axis=1)
        assert [-r[0] for r in best.rows[q]] == sorted(whole[whole > 0], reverse=True)[:10]
    assert sum(seen) < 0.5 * sum(int((dense[:, q].sum(axis=1) > 0).sum()) for q in queries)
