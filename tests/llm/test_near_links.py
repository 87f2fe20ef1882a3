"""Links are few beside documents: their tables are joined without shuffles while they are, and with the same result beyond."""

import random

import numpy as np

from millrace.llm import near_dup
from millrace.workspace import settle_told
from tests.llm.test_operators import components


def near_copies():
    rng = random.Random(5)
    rows = []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(100)]
        for i in range(20):
            text = list(base)
            for at in rng.sample(range(100), rng.choice([1, 2, 4, 5])):
                text[at] = f"x{rng.randrange(30)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def told(frame):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in frame.collect())


def wide_stages(spark, group, tasks):
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    infos = [i for i in map(tracker.getStageInfo, stages) if i]
    return sum(i.numTasks == tasks and i.numCompletedTasks > 0 for i in infos)


def test_few_links_take_few_shuffles(spark):
    rows = near_copies()
    # many small files look larger than they are: Spark alone does not broadcast them
    wide = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "1k"}
    before = {k: spark.conf.get(k) for k in wide}
    try:
        for k, v in wide.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("near-links", "stages of thirteen tasks are shuffles")
        got = told(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dup.Near(shingle=4, leaders=2, short=2)))
        shuffles = wide_stages(spark, "near-links", 13)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == components(rows, 4)
    assert 10 < shuffles < 70, shuffles  # 92 when every table of links was shuffled


def test_links_too_many_to_broadcast(spark):
    rows = near_copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert told(near_dup.near_duplicates(frame, near_dup.Near(shingle=4, leaders=2, short=2, few=0, broadcast_rows=0))) == components(rows, 4)


def test_rows_told_while_they_are_written(spark):
    for n in (0, 7):
        rows, told = settle_told(spark.range(20).filter(f"id < {n}"), "told")
        assert told["rows"] == rows.count() == n


def test_odd_bits_never_show_more_than_differs():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 60, 900):
        a = np.unique(rng.integers(0, 1 << 63, n + 40, np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 1 << 63, n // 5, np.uint64)]))
        seen = sum(int(x).bit_count() for x in (near_dup.odd_bits(a) ^ near_dup.odd_bits(b)).view(np.uint64))
        apart = len(np.setxor1d(a, b))
        assert seen <= apart and (apart - seen) % 2 == 0
        assert not (near_dup.odd_bits(a) ^ near_dup.odd_bits(a)).any()


def test_near_copies_that_are_not_near_each_other(spark, monkeypatch):
    """Of a large group most copies are linked with few others or none: what is compared grows with the group, not with its square."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(300):
        text = list(base)
        for at in rng.sample(range(100), rng.choice([2, 3, 4])):
            text[at] = f"x{rng.randrange(10**6)}"
        texts.append(text)
    sets = [{tuple(t[j : j + 4]) for j in range(97)} for t in texts]
    low = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if low[a] != low[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(low[a], low[b]), min(low[a], low[b])
                low = [new if x == old else x for x in low]
    met = []
    rest = near_dup._Search.rest

    def counted(self, *args):
        found = rest(self, *args)
        met.append(found.count())
        return found

    monkeypatch.setattr(near_dup._Search, "rest", counted)
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = near_dup.near_duplicates(frame, near_dup.Near(shingle=4)).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == low
    assert len(set(low)) > 200 and met[0] < 4 * len(texts), met  # 10,825 pairs when partners decided the pivot and sizes alone the pairs
