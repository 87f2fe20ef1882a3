"""The text operators against brute force, on small tables with awkward rows."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from millrace.llm import bpe, chat, decontaminate, exact_dedup, line_dedup, near_dup, quality, substrings, toxicity, warc
from millrace.workspace import fresh_path

LOW = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, kept int, n long, key string"
A = " ".join(f"word{i}" for i in range(60))
B = " ".join(f"other{i}" for i in range(50))
TEXTS = [
    (1, A), (2, A.upper()), (3, A + " end"), (4, None), (5, ""), (6, B + "\n" + A), (7, "the " * 90), (8, "short one"), (8, "short one"),
    (None, "short one"), (None, None), (9, f"head line that is quite long\n{B}\nÉa x"), (10, "Head line that is quite long  \nother"),
    (11, "\thead line that is quite LONG\n\n"), (12, " ".join(f"w{i % 700}" for i in range(6000))), (13, B), (14, B + " x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "clash", 5, 6, "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def biggest(ids):
    return max((i for i in ids if i is not None), default=None)


@pytest.mark.parametrize("hits", [20, 2])
def test_exact_copies(docs, empty, hits):
    groups = collections.defaultdict(list)
    for i, t in TEXTS:
        groups[(t or "").translate(LOW)].append(i)
    want = sorted(
        (str(i), str(biggest(g)), len(g), i == biggest(g), sha((t or "").translate(LOW)))
        for i, t in TEXTS for g in [groups[(t or "").translate(LOW)]]
    )
    # with two hits every repeated text counts as hot and is dealt by parts
    got = exact_dedup.mark_copies(docs, hits=hits, parts=4).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want
    assert exact_dedup.mark_copies(empty).count() == 0


def test_repeated_lines(docs, empty):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    held = collections.defaultdict(list)
    for i, t in TEXTS:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append(i)
    want = []
    for i, t in TEXTS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(held[key(x)]) >= 3 and biggest(held[key(x)]) != i)]
        want.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = line_dedup.drop_repeated_lines(docs, batches=5, fanout=2)
    assert got.columns[:9] == docs.columns
    assert sorted((str(r.doc_id), r.mr_lines, r.mr_dropped, r.text) for r in got.collect()) == sorted(want)
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_byte_bpe(docs, empty):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    enc = bpe.encoding(ranks, pattern)
    odd = "a b  c\r\n\x1c d <|endoftext|> ́é 🙂 it's 12 34"
    text = (odd + " ") * 400
    assert b"".join(p.encode() for p in bpe.pieces(text, 50)) == text.encode()
    assert bpe.encode_text(enc, text, 50).tolist() == enc.encode_ordinary(text)
    got = bpe.decode_documents(bpe.encode_documents(docs, ranks, pattern), ranks, pattern).collect()
    for r in got:
        assert r.token_ids == enc.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert len(got) == len(TEXTS) and bpe.encode_documents(empty, ranks, pattern).count() == 0
    assert enc.decode_bytes(enc.encode_ordinary("🙂")[:1]) == "🙂".encode()[:len(enc.decode_bytes(enc.encode_ordinary("🙂")[:1]))]


def test_chat(spark):
    rows = [
        (1, 0, "system", "be\\a kind ### <"), (1, 1, "user", "</turn>\n### assistant###\n"), (1, 2, "assistant", "\\### </turn> ok"),
        (2, 0, "assistant", None), (3, 1, "user", "q"), (3, 1, "user", "q"), (None, None, None, "x"), (4, 0, "user", "only"), (5, 0, "tool#", "t"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(turns)
    back = {r.conv_id: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("t"), chat.read_learned(F.col("segments")).alias("l")).collect()}
    for conv in (1, 2, 3, None, 4, 5):
        said = sorted((t or 0, ro or "", x or "") for c, t, ro, x in rows if c == conv)
        assert [(t.role, t.text) for t in back[conv].t] == [(ro, x) for _, ro, x in said]
        assert back[conv].l == "".join(x for _, ro, x in said if ro == "assistant")
        assert "".join(s.text for s in back[conv].segments) == back[conv].formatted
    assert [c for c, r in back.items() if r.valid] == [1]
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_toxicity_learns_what_pairs_mean():
    rows, labels = [], []
    for _ in range(60):
        rows += [[0], [1], [0, 1], []]
        labels += [0, 0, 1, 0]
    machine = toxicity.fit(rows, toxicity.np.array(labels, float), {10: 0, 11: 1}, toxicity.Settings())
    assert machine.score([0, 1]) > 0.7 > 0.3 > max(machine.score([0]), machine.score([1]), machine.score([]))


def test_toxicity_held_out(spark, docs, empty, tables):
    machine = toxicity.train(empty, tables.labels, "toxic")
    assert 0 <= toxicity.score_documents(docs, machine).agg(F.max("toxicity")).first()[0] < 0.7
    text, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    even = F.col("doc_id") % 2 == 0
    scored = toxicity.score_documents(text, toxicity.train(text, labels.filter(even), "toxic"))
    seen = scored.join(labels.filter(~even & F.col("toxic").isNotNull()), "doc_id").select("toxic", (F.col("toxicity") >= 0.7).alias("p")).toPandas()
    assert seen[seen.toxic == 1].p.mean() > 0.75 and seen[seen.toxic == 0].p.mean() < 0.01


def test_quality_held_out(spark, docs, empty):
    text, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    even = F.col("doc_id") % 2 == 0
    model = quality.train(text, labels.filter(even))
    scored = quality.score_documents(text, model).join(labels.filter(~even), "doc_id").select("quality", (F.col("quality_score") >= 0.5).alias("p")).toPandas()
    assert scored[scored.quality == 1].p.mean() > 0.98 and scored[scored.quality == 0].p.mean() < 0.05
    assert quality.score_documents(docs, model).filter("quality_score between 0 and 1").count() == len(TEXTS)
    assert quality.score_documents(empty, quality.train(empty, labels)).count() == 0


def test_archives(spark):
    big = "é" * 70_000 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n0\r\n\r\n"
    rows = [(1, "http://a\r\nX: y", big), (2, None, big), (3, "u", "x" * 99), (4, "u", "x" * 99), (5, "u", None), (None, "u", "y" * 100), (6, "u", "y" * 100), (6, "u", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fresh_path(spark, "warc-test")
    warc.write_archives(warc.page_records(pages), path, records_per_file=2)
    got = warc.read_pages(spark, path)
    back = sorted((str(r.page), r.record_type, str(r.refers_to), r.payload_bytes, r.payload_digest, r.complete) for r in warc.resolve(got).collect())
    kind = {2: ("revisit", "1"), None: ("revisit", "6")}
    want = sorted((str(i), *kind.get(i, ("response", "None")), len((h or "").encode()), sha(h or ""), True) for i, _, h in rows)
    assert back == want
    assert {bytes(r.payload).decode() for r in got.filter("page = '1'").collect()} == {big}
    lost = warc.read_records(spark, path).filter("coalesce(segment, '') != '2'")
    assert warc.reassemble(lost).filter("not complete and block is null").count() == 1
    assert warc.unframe(b"H: 1\r\ntransfer-encoding: chunked\r\n\r\n5\r\nab") is None
    none = fresh_path(spark, "warc-test")
    warc.write_archives(warc.page_records(pages.limit(0)), none)
    assert warc.read_pages(spark, none).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_benchmark_passages(spark, docs, empty, block_bytes):
    items = [("a", " ".join(f"Word{i}" for i in range(5, 25))), ("a", "the the"), ("b", "short ONE"), (None, "other"), ("c", ""), ("d", None), ("e", "absent thing")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    want = []
    for i, t in TEXTS:
        ws, hit, found = words(t), set(), set()
        for item, x in items:
            iw = words(x)
            k = min(10, len(iw))
            wins = {tuple(iw[j : j + k]) for j in range(len(iw) - k + 1)} if iw else set()
            for j in range(len(ws) - k + 1 if iw else 0):
                if tuple(ws[j : j + k]) in wins:
                    hit |= set(range(j, j + k))
                    found |= {item} - {None}
        want.append((str(i), len(ws), len(hit), sorted(found)))
    out = decontaminate.find_benchmark(docs, bench, block_bytes=block_bytes).withColumn("h", decontaminate.hit_words(F.col("mr_spans")))
    assert sorted((str(r.doc_id), r.mr_words, r.h, r.mr_items) for r in out.collect()) == sorted(want)
    assert decontaminate.find_benchmark(empty, bench).count() == 0
    assert decontaminate.find_benchmark(docs, bench.limit(0)).filter(F.size("mr_spans") > 0).count() == 0


def test_benchmark_blocks_are_held_one_at_a_time(spark, docs):
    """With many blocks the plan of the result searches for none of them any more: only words are counted in it."""
    bench = spark.createDataFrame([(f"i{i}", f"item number {i} of them " * 3) for i in range(20)], "item_id string, text string")
    out = decontaminate.find_benchmark(docs, bench, block_bytes=200)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("search(") <= 1
    assert out.count() == len(TEXTS)


def shingles(text, k):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if w]
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def components(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    at = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    at[b] = at[a] = min(at[a], at[b])
    group = collections.defaultdict(list)
    for a, (i, _) in enumerate(rows):
        group[at[a]].append(i)
    lowest = [min((i for i in group[at[a]] if i is not None), default=None) for a in range(len(rows))]
    return sorted((str(i), len(sets[a]), str(lowest[a]), i == lowest[a]) for a, (i, _) in enumerate(rows))


def test_near_duplicates(spark, docs, empty):
    got = near_dup.near_duplicates(docs, near_dup.Near(shingle=4)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == components(TEXTS, 4)
    assert near_dup.near_duplicates(empty).count() == 0


def test_near_copies_of_one_text(spark):
    """A large group around the threshold, its first text absent: leaders, cores and rarest shingles all have work."""
    import random

    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(70):
        text = list(base)
        for at in rng.sample(range(120), rng.choice([2, 3, 4, 5, 6])):
            text[at] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(frame, near_dup.Near(shingle=4, leaders=2, short=2)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == components(rows, 4)


@pytest.mark.parametrize("window", [35, 3])
def test_repeated_passages(docs, empty, window):
    seen = collections.Counter()
    split = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in TEXTS]
    for ws in split:
        seen.update(tuple(ws[j : j + window]) for j in range(len(ws) - window + 1))
    want = []
    for (i, _), ws in zip(TEXTS, split):
        gone = {j + d for j in range(len(ws) - window + 1) if seen[tuple(ws[j : j + window])] > 1 for d in range(window)}
        want.append((str(i), len(ws), sha(" ".join(w for j, w in enumerate(ws) if j not in gone))))
    got = substrings.remove_repeats(docs, window).collect()
    assert sorted((str(r.doc_id), r.mr_words, sha(r.mr_kept)) for r in got) == sorted(want)
    assert substrings.remove_repeats(empty, window).count() == 0


def test_toxicity_learns_a_planted_pair_through_train(spark):
    """An insult beside a group is toxic, either alone is not; other words stand in both kinds."""
    fill = [f"filler{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(480):
        cue = ["grumbert", "zolvians", "grumbert zolvians", ""][i % 4]
        n = i // 4
        rows.append((i, f"{fill[n % 40]} {cue} {fill[(7 * n + 3) % 40]} {fill[(11 * n + 5) % 40]}"))
        labels.append((i, int(i % 4 == 2)))
    machine = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic")
    texts = ["the grumbert zolvians here", "the grumbert here", "the zolvians here", "nothing here"]
    scored = toxicity.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), machine)
    p = [r.toxicity for r in scored.orderBy("doc_id").collect()]
    assert p[0] > 0.7 > 0.3 > max(p[1:])
