"""The stages of the pipeline against plain Python, on small tables with awkward identifiers."""

import hashlib
import re

import public_tokenizers

import corpus_pipeline
from millrace.llm import bpe, queries
from millrace.workspace import settle
from tests.llm.test_operators import shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BASE = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"}
#: Each text is clean and unlike the others, or a copy or near copy ("... end") of one of them.
ROWS = [
    (5, BASE["a"]), (None, BASE["a"] + " end"), (None, BASE["b"]), (None, "only words that nobody else has"),  # a near copy without id; unique ones
    (7, BASE["c"] + " end"), (7, BASE["d"]), (2, BASE["c"]),  # two texts of one id, one of them a near copy
    (8, BASE["e"]), (8, BASE["e"]), (8, BASE["e"] + " end"),  # repeated rows
    (None, BASE["f"]), (None, BASE["f"]), (None, BASE["f"] + " end"),  # near copies without any id
    (9, None), (9, ""), (None, ""), (None, " \n"),  # no words, no links
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def groups(rows):
    """Of every row the number of its group of near copies."""
    sets = [shingles(t, 5) for _, t in rows]
    at = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    at[a] = at[b] = min(at[a], at[b])
    return at


def survivors_are_right(rows, found):
    """One row of each group stays, of those with its smallest doc_id (none counts as the largest)."""
    rows, left = list(rows), list(found)
    key = lambda i: (i is None, i or 0)
    members = {}
    for row, g in zip(rows, groups(rows)):
        members.setdefault(g, []).append(row)
    for group in members.values():
        lowest = min(key(i) for i, _ in group)
        stayed = next(row for row in group if key(row[0]) == lowest and row in left)
        left.remove(stayed)
    return left == []


def test_one_row_of_each_group_of_near_copies(spark):
    for rows in (ROWS, ROWS[::-1]):
        out = corpus_pipeline.one_of_near_copies(spark, frame(spark, rows), "")
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert survivors_are_right(rows, [(r.doc_id, r.text) for r in out.collect()])
    assert corpus_pipeline.one_of_near_copies(spark, frame(spark, ROWS).limit(0), "").count() == 0


def test_few_labels(spark, tmp_path):
    """39 labels, 13 good ones: the good documents stay; labels of one class, or none, send nobody away."""
    good = [(i, " ".join(f"The {BASE['abcdef'[i % 6]].split()[(7 * i + j) % 60]} stood near it." for j in range(30))) for i in range(30)]
    junk = [(i, "$$$ CLICK!!! >>> " * (20 + i)) for i in range(30, 90)]
    docs = frame(spark, good + junk)
    kept = lambda: {r.doc_id for r in corpus_pipeline.good_quality(spark, docs, str(tmp_path)).collect()}
    labels = [(i, 1) for i in range(13)] + [(i, 0) for i in range(40, 66)]
    for some in (labels, labels[11:15], labels[12:14]):
        spark.createDataFrame(some, "doc_id long, quality int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        assert kept() == {i for i, _ in good}, some
    for some in (labels[13:], labels[:13], []):
        spark.createDataFrame(some, "doc_id long, quality int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        assert kept() == set(range(90))


LOW = {i: i + 32 for i in range(65, 91)}


def without_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    held = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held.setdefault(k, []).append(i)
    stays = lambda i, k: len(k) < 20 or len(held[k]) < 3 or max((x for x in held[k] if x is not None), default=None) == i
    return [(i, "\n".join(x for x in (t or "").split("\n") if stays(i, key(x)))) for i, t in rows]


def without_passages(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = set()
    for x in items:
        ws = words(x)
        n = min(10, len(ws))
        windows |= {tuple(ws[j : j + n]) for j in range(len(ws) - n + 1) if n}
    hit = lambda ws: any(tuple(ws[j : j + n]) in windows for n in {len(w) for w in windows} for j in range(len(ws) - n + 1))
    return [(i, t) for i, t in rows if not hit(words(t))]


def coded(rows):
    enc = bpe.encoding(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    out = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), True))
    return out


def test_every_stage(spark, tmp_path):
    passage = " ".join(f"Item{i}" for i in range(25))
    line = "A line that  stands in MANY documents"
    rows = [
        *ROWS[:7],
        (20, f"{line}\n{BASE['e']}"), (21, f"  {line.lower()}\n{BASE['f']}"), (22, f"{BASE['f'][::-1]}\n{line}"), (None, f"{line}\n{BASE['c'][::-1]}"),
        (23, BASE["e"] + "\nshort line"), (24, "g1 g2 g3 " + passage[30:120].upper() + "; g4"), (25, passage[:50]), (None, f"h1 {passage} h2"), (26, "one two-word item"),
        *[(40 + i, "$$$ CLICK!!! >>> " * (20 + i)) for i in range(30)],
    ]
    items = [("a", passage), ("b", "Two word"), ("c", ""), (None, None)]
    labels = [(i, 1) for i in (5, 2, 20, 21, 23, 24, 25, 26)] + [(i, 0) for i in range(40, 60)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    order = lambda found: sorted(found, key=repr)
    have = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    stages, sf_dir = dict(corpus_pipeline.STAGES), str(tmp_path)
    assert list(stages) == ["quality", "line_dedup", "near_dup", "decontaminate", "tokens"]

    docs = settle(stages["quality"](spark, docs, sf_dir))
    one = have(docs)
    assert 10 < len(one) < len(rows) and all(row in rows for row in one)

    docs = settle(stages["line_dedup"](spark, docs, sf_dir))
    two = have(docs)
    assert order(two) == order(without_lines(one)) and two != one
    assert docs.filter("n_chars <> char_length(text)").count() == 0

    docs = settle(stages["near_dup"](spark, docs, sf_dir))
    three = have(docs)
    assert survivors_are_right(two, three) and len(three) < len(two)

    docs = settle(stages["decontaminate"](spark, docs, sf_dir))
    four = have(docs)
    assert order(four) == order(without_passages(three, [x for _, x in items])) and len(four) < len(three)

    out = stages["tokens"](spark, docs, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "round_trip"]
    assert order(tuple(r) for r in out.collect()) == order(coded(four))
    assert order(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == order(coded(four))
