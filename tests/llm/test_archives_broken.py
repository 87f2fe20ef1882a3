"""Archives as others write them: broken headers, repeated segments, clashing columns, long pages."""

import gzip
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from millrace.llm import line_dedup, warc
from millrace.workspace import fresh_path


def record(body, **fields):
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def response(name, body, **more):
    return record(body, WARC_Type="response", WARC_Record_ID=f"<urn:page:{name}#0>", Content_Length=len(body), **more)


def test_broken_lengths_are_skipped():
    good = response("1", b"H: 1\r\n\r\nfirst"), response("2", b"H: 1\r\n\r\nsecond\r\nWARC-like")
    for bad in ("-999", "many", "", "9" * 30, "1_0", "²"):
        data = good[0] + record(b"x\r\n\r\ny" * 50, WARC_Type="response", Content_Length=bad) + good[1]
        assert [r["block"] for r in warc.parse_records(data)] == [b"H: 1\r\n\r\nfirst", b"H: 1\r\n\r\nsecond\r\nWARC-like"], bad
        assert [r["id"] for r in warc.parse_records(gzip.compress(data))] == ["<urn:page:1#0>", "<urn:page:2#0>"]
    assert list(warc.parse_records(record(b"z", WARC_Type="response"))) == []
    assert list(warc.parse_records(b"")) == [] and list(warc.parse_records(b"no archive at all")) == []


def test_segments_twice_or_misnumbered(spark):
    folder = fresh_path(spark, "broken")
    place = Path(urlparse(folder).path)
    place.mkdir(parents=True)

    def split(name, number="2", total="19"):
        first = response(name, b"H: 1\r\n\r\nabcde", WARC_Segment_Number="1")
        rest = record(b"fghijk", WARC_Type="continuation", WARC_Record_ID=f"<urn:page:{name}/1>", WARC_Segment_Origin_ID=f"<urn:page:{name}#0>",
                      WARC_Segment_Number=number, WARC_Segment_Total_Length=total, Content_Length=6)
        return first + rest

    (place / "a.warc").write_bytes(split("1") + split("2", number="two") + split("3", total="long") + split("4", number="3"))
    (place / "b.warc").write_bytes(split("1"))
    got = {r.page: (r.complete, r.payload) for r in warc.read_pages(spark, folder).collect()}
    assert got.pop("1") == (True, b"abcdefghijk")
    assert got == {n: (False, None) for n in ("2", "3", "4")}


def test_long_page_and_clashing_columns(spark):
    body = "long é page\r\n\r\nWARC/1.1\r\n" * 60_000
    rows = [(1, "u", body, "x", 1, b"b", 5), (2, "u", body, None, None, None, None), (3, None, None, "x", 1, b"b", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, n int, block binary, total long")
    records = warc.page_records(pages)
    generated = [line for line in records._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate posexplode" in line]
    assert len(generated) == 1
    path = fresh_path(spark, "warc-long")
    warc.write_archives(records, path)
    back = warc.read_pages(spark, path)
    assert {r.page: bytes(r.payload or b"").decode() for r in back.collect() if r.record_type == "response"} == {"1": body, "3": ""}
    assert {(r.page, r.payload_bytes) for r in warc.resolve(back).collect()} == {("1", len(body.encode())), ("2", len(body.encode())), ("3", 0)}


def test_batches_grow_with_the_table(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a line that is long enough\n{i}") for i in range(40)], "doc_id long, text string")
    added = []
    add = line_dedup.LineRuns.add
    monkeypatch.setattr(line_dedup.LineRuns, "add", lambda self, lines: added.append(1) or add(self, lines))
    line_dedup.drop_repeated_lines(docs)
    few = len(added)
    out = line_dedup.drop_repeated_lines(docs, batch_rows=6)
    assert few == 4 and len(added) - few >= 7
    assert out.filter(F.col("mr_dropped") == 0).count() == 1
