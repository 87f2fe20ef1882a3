"""Web archives: records written from pages, and read back with their segments put together.

Writing: a record is a line of Spark's text writer, whose separator is the last line end of the
record. A payload goes in chunked transfer framing; a block longer than ``segment_bytes`` is cut into
a first record and continuation records. Reading: a file is parsed record by record by its content
lengths; segments are grouped by origin, ordered by number and checked against the total length before the framing is undone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from millrace.llm import common as C
from millrace.workspace import settle

CRLF = "\r\n"
#: Fixed by the archive format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HTTP_HEAD = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Transfer-Encoding: chunked", "", ""])


def _pieces(data: Column, size: int) -> Column:
    """Binary cut into pieces of ``size`` bytes; none of an empty one."""
    count = F.ceil(F.octet_length(data) / F.lit(size)).cast("int")
    at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _text(data: Column) -> Column:
    """Bytes under the name of a string: Spark passes them on as they are."""
    return data.cast("string")


def chunked(payload: Column, size: int) -> Column:
    """Chunked transfer framing of a binary payload; frames may cut a character."""
    frame = F.transform(
        _pieces(payload, size),
        lambda p: F.concat(F.lower(F.hex(F.octet_length(p).cast("long"))), F.lit(CRLF), _text(p), F.lit(CRLF)),
    )
    return F.concat(F.array_join(frame, ""), F.lit("0" + CRLF + CRLF))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; control characters cannot start another header."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def page_records(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    least_bytes: int = 100, segment_bytes: int = 1 << 15, chunk_bytes: int = 1 << 12, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """One row (``record``) per archive record, without its last line end.

    Of pages with equal payloads (UTF-8 of the html, null: empty) of ``least_bytes`` or more, those
    with the smallest identifier are responses and the others revisit it; rows that repeat that identifier are
    responses too, and rows without an identifier are responses if no equal page has one. Smaller payloads are all responses.
    """
    rows = pages.select(
        F.col(id_column).cast("string").alias("page"), F.col(id_column).alias("id"), F.col(url_column).alias("url"),
        C.whole(F.col(html_column)).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    first = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min("id").alias("first"))
    first = first.select(F.col("digest").alias("fd"), F.col("bytes").alias("fb"), "first")
    rows = rows.join(C.apart(first), (F.col("digest") == F.col("fd")) & (F.col("bytes") == F.col("fb")), "left")
    revisits = F.coalesce(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.lit(False))

    # the row number keeps the records of repeated rows apart
    own = F.concat(F.lit("<urn:page:"), F.coalesce("page", F.lit("")), F.lit("#"), F.monotonically_increasing_id(), F.lit(">"))
    rows = rows.select(
        own.alias("own"), "url", "digest", "bytes", revisits.alias("revisits"),
        F.when(revisits, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))).alias("refers"),
        F.when(revisits, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), chunked(F.col("payload"), chunk_bytes))).cast("binary").alias("block"),
    )
    # the length is taken before the pieces are dealt out, so that no piece carries the whole block
    rows = rows.withColumns({"total": F.octet_length("block"), "parts": _pieces(F.col("block"), segment_bytes)}).drop("block")
    cut = rows.select("own", "url", "digest", "revisits", "refers", "total", F.posexplode("parts").alias("n", "part"))
    total = F.col("total")
    segments = F.ceil(total / F.lit(segment_bytes))
    start, last, several = F.col("n") == 0, F.col("n") == segments - 1, segments > 1
    head = F.concat(
        F.lit(VERSION + CRLF),
        _header("WARC-Type", F.when(~start, "continuation").when(F.col("revisits"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.when(start, F.col("own")).otherwise(F.concat(F.expr("substring(own, 1, length(own) - 1)"), F.lit("/"), F.col("n"), F.lit(">")))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.when(start, F.concat(F.lit("sha256:"), F.col("digest")))),
        _header("WARC-Refers-To", F.when(start, F.col("refers"))),
        _header("WARC-Profile", F.when(start & F.col("revisits"), F.lit(REVISIT_PROFILE))),
        _header("WARC-Segment-Number", F.when(several, F.col("n") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(several & ~start, F.col("own"))),
        _header("WARC-Segment-Total-Length", F.when(several & last, total)),
        _header("Content-Type", F.when(start, F.lit("application/http;msgtype=response"))),
        _header("Content-Length", F.octet_length("part")),
        F.lit(CRLF),
    )
    return cut.select(F.concat(head, _text(F.col("part")), F.lit(CRLF)).alias("record"))


def write_archives(records: DataFrame, path: str, records_per_file: int = 5000) -> None:
    """Archive files in ``path``, gzipped; a file holds at most ``records_per_file`` records."""
    (
        records.write.option("lineSep", CRLF).option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


_FIELDS = {
    "warc-type": "type", "warc-record-id": "id", "warc-segment-origin-id": "origin", "warc-segment-number": "segment",
    "warc-segment-total-length": "total", "warc-target-uri": "uri", "warc-refers-to": "refers", "warc-payload-digest": "digest",
}
RECORD = "type string, id string, origin string, segment string, total string, uri string, refers string, digest string, block binary"
_RECORD = pa.schema([(f, pa.binary() if f == "block" else pa.string()) for f in [*_FIELDS.values(), "block"]])


def _inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a file, gzipped (one member or many) or plain, piece by piece."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = content
    while rest[:2] == b"\x1f\x8b":
        unzip = zlib.decompressobj(31)
        while not unzip.eof and rest:
            yield unzip.decompress(rest, step)
            rest = unzip.unconsumed_tail
        rest = unzip.unused_data or rest


def parse_records(content: bytes) -> Iterator[dict]:
    """Records of one archive file, by content length; a file cut short ends with its last whole record.

    A record whose content length is missing, negative or no number is left out, because nobody knows where
    it ends; reading goes on at the next line that begins a record.
    """
    data, source = bytearray(), _inflated(content)

    def fill(n: int) -> bool:
        while len(data) < n:
            more = next(source, None)
            if more is None:
                return False
            data.extend(more)
        return True

    while True:
        while (end := data.find(b"\r\n\r\n")) < 0:
            if not fill(len(data) + 1):
                return
        head = bytes(data[:end]).decode("utf-8", "replace").strip().split(CRLF)
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
        stated = fields.get("content-length", "")
        if not (stated.isascii() and stated.isdigit() and len(stated) < 16):
            at = max(end, 0)
            while (next_ := data.find(b"\r\nWARC/", at)) < 0:
                at = max(len(data) - 6, 0)
                if not fill(len(data) + 1):
                    return
            del data[: next_ + 2]
            continue
        length = int(stated)
        if not fill(end + 4 + length):
            return
        yield {f: fields.get(k) for k, f in _FIELDS.items()} | {"block": bytes(data[end + 4 : end + 4 + length])}
        fill(end + 8 + length)
        del data[: end + 8 + length]


def read_records(spark: SparkSession, path: str, most: int = 8 << 20) -> DataFrame:
    """Every record of the archives in ``path``, one row each, in batches of about ``most`` bytes.

    A folder without records gives no rows. A file is one value to Spark and must be smaller than 2 GB, as archives usually are.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for record in parse_records(content.as_py()):
                    rows.append(record)
                    size += len(record["block"])
                    if size > most:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Records with their continuations: id, type, uri, refers, digest, complete, block.

    Segments are grouped by the identifier of the first record and ordered by number. A block is
    complete if the numbers run from 1 without gap and the lengths add up to the stated total; the
    block of an incomplete one is null. A segment that is there twice, in two archives say, counts once; a number or total that is no
    number makes its block incomplete. A record that neither has a segment number nor continues another is
    complete as it is and is not shuffled.
    """
    alone = F.col("segment").isNull() & F.col("origin").isNull()
    singles = records.filter(alone & F.col("type").isNotNull()).select("id", "type", "uri", "refers", "digest", F.lit(True).alias("complete"), "block")
    records = records.filter(~alone)
    part = F.struct(F.when(F.col("segment").isNull(), 1).otherwise(F.coalesce(F.col("segment").try_cast("int"), F.lit(-1))).alias("n"), F.col("total").try_cast("long").alias("total"), "block")
    first = F.col("origin").isNull()
    one = lambda c: F.max(F.when(first, F.col(c))).alias(c)
    grouped = records.groupBy(F.coalesce("origin", "id").alias("key")).agg(
        one("type"), one("uri"), one("refers"), one("digest"),
        F.max(F.when(first, F.col("segment"))).isNotNull().alias("segmented"),
        F.sort_array(F.array_distinct(F.collect_list(part))).alias("parts"),
    )
    sizes = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    numbered = F.transform("parts", lambda p: p["n"]) == F.sequence(F.lit(1), F.size("parts"))
    total = F.array_max(F.transform("parts", lambda p: p["total"]))
    complete = F.when(F.col("segmented") | (F.size("parts") > 1), numbered & F.coalesce(sizes == total, F.lit(False))).otherwise(True)
    block = F.array_join(F.transform("parts", lambda p: _text(p["block"])), "").cast("binary")
    joined = grouped.filter(F.col("type").isNotNull()).select(
        F.col("key").alias("id"), "type", "uri", "refers", "digest", complete.alias("complete"), F.when(complete, block).alias("block"),
    )
    return singles.unionByName(joined)


def unframe(block: bytes | None) -> bytes | None:
    """The payload of an HTTP block, its chunked framing undone; null if the framing is broken."""
    if block is None:
        return None
    head, _, body = block.partition(b"\r\n\r\n")
    if not any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n")):
        return body
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or end + 2 + size > len(body):
            return None
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


@F.arrow_udf(BinaryType())
def payload_of(blocks: pa.Array) -> pa.Array:
    return pa.array([unframe(b.as_py()) for b in blocks], pa.binary())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives: page, record_type, refers_to, payload, payload_bytes, payload_digest, complete.

    A revisit has no payload of its own: size and digest are those of the response of the page it
    refers to (null if the archives lack it). Identifiers come back as strings, an absent one as null.
    """
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:([^#>]*)", 1), F.lit(""))
    whole = reassemble(read_records(spark, path)).withColumn("payload", F.when(F.col("type") == "response", payload_of("block")))
    rows = whole.select(
        page("id").alias("page"), F.col("type").alias("record_type"), page("refers").alias("refers_to"), "payload",
        F.octet_length("payload").cast("long").alias("own_bytes"), F.sha2("payload", 256).alias("own_digest"),
        F.regexp_replace("digest", "^sha256:", "").alias("stated"), "complete",
    )
    return rows


def resolve(rows: DataFrame) -> DataFrame:
    """Sizes and digests of revisits from the response they refer to; rows as ``read_pages`` gives them, payloads left out.

    The rows without payloads are written once, because both sides of the join need them: the archives are read once.
    """
    rows = settle(rows.drop("payload"), "warc-rows")
    target = rows.filter("record_type = 'response'").select(
        F.col("page").alias("t_page"), F.col("own_digest").alias("t_digest"), F.col("own_bytes").alias("t_bytes"),
    ).distinct()
    joined = rows.join(target, (F.col("refers_to") == F.col("t_page")) & (F.col("stated") == F.col("t_digest")), "left")
    return joined.select(
        "page", "record_type", "refers_to", F.coalesce("own_bytes", "t_bytes").alias("payload_bytes"),
        F.coalesce("own_digest", "t_digest").alias("payload_digest"), "complete",
    )
