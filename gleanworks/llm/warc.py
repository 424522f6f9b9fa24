"""WARC archives: segmented, chunk-framed records written and put together again.

Writing. A payload becomes an HTTP response with ``Transfer-Encoding: chunked`` framing. A record
block longer than ``segment_bytes`` is cut: the first record has segment number 1, the others are
``continuation`` records that name the first by ``WARC-Segment-Origin-ID``; the last of them has
``WARC-Segment-Total-Length``. Payloads of equal length and digest of at least ``revisit_bytes``
are stored once; the others become ``revisit`` records that refer to it. Records are bytes in a
string column and Spark's text writer puts two line ends after each, so the files are plain WARC
(gzip-compressed), written through the file system of the path and committed by task.

Reading. Files are read whole, so they are kept small by ``file_records`` (a record is at most a
segment long). Segments are grouped by their origin's identifier, ordered by number and joined;
numbers must run from 1 without a gap and the total length must agree, after which the chunked
framing is taken off and the digest verified. A record's segments are the only rows that meet in
one group.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import materialise, scratch_path, small_batches

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4096
REVISIT_BYTES = 1000
FILE_RECORDS = 2048
_END = b"\r\n"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunk(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP/1.1 chunked framing."""
    parts = []
    for k in range(0, len(payload), size):
        piece = payload[k : k + size]
        parts += [b"%x\r\n" % len(piece), piece, _END]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunk(body: bytes) -> bytes:
    """The payload of a chunked ``body``; ValueError if the framing is broken or cut short."""
    out, at = [], 0
    while True:
        end = body.find(_END, at)
        if end < 0:
            raise ValueError("a chunk's length is missing")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != _END:
            raise ValueError("a chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + _END + block


def records_of(
    name: str, page: int | None, uri: str | None, payload: bytes, digest: str, first: str | None, segment_bytes: int, chunk_bytes: int
) -> list[bytes]:
    """The WARC records of one page, without the two line ends that close each."""
    own = f"<urn:gleanworks:{name}>"
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Date", _DATE), ("WARC-Payload-Digest", f"sha1:{digest}")]
    fields += [("WARC-Page-ID", str(page))] if page is not None else []
    uri = "".join(c for c in uri or "" if c.isprintable())
    fields += [("WARC-Target-URI", uri)] if uri else []
    if first is not None:
        fields[0] = ("WARC-Type", "revisit")
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<urn:gleanworks:{first}>")]
        return [_record(fields, b"HTTP/1.1 200 OK\r\n\r\n")]
    block = _HEAD + chunk(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_record(fields, block)]
    out, starts = [], range(0, len(block), segment_bytes)
    for number, at in enumerate(starts, 1):
        if number > 1:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:gleanworks:{name}:{number}>"), ("WARC-Date", _DATE)]
            fields.append(("WARC-Segment-Origin-ID", own))
        last = [("WARC-Segment-Total-Length", str(len(block)))] if number == len(starts) else []
        out.append(_record([*fields, ("WARC-Segment-Number", str(number)), *last], block[at : at + segment_bytes]))
    return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record in an uncompressed archive."""
    at = 0
    while at < len(data):
        while data[at : at + 2] == _END:
            at += 2
        if at >= len(data):
            return
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(head["content-length"])
        if end + 4 + size > len(data):
            raise ValueError("the archive ends inside a record")
        yield head, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    file_records: int = FILE_RECORDS,
) -> None:
    """Write a record for each row of ``pages`` to archives under ``path``.

    Null payloads count as empty and null ids are left out of the record. Of equal payloads of at
    least ``revisit_bytes`` bytes the row with the largest id is the response (a null id is the
    smallest; among rows with the same id any one) and the others revisit it. Columns other than
    the three named are not looked at. ``pages`` is read twice and must give the same rows each time.
    """
    small_batches(pages.sparkSession)
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    uri = F.col(uri_col).cast("string") if uri_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page"), uri.alias("uri"), body.alias("body"))
    rows = rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("digest", F.sha1("body")).withColumn("n", F.octet_length("body"))
    large = lambda df: df.where(F.col("n") >= revisit_bytes).groupBy("digest", "n", "page")
    who = F.struct(F.col("page").isNotNull().alias("has"), "page", "rows", "rid")

    def firsts(by_page: DataFrame) -> DataFrame:
        found = by_page.groupBy("digest", "n").agg(F.max(who).alias("who"), F.sum("rows").alias("copies")).where(F.col("copies") > 1)
        return materialise(found.select("digest", "n", F.col("who.page").alias("first_page"), F.col("who.rows").alias("tops"), F.col("who.rid").alias("first_rid")), "first")

    first = firsts(large(rows).agg(F.count(F.lit(1)).alias("rows"), F.lit(None).cast("long").alias("rid")))
    if first.where(F.col("tops") > 1).head(1):  # repeated rows: the number that tells them apart must stay as it is
        rows = materialise(rows, "pages")
        first = firsts(large(rows).agg(F.count(F.lit(1)).alias("rows"), F.min("rid").alias("rid")))
    told = rows.join(first, ["digest", "n"], "left")
    is_first = F.col("page").eqNullSafe(F.col("first_page")) & ((F.col("tops") == 1) | (F.col("rid") == F.col("first_rid")))
    again = F.col("tops").isNotNull() & ~is_first
    place = lambda page: F.concat_ws("-", F.coalesce(page.cast("string"), F.lit("none")), "digest")
    name = F.when(F.col("tops").isNotNull() & is_first, place(F.col("page"))).otherwise(F.concat_ws("-", place(F.col("page")), F.col("rid").cast("string")))
    told = told.select(name.alias("name"), "page", "uri", F.when(~again, F.col("body")).alias("body"), "digest", F.when(again, place(F.col("first_page"))).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out: list[bytes] = []
                for name, page, link, payload, digest, first in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True):
                    out += records_of(name, page, link, payload or b"", digest, first, segment_bytes, chunk_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = told.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every stored record (segments apart): its headers of use here, its file and its block."""
    schema = "type string, id string, origin string, number int, total long, page long, uri string, digest string, refers string, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                rows: list[tuple] = []
                for head, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    get = head.get
                    number = lambda k: int(head[k]) if k in head else None  # noqa: E731, B023
                    rows.append((get("warc-type"), get("warc-record-id"), get("warc-segment-origin-id") or get("warc-record-id"), number("warc-segment-number"), number("warc-segment-total-length"), number("warc-page-id"), get("warc-target-uri"), (get("warc-payload-digest") or "").removeprefix("sha1:") or None, get("warc-refers-to"), block))
                if rows:
                    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                    cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(cols, schema_names)

    schema_names = [x.split()[0] for x in schema.split(", ")]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(~F.col("path").rlike(r"/[_.][^/]*$")).select("content").mapInArrow(run, schema)


def reassemble(records: DataFrame) -> DataFrame:
    """One row for each original record: its segments joined, checked and decoded.

    ``payload`` is null and ``problem`` says why if a segment is missing or repeated, if the total
    length or the digest disagrees or if the framing is broken; else ``problem`` is null. Revisit
    records have no payload of their own.
    """
    part = F.struct(F.coalesce("number", F.lit(1)).alias("number"), "total", "block")
    is_first = F.col("type") != "continuation"
    of = lambda c: F.max(F.when(is_first, F.col(c))).alias(c)
    whole = records.groupBy("origin").agg(of("type"), of("page"), of("uri"), of("digest"), of("refers"), F.sort_array(F.collect_list(part)).alias("parts"))
    count = F.size("parts")
    total = F.element_at("parts", -1)["total"]
    gapless = F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), count)
    block = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["block"]))
    whole = whole.select("origin", "type", "page", "uri", "digest", "refers", count.alias("segments"), block.alias("block"), total.alias("total"), gapless.alias("gapless"))
    size = F.octet_length("block")
    fault = F.when(F.col("type").isNull(), "the origin record is missing").when(~F.col("gapless"), "segment numbers have a gap or a repeat")
    fault = fault.when((F.col("segments") > 1) & F.col("total").isNull(), "the last segment is missing").when(F.col("total") != size, "the total length disagrees")
    whole = whole.select("origin", "type", "page", "uri", "digest", "refers", "segments", "block", fault.alias("problem"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types, digests, blocks, faults = (batch.column(k).to_pylist() for k in (1, 4, 7, 8))
            payloads: list[bytes | None] = []
            for k, (kind, digest, data, problem) in enumerate(zip(types, digests, blocks, faults, strict=True)):
                payload = None
                if problem is None and kind != "revisit":
                    try:
                        head, _, body = data.partition(b"\r\n\r\n")
                        payload = unchunk(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked", head) else body
                        if digest and hashlib.sha1(payload).hexdigest() != digest.lower():
                            payload, faults[k] = None, "the payload digest disagrees"
                    except ValueError as why:
                        faults[k] = str(why)
                payloads.append(payload)
            kept = [batch.column(k) for k in range(7)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(payloads, pa.binary()), pa.array(faults, pa.string())], [*batch.schema.names[:7], "payload", "problem"])

    return whole.mapInArrow(run, "origin string, type string, page long, uri string, digest string, refers string, segments int, payload binary, problem string")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The archives' records put together again, revisits resolved.

    Columns: page_id, uri, record_type, payload (null for revisits), payload_bytes, payload_digest
    (of the payload as read, for revisits that of the record they refer to), refers_to, segments,
    problem. Without ``payloads`` they are measured and left out. An archive without records gives
    no rows.
    """
    whole = reassemble(read_records(spark, path)).withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload"))
    sized = whole = materialise(whole if payloads else whole.withColumn("payload", F.lit(None).cast("binary")), "records")
    own = sized.where(F.col("type") != "revisit").select("page", "uri", "type", "payload", "bytes", "sha", F.lit(None).cast("long").alias("to"), "segments", "problem")
    target = sized.where(F.col("type") == "response").select(F.col("origin").alias("refers"), F.col("bytes").alias("bytes"), "sha", F.col("page").alias("to"), F.lit(True).alias("there"))
    again = whole.where(F.col("type") == "revisit").drop("bytes", "sha").join(target, "refers", "left")
    fault = F.when(F.col("there").isNull(), "the record referred to is missing").when(F.col("sha") != F.col("digest"), "the payload digest disagrees")
    again = again.select("page", "uri", "type", "payload", "bytes", "sha", "to", "segments", F.coalesce("problem", fault).alias("problem"))
    named = ["page_id", "uri", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "segments", "problem"]
    return own.unionAll(again).toDF(*named)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC archives in the shared folder and read them back."""
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments", "problem")


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) AS top FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to,
  CAST(CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 1 ELSE ceil((87 + payload_bytes + 5
    + (payload_bytes // 4096) * 8 + CASE WHEN payload_bytes % 4096 = 0 THEN 0 ELSE length(printf('%x', payload_bytes % 4096)) + 4 END) / 16384.0) END AS INTEGER) AS segments,
  CAST(NULL AS VARCHAR) AS problem
FROM m
"""
