"""WARC archives: round trip, segments, revisits and faults."""

from __future__ import annotations

import hashlib

import pytest

from gleanworks.llm import warc
from gleanworks.llm.common import scratch_path


def brute(rows):
    out, top = {}, {}
    for page, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000:
            top[body] = max(top.get(body, page), page)
    for page, html in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and top[body] != page
        out[page] = (len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top[body] if again else None)
    return out


def test_round_trip_with_segments_revisits_nulls_and_odd_text(spark):
    big = "é" * 40_000 + "\r\n\r\nWARC/1.1\r\n0\r\n\r\n"
    rows = [(1, None), (2, ""), (3, "a" * 999), (4, "a" * 999), (5, "b" * 1000), (6, "b" * 1000), (7, big), (8, big), (9, "x\r\n\r\ny" * 5000)]
    rows += [(k, "c" * 4096 * 8) for k in range(10, 40)]
    df = spark.createDataFrame([(p, "http://h/\r\nX: 1" if p == 5 else None, h, "extra") for p, h in rows], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "t")
    warc.write_archives(df, path, segment_bytes=5000, file_records=7)
    got = warc.read_archives(spark, path).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == brute(rows)
    assert len(got) == len(rows) and all(r.problem is None for r in got)
    stored = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert stored[8].decode() == big and stored[1] == b"" and max(r.segments for r in got) > 10


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "z" * 2000), (None, "z" * 2000), (1, "z" * 2000), (1, "z" * 2000)], "page_id long, html string")
    path = scratch_path(spark, "t")
    warc.write_archives(df, path)
    got = sorted((r.record_type, r.page_id or -1, r.refers_to or -1, r.payload_bytes) for r in warc.read_archives(spark, path).collect())
    assert got == [("response", 1, -1, 2000), ("revisit", -1, 1, 2000), ("revisit", -1, 1, 2000), ("revisit", 1, 1, 2000)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "t")
    warc.write_archives(df, path)
    assert warc.read_archives(spark, path).count() == 0


@pytest.mark.parametrize(
    ("drop", "says"), [(1, "the origin record is missing"), (2, "segment numbers have a gap or a repeat"), (4, "the last segment is missing")]
)
def test_missing_segments_are_told(spark, drop, says):
    parts = warc.records_of('1', 1, None, b"q" * 900, hashlib.sha1(b"q" * 900).hexdigest(), None, 300, 100)
    assert len(parts) == 4
    rows = []
    for head, block in warc.parse(b"\r\n\r\n".join(p for k, p in enumerate(parts, 1) if k != drop) + b"\r\n\r\n"):
        n = lambda k, h=head: int(h[k]) if k in h else None
        rows.append((head["warc-type"], head["warc-record-id"], head.get("warc-segment-origin-id") or head["warc-record-id"], n("warc-segment-number"), n("warc-segment-total-length"), 1, None, (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None, None, block))
    df = spark.createDataFrame(rows, "type string, id string, origin string, number int, total long, page long, uri string, digest string, refers string, block binary")
    got = warc.reassemble(df).collect()
    assert [(r.payload, r.problem) for r in got] == [(None, says)]


def test_wrong_length_and_digest_are_told(spark):
    good = warc.records_of('1', 1, None, b"q" * 900, hashlib.sha1(b"other").hexdigest(), None, 10_000, 100)[0]
    head, block = next(warc.parse(good))
    cols = "type string, id string, origin string, number int, total long, page long, uri string, digest string, refers string, block binary"
    rows = [("response", "a", "a", None, None, 1, None, "0" * 40, None, block), ("response", "b", "b", 1, 5, 2, None, None, None, block), ("response", "c", "c", None, None, 3, None, None, None, block[:-30])]
    got = {r.page: r.problem for r in warc.reassemble(spark.createDataFrame(rows, cols)).collect()}
    assert got[1] == "the payload digest disagrees" and got[2] == "the total length disagrees" and got[3]


def test_chunks_round_trip():
    for n in (0, 1, 4095, 4096, 4097, 12_288):
        assert warc.unchunk(warc.chunk(b"k" * n)) == b"k" * n
    assert warc.unchunk(b"4;ext=1\r\nabcd\r\n0\r\nTrailer: x\r\n\r\n") == b"abcd"
    with pytest.raises(ValueError):
        warc.unchunk(b"5\r\nabc")


def test_query_matches_brute_force(spark, sf_dir):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = warc.op1_warc(spark, sf_dir).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == brute(pages)
