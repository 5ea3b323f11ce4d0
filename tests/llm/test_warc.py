"""Archives against the pages they were made of."""

import glob
import gzip
import hashlib

import pytest

from feldspar.llm import warc
from feldspar.llm.queries import QUERIES


def expected(rows):
    """Multiset of (page, bytes, digest, type, refers)."""
    first = {}
    for i, html in rows:
        p = (html or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, html in rows:
        p = (html or "").encode()
        refers = first.get(p) if len(p) >= 100 else None
        refers = None if refers == i else refers
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def of(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


ROWS = [
    (1, None), (2, ""), (3, "short"), (4, "short"), (5, "x" * 100), (6, "x" * 100), (9, "x" * 100), (7, "é漢😀" * 40_000), (8, "a\r\n\r\nWARC/1.1\r\n" * 9000),
    (10, "é漢😀" * 40_000), (11, "0\r\n\r\n"), (None, "no id " * 30), (None, "x" * 100), (12, "y" * 99), (13, "y" * 99), (5, "x" * 100), (7, "é漢😀" * 40_000), (14, "z" * 32_768 * 3),
]


def test_odd_pages(spark):
    frame = spark.createDataFrame([(i, f"http://a.b/{i} x", h, "c", 1) for i, h in ROWS], "page_id long, url string, html string, record_type string, row int")
    assert of(warc.round_trip(frame)) == expected(ROWS)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_payloads_and_files(spark, tmp_path):
    frame = spark.createDataFrame([(i, None, h) for i, h in ROWS if i is not None], "page_id long, url string, html string")
    folder = str(tmp_path / "archive")
    warc.write(frame, folder)
    back = {r.page_id: r.payload for r in warc.read(spark, folder).collect() if r.record_type == "response"}
    for i, h in ROWS:
        if i in back:
            assert bytes(back[i]) == (h or "").encode()
    kinds, segments = set(), 0
    for f in glob.glob(folder + "/*.gz"):
        for fields, block in warc.parse(gzip.open(f).read()):
            kinds.add(fields["warc-type"])
            segments += "warc-segment-total-length" in fields
            assert len(block) <= warc.SEGMENT_BYTES + 3
    assert kinds == {"response", "revisit", "continuation"} and segments >= 4


def test_broken_segments():
    with pytest.raises(ValueError):
        warc.joined([(1, None, b"a"), (3, 2, b"b")])
    with pytest.raises(ValueError):
        warc.joined([(1, None, b"a"), (2, 3, b"b")])
    assert warc.joined([(2, 2, b"b"), (1, None, b"a")]) == b"ab"
    with pytest.raises(ValueError):
        warc.unchunked(b"2\r\nabc\r\n0\r\n\r\n")
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nfield: 1\r\n\r\n") == b"abc"


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert of(QUERIES["op8_warc_segments"](spark, folder)) == expected(rows)
