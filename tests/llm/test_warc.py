"""WARC archives: exact round trip, revisits, damage, odd rows."""

import base64
import hashlib
import random

import pytest

from skygrain.llm import queries, warc

SF = "/root/testdata/sf0.001"


def _expected(rows, least=0):
    """Of (page_id, html) rows: the result rows."""
    last = {}
    for page, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, html in rows:
        data = (html or "").encode()
        target = last.get(html or "") if page is not None and len(data) >= least else None
        revisit = target is not None and page < target
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def _got(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert _got(queries.op4_warc(spark, SF).collect()) == _expected(pages)


@pytest.mark.parametrize("least", [0, 3])
def test_odd_rows(spark, tmp_path, least):
    long = "".join(random.Random(1).choices("ab\r\n é", k=200_000))
    rows = [(1, "same"), (2, "same"), (9, "same"), (3, None), (4, ""), (5, "ab"), (6, "ab"), (None, "same"), (None, None), (9, "same"), (2, "same"),
            (10, long), (11, long), (12, "\r\n\r\nWARC/1.1\r\n\r\n"), (13, "0\r\n\r\n"), (-7, "same"), (14, "x" * warc.SEGMENT_BYTES), (15, "x" * 32_600)]
    pages = spark.createDataFrame([(p, f"http://x/{k}\r\nWARC-Type: é" if k % 2 else None, h, "t") for k, (p, h) in enumerate(rows)],
                                  "page_id long, url string, html string, sha string")
    found = warc.read(spark, warc.write(pages, str(tmp_path / "a"), least=least)).collect()
    assert _got(found) == _expected(rows, least) and all(r.intact for r in found)
    assert warc.read(spark, warc.write(pages.limit(0), str(tmp_path / "b"))).count() == 0


def test_segments_and_chunks():
    payload = bytes(random.Random(2).choices(range(256), k=70_000))
    for size in (0, 1, 8191, 8192, 8193, 70_000):
        assert warc.unchunked(warc.chunked(payload[:size])) == payload[:size]
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    for bad in (b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"3\r\nabc\r\n0\r\n"):
        with pytest.raises(warc.Damaged):
            warc.unchunked(bad)
    archive = b"".join(r + b"\r\n\r\n" for r in warc.records_of(5, "u", payload, None, 1000))
    found = list(warc.parse(archive))
    assert len(found) > 70 and found[-1][0]["warc-segment-total-length"] == str(sum(len(b) for _, b in found))
    assert {f.get("warc-segment-origin-id") for f, _ in found[1:]} == {found[0][0]["warc-record-id"]}
    segments = [(int(f["warc-segment-number"]), b) for f, b in found]
    total = int(found[-1][0]["warc-segment-total-length"])
    random.Random(3).shuffle(segments)
    assert warc.payload_of(warc.reassembled(segments, total)) == payload
    for wrong, length in ((segments[1:], total), (segments + segments[:1], total), (segments, total - 1), (segments, None)):
        with pytest.raises(warc.Damaged):
            warc.reassembled(wrong, length)
    with pytest.raises(warc.Damaged):
        list(warc.parse(archive[:-10]))


def test_lost_segment_is_reported(spark, tmp_path):
    records = [r for page in (1, 2) for r in warc.records_of(page, "u", b"y%d" % page * 50_000, None)]
    records += warc.records_of(0, "u", b"y2" * 50_000, 2)
    del records[2]
    spark.createDataFrame([(r.decode(),) for r in records], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip").text(str(tmp_path / "a"))
    found = {r.page_id: r for r in warc.read(spark, str(tmp_path / "a")).collect()}
    assert not found[1].intact and found[1].payload_bytes is None
    assert found[2].intact and found[2].payload_bytes == 100_000
    assert found[0].intact and found[0].record_type == "revisit" and found[0].payload_digest == found[2].payload_digest
