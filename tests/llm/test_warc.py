import base64
import gzip
import hashlib

import pytest

from tidemark.llm import warc


def sample(spark):
    rows = [
        (1, "http://a/", "<p>same</p>"), (5, "http://b/\r\nX: 1", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "http://c/", "WARC/1.1\r\n\r\nin \r\n\r\n text \U0001f600"),
        (7, "u", None), (8, "u", ""), (9, "", "\r\n\r\n"), (None, "n", "<p>same</p>"), (10, "x", "long " * 200000), (5, "http://b/", "<p>same</p>"), (None, "n", "alone"),
    ]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, at int, digest string").repartition(3), rows


def brute(rows, least=0):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        first = max(same, default=None)
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), first, len(raw) >= least))
    return out


@pytest.mark.parametrize(("compression", "least"), [("gzip", 0), ("none", 12)])
def test_round_trip(spark, root, compression, least):
    df, rows = sample(spark)
    warc.write(warc.resolve(df, min_bytes=least), root, compression=compression)
    got = warc.with_referred(warc.read(spark, root)).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest) for r in got], key=str) == sorted([b[:3] for b in brute(rows, least)], key=str)
    expected = {(b[1], b[2]): b for b in brute(rows, least)}
    for r in got:
        _, _, _, first, large = expected[r.payload_bytes, r.payload_digest]
        if r.record_type == "revisit":
            assert large and r.refers_to == first and r.payload == b""
        else:
            assert r.refers_to is None and (r.page_id == first or not large)
            assert base64.b32encode(hashlib.sha1(r.payload).digest()).decode() == r.payload_digest
    responses = [r for r in got if r.record_type == "response" and r.payload_bytes >= least]
    assert len(responses) == len({r.payload_digest for r in responses})
    assert len({r.record_id for r in got}) == len(got)
    by_url = {r.page_id: r.url for r in got}
    assert by_url[4] == "http://c/" and by_url[3] is None
    assert {r.url for r in got if r.page_id == 5} == {"http://b/%0D%0AX: 1", "http://b/"}


def test_no_pages(spark, root):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(warc.resolve(none), root)
    assert warc.read(spark, root).collect() == []


def test_broken_archives_are_told():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [b for _, b in warc.records(record * 2)] == [b"abcd"] * 2
    assert [b for _, b in warc.records(gzip.compress(record) + gzip.compress(record))] == [b"abcd"] * 2
    with pytest.raises(ValueError):
        list(warc.records(record[:-6]))
    with pytest.raises(ValueError):
        list(warc.records(b"HTTP/1.1 200 OK\r\n"))
