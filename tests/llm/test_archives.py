"""Archives are read as streams, and hold a bounded number of bytes."""

import gzip
import os

import pytest

from queixa.llm import warc


def record(number, payload):
    import hashlib
    body = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{number}>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"
            f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("piece", [7, 1000, 1 << 20])
def test_streams(monkeypatch, piece):
    monkeypatch.setattr(warc, "PIECE", piece)
    payloads = [b"", b"x", os.urandom(3000), b"a\r\n\r\nb" * 500, b"0" * 200_000 if piece > 7 else b"0" * 2000]
    plain = [record(i, p) for i, p in enumerate(payloads)]
    one, several = gzip.compress(b"".join(plain)), b"".join(map(gzip.compress, plain))
    for data in (one, several):
        found = list(warc.parse(data, "a"))
        assert [f["payload_bytes"] for f in found] == [len(p) for p in payloads]
        for f in found:
            assert b"".join(plain)[f["offset"]:f["offset"] + f["length"]] == plain[f["page_id"]]
    assert list(warc.parse(gzip.compress(b""), "a")) == [] and list(warc.parse(b"", "a")) == []
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse(gzip.compress(plain[2][:-10]), "a"))


def test_large_pages_make_small_archives(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a.b/{i}", "20200101000000", str(i) * 1_500_000) for i in range(1, 10)],
                                  "page_id long, url string, timestamp string, html string").coalesce(1)
    size = warc.ARCHIVE_BYTES
    try:
        warc.ARCHIVE_BYTES = 4_000_000
        warc.write_archives(pages, str(tmp_path / "w"))
    finally:
        warc.ARCHIVE_BYTES = size
    archives = [f for f in os.listdir(tmp_path / "w") if f.endswith(".gz")]
    assert len(archives) >= 5
    got = warc.index(spark, str(tmp_path / "w")).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(i, 1_500_000) for i in range(1, 10)]
