import base64
import hashlib

import pytest

from wordloom.llm import warc
from wordloom.llm.queries import QUERIES
from wordloom.session import new_path

AWKWARD = [
    "plain", "", None, "é中😀" * 50, "WARC/1.0\r\n", "x\nWARC/1.0\r\ny", "\r\n\r\nWARC/1.0", "a\nWARC/1.0\nWARC/1.0", "\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n",
    "\r\n\r\n", "end\r\n", "end\r\n\r", "\n", "WARC/1.0", "xWARC/1.0\r\n" * 9, "\x00nul", "plain", "", "0123456789" * 1000, "0123456789" * 1000,
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    """(key, bytes, digest, type, refers) of every row."""
    least = {}
    for key, text in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    out = []
    for key, text in rows:
        size = len((text or "").encode())
        first = least.get(text or "")
        copies = sum((t or "") == (text or "") for _, t in rows)
        again = size >= min_bytes and copies > 1 and first is not None and key != first
        out.append((key, size, digest(text), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes", [4, 7, 64, warc.CHUNK_BYTES])
@pytest.mark.parametrize("min_bytes", [0, 6])
def test_round_trip(spark, chunk_bytes, min_bytes):
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(0, "plain"), (None, "plain"), (None, "only null"), (None, "only null"), (7, "é")]
    df = spark.createDataFrame([(k, t, f"http://x/é {k}\n", "t") for k, t in rows], "page_id long, html string, url string, payload string")
    got = warc.round_trip(df.repartition(3), chunk_bytes=chunk_bytes, min_bytes=min_bytes)
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()]
    assert sorted(found, key=str) == expected(rows, min_bytes)


def test_chunks_hold_the_payload():
    for text in AWKWARD:
        data = (text or "").encode()
        for size in (4, 5, 9, 1000):
            pieces = [bytes(p) for p in warc.cut_payload(memoryview(data), size)]
            assert b"".join(pieces) == data and all(len(p) <= size for p in pieces) and len(pieces) >= 1
            for piece in pieces:
                piece.decode()
                assert b"\nWARC/1.0" not in b"\n" + piece


def test_archive_is_plain_warc(spark):
    df = spark.createDataFrame([(1, "abcdefgh", None), (2, "abcdefgh", "http://u")], "page_id long, html string, url string").coalesce(1)
    path = new_path(spark, "plain")
    warc.write_warc(df, path, chunk_bytes=5)
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert text.count("WARC/1.0\r\n") == 3 and text.endswith("\r\n\r\n")
    assert "WARC-Type: continuation" in text and "WARC-Segment-Total-Length: 8" in text and "WARC-Type: revisit" in text
    chunks = warc.read_chunks(spark, path)
    assert chunks.filter("body IS NOT NULL").count() == 2


def test_broken_archive_fails(spark):
    df = spark.createDataFrame([(1, "abcdefgh", None)], "page_id long, html string, url string")
    chunks = warc.chunk_table(df, chunk_bytes=4)
    assert [r["body"] for r in chunks.orderBy("chunk_no").collect()] == ["abcd", "efgh"]
    path = new_path(spark, "broken")
    warc.write_warc(df, path, chunk_bytes=4)
    read = warc.read_chunks(spark, path)
    with pytest.raises(Exception, match="lacks chunk"):
        warc.records(read.filter("chunk_no = 1")).collect()
    with pytest.raises(Exception, match="differs from its digest"):
        warc.records(read.withColumn("payload_bytes", read.payload_bytes + 1)).collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, html string, url string")
    assert warc.round_trip(df).count() == 0


def test_query(spark, sf):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op3_warc"](spark, sf).collect()), key=str) == expected(rows)
