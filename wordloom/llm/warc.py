"""WARC archives as a table of chunks.

A payload becomes rows of record, chunk number and at most ``chunk_bytes`` bytes, which the archive
holds as one record each: the first chunk under the record's own type, the others as ``continuation``
records, as the format provides for oversized payloads. Digests run on from chunk to chunk, so
neither side ever holds more of a payload than a chunk. Spark's text writer and reader move the
records, so archives can lie wherever Spark can write: chunks are cut so that none contains the
line that separates records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.session import new_path

CHUNK_BYTES = 1 << 20
_BATCH_BYTES = 4 << 20
DATE = "2000-01-01T00:00:00Z"
# Marks of the format.
_VERSION = "WARC/1.0"
_END = "\r\n\r\n"
_BETWEEN = f"\n{_VERSION}\r\n"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_CHUNK_ROW = "key string, url string, payload_bytes long, payload_digest string, chunk_no int, n_chunks int, body string"
_PART_ROW = (
    "record_id string, chunk_no int, key string, url string, type string, payload_bytes long, payload_digest string, "
    "refers_to string, last boolean, found_bytes long, found_digest string, body binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def cut_payload(payload: memoryview, chunk_bytes: int) -> Iterator[memoryview]:
    """Chunks of whole characters; a line that begins like a record is cut in two. At least one chunk."""
    start, mark = 0, _VERSION.encode()
    while True:
        stop = min(len(payload), start + max(4, chunk_bytes))
        while start < stop < len(payload) and payload[stop] & 0xC0 == 0x80:
            stop -= 1
        piece = bytes(payload[start:stop])
        at = 0 if piece.startswith(mark) else piece.find(b"\n" + mark)
        if at >= 0:
            stop = start + at + (4 if at == 0 and piece.startswith(mark) else 5)
        # A mark that a size limit would cut off is whole in neither chunk, so it needs no care.
        yield payload[start:stop]
        start = stop
        if start >= len(payload):
            return


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], width: int) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``_BATCH_BYTES`` by the size of column ``width``."""
    held, size = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], t) for i, t in enumerate(types)], names=names)

    for row in rows:
        held.append(row)
        size += len(row[width] or "") + 64
        if size >= _BATCH_BYTES:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def chunk_table(df: DataFrame, payload: str = "html", key: str = "page_id", url: str | None = "url", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of each row's ``payload`` in UTF-8, with length and digest of the whole payload.

    A NULL payload is empty; an empty one has a single empty chunk. Keys may be NULL or repeated.
    """
    slim = df.select(
        F.col(key).cast("string").alias("key"), (F.col(url) if url else F.lit(None).cast("string")).alias("url"), F.col(payload).alias("payload")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    owner, at, value = (batch.column(c)[i] for c in range(3))
                    held = value.as_buffer() if value.is_valid else None
                    view = memoryview(held) if held is not None and len(held) else memoryview(b"")
                    running, count = hashlib.sha1(), 0
                    for chunk in cut_payload(view, chunk_bytes):
                        running.update(chunk)
                        count += 1
                    digest = base32(running.digest())
                    for number, chunk in enumerate(cut_payload(view, chunk_bytes)):
                        yield owner.as_py(), at.as_py(), len(view), digest, number, count, bytes(chunk).decode()

        s, n = pa.string(), pa.int32()
        yield from _batches(rows(), [c.split()[0] for c in _CHUNK_ROW.split(", ")], [s, s, pa.int64(), s, n, n, s], 6)

    return slim.mapInArrow(run, _CHUNK_ROW)


def digests(df: DataFrame, payload: str = "html", key: str = "page_id") -> DataFrame:
    """``(key, payload_bytes, payload_digest)`` of every row, chunk by chunk but without their bodies."""
    slim = df.select(F.col(key).alias("key"), F.col(payload).alias("payload"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for value in batch.column(1):
                running, size = hashlib.sha1(), 0
                if value.is_valid and len(value.as_buffer()):
                    view = memoryview(value.as_buffer())
                    size = len(view)
                    for start in range(0, size, CHUNK_BYTES):
                        running.update(view[start : start + CHUNK_BYTES])
                sizes.append(size)
                found.append(base32(running.digest()))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "payload_bytes", "payload_digest"])

    return slim.mapInArrow(run, f"key {kind}, payload_bytes long, payload_digest string")


def write_warc(
    df: DataFrame,
    path: str,
    payload: str = "html",
    key: str = "page_id",
    url: str | None = "url",
    min_bytes: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
    date: str = DATE,
) -> None:
    """Write the rows as WARC records below ``path`` (gzip files).

    Of equal payloads of at least ``min_bytes``, the one with the smallest key is a ``response``, the others
    are ``revisit`` records that refer to it and have no body; NULL keys come last. Rows that repeat
    the smallest key with the same payload are all responses. An empty table writes no records.
    """
    # Equality of payloads is equality of SHA-1 and length; only payloads that occur twice have a row.
    repeated = (
        digests(df, payload, key)
        .filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("key").cast("string").alias("first_key"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    chunks = chunk_table(df, payload, key, url, chunk_bytes)
    placed = chunks.join(repeated, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first_key").isNotNull() & ~F.col("first_key").eqNullSafe(F.col("key"))
    marked = placed.withColumn("revisit", again).filter(~F.col("revisit") | (F.col("chunk_no") == 0))

    def record_id(owner: str, number) -> F.Column:
        h = F.md5(F.concat_ws("|", F.coalesce(F.col(owner), F.lit("none")), "payload_digest", number.cast("string")))
        parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    first = F.col("chunk_no") == 0
    several = (F.col("n_chunks") > 1) & ~F.col("revisit")
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("body"))
    clean_url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    fields = [
        ("WARC-Type", F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id("key", F.col("chunk_no"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", clean_url),
        ("Record-Key", F.regexp_replace(F.col("key"), r"[\r\n]", " ")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        ("Payload-Length", F.col("payload_bytes").cast("string")),
        ("WARC-Profile", F.when(F.col("revisit"), _PROFILE)),
        ("WARC-Refers-To", F.when(F.col("revisit"), record_id("first_key", F.lit(0)))),
        ("Refers-To-Key", F.when(F.col("revisit"), F.col("first_key"))),
        ("WARC-Segment-Number", F.when(several, (F.col("chunk_no") + 1).cast("string"))),
        ("WARC-Segment-Origin-ID", F.when(~first, record_id("key", F.lit(0)))),
        ("WARC-Segment-Total-Length", F.when(several & (F.col("chunk_no") == F.col("n_chunks") - 1), F.col("payload_bytes").cast("string"))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length(body).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]  # NULL values leave no line
    record = F.concat(F.concat_ws("\r\n", F.lit(_VERSION), *lines), F.lit(_END), body)
    marked.select(record.alias("value")).write.option("compression", "gzip").text(path, lineSep=_END)


def _parse(value: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = value.removeprefix(f"{_VERSION}\r\n".encode()).partition(_END.encode())
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n") if ": " in line)
    size = int(fields["Content-Length"])
    if rest[size:] not in (b"\r\n\r", b"\r\n\r\n", b""):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is longer or shorter than its Content-Length")
    return fields, rest[:size]


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The archives' records as chunk rows. A record of one chunk has its digest already and no ``body``."""
    lines = spark.read.text(path, lineSep=_BETWEEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for value in batch.column(0):
                    held, body = _parse(bytes(value.as_buffer()))
                    number = int(held.get("WARC-Segment-Number", 1)) - 1
                    whole = "WARC-Segment-Number" not in held
                    yield (
                        held.get("WARC-Segment-Origin-ID", held["WARC-Record-ID"]),
                        number,
                        held.get("Record-Key"),
                        held.get("WARC-Target-URI"),
                        held["WARC-Type"],
                        int(held["Payload-Length"]),
                        held["WARC-Payload-Digest"].removeprefix("sha1:"),
                        held.get("Refers-To-Key"),
                        whole or "WARC-Segment-Total-Length" in held,
                        len(body) if whole else None,
                        base32(hashlib.sha1(body).digest()) if whole else None,
                        None if whole else body,
                    )

        s, n = pa.string(), pa.int64()
        types = [s, pa.int32(), s, s, s, n, s, s, pa.bool_(), n, s, pa.binary()]
        yield from _batches(rows(), [c.split()[0] for c in _PART_ROW.split(", ")], types, 11)

    return lines.mapInArrow(run, _PART_ROW)


class _Running:
    """Digest of a record whose chunks come in order; equal records may come chunk by chunk together."""

    def __init__(self) -> None:
        self.record = None

    def take(self, row: dict) -> Iterator[dict]:
        if row["found_digest"] is not None:
            yield row
            return
        if row["record_id"] != self.record:
            self.record, self.next, self.sha, self.size, self.first = row["record_id"], 0, hashlib.sha1(), 0, row
        if row["chunk_no"] == self.next:
            self.sha.update(row["body"])
            self.size += len(row["body"])
            self.next += 1
        elif row["chunk_no"] != self.next - 1:
            raise ValueError(f"record {self.record} lacks chunk {self.next}")
        if row["last"]:
            yield {**self.first, "found_bytes": self.size, "found_digest": base32(self.sha.digest())}


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: ``key, url, record_type, payload_bytes, payload_digest, refers_to``.

    Chunks of a record are streamed in order. A body that doesn't have the length or digest that its
    record declares fails the job; so does a missing chunk.
    """
    out = "key string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = _Running()
        for batch in batches:
            done = [row for i in range(batch.num_rows) for row in running.take(batch.slice(i, 1).to_pylist()[0])]
            for row in done:
                if row["type"] != "revisit" and (row["found_bytes"], row["found_digest"]) != (row["payload_bytes"], row["payload_digest"]):
                    raise ValueError(f"record {row['record_id']} differs from its digest")
            columns = [("key", "key"), ("url", "url"), ("record_type", "type"), ("payload_bytes", "payload_bytes"), ("payload_digest", "payload_digest"), ("refers_to", "refers_to")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in done], pa.int64() if c == "payload_bytes" else pa.string()) for _, c in columns],
                names=[n for n, _ in columns],
            )

    ordered = chunks.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return ordered.mapInArrow(run, out)


def round_trip(df: DataFrame, payload: str = "html", key: str = "page_id", url: str | None = "url", **options) -> DataFrame:
    """Write ``df`` as archives in the shared folder and read them back as ``records``, with ``key`` under its name."""
    spark = df.sparkSession
    path = new_path(spark, "warc")
    write_warc(df, path, payload, key, url, **options)
    kind = df.schema[key].dataType
    read = records(read_chunks(spark, path))
    return read.select(
        F.col("key").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url"
    )
