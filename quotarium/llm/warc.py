"""WARC records in seekable Zstandard bundles (operator 4).

A bundle is one file: independent Zstandard frames of whole records, a skippable frame with the record
index (identifier, frame, offset in the frame's plain bytes, length) and the footer seek table of the
public seekable format. To fetch a record a reader takes the footer, one frame and a slice of it.

Bundles are written and read by Spark's own file sources, so they can lie in any store that Spark reads,
and a lost executor costs one task. Spark's text writer ends each row with a line separator; the separator
used here is the seek table's closing magic number, and each file holds one row, so files are valid bundles.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotarium.llm.common import bounded, scratch, small_batches, written

SEEK_MAGIC = b"\xb1\xea\x92\x8f"
SKIPPABLE_SEEK, SKIPPABLE_INDEX = 0x184D2A5E, 0x184D2A50
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 8 << 20
MIN_REVISIT = 100
CLOSING = "".join(map(chr, SEEK_MAGIC))


_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A response's block is an HTTP response with the payload as its body; a revisit has no block, its headers keep the payload's digest and length."""
    block = b"" if kind == "revisit" else _HTTP.format(len(payload)).encode() + payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI: " + "".join(c for c in url or "" if c >= " "), "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


#: Set in a record's frame number if it has no identifier.
NO_KEY = 1 << 31


def make_bundle(records: list[tuple[int | None, bytes]], frame_bytes: int = FRAME_BYTES) -> bytes:
    """A bundle without its last four bytes, which the writer's line separator adds."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
    frames, table, index, plain, at = [], [], [], [], 0
    for i, (key, raw) in enumerate(records):
        index.append(struct.pack("<qIQQ", key or 0, len(frames) | (NO_KEY if key is None else 0), at, len(raw)))
        plain.append(raw)
        at += len(raw)
        if at >= frame_bytes or i == len(records) - 1:
            frames.append(pack(b"".join(plain)))
            table.append(struct.pack("<II", len(frames[-1]), at))
            plain, at = [], 0
    own = b"".join(index)
    frames.append(struct.pack("<II", SKIPPABLE_INDEX, len(own)) + own)
    table.append(struct.pack("<II", len(frames[-1]), 0))
    foot = struct.pack("<IB", len(table), 0)
    return b"".join([*frames, struct.pack("<II", SKIPPABLE_SEEK, 8 * len(table) + 9), *table, foot])


def read_index(bundle: bytes) -> tuple[list[tuple[int, int]], list[tuple[int | None, int, int, int]]]:
    """(start, size) of each data frame, and (key, frame, offset, length) of each record, from the footer backwards."""
    if bundle[-4:] != SEEK_MAGIC:
        raise ValueError("not a seekable bundle")
    n, flags = struct.unpack_from("<IB", bundle, len(bundle) - 9)
    entry = 12 if flags & 128 else 8
    at, frames = len(bundle) - 9 - n * entry, []
    begin = 0
    for i in range(n):
        size, _ = struct.unpack_from("<II", bundle, at + i * entry)
        frames.append((begin, size))
        begin += size
    begin, size = frames.pop()
    index = struct.iter_unpack("<qIQQ", bundle[begin + 8 : begin + size])
    return frames, [(None if frame & NO_KEY else key, frame & ~NO_KEY, offset, length) for key, frame, offset, length in index]


def fetch(bundle: bytes, frames: list[tuple[int, int]], entry: tuple[int | None, int, int, int]) -> bytes:
    """One record: only its frame is decompressed."""
    import zstandard

    begin, size = frames[entry[1]]
    return zstandard.ZstdDecompressor().decompress(bundle[begin : begin + size])[entry[2] : entry[2] + entry[3]]


def classed(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type, refers_to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    # a digest's rows are summed up in each task first; only digests seen twice go to the join
    first = rows.filter(F.octet_length("payload") >= MIN_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 and first_id is not null").select("payload_digest", "first_id")
    # the join moves keys, not payloads, unless the copies' digests are too many to send around
    rows = rows.join(bounded(written(first, "warc-copies"), 96), "payload_digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.withColumns({"record_type": F.when(again, "revisit").otherwise("response"), "refers_to": F.when(again, F.col("first_id"))})


def write_bundles(rows: DataFrame, path: str, bundle_bytes: int = BUNDLE_BYTES, frame_bytes: int = FRAME_BYTES) -> None:
    """rows: as classed() gives them. Each task fills bundles of at most about bundle_bytes plain bytes (a larger record is alone in one)."""
    small_batches(rows.sparkSession)

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        give = lambda: pa.RecordBatch.from_pydict({"value": pa.array([make_bundle(held, frame_bytes)], pa.binary())})
        for b in batches:
            for r in zip(*(b[c] for c in ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to"))):
                key, url, payload, digest, kind, refers = (x.as_py() for x in r)
                raw = make_record(key, url, payload, digest, kind, refers)
                if held and size + len(raw) > bundle_bytes:
                    yield give()
                    held, size = [], 0
                held.append((key, raw))
                size += len(raw)
        if held:
            yield give()

    out = rows.select("page_id", "url", "payload", "payload_digest", "record_type", "refers_to").mapInArrow(bundles, "value binary")
    out.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", CLOSING).text(path)


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Every record of every bundle, found through index and seek table: page_id, headers' and payload's facts, and where it lies."""
    small_batches(spark)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for file, content in zip(b["path"].to_pylist(), b["content"]):
                bundle = content.as_py()
                frames, index = read_index(bundle)
                out, last, plain = [], -1, b""
                for key, frame, offset, length in index:
                    if frame != last:
                        begin, size = frames[frame]
                        plain, last = unpack(bundle[begin : begin + size]), frame
                    head, body = parse_record(plain[offset : offset + length])
                    own = head["WARC-Record-ID"][10:-1]
                    is_own = head["WARC-Type"] == "response"
                    digest = hashlib.sha256(body).hexdigest() if is_own else head["WARC-Payload-Digest"][7:]
                    if digest != head["WARC-Payload-Digest"][7:] or (int(own) if own else None) != key:
                        raise ValueError(f"record {key} of {file} is damaged")
                    to = head.get("WARC-Refers-To", "")[10:-1]
                    out.append((int(own) if own else None, len(body) if is_own else int(head["X-Payload-Length"]), digest, head["WARC-Type"], int(to) if to else None, file, frame, offset, length))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), FIELDS.values())], names=list(FIELDS))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, bundle string, frame int, offset long, record_bytes long")


FIELDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "bundle": pa.string(), "frame": pa.int32(), "offset": pa.int64(), "record_bytes": pa.int64()}


def warc_round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes one record a page (null html: empty payload) and returns what reading the bundles back gives.

    Of records with equal payloads of at least 100 bytes the smallest page_id is response, the others revisit it. Rows that share that
    smallest page_id are all responses; a null page_id is never the smallest, and copies that all lack a page_id are responses.
    A payload of any length is a record of its own. An empty table writes no bundle and returns no rows. Other columns are ignored, whatever their names.
    """
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_bundles(classed(pages), path)
    return read_bundles(spark, path)
