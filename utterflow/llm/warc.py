"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle ends with a seek
table in a skippable frame, so any tool reads it as one .warc.zst file and a
reader can decompress a single frame. The index maps record ids to a bundle, a
frame number and an offset within the frame. Executors write bundles straight
to the shared folder; the index is a table written by the same tasks, so only
bundles of tasks that succeeded are in it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import open_root, qualified
from ..sources.tables import read_table
from .common import shared_path, small_batches, spread_key, written

FRAME_BYTES = 256 * 1024         # uncompressed records in a frame before it is closed
BUNDLE_BYTES = 64 * 1024 * 1024  # compressed bytes in a bundle before the next one is begun
READ_FRAMES = 128                # frames in a row that one task reads
DATE = "1970-01-01T00:00:00Z"

_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1


class BundleWriter:
    """Appends frames to a bundle under a temporary name; ``close`` adds the seek table and names it."""

    def __init__(self, folder: str):
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.fs, base = open_root(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{base}/{self.name}"
        self.out = self.fs.open_output_stream(f"{base}/_{self.name}", compression=None)
        self.hidden = f"{base}/_{self.name}"
        self.zip = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.size = 0

    def add(self, frame: bytes) -> int:
        packed = self.zip.compress(frame)
        self.out.write(packed)
        self.frames.append((len(packed), len(frame)))
        self.size += len(packed)
        return len(self.frames) - 1

    def close(self) -> None:
        body = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(body) + len(footer)) + body + footer)
        self.out.close()
        self.fs.move(self.hidden, self.path)


def seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed, uncompressed) of every frame of an open bundle, from its footer."""
    size = f.size()
    n, flags, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
    if magic != _SEEKABLE or flags & 0x7C:
        raise ValueError("no seek table at the end of the bundle")
    entry = 12 if flags & 0x80 else 8
    table = f.read_at(n * entry, size - 9 - n * entry)
    out, at = [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        out.append((at, packed, plain))
        at += packed
    return out


def record_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    tail = uri.removesuffix(">").rpartition(":")[2]
    return int(tail) if tail else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool) -> bytes:
    """A WARC/1.1 record. A revisit holds the HTTP headers of its payload, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_uri(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names) and the payload of one record; None as payload of a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    n = int(out["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    out["payload_bytes"] = int(http.lower().rpartition(b"content-length: ")[2])
    out["payload"] = None if out["warc-type"] == "revisit" else payload
    return out


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(sha1, id, refers_to) of the pages whose payload a page with a larger id has, too.

    Only ids and digests are shuffled; the largest id of a payload is found by
    partial aggregation, and the join back splits a payload with many copies.
    """
    keyed = pages.where(F.col("id").isNotNull() & (F.octet_length("payload") >= min_payload)) \
        .select("id", F.sha1("payload").alias("sha1"))
    last = keyed.groupBy("sha1").agg(F.max("id").alias("refers_to"), F.min("id").alias("first")) \
        .where("first < refers_to").select("sha1", "refers_to", spread_key("sha1").alias("part"))
    return keyed.withColumn("part", spread_key("sha1")).join(last, ["part", "sha1"]).where("id < refers_to") \
        .select("sha1", "id", "refers_to").distinct()


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_payload: int = 0) -> DataFrame:
    """Write one record per row and return the index (page_id, bundle, frame, start, length, frame_bytes).

    Of equal payloads of at least ``min_payload`` bytes the one with the largest
    id is a response and the others are revisits that refer to it; smaller ones
    are all responses. Null html is an empty payload, a null url is left out;
    repeated rows are written each; rows with the same largest id, and rows with
    a null id, are responses.
    """
    folder = qualified(df.sparkSession, folder)
    pages = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                      F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    again = revisits(pages, min_payload).toDF("sha1", "rid", "refers_to")
    rows = pages.join(again, (F.col("id") == F.col("rid")) & (F.sha1("payload") == F.col("sha1")), "left") \
        .select("id", "url", "payload", "refers_to").sortWithinPartitions("id")
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("bundle", T.StringType()),
                           T.StructField("frame", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("frame_bytes", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, frame, entries, done = None, bytearray(), [], []

        def close_frame():
            nonlocal bundle, frame, entries
            if entries:
                bundle = bundle or BundleWriter(folder)
                k, size = bundle.add(bytes(frame)), len(frame)
                done.extend((p, bundle.name, k, a, n, size) for p, a, n in entries)
                frame, entries = bytearray(), []

        def hand_on():
            nonlocal done
            out = pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in done],
                                             schema=pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()),
                                                               ("start", pa.int64()), ("length", pa.int64()), ("frame_bytes", pa.int64())]))
            done = []
            return out

        for b in small_batches(batches):
            for page, url, payload, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rec = build_record(page, url, payload, payload_digest(payload), refers_to, refers_to is not None)
                entries.append((page, len(frame), len(rec)))
                frame += rec
                if len(frame) >= FRAME_BYTES:
                    close_frame()
                if bundle and bundle.size >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
                    yield hand_on()
        close_frame()
        if bundle:
            bundle.close()
        yield hand_on()

    return written(rows.mapInArrow(run, schema), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the indexed records, from the archives.

    Frames are found by the bundles' seek tables and decompressed one at a time;
    a task gets runs of ``READ_FRAMES`` frames of a bundle, so it opens it, and
    reads its footer, once a run. Digests of responses are taken from the payload
    read.
    """
    folder = qualified(index.sparkSession, folder)
    run_of = F.expr(f"frame div {READ_FRAMES}").alias("run")
    runs = index.select("bundle", run_of).distinct().count()
    tasks = max(1, min(runs, 10_000))
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
                           T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
                           T.StructField("refers_to", T.LongType())])
    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_root(folder)
        unzip = zstandard.ZstdDecompressor()
        name, f, frames, at, plain = None, None, [], None, b""
        for b in small_batches(batches):
            out = []
            for bundle, frame, start, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bundle != name:
                    if f:
                        f.close()
                    f, name, at = fs.open_input_file(f"{base}/{bundle}"), bundle, None
                    frames = seek_table(f)
                if frame != at:
                    offset, packed, size = frames[frame]
                    plain, at = unzip.decompress(f.read_at(packed, offset), max_output_size=size), frame
                rec = parse_record(plain[start:start + length])
                revisit = rec["warc-type"] == "revisit"
                digest = rec["warc-payload-digest"].removeprefix("sha1:")
                if not revisit and (payload_digest(rec["payload"]) != digest or len(rec["payload"]) != rec["payload_bytes"]):
                    raise ValueError(f"payload of {rec['warc-record-id']} does not match its digest")
                out.append({"page_id": page_of(rec["warc-record-id"]), "payload_bytes": rec["payload_bytes"],
                            "payload_digest": digest, "record_type": rec["warc-type"],
                            "refers_to": page_of(rec["warc-refers-to"]) if revisit else None})
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
        if f:
            f.close()

    return index.select("bundle", "frame", "start", "length").repartition(tasks, "bundle", run_of) \
        .sortWithinPartitions("bundle", "frame", "start").mapInArrow(run, schema)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records and read every record back from the archives."""
    folder = shared_path(spark, "warc")
    return read_records(write_archives(read_table(spark, sf_dir, "pages"), folder), folder)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h FROM p),
l AS (SELECT h, max(page_id) AS last FROM d GROUP BY h),
b AS (SELECT page_id, payload_bytes, h, last,
        list_aggregate(list_transform(range(0, 40),
          lambda i: lpad(bin(strpos('0123456789abcdef', substr(h, CAST(i + 1 AS INT), 1)) - 1), 4, '0')), 'string_agg', '') AS bits
      FROM d JOIN l USING (h))
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS INT), 1) AS INT) * CAST(pow(2, 4 - j) AS INT))) + 1 AS INT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM b
"""
