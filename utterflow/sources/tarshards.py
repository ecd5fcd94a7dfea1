"""Tar and tar.gz archive shards as a Spark data source, with several input partitions a shard.

Members are streamed into Arrow batches, never extracted to disk. A shard is cut
into byte ranges, and a partition reads the members that begin in its range:

* a plain tar is walked from header to header, seeking over contents;
* a tar.gz from ``sinks.write_tar_shards`` is a sequence of gzip members of some
  megabytes, each of whole tar members and begun by a fixed header. A partition
  looks for the first such header in its range. To other programs the file is
  a usual tar.gz;
* any other compressed tar can only be read from its beginning, by one partition.

    tarshards.register(spark)
    spark.read.format("tarshards").load("/data/shards/*.tar.gz")

The path is a glob on any file system pyarrow knows; only names and sizes of
shards are listed on the driver.
"""

from __future__ import annotations

import io
import json
import struct
import tarfile
import zlib

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .storage import list_matching, open_root, qualified

BATCH_ROWS, BATCH_BYTES = 1000, 8 * 1024 * 1024
RANGE_BYTES = 128 << 20          # of a shard for one partition
READ_BYTES = 1 << 20
SCHEMA = "shard string, member string, size bigint, offset bigint, content binary"

# Fixed values of the gzip format: magic, deflate, an extra field; no time, unknown system. The extra field's
# subfield "UF" names what follows as the beginning of whole tar members.
_MARK = b"utterflow members"
HEADER = struct.pack("<4sIBBH2sH", b"\x1f\x8b\x08\x04", 0, 0, 255, 4 + len(_MARK), b"UF", len(_MARK)) + _MARK


class GroupWriter:
    """A tar.gz whose gzip members hold whole tar members, ``group_bytes`` or a little more of them."""

    def __init__(self, out, group_bytes: int = 4 << 20):
        self.out, self.group_bytes, self.deflate = out, group_bytes, None

    def add(self, name: str, data: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        self._put(info.tobuf(tarfile.GNU_FORMAT) + data + b"\0" * (-len(data) % tarfile.BLOCKSIZE))
        if self.size >= self.group_bytes:
            self._end()

    def close(self) -> None:
        self._put(b"\0" * tarfile.RECORDSIZE)
        self._end()

    def _put(self, data: bytes) -> None:
        if self.deflate is None:
            self.deflate, self.crc, self.size = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS), 0, 0
            self.out.write(HEADER)
        self.out.write(self.deflate.compress(data))
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)

    def _end(self) -> None:
        self.out.write(self.deflate.flush() + struct.pack("<II", self.crc, self.size & 0xFFFFFFFF))
        self.deflate = None


class _Groups(io.RawIOBase):
    """What the gzip members that begin in [start, end) of a file hold, decompressed."""

    def __init__(self, f, start: int, end: int):
        self.f, self.at, self.end, self.size = f, start, end, f.size()
        self.inflate, self.held = zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, b) -> int:
        while not self.held:
            if self.inflate.eof:
                if self.at >= self.end:
                    return 0
                self.inflate = zlib.decompressobj(31)
            data = self.inflate.unconsumed_tail
            if not data:
                data = self.f.read_at(min(READ_BYTES, self.size - self.at), self.at)
                if not data:
                    return 0
                self.at += len(data)
            self.held = self.inflate.decompress(data, READ_BYTES)
            if self.inflate.eof:                       # the next member begins where this one ended
                self.at -= len(self.inflate.unused_data)
        n = min(len(b), len(self.held))
        b[:n], self.held = self.held[:n], self.held[n:]
        return n


def _first_group(f, start: int, end: int) -> int | None:
    """Position of the first group that begins in [start, end)."""
    keep = len(HEADER) - 1
    for at in range(start, end, READ_BYTES):
        found = f.read_at(min(READ_BYTES + keep, f.size() - at), at).find(HEADER)
        if found >= 0:
            return at + found if at + found < end else None
    return None


class TarShardsDataSource(DataSource):
    """Options: ``path`` (glob of shard files); ``content`` ("true"/"false"); ``rangebytes`` (of a shard for one
    partition); ``piecebytes`` (a longer member is several rows, each with its ``offset``; unset: one row a member)."""

    @classmethod
    def name(cls) -> str:
        return "tarshards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _TarShardsReader(self.options)


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


class _TarShardsReader(DataSourceReader):
    def __init__(self, options):
        pattern = options.get("path")
        if not pattern:
            raise ValueError("tarshards needs a path (glob of shard files)")
        self.pattern = pattern
        self.content = str(options.get("content", "true")).lower() == "true"
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.piece_bytes = int(options.get("piecebytes", 0))
        self.shards, self.names = (set(json.loads(options[k])) if k in options else None for k in ("shards", "members"))

    def partitions(self):
        out = []
        for p in list_matching(self.pattern):
            if self.shards is not None and p.rpartition("/")[2] not in self.shards:
                continue
            fs, name = open_root(p)
            size = fs.get_file_info(name).size
            out += [_Range(p, a, min(a + self.range_bytes, size)) for a in range(0, max(size, 1), self.range_bytes)]
        return out or [_Range("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        shard = partition.path.rpartition("/")[2]
        fs, name = open_root(partition.path)
        rows, size = [], 0
        with fs.open_input_file(name) as f:
            for row in self._members(f, partition.start, partition.end):
                rows.append((shard, *row))
                size += len(row[-1] or b"")
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _members(self, f, start: int, end: int):
        """(member, size, offset, content) of the tar members that begin in [start, end) of a shard."""
        head = f.read_at(min(tarfile.BLOCKSIZE, f.size()), 0)
        if head.startswith(HEADER):
            first = _first_group(f, start, end)
            if first is not None:
                stream = io.BufferedReader(_Groups(f, first, end), READ_BYTES)
                with tarfile.open(fileobj=stream, mode="r|") as tf:
                    yield from self._rows(tf, 0, 1 << 62)
        elif head[257:262] == b"ustar":
            f.seek(0)
            with tarfile.open(fileobj=f, mode="r:") as tf:
                yield from self._rows(tf, start, end)
        elif start == 0 and head:
            f.seek(0)
            with tarfile.open(fileobj=f, mode="r|*") as tf:
                yield from self._rows(tf, 0, 1 << 62)

    def _rows(self, tf, start: int, end: int):
        for m in tf:
            if m.offset >= end:
                return
            tf.members = []                            # tarfile would keep every header
            if not m.isfile() or m.offset < start or self.names is not None and m.name not in self.names:
                continue
            size = int(m.size)
            if not self.content:
                yield m.name, size, 0, None
                continue
            content = tf.extractfile(m)
            piece = self.piece_bytes or max(size, 1)
            for at in range(0, max(size, 1), piece):
                yield m.name, size, at, content.read(min(piece, size - at))


def _batch(rows) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["shard", "member", "size", "offset", "content"])


def register(spark) -> None:
    spark.dataSource.register(TarShardsDataSource)


def read_tar_shards(spark, pattern: str, shards: list[str] | None = None, members: list[str] | None = None, **options):
    """The members of the shards that match ``pattern``, a path of Spark's file system; of ``shards`` and
    ``members`` only, if given.

    Names are arguments, not pushed filters: Spark 4.1 keeps what a Python
    source answered to one query's filters for other queries on the same frame.
    """
    register(spark)
    some = {k: json.dumps(sorted(v)) for k, v in (("shards", shards), ("members", members)) if v is not None}
    return spark.read.format("tarshards").options(**options, **some).option("path", qualified(spark, pattern)).load()
