"""CSV records with line breaks in quotes, read by several tasks a file.

Whether a line break ends a record depends on the quotes before it, from the
file's beginning on. A file is cut into byte ranges. One pass gives, for each
state that a range can begin in, the state that it ends in; these tables, a few
numbers a range, are composed along each file. The second pass cuts every range
from its first record on, beyond its end for its last record, and Spark's
``from_csv`` parses the records.

States are those of a CSV parser that takes a quote as such only where a field
begins, and a field with other text after its closing quote as unquoted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .listing import list_tree
from .storage import list_matching, open_root, qualified

RANGE_BYTES = 32 << 20
RECORD, FIELD, PLAIN, QUOTED, CLOSED = range(5)    # at a record, at a field, in a plain field, in quotes, after a quote in quotes
BATCH_BYTES = 4 << 20


class Scanner:
    """Record borders of CSV bytes with a one-byte separator."""

    def __init__(self, sep: str):
        s = re.escape(sep.encode())
        field = rb'(?:"[^"]*+(?:""[^"]*+)*+"(?!")[^%s\n]*+|[^"%s\n][^%s\n]*+|)' % (s, s, s)
        self.record = re.compile(rb"(?:%s%s)*+%s\n" % (field, s, field))
        self.stop = re.compile(rb"[%s\n]" % s)
        self.sep = sep.encode()[0]

    def step(self, data: bytes, at: int, state: int) -> tuple[int, int]:
        """Position and state after a border of fields or quotes, or at the end of ``data``."""
        if at >= len(data):
            return at, state
        if state == QUOTED:
            end = data.find(b'"', at)
            return (len(data), QUOTED) if end < 0 else (end + 1, CLOSED)
        c = data[at]
        if c == 0x0A:
            return at + 1, RECORD
        if c == self.sep:
            return at + 1, FIELD
        if c == 0x22 and state in (RECORD, FIELD, CLOSED):
            return at + 1, QUOTED
        m = self.stop.search(data, at)
        return (m.start(), PLAIN) if m else (len(data), PLAIN)

    def first_record(self, data: bytes, state: int) -> tuple[int, int]:
        """Position of the first record that begins in ``data`` (its length if none does) and the state there."""
        at = 0
        while at < len(data) and state != RECORD:
            at, state = self.step(data, at, state)
        return at, state

    def records(self, data: bytes, at: int) -> Iterator[int]:
        """Ends of the whole records from ``at`` on."""
        while m := self.record.match(data, at):
            at = m.end()
            yield at

    def ends(self, data: bytes) -> list[int]:
        """State after ``data`` for each state before it."""
        known: dict[int, int] = {}
        out = []
        for before in range(5):
            at, state = self.first_record(data, before)
            if state == RECORD and at not in known:
                last = at
                for last in self.records(data, at):  # noqa: B007
                    if last in known:
                        break
                end, inner = last, RECORD
                while last not in known and end < len(data):
                    end, inner = self.step(data, end, inner)
                known[at] = known.get(last, inner)
            out.append(known[at] if state == RECORD else state)
        return out


def _bytes(f, start: int, end: int) -> bytes:
    return f.read_at(end - start, start)


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of a file, of the files of a folder, or of those that match a pattern; as Spark, without
    those whose name, or a folder's below the root, begins with a dot or an underscore."""
    if not re.search(r"[*?\[]", path):
        return list_tree(spark, path).where(~F.col("rel").rlike(r"(?:^|/)[._]")).select("path", "length")
    found = list_matching(qualified(spark, path))
    sizes = [(p, open_root(p)) for p in found]
    return spark.createDataFrame([(p, fs.get_file_info(name).size) for p, (fs, name) in sizes], "path string, length long")


def read_records(spark: SparkSession, path: str, sep: str, header: bool = False, range_bytes: int | None = None) -> DataFrame:
    """(path, start, value): every record of CSV files as text, with the byte that it begins at.

    Records end at LF, or at CR LF in files whose first record does. Records
    without a character are none; ``header`` leaves out each file's first.
    """
    step = range_bytes or RANGE_BYTES
    files = _manifests(spark, path).where("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))).alias("start")) \
        .select("path", "start", F.least(F.col("start") + step, "length").alias("end"))
    sizes = ranges.agg(F.count("*").alias("n"), F.count_distinct("path").alias("files")).first()
    tasks = max(1, min(sizes["n"], 10_000))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sep)
        for b in batches:
            for name, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, file = open_root(name)
                with fs.open_input_file(file) as f:
                    ends = _ends(scanner, f, start, end)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([start]), pa.array([end]), pa.array([ends], pa.list_(pa.int32()))],
                                                 ["path", "start", "end", "ends"])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start")
        states, state = [], RECORD
        for ends in pdf["ends"]:
            states.append(state)
            state = int(ends[state])
        return pdf[["path", "start", "end"]].assign(state=states)

    if sizes["n"] > sizes["files"]:
        looked = ranges.repartition(tasks).mapInArrow(look, "path string, start long, end long, ends array<int>")
        ranges = looked.groupBy("path").applyInPandas(compose, "path string, start long, end long, state int")
    else:
        ranges = ranges.withColumn("state", F.lit(RECORD))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sep)
        for b in batches:
            for name, start, end, state in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, file = open_root(name)
                with fs.open_input_file(file) as f:
                    yield from _cut(scanner, f, name, start, end, state, header)

    # the ranges are few and small; each is a task's work
    return ranges.repartition(tasks).mapInArrow(cut, "path string, start long, value string")


def _ends(scanner: Scanner, f, start: int, end: int) -> list[int]:
    """``Scanner.ends`` of a range, read in pieces."""
    ends = list(range(5))
    for at in range(start, end, BATCH_BYTES):
        after = scanner.ends(_bytes(f, at, min(end, at + BATCH_BYTES)))
        ends = [after[state] for state in ends]
    return ends


def _ends_with_cr(scanner: Scanner, f, size: int) -> bool:
    """Whether the first record of a file ends at CR LF."""
    data, more = b"", 1 << 16
    while len(data) < size:
        data += _bytes(f, len(data), min(size, len(data) + more))
        more *= 2
        if m := scanner.record.match(data):
            return data[:m.end()].endswith(b"\r\n")
    return False


def _cut(scanner: Scanner, f, name: str, start: int, end: int, state: int, header: bool) -> Iterator[pa.RecordBatch]:
    """The records that begin in [start, end), the last one read to its end; pieces of the file are held, not the range."""
    size = f.size()
    tail = 2 if _ends_with_cr(scanner, f, size) else 1
    base, data = start, b""
    at = 0
    while (state != RECORD or at >= len(data)) and base + len(data) < end:
        base += len(data)
        data = _bytes(f, base, min(end, base + BATCH_BYTES))
        at, state = scanner.first_record(data, state)
    if state != RECORD or base + at >= end:
        return
    held, weight = [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array([p for p, _ in held], pa.int64()),
                                           pa.array([v for _, v in held], pa.string())], ["path", "start", "value"])

    def text(a: int, b: int) -> str | None:
        value = data[a:b]
        if value.endswith(b"\r\n"[-tail:]):
            value = value[:-tail]
        elif value.endswith(b"\n"):
            value = value[:-1]
        if base + a == 0:
            value = value.removeprefix(b"\xef\xbb\xbf")
            if header:
                return None
        return value.decode("utf-8", "replace") if value else None

    more = 1 << 16
    while base + at < end:
        begun = at
        for stop in scanner.records(data, at):
            if (value := text(at, stop)) is not None:
                held.append((base + at, value))
                weight += stop - at
            at = stop
            if weight >= BATCH_BYTES:
                yield out()
                held, weight = [], 0
            if base + at >= end:
                break
        if base + at >= end:
            break
        read = base + len(data)
        if read >= size:                           # the file's last record has no line break
            if (value := text(at, len(data))) is not None:
                held.append((base + at, value))
            break
        more = 2 * more if at == begun else 1 << 16      # a record longer than what is held: twice as much more
        data, base, at = data[at:] + _bytes(f, read, min(size, read + max(more, min(end - read, BATCH_BYTES)))), base + at, 0
    if held:
        yield out()
