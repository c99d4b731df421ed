"""Lines of gzip files that are made of many members, read by many tasks.

A gzip file cannot be split blindly, but a concatenation of members can be split between them. Every file is cut into
byte ranges. A range's task looks for the first member that begins in it, proves it by unpacking it to its checksum, and
then reads on member by member until the next one would begin in the next range. A file of one member is one task.

Lines may span members, so the text before the first and after the last line break of a range is handed over: these few
fragments of a file are put together in order and split again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 32 << 20
READ_BYTES = 1 << 20
OUT_BYTES = 8 << 20
# Identification, method deflate; reserved flags must be zero.
_MAGIC = b"\x1f\x8b\x08"


class _Window:
    """Forward reads of a file in blocks, holding only what is still needed."""

    def __init__(self, file, at: int):
        self.file, self.start, self.held = file, at, b""

    def need(self, at: int, size: int) -> bytes:
        """``size`` bytes from ``at`` on, fewer at the end of the file."""
        if at > self.start:
            self.held, self.start = self.held[at - self.start:], at
        while len(self.held) < size:
            block = bytes(self.file.read_at(size - len(self.held), self.start + len(self.held)))
            if not block:
                break
            self.held += block
        return self.held[:size]


def _unpack(file, at: int) -> Iterator[bytes | int]:
    """The text of the member at ``at`` in pieces, then the place after it. Raises where it is none or is cut off."""
    stream, place = zlib.decompressobj(31), at
    while not stream.eof:
        block = bytes(file.read_at(READ_BYTES, place))
        if not block:
            raise EOFError(f"gzip member at {at} is cut off")
        place += len(block)
        while block and not stream.eof:
            yield stream.decompress(block, OUT_BYTES)
            block = stream.unconsumed_tail
    yield place - len(stream.unused_data)


def _is_member(file, at: int) -> bool:
    try:
        for _ in _unpack(file, at):
            pass
    except (zlib.error, EOFError):
        return False
    return True


def _first_member(file, start: int, end: int) -> int | None:
    """Place of the first member that begins in [start, end)."""
    if start == 0:
        return 0 if end else None
    window, at = _Window(file, start), start
    while at < end:
        size = min(READ_BYTES, end - at) + 10
        block = window.need(at, size)
        hit = block.find(_MAGIC)
        if hit < 0:
            if len(block) < size:
                return None
            at += len(block) - 2
            continue
        if at + hit >= end:
            return None
        if len(block) > hit + 3 and block[hit + 3] < 0x20 and _is_member(file, at + hit):
            return at + hit
        at += hit + 1
    return None


def range_lines(file, size: int, start: int, end: int) -> Iterator[tuple[list[bytes], bytes | None, bytes | None]]:
    """(whole lines, head, tail) of the members that begin in a range: head and tail only in the last item.

    Without any line break the whole text is the tail and there is no head.
    """
    at = _first_member(file, start, end)
    head, rest = None, []
    while at is not None and at < min(end, size):
        for piece in _unpack(file, at):
            if isinstance(piece, int):
                at = piece
                while at < size and bytes(file.read_at(1, at)) == b"\0":  # padding after a member
                    at += 1
                continue
            first, *more = piece.split(b"\n")
            rest.append(first)
            if not more:
                continue
            line, rest = b"".join(rest), [more.pop()]
            if head is None:
                head = line
            else:
                more.insert(0, line)
            if more:
                yield more, None, None
    yield [], head, b"".join(rest)


_FOUND = "path string, start long, lines array<binary>, head binary, tail binary"


def read_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, pattern: str = "*") -> DataFrame:
    """(value): the lines of all gzip files at ``path`` whose names fit ``pattern``, as ``spark.read.text`` gives them.

    A member that is cut off or broken fails the read. Bytes that are not UTF-8 become replacement characters.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length").where("length > 0")
    step = F.lit(range_bytes)
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)).alias("start"))
    # One small row stands for much work, so the rows are dealt over tasks by their number.
    count = max(1, ranges.count())
    dealt = ranges.repartitionByRange(min(count, 100_000), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        for batch in batches:
            for r in batch.to_pylist():
                fs, place = pafs.FileSystem.from_uri(r["path"])
                with fs.open_input_file(place) as file:
                    for lines, head, tail in range_lines(file, r["length"], r["start"], r["start"] + range_bytes):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r["path"]]), pa.array([r["start"]]), pa.array([lines], pa.list_(pa.binary())),
                             pa.array([head], pa.binary()), pa.array([tail], pa.binary())],
                            names=["path", "start", "lines", "head", "tail"])

    found = dealt.mapInArrow(run, _FOUND)
    text = F.make_valid_utf8(F.col("line").cast("string"))
    whole = found.where("tail IS NULL").select(F.explode("lines").alias("line")).select(text.alias("value"))
    # Each range in order: its head ends a line, its tail begins one; the pieces between two breaks are one line.
    edge = F.when(F.col("head").isNull(), F.col("tail")).otherwise(F.concat("head", F.lit(b"\n"), "tail"))
    edges = found.where("tail IS NOT NULL").groupBy("path").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("start", edge.alias("edge")))), lambda x: x["edge"]).alias("edges"))
    # Latin-1 keeps every byte apart until the pieces are joined; then they are read as UTF-8.
    joined = F.array_join(F.transform("edges", lambda e: F.decode(e, "ISO-8859-1")), "")
    parts = F.split(joined, "\n")
    last = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    rejoined = edges.select(F.explode(last).alias("latin")).select(
        F.make_valid_utf8(F.encode("latin", "ISO-8859-1").cast("string")).alias("value"))
    return whole.unionByName(rejoined)
