"""WARC records read by byte range."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.predicates import has_pointer
from gleaner.schema import POINTER

RECORD = T.StructType([
    *POINTER.fields, T.StructField("body", T.BinaryType()), T.StructField("error", T.StringType())])
MAX_TRIES = 3
# Ranges closer together than this are read in one request.
MAX_GAP, MAX_READ = 64 * 1024, 8 * 1024 * 1024
# Bodies that leave a task together.
MAX_BATCH = 64 * 1024 * 1024
# Bytes one record may have when it is unpacked.
MAX_RECORD = 256 * 1024 * 1024
# Compressed bytes one fetch task reads.
BYTES_PER_TASK = 64 * 1024 * 1024


def split_response(data: bytes) -> bytes | None:
    """HTTP body of a WARC response record."""
    _, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        return None
    for end in (b"\r\n\r\n", b"\n\n"):
        head, found, body = rest.partition(end)
        if found:
            return body
    return None


def inflate(member: bytes, limit: int = MAX_RECORD) -> bytes:
    """The gzip members of a record; more than ``limit`` bytes, or an end within a member, is an error."""
    out, size = [], 0
    while member:
        stream = zlib.decompressobj(31)
        part = stream.decompress(member, limit - size + 1)
        size += len(part)
        if size > limit:
            raise ValueError(f"more than {limit} bytes")
        if not stream.eof:
            raise EOFError("cut off")
        out.append(part)
        member = stream.unused_data.lstrip(b"\0")
    return b"".join(out)


def _body(member: bytes) -> tuple[bytes | None, str | None]:
    try:
        body = split_response(inflate(member))
    except (ValueError, EOFError, zlib.error) as e:
        return None, f"unreadable record: {e}"
    return (body, None) if body else (None, "no body")


def _runs(offsets: list[int], lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Half-open row ranges whose byte ranges are close enough for one read."""
    start, end = 0, offsets[0] + lengths[0]
    for i in range(1, len(offsets)):
        grown = max(end, offsets[i] + lengths[i])
        # Offsets start over where the next slice reads the same file.
        backwards = offsets[i] < offsets[i - 1]
        if backwards or offsets[i] - end > MAX_GAP or grown - offsets[start] > MAX_READ:
            yield start, i
            start, end = i, offsets[i] + lengths[i]
        else:
            end = grown
    yield start, len(offsets)


def _read_run(f, offsets: list[int], lengths: list[int]) -> list[tuple[bytes | None, str | None]]:
    """The records of one run in one read; where that keeps failing, record by record, so that one bad range costs
    one record."""
    at = offsets[0]
    size = max(o + n for o, n in zip(offsets, lengths)) - at
    error = ""
    for _ in range(MAX_TRIES):
        try:
            block = bytes(f.read_at(size, at))
            return [_body(block[o - at:o - at + n]) for o, n in zip(offsets, lengths)]
        except OSError as e:
            error = str(e)
    if len(offsets) == 1:
        return [(None, error)]
    return [r for o, n in zip(offsets, lengths) for r in _read_run(f, [o], [n])]


def _open(fs, path: str):
    for attempt in range(MAX_TRIES):
        try:
            return fs.open_input_file(path)
        except OSError:
            if attempt == MAX_TRIES - 1:
                raise


def _read_file(fs, path: str, offsets: list[int], lengths: list[int]) -> Iterator[list[tuple[bytes | None, str | None]]]:
    """Records of a file, run by run."""
    try:
        f = _open(fs, path)
    except OSError as e:
        yield [(None, str(e))] * len(offsets)
        return
    with f:
        for a, b in _runs(offsets, lengths):
            yield _read_run(f, offsets[a:b], lengths[a:b])


def fetch_partitions(pointers: DataFrame, bytes_per_task: int = BYTES_PER_TASK) -> int:
    """Number of fetch tasks for the bytes the pointers stand for.

    Pointers are tiny next to the records, so their own size must not decide the parallelism.
    """
    spark = pointers.sparkSession
    total = pointers.agg(F.sum("length")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bytes_per_task))


def read_ranges(pointers: DataFrame, root: str, partitions: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Records behind the pointers, with the body or the reason why there is none.

    Pointers are slim and may be many, so they are spread by slice, file and offset range: neighbours meet in
    one task and are read together, a file with very many records is split over tasks, and a task writes few
    slices of the page store, so page text needs no shuffle at all. ``root`` is a folder or bucket URI that
    pyarrow can open. Without ``partitions`` the total length is summed first. Columns in ``carry`` go along.
    Records leave a task in batches of about ``MAX_BATCH`` bytes.
    """
    names, target = [*POINTER.fieldNames(), *carry], root.rstrip("/")
    df = pointers.where(has_pointer()).select(*names)
    by = ["platform", "crawl_id", "filename", "offset"]
    df = df.repartitionByRange(partitions or fetch_partitions(df), *by)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(target)
        for batch in batches:
            files, offsets, lengths = (batch.column(n).to_pylist() for n in ("filename", "offset", "length"))
            got: list[tuple[bytes | None, str | None]] = []
            done = start = size = 0

            def emit():
                rows = batch.slice(done, len(got))
                return pa.RecordBatch.from_arrays(
                    [*[rows.column(n) for n in names],
                     pa.array([b for b, _ in got], pa.binary()), pa.array([e for _, e in got], pa.string())],
                    names=[*names, "body", "error"])

            for i in range(1, len(files) + 1):
                if i < len(files) and files[i] == files[start]:
                    continue
                for found in _read_file(fs, f"{base}/{files[start]}", offsets[start:i], lengths[start:i]):
                    got += found
                    size += sum(len(b) for b, _ in found if b)
                    if size > MAX_BATCH:
                        yield emit()
                        done, got, size = done + len(got), [], 0
                start = i
            if got:
                yield emit()

    schema = T.StructType([*df.schema.fields, *RECORD.fields[-2:]])
    return df.sortWithinPartitions(*by).mapInArrow(fetch, schema)


def fetch_issues(records: DataFrame) -> DataFrame:
    """Failed reads per platform and crawl."""
    return records.where(F.col("body").isNull()).groupBy("platform", "crawl_id").agg(
        F.count(F.lit(1)).alias("n_failed"))


def decode_body(body: Column) -> Column:
    """UTF-8 where valid, else Latin-1."""
    text = body.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(body, "ISO-8859-1"))


def decode_replacing(body: Column) -> Column:
    """UTF-8 with replacement characters for broken bytes."""
    return F.make_valid_utf8(body.cast("string"))


def failures(records: DataFrame) -> DataFrame:
    """Pointers whose record could not be read, with the reason."""
    return records.where(F.col("body").isNull()).drop("body")


def to_pages(records: DataFrame, lenient: bool = False, carry: tuple[str, ...] = (),
             failed: bool = False) -> DataFrame:
    """Page rows of the records that were read, and with ``failed`` those of the others, without text."""
    body = F.col("body")
    return records.where(body.isNotNull() | F.lit(failed)).select(
        "url", "timestamp", "status", F.col("mime").alias("mime_type"), "crawl_id", "platform",
        (decode_replacing(body) if lenient else decode_body(body)).alias("html"), *carry)
