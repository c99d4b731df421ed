"""The page store: one Parquet table partitioned by platform and crawl."""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.urls import storage_key
from gleaner.operators.predicates import any_of
from gleaner.operators.ranking import collision_versions, numbered_key
from gleaner.operators.resolve import first_per_key
from gleaner.schema import FETCHED, PAGE, RECORD_ID, STORED
from gleaner.sources import file_tree
from gleaner.sources.slices import exists


SLICE = ["platform", "crawl_id"]
# Folders below a store: pages that arrived, and records that did not.
ARRIVED, FAILED = "stored", "failed"


def place(path: str, state: str = ARRIVED) -> str:
    """Folder of the pages (or of the failed records) of a store."""
    return f"{path.rstrip('/')}/state={state}"


def with_stored_key(rows: DataFrame) -> DataFrame:
    """Storage key and collision version of pointers or pages; meant for rows without page text."""
    keyed = rows.withColumn("key", F.coalesce(storage_key(F.coalesce("url", F.lit(""))), F.lit("")))
    return collision_versions(
        keyed, SLICE, "key", "timestamp", ties=tuple(c for c in ("url", "filename", "offset") if c in keyed.columns))


def write_pages(pages: DataFrame, path: str) -> None:
    """Write pages; the slices present in the input replace stored slices of the same platform and crawl."""
    (pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SLICE).parquet(place(path)))


def new_pointers(pointers: DataFrame, stored: DataFrame) -> DataFrame:
    """Pointers whose record is not stored yet, once each, with storage keys that go on after the stored ones.

    Records are told apart by slice, file and offset, null-safely: two records of one address and time are two pages, and
    a record that failed is not stored. All of it is slim: no page text is read.
    """
    record = [*SLICE, *RECORD_ID.fieldNames()]
    once = first_per_key(pointers, [F.col(c) for c in record], ["url", "timestamp"])
    have = stored.select(*record).distinct()
    fresh = once.join(have, reduce(and_, [once[c].eqNullSafe(have[c]) for c in record]), "left_anti")
    slot = [*SLICE, "key"]
    last = stored.groupBy(*slot).agg(F.max("version").alias("_last"))
    moment = F.coalesce("timestamp", F.lit("")).alias("_at")
    numbers = stored.groupBy(*slot, moment).agg(F.max("number").alias("_taken"))
    df = with_stored_key(fresh).withColumn("_at", moment).join(last, slot, "left").join(numbers, [*slot, "_at"], "left")
    df = df.withColumns({
        "version": F.col("version") + F.coalesce("_last", F.lit(0)), "number": F.col("number") + F.coalesce("_taken", F.lit(0))})
    return df.withColumn("stored_key", numbered_key("key", "timestamp")).drop("_last", "_at", "_taken")


def add_records(records: DataFrame, path: str) -> None:
    """Add pages and failed records (those with an error) to their slices in one write; what is stored stays."""
    state = F.when(F.col("error").isNull(), ARRIVED).otherwise(FAILED)
    records.withColumn("state", state).write.mode("append").partitionBy("state", *SLICE).parquet(path)


def slices_of(pointers: DataFrame) -> Column:
    """A test on platform and crawl for the slices that the pointers touch, as literals, which prune partitions."""
    touched: dict[str, list[str]] = {}
    for r in pointers.select(*SLICE).distinct().toLocalIterator():
        touched.setdefault(r["platform"], []).append(r["crawl_id"])
    return any_of([(F.col("platform") == p) & F.col("crawl_id").isin(*crawls) for p, crawls in sorted(touched.items())]
                  or [F.lit(False)])


def _read(spark: SparkSession, where: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(where) if exists(spark, where) else spark.createDataFrame([], schema)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """Pages with their storage keys and records; nothing before the first fetch."""
    return _read(spark, place(path), T.StructType([*PAGE.fields, *FETCHED.fields]))


def read_failed(spark: SparkSession, path: str) -> DataFrame:
    """Records that could not be read, of all runs. One that arrived later is among the stored ones, too."""
    return _read(spark, place(path, FAILED), T.StructType([*PAGE.fields, *FETCHED.fields])).drop("html", *STORED.fieldNames())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, place(path), PAGE)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """HTML files ``{platform}/{crawl}/{key}.html`` with the three parts of their place below ``path``.

    Tasks list the folders (now) and read the files, so the driver holds none of their names. A ``path`` that pyarrow
    cannot open is left to Spark's reader, whose driver holds an entry per file.
    """
    place_of, listing = _place(path, ".html"), file_tree.list_files(spark, path, ".html")
    if listing:
        df = file_tree.read_files(listing, bytes)
    else:
        df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").format(
            "binaryFile").load(path)
    return df.where(F.col("path").rlike(place_of)).select(
        F.regexp_extract("path", place_of, 1).alias("path_platform"),
        F.regexp_extract("path", place_of, 2).alias("path_crawl"),
        F.regexp_extract("path", place_of, 3).alias("key"), F.col("content").alias("body"))


_SIDECAR = T.StructType([T.StructField(n, T.IntegerType() if n == "status" else T.StringType())
                         for n in ("url", "timestamp", "status", "mime_type", "crawl_id", "platform")])
_TEXT_CELLS = {*_SIDECAR.fieldNames()} - {"status"}
_JSON, _BLANK = json.JSONDecoder(), " \t\r\n"


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """JSON sidecars, keyed like the pages and read like them.

    A file holds an object or an array of objects, each a row; one that is no JSON in UTF-8, 16 or 32 is a row without
    values. Numbers, objects and arrays in text cells stay as they are written.
    """
    place_of, listing = _place(path, ".json"), file_tree.list_files(spark, path, ".json")
    if listing:
        texts = file_tree.read_files(listing, _sidecar_text, "string", file_tree.uri_path)
        rows = texts.select(F.coalesce("path", F.lit("")).alias("_f"), F.explode(_sidecar_rows(F.col("content"))).alias("_r"))
        df = file_tree.not_broadcast(rows.where(F.col("_r").isNotNull()).select("_f", "_r.*"), listing)
    else:
        df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option(
            "multiLine", "true").schema(_SIDECAR).json(path).withColumn("_f", F.col("_metadata.file_path"))
    return df.select(
        F.regexp_extract("_f", place_of, 1).alias("path_platform"), F.regexp_extract("_f", place_of, 2).alias("path_crawl"),
        F.regexp_extract("_f", place_of, 3).alias("key"), *_SIDECAR.fieldNames())


def _sidecar_rows(text: Column) -> Column:
    """The rows that Spark's JSON reader finds in a file: NULL for a blank one, a row without values for a bad one."""
    # With an option set, the optimizer leaves the parser all fields.
    one, many, none = (F.from_json(x, kind, {"mode": "PERMISSIVE"}) for x, kind in (
        (text, _SIDECAR), (text, T.ArrayType(_SIDECAR)), (F.lit("{}"), _SIDECAR)))
    bad = many.isNull() | F.exists(many, lambda r: r.isNull())
    return F.when(~F.ltrim(text, F.lit(_BLANK)).startswith("["), F.array(one)).when(bad, F.array(none)).otherwise(many)


def _sidecar_text(data: bytes) -> str:
    """JSON text up to the first broken byte. What is no string in a text cell becomes one, as from_json writes it anew."""
    encoding = json.detect_encoding(data)
    try:
        text = data.decode(encoding)
    except UnicodeDecodeError as e:
        text = data[:e.start].decode(encoding)
    try:
        start = _filled(text, 0)
        root, _ = _JSON.raw_decode(text, start)
        rows = root if isinstance(root, list) else [root]
        if any(_is_other(n, v) for r in rows if isinstance(r, dict) for n, v in r.items()):
            return _quoted(text, start)
    except (ValueError, RecursionError):
        pass  # from_json settles what is wrong with it
    return text


def _is_other(name: str, value: object) -> bool:
    return name in _TEXT_CELLS and value is not None and not isinstance(value, str | bool)


def _filled(text: str, at: int) -> int:
    """The next place that is not blank."""
    while text[at:at + 1] and text[at] in _BLANK:
        at += 1
    return at


def _quoted(text: str, at: int) -> str:
    """The object, or array of objects, that begins at a place of a valid text, with all its text cells as strings."""
    out, is_array = [], text[at] == "["
    at = _filled(text, at + 1)
    while text[at] not in "]}":
        name, value, end = None, *_JSON.raw_decode(text, at)
        if not is_array:
            at = _filled(text, _filled(text, end) + 1)
            name, (value, end) = value, _JSON.raw_decode(text, at)
        raw = _quoted(text, at) if is_array and isinstance(value, dict) else text[at:end]
        out.append(raw if is_array else f"{json.dumps(name)}:{json.dumps(raw) if _is_other(name, value) else raw}")
        at = _filled(text, end)
        at = _filled(text, at + 1) if text[at] == "," else at
    return f"[{','.join(out)}]" if is_array else f"{{{','.join(out)}}}"


def _place(path: str, ending: str) -> str:
    """Pattern of platform, crawl and key below a root, whatever its scheme is written like."""
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path.rstrip("/"))
    before = r"^(?:[^:/]+:(?://[^/]*)?)?" if root.startswith("/") else r"^.*/"
    return before + re.escape(root) + r"/([^/]+)/([^/]+)/(.+)" + re.escape(ending) + "$"
