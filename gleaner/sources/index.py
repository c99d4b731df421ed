"""Index scans: the columnar index, CDX text, CDX JSON lines, and the nested index document."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.numbers import timestamp_iso
from gleaner.operators.predicates import CRAWL_ID, any_of, fetched_html, source_key, source_scope, valid_crawl_id
from gleaner.profiles import PROFILES, SourceProfile
from gleaner.schema import INDEX, INDEX_COLUMNS, L, S
from gleaner.sources import gzip_lines, slices

CDX_JSON = T.StructType([
    T.StructField(n, S) for n in ("url", "status", "mime", "filename", "offset", "length")])
CDX_LINE = T.StructType([T.StructField("urlkey", S), T.StructField("timestamp", S), *CDX_JSON.fields])


def write_index(df: DataFrame, path: str) -> None:
    """Store an index partitioned by crawl and subset, rows of one host close together."""
    keys = [F.col(c) for c in ("crawl", "subset", "url_host_registered_domain")]
    (df.select(*INDEX.fieldNames()).hint("rebalance", *keys)
       .sortWithinPartitions("url_host_registered_domain", "url")
       .write.mode("overwrite").partitionBy("crawl", "subset").parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path)


def scan_crawl(index: DataFrame, crawl: str, subset: str = "warc") -> DataFrame:
    """The pointer columns of one crawl slice; both filters prune partitions."""
    return index.where((F.col("crawl") == crawl) & (F.col("subset") == subset)).select(*INDEX_COLUMNS)


def check_crawl_ids(crawls: list[str]) -> None:
    bad = [c for c in crawls if not re.match(CRAWL_ID, c)]
    if bad:
        raise ValueError(f"not crawl ids: {bad}")


def source_rows(
    index: DataFrame, crawls: list[str] | None = None, profiles: tuple[SourceProfile, ...] = PROFILES
) -> DataFrame:
    """Fetchable HTML rows of all sources and crawls in one scan.

    The sources become one disjunction of literal tests, which reaches the Parquet reader; a join with a
    source table would not.
    """
    df = index.where(fetched_html() & any_of([source_scope(p) for p in profiles]))
    if crawls is not None:
        check_crawl_ids(crawls)
        df = df.where(F.col("crawl").isin(*crawls))
    return df.where(valid_crawl_id(F.col("crawl"))).select(
        *INDEX_COLUMNS, F.col("crawl").alias("crawl_id"), source_key(profiles).alias("platform"))


def to_pointers(rows: DataFrame) -> DataFrame:
    """Index rows under the names the fetch step uses, with defaults for absent values."""
    fetched = F.coalesce(F.date_format("fetch_time", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(""))
    return rows.select(
        F.coalesce("url", F.lit("")).alias("url"), timestamp_iso(fetched).alias("timestamp"),
        F.coalesce("fetch_status", F.lit(200)).alias("status"),
        F.coalesce("content_mime_detected", F.lit("text/html")).alias("mime"),
        F.coalesce("warc_filename", F.lit("")).alias("filename"),
        F.coalesce("warc_record_offset", F.lit(0)).cast(L).alias("offset"),
        F.coalesce("warc_record_length", F.lit(0)).cast(L).alias("length"),
        F.coalesce("crawl_id", F.lit("")).alias("crawl_id"), F.coalesce("platform", F.lit("")).alias("platform"))


def parse_cdx(lines: DataFrame, domain: str, value: str = "value", reversed_key: bool = False) -> DataFrame:
    """CDX lines ``urlkey timestamp {json}`` of a domain; malformed lines are dropped.

    A key is kept when it holds the domain as written or with commas for dots. Sort-friendly keys write the
    labels in reverse order; ``reversed_key`` accepts those too.
    """
    parts = F.split(F.trim(value), " ", 3)
    key, forms = F.col("_p")[0], [domain, domain.replace(".", ",")]
    if reversed_key:
        forms.append(",".join(reversed(domain.split("."))))
    df = lines.select(parts.alias("_p")).where(F.size("_p") == 3)
    df = df.where(any_of([key.contains(f) for f in forms]))
    df = df.withColumn("_j", F.from_json(F.col("_p")[2], CDX_JSON, {"mode": "PERMISSIVE"}))
    # A tail that is not JSON gives a record without any value.
    ok = F.try_parse_json(F.col("_p")[2]).isNotNull()
    return df.where(ok).select(key.alias("urlkey"), F.col("_p")[1].alias("timestamp"), "_j.*")


def read_cdx(spark: SparkSession, path: str, domain: str, reversed_key: bool = False, split: bool = True) -> DataFrame:
    """CDX text files, gzip or plain.

    With ``split``, gzip files of many members are read by many tasks each (``gzip_lines``, which opens files with
    pyarrow); without it, one gzip file is one task. Plain files are split by Spark.
    """
    if not split:
        return parse_cdx(spark.read.text(path), domain, reversed_key=reversed_key)
    plain = spark.read.option("pathGlobFilter", "*[!z]").text(path)
    lines = gzip_lines.read_lines(spark, path, pattern="*.gz").unionByName(plain)
    return parse_cdx(lines, domain, reversed_key=reversed_key)


def read_cdx_json(spark: SparkSession, path: str, status: str = "200") -> DataFrame:
    """One JSON record per line; malformed lines are dropped."""
    schema = T.StructType([T.StructField("urlkey", S), T.StructField("timestamp", S), *CDX_JSON.fields])
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.col("status") == status)


_DOCUMENT = T.MapType(S, T.MapType(S, T.ArrayType(CDX_JSON)))


def flatten_document(docs: DataFrame, value: str = "value") -> DataFrame:
    """Index documents ``{crawl: {platform: [records]}}`` to one row per record."""
    # The outer form keeps the optimizer from parsing every document a second time for a size filter.
    df = docs.select(F.explode_outer(F.from_json(value, _DOCUMENT)).alias("crawl_id", "_p"))
    df = df.select("crawl_id", F.explode("_p").alias("platform", "_r"))
    return df.select("crawl_id", "platform", F.inline("_r"))


def write_documents(rows: DataFrame, path: str) -> None:
    """Index documents as JSON text lines, one record each; lines of the same keys add up when flattened."""
    rows.select(document_line().alias("value")).write.mode("overwrite").text(path)


def document_line() -> Column:
    """One record as an index document of its own; documents of the same keys add up when flattened."""
    record = F.struct(*[F.col(f.name).cast("string").alias(f.name) for f in CDX_JSON.fields])
    return F.to_json(F.create_map("crawl_id", F.create_map("platform", F.array(record))))


def missing_slices(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Crawl and platform slices that have no stored result yet."""
    keys = ["crawl_id", "platform"]
    return wanted.join(present.select(*keys).distinct(), keys, "left_anti")


RESULT = T.StructType([*[f for f in INDEX.fields if f.name in INDEX_COLUMNS], T.StructField("crawl_id", S), T.StructField("platform", S)])


def reuse_or_scan(
    index: DataFrame, path: str, crawls: list[str], profiles: tuple[SourceProfile, ...] = PROFILES, refresh: bool = False,
) -> DataFrame:
    """Index rows of the crawls and sources from the result store at ``path``, which first gets the slices it lacks.

    A slice counts as stored once it is published, also without rows; one that a broken run left behind is scanned
    again. There is at most one slice per crawl and source, so the slices to scan become literal tests: partitions of
    crawls that are complete are not read. ``refresh`` scans all of them anew.
    """
    check_crawl_ids(crawls)
    spark, keys = index.sparkSession, [p.key for p in profiles]
    asked = F.col("crawl_id").isin(*crawls) & F.col("platform").isin(*keys)
    have = set() if refresh else {
        (r["crawl_id"], r["platform"]) for r in slices.published(spark, path).where(asked).collect()}
    lacking = {c: [p for p in profiles if (c, p.key) not in have] for c in crawls}
    tests = [(F.col("crawl") == c) & any_of([source_scope(p) for p in missing]) for c, missing in lacking.items() if missing]
    if tests:
        scanned = index.where(F.col("crawl").isin(*[c for c in crawls if lacking[c]]) & fetched_html() & any_of(tests)).select(
            *INDEX_COLUMNS, F.col("crawl").alias("crawl_id"), source_key(profiles).alias("platform"))
        computed = spark.createDataFrame(
            [(c, p.key) for c, missing in lacking.items() for p in missing], "crawl_id string, platform string")
        slices.publish(scanned, path, computed)
    return slices.read(spark, path, RESULT, only=asked)
