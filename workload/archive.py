"""Archive files written from the test tables: WARC members, CDX lines and a text page store."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import scratch_dir
from workload import fixtures as fx
from workload.registry import Tables

WARC_HEAD = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: x\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
HTTP_HEAD_LF = b"HTTP/1.1 200 OK\nContent-Type: text/html\n\n"


def _member(page_id: int, html: str) -> bytes:
    """One gzip member. Some pages use bare line feeds, some Latin-1, some have no end of headers."""
    if page_id % 7 == 3:
        body = ("é" + html.encode("ascii", "ignore").decode()).encode("latin-1")
    else:
        body = html.encode()
    if page_id % 11 == 5:
        return gzip.compress(WARC_HEAD + b"HTTP/1.1 200 OK", mtime=0)
    return gzip.compress(WARC_HEAD + (HTTP_HEAD_LF if page_id % 5 == 1 else HTTP_HEAD) + body, mtime=0)


def write_warcs(t: Tables, label: str, per_page: bool = False) -> tuple[str, DataFrame]:
    """WARC files, one per task or page, and the index rows that point into them."""
    root = scratch_dir(t.spark, label)
    target = f"{root}/warc"

    def store(batches):
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        fs, base = pafs.FileSystem.from_uri(target)
        fs.create_dir(base)
        name, at = f"part-{TaskContext.get().partitionId():05d}.warc.gz", 0
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in batches:
                ids, pages = batch.column("page_id").to_pylist(), batch.column("html").to_pylist()
                members = [_member(i, h) for i, h in zip(ids, pages)]
                offsets, lengths = [], []
                for i, m in zip(ids, members):
                    if per_page:  # named so that files are in the order of the pages
                        with fs.open_output_stream(f"{base}/{i:012d}.warc.gz", compression=None) as single:
                            single.write(m)
                        at = 0
                    out.write(m)
                    offsets.append(at + 3 if i % 17 == 4 else at)  # some pointers miss the member
                    lengths.append(0 if i % 13 == 7 else len(m))
                    at += len(m)
                names = [f"{i:012d}.warc.gz" if per_page else name for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), pa.array(names, pa.string()), pa.array(offsets, pa.int64()),
                     pa.array(lengths, pa.int64())],
                    names=["page_id", "warc_filename", "warc_record_offset", "warc_record_length"])

    schema = "page_id long, warc_filename string, warc_record_offset long, warc_record_length long"
    written = t.pages.select("page_id", "html").repartition("page_id").mapInArrow(store, schema)
    written.write.parquet(f"{root}/pointers")
    where = t.spark.read.parquet(f"{root}/pointers")
    replaced = ["warc_filename", "warc_record_offset", "warc_record_length"]
    return target, fx.index(t).drop(*replaced).join(where, "page_id").withColumn("crawl_id", F.col("crawl")).withColumn(
        "platform", F.col("lang"))


# Pages whose record can be read, and the text that must come back.
READABLE_SQL = """
readable AS (SELECT page_id, url, lang, crawl, fetch_time, fetch_status,
  CASE WHEN page_id % 7 = 3 THEN 'é' || regexp_replace(html, '[^\\x00-\\x7F]', '', 'g') ELSE html END AS html
  FROM fx_index JOIN (SELECT page_id, html FROM pages) USING (page_id)
  WHERE page_id % 11 <> 5 AND page_id % 13 <> 7 AND page_id % 17 <> 4)
"""


def cdx_lines(t: Tables) -> DataFrame:
    """CDX text of the index, and two malformed lines for every tenth row."""
    df = fx.index(t)
    record = F.to_json(F.struct(
        "url", F.col("fetch_status").cast("string").alias("status"), F.col("content_mime_detected").alias("mime"),
        F.col("warc_filename").alias("filename"), F.col("warc_record_offset").cast("string").alias("offset"),
        F.col("warc_record_length").cast("string").alias("length")))
    key = F.concat(
        F.array_join(F.reverse(F.split("url_host_name", r"\.")), ","), F.lit(")"), F.col("url_path"))
    stamp = F.date_format("fetch_time", "yyyyMMddHHmmss")
    good, cut = F.concat_ws(" ", key, stamp, record), F.concat_ws(" ", key, stamp)
    broken = F.array(good, cut, F.concat(cut, F.lit(' {"url": "cut off')))
    # One pass over the pages, so that a task reads its own pages once.
    return df.select(F.explode(F.when(F.col("fetch_status") != 200, broken).otherwise(F.array(good))).alias("value"))


def write_gzip_members(t: Tables, lines: DataFrame, label: str, members: int = 40) -> str:
    """Gzip files of many members each, one file per task; members end wherever their bytes end, mostly within a line."""
    root = f"{scratch_dir(t.spark, label)}/cdx"

    def store(batches):
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        fs, base = pafs.FileSystem.from_uri(root)
        fs.create_dir(base)
        text = b"".join(v.encode() + b"\n" for batch in batches for v in batch.column("value").to_pylist())
        size = max(1, -(-len(text) // members))
        with fs.open_output_stream(f"{base}/shard-{TaskContext.get().partitionId():05d}.gz", compression=None) as out:
            for at in range(0, len(text), size):
                out.write(gzip.compress(text[at:at + size], mtime=0))
        yield pa.RecordBatch.from_arrays([pa.array([len(text)], pa.int64())], names=["n"])

    lines.select("value").mapInArrow(store, "n long").write.parquet(f"{root}-done")
    return root


def write_page_files(t: Tables, label: str) -> str:
    """A text page store: ``{platform}/{crawl}/{key}.html`` and, for two pages of three, a JSON sidecar."""
    root = f"{scratch_dir(t.spark, label)}/store"
    rows = fx.index(t).select("page_id", "url", "lang", "crawl").join(t.pages.select("page_id", "html"), "page_id")

    def store(batches):
        import json

        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for r in batch.to_pylist():
                folder = f"{base}/{r['lang']}/{r['crawl']}/d{r['page_id']}"
                fs.create_dir(folder)
                stem = f"{folder}/T{r['page_id'] % 3}_x"  # stems recur in every crawl and folder
                with fs.open_output_stream(f"{stem}.html", compression=None) as out:
                    out.write(r["html"].encode() + b"\xff")
                if r["page_id"] % 3:
                    meta = {"url": r["url"], "timestamp": f"2022-01-01T{r['page_id']}", "status": 200,
                            "mime_type": "text/html", "crawl_id": r["crawl"], "platform": r["lang"]}
                    with fs.open_output_stream(f"{stem}.json", compression=None) as out:
                        out.write(json.dumps(meta, indent=2).encode())
            yield pa.RecordBatch.from_arrays([batch.column("page_id")], names=["page_id"])

    rows.mapInArrow(store, "page_id long").write.parquet(f"{root}-done")
    return root


def table(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """A written table in the shared scratch folder."""
    path = f"{scratch_dir(spark, label)}/table"
    df.write.parquet(path)
    return spark.read.parquet(path)
