"""Tables laid out for the reads that follow: clustered files with their ranges, and buckets that join in place."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.schema import INDEX
from gleaner.sources.index import check_crawl_ids

FILE_ROWS = 2_000_000
_CLUSTER = ["crawl", "subset", "url_host_registered_domain", "url_path"]
RANGES = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("crawl", T.StringType()), T.StructField("subset", T.StringType()),
    T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("n_rows", T.LongType())])


def write_clustered_index(df: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Store an index in files of neighbouring domains and paths, with the domain range of every file beside them.

    Range partitions follow the keys, so a hot domain spans several files and rare ones share one. Parquet bloom filters
    on domain and URL serve lookups within a file. Rows without a domain come first and have no range.
    """
    spark = df.sparkSession
    files = max(1, -(-df.count() // file_rows))
    (df.select(*INDEX.fieldNames()).repartitionByRange(files, *_CLUSTER).sortWithinPartitions(*_CLUSTER, "url")
     .write.mode("overwrite").partitionBy("crawl", "subset")
     .option("parquet.bloom.filter.enabled#url_host_registered_domain", "true")
     .option("parquet.bloom.filter.enabled#url", "true").parquet(f"{path}/rows"))
    domain = F.col("url_host_registered_domain")
    (spark.read.schema(INDEX).parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias("file"), "crawl", "subset")
     .agg(F.min(domain).alias("first"), F.max(domain).alias("last"), F.count(F.lit(1)).alias("n_rows"))
     .write.mode("overwrite").parquet(f"{path}/ranges"))


def read_clustered_index(spark: SparkSession, path: str, domains: list[str], crawls: list[str] | None = None) -> DataFrame:
    """Rows of the domains, from the files whose range holds one of them. Only those file names reach the driver."""
    wanted = spark.createDataFrame([(d,) for d in set(domains)], "domain string")
    ranges = spark.read.schema(RANGES).parquet(f"{path}/ranges")
    if crawls is not None:
        check_crawl_ids(crawls)
        ranges = ranges.where(F.col("crawl").isin(*crawls))
    hits = ranges.join(F.broadcast(wanted), F.col("domain").between(F.col("first"), F.col("last")), "left_semi")
    files = [r["file"] for r in hits.select("file").distinct().toLocalIterator()]
    if not files:
        return spark.createDataFrame([], INDEX)
    rows = spark.read.schema(INDEX).option("basePath", f"{path}/rows").parquet(*files)
    return rows.where(F.col("url_host_registered_domain").isin(*domains))


def bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table in buckets of the keys and read it back so that joins on all of the keys need no exchange.

    Tables that are joined must have the same keys and number of buckets. The catalog only knows the table while it is
    written; its files stay at ``path``.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def bucket_count(n_bytes: int, bucket_bytes: int = 128 << 20) -> int:
    """Number of buckets for a table of so many bytes: a power of two, so that grown tables still fit older ones."""
    return 1 << max(0, (max(1, n_bytes) - 1) // bucket_bytes).bit_length()
