"""Slices (crawl and platform) that are published whole.

A run stages its tables under a version of its own and then appends one manifest row for every slice it computed, also
for slices without rows. Readers take the last manifest row of each slice and read only that version's folder. So a run
that dies before the manifest leaves nothing that anyone reads, a slice that has become empty has no rows any more, and
several tables (rows and what was counted from them) change together. The manifest has one row per slice and run; only
slice names and versions reach the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["crawl_id", "platform"]
ROWS = "rows"
MANIFEST = T.StructType([
    *[T.StructField(k, T.StringType()) for k in KEYS], T.StructField("version", T.StringType()),
    T.StructField("sequence", T.LongType()), T.StructField("n_rows", T.LongType())])


def _folder(path: str, table: str, version: str) -> str:
    return f"{path.rstrip('/')}/{table}/version={version}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _file_system(spark, path)
    return fs.exists(place)


def qualified(spark: SparkSession, path: str) -> tuple[str, str]:
    """A path with its scheme, as an encoded URI and as Spark writes it."""
    place, fs = _file_system(spark, path)
    full = fs.makeQualified(place)
    return full.toUri().toASCIIString(), full.toString()


def new_version() -> str:
    # The letter keeps a partition value from being read as a number.
    return f"v{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str, version: str, table: str = ROWS) -> DataFrame:
    """Write one table of a run, which nobody reads yet, and give it back as written."""
    (df.hint("rebalance", *[F.col(k) for k in KEYS]).write.partitionBy(*KEYS).parquet(_folder(path, table, version)))
    return df.sparkSession.read.schema(df.schema).parquet(_folder(path, table, version))


def commit(spark: SparkSession, path: str, version: str, processed: DataFrame) -> None:
    """Publish the slices of a staged run: those in ``processed`` and those that have rows."""
    schema = T.StructType(MANIFEST.fields[:2])
    rows = spark.read.schema(schema).parquet(_folder(path, ROWS, version)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    names = processed.select(*KEYS).withColumn("n", F.lit(0).cast("long")).unionByName(rows)
    last = manifest(spark, path).agg(F.max("sequence")).first()[0] or 0
    (names.groupBy(*KEYS).agg(F.sum("n").alias("n_rows"))
     .select(*KEYS, F.lit(version).alias("version"), F.lit(last + 1).cast("long").alias("sequence"), "n_rows")
     .coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/manifest"))


def publish(rows: DataFrame, path: str, processed: DataFrame, derived: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> str:
    """Stage rows and the tables derived from them, then publish all of it; returns the version.

    ``processed`` (crawl_id, platform) names the slices that were computed. Derived tables have the keys as columns.
    """
    version = new_version()
    staged = stage(rows, path, version)
    for table, derive in (derived or {}).items():
        stage(derive(staged), path, version, table)
    commit(rows.sparkSession, path, version, processed)
    return version


def manifest(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path.rstrip('/')}/manifest"
    return spark.read.schema(MANIFEST).parquet(where) if exists(spark, where) else spark.createDataFrame([], MANIFEST)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The valid version of each slice."""
    last = F.max(F.struct("sequence", "version", "n_rows")).alias("_last")
    return manifest(spark, path).groupBy(*KEYS).agg(last).select(*KEYS, "_last.version", "_last.sequence", "_last.n_rows")


def read(spark: SparkSession, path: str, schema: T.StructType, table: str = ROWS, only: Column | None = None) -> DataFrame:
    """Published rows, of the slices that ``only`` (on crawl_id and platform) accepts; no other folder is listed."""
    current = published(spark, path).where("n_rows > 0")
    if only is not None:
        current = current.where(only)
    segment = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    folders = ["/".join([_folder(path, table, r["version"]), *[segment(k, r[k]) for k in KEYS]])
               for r in current.toLocalIterator()]
    if not folders:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(whole).option("basePath", f"{path.rstrip('/')}/{table}").parquet(*folders).select(*schema.fieldNames())


def vacuum(spark: SparkSession, path: str, keep_hours: float = 24.0) -> list[str]:
    """Delete versions of which no slice is valid any more, unless they are younger than ``keep_hours``."""
    valid = {r["version"] for r in published(spark, path).select("version").distinct().toLocalIterator()}
    place, fs = _file_system(spark, path)
    gone = []
    for table in fs.listStatus(place):
        if not table.isDirectory() or table.getPath().getName() == "manifest":
            continue
        for folder in fs.listStatus(table.getPath()):
            version = folder.getPath().getName().removeprefix("version=")
            if version not in valid and folder.getModificationTime() <= (time.time() - keep_hours * 3600) * 1000:
                fs.delete(folder.getPath(), True)
                gone.append(f"{table.getPath().getName()}/{version}")
    return gone
