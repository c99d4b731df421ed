"""Entity slices, their CSV form and the summaries built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.text import blank_to_null, path_safe, pipe_to_list
from gleaner.operators import reports
from gleaner.schema import ENTITY, ENTITY_COLUMNS, S, export_columns
from gleaner.session import scratch_dir
from gleaner.sources import slices

UNKNOWN = "unknown"
# Key of a NULL in a summary document, apart from every value a name can have.
NO_KEY = "\u0000"
LEVEL_KEYS = {"by_platform": "platform", "by_crawl": "crawl_id", "by_city": "city", "by_date": "date"}
_CSV = T.StructType([T.StructField(f.name, S if f.name == "categories" else f.dataType) for f in ENTITY.fields])


def with_slice_keys(df: DataFrame) -> DataFrame:
    """Partition keys of an entity row; absent ones become ``unknown``."""
    keys = {c: path_safe(F.coalesce(blank_to_null(F.col(c)), F.lit(UNKNOWN))) for c in ("crawl_id", "platform")}
    return df.withColumns(keys)


def write_entities(df: DataFrame, path: str, processed: DataFrame | None = None) -> None:
    """One Parquet slice per crawl and platform; slices present in the input are replaced, others stay.

    ``processed`` (crawl_id, platform) names the slices the input was made from: those that gave no entity this time
    lose their old rows. The rebalance keeps a slice in few files, yet splits one that is too large for one task.
    """
    rows = with_slice_keys(df).select(*ENTITY_COLUMNS)
    empty = None
    if processed is not None:
        # The new rows are staged, so that they are made once and may come from the store itself.
        spark, staged = df.sparkSession, scratch_dir(df.sparkSession, "staged")
        rows.write.parquet(f"{staged}/rows")
        rows = spark.read.schema(ENTITY).parquet(f"{staged}/rows")
        keys = ["crawl_id", "platform"]
        with_slice_keys(processed).select(*keys).distinct().join(rows.select(*keys).distinct(), keys, "left_anti").write.parquet(
            f"{staged}/empty")
        empty = spark.read.schema("crawl_id string, platform string").parquet(f"{staged}/empty")
    (rows.hint("rebalance", F.col("crawl_id"), F.col("platform")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("crawl_id", "platform").parquet(path))
    if empty is not None:
        _clear(empty, path)


def _clear(slices: DataFrame, path: str) -> None:
    """Delete stored slices. The driver sees their names, one after the other."""
    spark = slices.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in slices.toLocalIterator():
        place = folder(f"{path.rstrip('/')}/crawl_id={escape(r['crawl_id'])}/platform={escape(r['platform'])}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_entities(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """All slices as one table. ``merge`` reconciles slices written with different columns."""
    if merge:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(ENTITY).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and the 22 export columns."""
    export_columns(df).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV form back to entity types; an explicit schema spares the inference pass.

    Cells may hold line breaks, so a file is not split; the sink writes one file per task.
    """
    df = spark.read.schema(_CSV).option("header", "true").option("escape", '"').option("multiLine", "true").csv(path)
    return df.withColumn("categories", pipe_to_list(F.col("categories"))).select(*ENTITY_COLUMNS)


def summary_lines(counts: DataFrame) -> DataFrame:
    """Aggregated counts as JSON documents ``{level: {key: n}}``.

    Every line holds one entry and the documents add up, so no level is gathered in one place.
    """
    key = F.lit("all")
    for level, column in LEVEL_KEYS.items():
        key = F.when(F.col("level") == level, F.coalesce(F.col(column), F.lit(NO_KEY))).otherwise(key)
    return counts.select(F.to_json(F.create_map("level", F.create_map(key, "n"))).alias("value"))


def nested_summary_lines(counts: DataFrame) -> DataFrame:
    """Two-level counts as JSON documents ``{level: {key: {key: n}}}``, which add up like the others."""
    def known(column: str):
        return F.coalesce(F.col(column), F.lit(NO_KEY))

    first = F.when(F.col("level") == "by_crawl_platform", known("crawl_id")).otherwise(known("platform"))
    second = F.when(F.col("level") == "by_crawl_platform", known("platform")).otherwise(known("city"))
    inner = F.create_map(first, F.create_map(second, "n"))
    return counts.select(F.to_json(F.create_map("level", inner)).alias("value"))


def read_summary_lines(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.text(path).select(
        F.explode_outer(F.from_json("value", "map<string,map<string,bigint>>")).alias("level", "m"))
    return df.select("level", F.explode("m").alias("key", "n")).withColumn("key", F.nullif("key", F.lit(NO_KEY)))


def read_nested_summary_lines(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.text(path).select(
        F.explode_outer(F.from_json("value", "map<string,map<string,map<string,bigint>>>")).alias("level", "m"))
    df = df.select("level", F.explode("m").alias("first", "m")).select("level", "first", F.explode("m").alias("second", "n"))
    return df.withColumns({c: F.nullif(c, F.lit(NO_KEY)) for c in ("first", "second")})


def write_summary_lines(counts: DataFrame, path: str) -> None:
    summary_lines(counts).write.mode("overwrite").text(path)


def write_nested_summary_lines(counts: DataFrame, path: str) -> None:
    nested_summary_lines(counts).write.mode("overwrite").text(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """Summary table as Parquet and CSV."""
    summary.write.mode("overwrite").parquet(f"{path}/parquet")
    stored = summary.sparkSession.read.schema(summary.schema).parquet(f"{path}/parquet")
    stored.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


COUNTS = T.StructType([T.StructField(c, S) for c in ("crawl_id", "platform", "city", "date")] + [T.StructField("n", T.LongType())])
SKETCHES = T.StructType([T.StructField("crawl_id", S), T.StructField("platform", S), T.StructField("sketch", T.BinaryType())])


def publish_entities(df: DataFrame, path: str, processed: DataFrame) -> None:
    """Publish entity slices with their counts and distinct-address sketches; see ``slices``.

    ``processed`` (crawl_id, platform as in the entities) names the slices the rows were made from: those that gave no
    entity this time have none afterwards. Counts and sketches are made from the new rows only.
    """
    slices.publish(
        with_slice_keys(df).select(*ENTITY_COLUMNS), path, with_slice_keys(processed),
        {"counts": reports.slice_counts, "sketches": reports.slice_sketches})


def read_published(spark: SparkSession, path: str, only: Column | None = None) -> DataFrame:
    return slices.read(spark, path, ENTITY, only=only)


def published_counts(spark: SparkSession, path: str) -> DataFrame:
    """Entities per crawl, platform, city and date, as counted slice by slice when they were published."""
    return slices.read(spark, path, COUNTS, "counts")


def published_sketches(spark: SparkSession, path: str) -> DataFrame:
    return slices.read(spark, path, SKETCHES, "sketches")


def load_crawls(spark: SparkSession, entities: DataFrame, crawls: list[str], path: str) -> DataFrame:
    """Replace the published slices of the named crawls; the summary adds up the counts of all slices.

    Entities of other crawls are neither read nor counted again.
    """
    named = F.col("crawl_id").isin(*crawls)
    publish_entities(entities.where(named), path, slices.published(spark, path).where(named))
    return reports.summary_of_counts(published_counts(spark, path))
