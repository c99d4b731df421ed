"""What several operators share: written tables between steps, components of a link table, keeping decided rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.session import scratch_dir

# Texts vary from nothing to many megabytes, so Arrow batches are bounded by bytes as well as rows.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


class Work:
    """Tables written below the shared checkpoint folder; a lost executor costs no more than one step."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self._count = spark, scratch_dir(spark, label), 0

    def save(self, df: DataFrame, name: str, lean: bool = False) -> DataFrame:
        """Write a table and read it back, which cuts the lineage; ``lean`` deletes the write's shuffle files at its end."""
        self._count += 1
        path = f"{self.root}/{name}-{self._count}"
        self._write(lean, lambda: df.write.option("compression", "zstd").parquet(path))
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._work_path = path
        return saved

    def table_name(self, name: str) -> str:
        return f"{name}_{uuid.uuid4().hex}"

    def save_buckets(self, df: DataFrame, key: str, buckets: int, name: str, table: str | None = None,
                     lean: bool = False) -> DataFrame:
        """Write a table in buckets of a key, which later joins on that key read without a shuffle.

        Rows are added to ``table`` where one is named.
        """
        table = table or self.table_name(name)
        self._write(lean, lambda: df.write.option("compression", "zstd").option(
            "path", f"{self.root}/{table}").bucketBy(buckets, key).mode("append").saveAsTable(table))
        return self.spark.table(table)

    def _write(self, lean: bool, write: Callable[[], None]) -> None:
        conf = self.spark.conf
        before = conf.get(SHUFFLE_CLEANUP)
        conf.set(SHUFFLE_CLEANUP, "true" if lean else before)
        try:
            write()
        finally:
            conf.set(SHUFFLE_CLEANUP, before)

    def drop(self, saved: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(saved._work_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(work: Work, links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): the smallest node reachable.

    Alternates large-star and small-star steps over written tables until nothing changes. Every step is a
    grouped minimum, combined before the shuffle, and a join that AQE may split, so a hub is no hot task.
    """
    u, v = F.col("u"), F.col("v")
    edges = work.save(
        links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(v > u).join(least, "u")
                 .select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct())
        large = work.save(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.when(v == F.col("m"), u).otherwise(v).alias("u"), F.col("m").alias("v"))
                 .where(u != v).distinct())
        smaller = work.save(small, "small")
        work.drop(large)
        work.drop(edges)
        edges = smaller
    roots = edges.select(v.alias("node"), v.alias("component")).distinct()
    return edges.select(u.alias("node"), v.alias("component")).unionByName(roots)


def keep_rows(work: Work, docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``found`` (doc_id, digest, keep) keeps; of rows with one id and text one stays.

    ``digest`` is the binary SHA-256 of the text, a null text counting as empty. Null ids match null ids. Decisions are
    slim; what is dropped is taken off by an anti join, and only ids that repeat with their text are ranked, by all
    columns, so that the row that stays is always the same. The decisions may be many, so they are never broadcast: the
    join deals both sides by id and digest at every size, and only the slim side is held in memory, a partition at a time.
    """
    digest, rank = free_name(docs, "digest_"), free_name(docs, "rank_")
    tagged = docs.withColumn(digest, F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
    decided = work.save(found.groupBy("doc_id", "digest").agg(
        F.max("keep").alias("keep"), (F.count(F.lit(1)) > 1).alias("repeats")).where("repeats OR NOT keep").select(
            F.col("doc_id").alias("found_id_"), F.col("digest").alias("found_digest_"), "keep"), "decided")
    same = tagged[id_col].eqNullSafe(decided["found_id_"]) & (tagged[digest] == decided["found_digest_"])
    single = tagged.join(decided.hint("shuffle_hash"), same, "left_anti").select(*docs.columns)
    if not decided.where("keep").limit(1).count():
        return single
    again = tagged.join(decided.where("keep").hint("shuffle_hash"), same, "left_semi")
    order = Window.partitionBy(id_col, digest).orderBy(F.to_json(F.struct(*[again[c] for c in docs.columns])))
    first = again.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)
    return single.unionByName(first)
