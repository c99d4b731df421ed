"""Incremental extraction: newly arrived page slices replace their entity slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gleaner.plans.extract_step import entity_slices, entity_table
from gleaner.profiles import SourceProfile
from gleaner.schema import PAGE
from gleaner.session import scratch_dir
from gleaner.sources import entity_store, page_store


def only_slices(pages: DataFrame, slices: DataFrame) -> DataFrame:
    """Pages of the given slices: a semi join on the partition columns, which Spark prunes at run time."""
    return pages.join(slices, ["platform", "crawl_id"], "left_semi")


def watch_pages(
    spark: SparkSession, pages: str, out: str, checkpoint: str, profiles: tuple[SourceProfile, ...] | None = None
) -> StreamingQuery:
    """Process the page files that arrived in the page store since the last run, then stop.

    A crawl slice is complete when its files appear, so each micro-batch recomputes the touched slices from
    the whole stored slice and publishes them anew, also those that give no entity any more; replaying a batch gives
    the same result.
    """

    def replace(batch: DataFrame, _: int) -> None:
        where = scratch_dir(spark, "touched")
        batch.select("platform", "crawl_id").distinct().write.parquet(where)
        touched = spark.read.schema("platform string, crawl_id string").parquet(where)
        stored = page_store.read_pages(spark, pages)
        fresh = entity_table(only_slices(stored, touched), profiles)
        entity_store.publish_entities(fresh, out, entity_slices(touched, profiles))

    stream = spark.readStream.schema(PAGE).parquet(page_store.place(pages)).select("platform", "crawl_id")
    return (stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
