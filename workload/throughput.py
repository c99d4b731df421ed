"""Page extraction speed from a stored page table to entity rows."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gleaner.operators.resolve import bag_union
from gleaner.plans.extract_step import extract_entities
from gleaner.session import scratch_dir
from gleaner.sources import page_store
from workload import fixtures as fx
from workload.registry import Tables


def extraction(spark: SparkSession, folder: str, copies: int = 8) -> tuple[int, int, float]:
    """Pages, rows and seconds for pages of every kind, repeated to keep the cores busy."""
    t = Tables(spark, folder)
    pages = bag_union(
        fx.linked_pages(t), fx.keyed_pages(t), fx.tree_pages(t), fx.script_pages(t), fx.card_pages(t))
    more = pages.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_i", "page_id")
    path = f"{scratch_dir(spark, 'throughput')}/pages"
    page_store.write_pages(more, path)
    stored = page_store.read_pages(spark, path)
    n_pages = stored.count()
    rows = extract_entities(stored)
    n_rows = rows.count()
    start = time.perf_counter()
    rows.write.format("noop").mode("overwrite").save()
    return n_pages, n_rows, time.perf_counter() - start
