"""The three steps and the sample download as plans over tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.text import blank_to_null
from gleaner.operators.predicates import has_pointer, is_listing
from gleaner.operators.ranking import first_n, limit_by
from gleaner.operators.reports import summary_of_counts
from gleaner.plans.extract_step import entity_slices, entity_table
from gleaner.profiles import SourceProfile, all_profiles
from gleaner.schema import FETCHED, POINTER, STORED
from gleaner.session import scratch_dir
from gleaner.sources import entity_store, page_store, warc
from gleaner.sources.index import source_rows, to_pointers


def index_step(
    index: DataFrame, crawls: list[str] | None = None, profiles: tuple[SourceProfile, ...] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Index rows of every crawl and source in one scan; sorted by URL only when asked, as sorting shuffles."""
    rows = source_rows(index, crawls, profiles or all_profiles())
    return rows.orderBy("url") if ordered else rows


def plan_fetch(
    rows: DataFrame, limit: int | None = None, listings_only: bool = False,
    profiles: tuple[SourceProfile, ...] | None = None,
) -> DataFrame:
    """Pointers to fetch; everything here is slim."""
    pointers = to_pointers(rows).where(has_pointer())
    if listings_only:
        pointers = pointers.where(is_listing(F.col("url"), F.col("platform"), profiles or all_profiles()))
    if limit:
        pointers = first_n(pointers, ["crawl_id", "platform"], ["url", "timestamp", "filename", "offset"], limit).drop("rn")
    return pointers


def fetch_step(pointers: DataFrame, root: str, out: str, lenient: bool = False) -> DataFrame:
    """Read the records that are not stored yet, add them to their slices, and return the failures as a table.

    The planned pointers are written once, with storage key and version; the byte sum, the range sample and the read
    come from that table. Only the touched slices of the store are looked up. Pages and failed records leave in one
    write, told apart by a partition, so page text crosses the disk once. A record that failed is read again next time.
    """
    spark = pointers.sparkSession
    work, run = scratch_dir(spark, "fetch"), uuid.uuid4().hex
    known = {c: F.coalesce(blank_to_null(F.col(c)), F.lit(entity_store.UNKNOWN)) for c in page_store.SLICE}
    pointers.select(*POINTER.fieldNames()).withColumns(known).write.parquet(f"{work}/wanted")
    wanted = spark.read.schema(POINTER).parquet(f"{work}/wanted")
    touched = page_store.slices_of(wanted)
    page_store.new_pointers(wanted, page_store.read_stored(spark, out).where(touched)).write.parquet(f"{work}/pointers")
    planned = spark.read.schema(T.StructType([*POINTER.fields, *STORED.fields])).parquet(f"{work}/pointers")
    # File, offset and length are columns of the record already.
    records = warc.read_ranges(planned, root, carry=tuple(STORED.fieldNames())).withColumn("run", F.lit(run))
    page_store.add_records(warc.to_pages(records, lenient, carry=tuple(FETCHED.fieldNames()), failed=True), out)
    return page_store.read_failed(spark, out).where(touched & (F.col("run") == run)).drop("run")


def extract_step(
    spark: SparkSession, pages: DataFrame, out: str, profiles: tuple[SourceProfile, ...] | None = None
) -> DataFrame:
    """Extract, de-duplicate, publish per crawl and platform, and return the summary of all published slices.

    Slices of the pages that give no entity any more are published empty. The summary adds up stored counts.
    """
    entity_store.publish_entities(entity_table(pages, profiles), out, entity_slices(pages, profiles))
    return summary_of_counts(entity_store.published_counts(spark, out))


def sample_step(rows: DataFrame, wanted: Column, n: int, root: str, out: str) -> DataFrame:
    """Fetch a few pages of one kind into the store at ``out``, and return the failures as a table."""
    return fetch_step(limit_by(to_pointers(rows.where(wanted)).where(has_pointer()), ["url", "timestamp"], n), root, out)
