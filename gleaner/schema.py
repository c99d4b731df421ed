"""Table layouts shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, D, B, I = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INDEX = _struct(
    ("url", S), ("fetch_time", T.TimestampType()), ("fetch_status", I), ("content_mime_detected", S),
    ("warc_filename", S), ("warc_record_offset", L), ("warc_record_length", L),
    ("url_host_registered_domain", S), ("url_host_name", S), ("url_protocol", S), ("url_path", S),
    ("crawl", S), ("subset", S),
)
INDEX_COLUMNS = [
    "url", "fetch_time", "fetch_status", "content_mime_detected",
    "warc_filename", "warc_record_offset", "warc_record_length",
]
POINTER = _struct(
    ("url", S), ("timestamp", S), ("status", I), ("mime", S), ("filename", S),
    ("offset", L), ("length", L), ("crawl_id", S), ("platform", S),
)
PAGE = _struct(
    ("url", S), ("timestamp", S), ("status", I), ("mime_type", S), ("crawl_id", S), ("platform", S), ("html", S),
)
# Where a page is stored: its key, its place among the pages of that key and among those of its timestamp, and the key
# with both worked in.
STORED = _struct(("key", S), ("version", L), ("number", L), ("stored_key", S))
# The record a page came from, which tells it from all others of its slice; the run that read it; why it failed.
RECORD_ID = _struct(("filename", S), ("offset", L))
FETCHED = _struct(*[(f.name, f.dataType) for f in (*STORED, *RECORD_ID)], ("length", L), ("run", S), ("error", S))
ENTITY = _struct(
    ("date", S), ("city", S), ("name", S), ("platform", S), ("address", S), ("neighborhood", S),
    ("food_type", S), ("categories", T.ArrayType(S)), ("rating", D), ("num_ratings", L), ("price_range", S),
    ("delivery_fee", S), ("delivery_time", S), ("min_order", S), ("is_promoted", B), ("is_new", B),
    ("latitude", D), ("longitude", D), ("restaurant_url", S), ("image_url", S), ("source_url", S), ("crawl_id", S),
)
ENTITY_COLUMNS = ENTITY.fieldNames()
SUMMARY_COLUMNS = ["crawl_id", "platform", "city", "restaurant_count"]
ISSUE = _struct(("check", S), ("platform", S), ("crawl_id", S), ("subject", S), ("detail", S), ("n", L))

ENTITY_DEFAULTS = {"is_promoted": False, "is_new": False, "city": ""}


def entity_struct(**fields: Column) -> Column:
    """One entity value with every column of ``ENTITY`` in order."""
    unknown = set(fields) - set(ENTITY_COLUMNS)
    if unknown:
        raise ValueError(f"not entity columns: {sorted(unknown)}")
    cells = []
    for f in ENTITY.fields:
        cell = fields.get(f.name, F.lit(None)).cast(f.dataType)
        if f.name in ENTITY_DEFAULTS:
            cell = F.coalesce(cell, F.lit(ENTITY_DEFAULTS[f.name]))
        elif f.name == "categories":
            cell = F.coalesce(cell, F.array().cast(f.dataType))
        cells.append(cell.alias(f.name))
    return F.struct(*cells)


def no_entities() -> Column:
    """An empty array of entities."""
    return F.array().cast(T.ArrayType(ENTITY))


def select_ordered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project to the given columns in the given order."""
    return df.select(*columns)


def export_columns(df: DataFrame) -> DataFrame:
    """The 22 export columns in order, categories as pipe text."""
    return df.withColumn("categories", F.array_join("categories", "|")).select(*ENTITY_COLUMNS)
