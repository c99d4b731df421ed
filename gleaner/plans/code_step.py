"""Sources whose pages are read by a function of the user: pages to entity rows, batch by batch.

The function runs in the Python workers on one page at a time and may give any number of rows. Batches of pages and of
rows are bounded by bytes, pages are never shuffled, and a page on which the function fails gives one row with the error
instead of its entities.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.functions.numbers import crawl_date_text
from gleaner.functions.urls import city_from_url
from gleaner.operators.predicates import excluded
from gleaner.profiles import SourceProfile
from gleaner.schema import ENTITY, ENTITY_DEFAULTS

MAX_ROWS, MAX_BYTES = 10_000, 16 << 20
_PAGE = ("url", "timestamp", "date", "city", "crawl_id")


def _flag(value) -> bool:
    if not isinstance(value, bool):
        raise ValueError(value)
    return value


_READ = {T.StringType: str, T.DoubleType: float, T.LongType: int, T.BooleanType: _flag,
         T.ArrayType: lambda values: [str(v) for v in values if v is not None]}
_READERS = {f.name: _READ[type(f.dataType)] for f in ENTITY.fields}


def _cell(name: str, value):
    """A value as the column's type; one that cannot be read is no value."""
    if value is not None:
        try:
            return _READERS[name](value)
        except (TypeError, ValueError, OverflowError):
            value = None
    return [] if name == "categories" else ENTITY_DEFAULTS.get(name, value)


def _entity(fields: dict, page: dict, platform: str) -> list:
    unknown = set(fields) - set(_READERS)
    if unknown:
        raise ValueError(f"not entity columns: {sorted(unknown)}")
    whole = {"platform": platform, "city": page["city"], "date": page["date"], "source_url": page["url"],
             "crawl_id": page["crawl_id"], **fields}
    return [_cell(name, whole.get(name)) for name in _READERS]


def code_rows(pages: DataFrame, source: SourceProfile, carry: tuple[str, ...] = ()) -> DataFrame:
    """(carry, pos, error, entity columns): what ``source.rows(html, page)`` gives for each page of the source.

    ``page`` has url, timestamp, date, city and crawl_id, and the function gives dictionaries of entity columns, which
    may leave out what the page says. A page without text is not read. Either ``error`` or the entity is set.
    """
    url = F.coalesce("url", F.lit(""))
    df = pages.where((F.col("platform") == source.key) & F.col("html").isNotNull())
    if source.excluded_paths:
        df = df.where(~excluded(url, source.excluded_paths))
    df = df.select(
        *[F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)], url.alias("url"), "html", "timestamp", "crawl_id",
        crawl_date_text(F.col("timestamp")).alias("date"), city_from_url(url, source.city_steps).alias("city"))
    read, platform = source.rows, source.name
    carried = [T.StructField(f"carried_{i}", pages.schema[c].dataType) for i, c in enumerate(carry)]
    schema = T.StructType([*carried, T.StructField("pos", T.IntegerType()), T.StructField("error", T.StringType()),
                           *[T.StructField(f"e_{f.name}", f.dataType) for f in ENTITY.fields]])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    blank = [None] * len(ENTITY.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, taken, size = [], [], 0

            def flush():
                head = [batch.column(i).take(pa.array(taken, pa.int64())) for i in range(len(carried))]
                tail = [pa.array([r[j] for r in rows], kinds[len(carried) + j]) for j in range(len(schema) - len(carried))]
                return pa.RecordBatch.from_arrays([*head, *tail], names=schema.fieldNames())

            texts = batch.column("html").to_pylist()
            about = batch.select(list(_PAGE)).to_pylist()
            for i, (html, page) in enumerate(zip(texts, about)):
                try:
                    found = [[pos, None, *_entity(fields, page, platform)] for pos, fields in enumerate(read(html, page))]
                except Exception as e:  # user code: the page is reported, the others go on
                    found = [[0, f"{type(e).__name__}: {e}", *blank]]
                for row in found:
                    rows.append(row)
                    taken.append(i)
                    size += sum(len(v) for v in row if isinstance(v, str)) + 100
                    if len(rows) >= MAX_ROWS or size >= MAX_BYTES:
                        yield flush()
                        rows, taken, size = [], [], 0
            if rows:
                yield flush()

    out = df.mapInArrow(run, schema)
    return out.select(
        *[F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)], "pos", "error",
        *[F.col(f"e_{f.name}").alias(f.name) for f in ENTITY.fields])
