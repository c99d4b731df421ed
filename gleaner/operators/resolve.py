"""Duplicates, fallback order and set operations on tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import blank_to_null, comparison_key

_RN, _KEY = "_rn", "_key"


def first_per_key(df: DataFrame, keys: list[Column], order_by: list[Column | str], rank: str = _RN) -> DataFrame:
    """First row per key. The rank limit runs before the shuffle, so a hot key sends one row per task.

    A hash of the key leads the window's sort: addresses share their first bytes, which makes the sort prefix
    useless, while the hash decides almost every comparison at once.
    """
    return _first(df, Window.partitionBy(F.xxhash64(*keys), *keys), order_by, rank)


def _first(df: DataFrame, groups, order_by: list[Column | str], rank: str = _RN) -> DataFrame:
    return df.withColumn(rank, F.row_number().over(groups.orderBy(*order_by))).where(F.col(rank) == 1).drop(rank)


def key_digest(keys: list[Column]) -> Column:
    """16 bytes of the SHA-256 of a key's texts; lengths keep the parts apart, and NULL from an empty text.

    Among n distinct keys about n * n / 2^129 pairs are taken for one: less than one in 10^18 for 10^10 keys.
    """
    parts = []
    for k in keys:
        parts += [F.coalesce(F.octet_length(k).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(k, F.lit(""))]
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def duplicate_key(trim: bool = False, cell: Callable[[str], Column] = F.col) -> list[Column]:
    """Address and crawl where the row has an address, else name, platform, city and crawl."""
    url = blank_to_null(cell("restaurant_url"))
    named = url.isNull()
    crawl = F.coalesce(cell("crawl_id"), F.lit(""))

    def norm(c: str) -> Column:
        return F.when(named, comparison_key(cell(c), trim))

    return [url, norm("name"), F.when(named, F.coalesce(cell("platform"), F.lit(""))), norm("city"), crawl]


def drop_duplicates_first(df: DataFrame, order_by: list[Column | str], trim: bool = False,
                          cells: dict[str, Column] | None = None) -> DataFrame:
    """Two-strategy de-duplication in one pass; ``order_by`` must be a total order and decides the winner.

    ``cells`` are columns that the result gets, made from those of ``df``. The key may name them, yet they are made for
    the rows that stay only: what is sorted and shuffled are the columns of ``df`` that they need. Rows go with a digest
    of their key, as the key itself is long and repeats cells of the row.
    """
    cells = cells or {}
    digest = key_digest(duplicate_key(trim, lambda c: cells[c] if c in cells else F.col(c)))
    first = _first(df.withColumn(_KEY, digest), Window.partitionBy(_KEY), order_by)
    kept = [F.col(c) for c in df.columns if c not in cells]
    return first.select(*kept, *[c.alias(name) for name, c in cells.items()])


def duplicate_report(df: DataFrame, trim: bool = False) -> DataFrame:
    """Rows before, after and removed; keys are pre-aggregated, so no ranking is needed."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(duplicate_key(trim))]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        total.alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
        (total - F.count(F.lit(1))).alias("rows_removed"))


def first_in_page(df: DataFrame, page_key: list[str], name: str = "name", order_by: str = "pos") -> DataFrame:
    """First row per page and lower-case name."""
    return first_per_key(df, [*[F.col(k) for k in page_key], F.lower(name)], [order_by])


def bag_union(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def first_branch(df: DataFrame, page_key: list[str], priority: str = "priority") -> DataFrame:
    """Rows of the best branch that gave any row for the page.

    The best priority is aggregated per page and joined back, so that one page with very many rows stays
    spread over tasks.
    """
    best = df.groupBy(*page_key).agg(F.min(priority).alias("_best"))
    return df.join(best, page_key).where(F.col(priority) == F.col("_best")).drop("_best")


def additive_branches(
    df: DataFrame, page_key: list[str], detail: Column, main: str = "jsonld", extra: str = "script"
) -> DataFrame:
    """Main and extra rows together, without the extra ones on detail pages that have main rows.

    One flag per page is aggregated, combined before the shuffle, and joined back.
    """
    flags = df.groupBy(*page_key).agg(F.bool_or((F.col("branch") == main) & detail).alias("_main"))
    drop = (F.col("branch") == extra) & detail & F.col("_main")
    return df.join(flags, page_key).where(~F.coalesce(drop, F.lit(False))).drop("_main")


def distinct_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.select(url).distinct()


def missing_names(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted (page, name) pairs that are not present."""
    return wanted.join(present.select(*keys), keys, "left_anti")
