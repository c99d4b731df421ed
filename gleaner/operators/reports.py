"""Counts, pivots and histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import blank_to_null
from gleaner.functions.urls import NO_DOMAIN, host
from gleaner.operators.ranking import first_n, top_per_group
from gleaner.profiles import PROFILES, SourceProfile

# JSON-LD types a reader of the report need not look at.
HANDLED_TYPES = (
    "Restaurant", "LocalBusiness", "FoodEstablishment", "FoodService", "Store", "ItemList", "SearchResultsPage",
    "ListItem", "WebSite", "WebPage", "BreadcrumbList", "Organization",
)
FOOD_WORDS = ("food", "menjar", "comida", "restaur", "cocina", "cuina")


def n_rows() -> Column:
    return F.count(F.lit(1))


def _grouping_sets(df: DataFrame, sets: list[tuple[str, ...]], level: str, n: Column | None = None) -> DataFrame:
    """One Expand and one aggregation for several groupings; ``level`` names the grouping, ``n`` counts."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        (n_rows() if n is None else n).alias("n"), F.grouping_id().alias("_gid"))
    ids = {}
    for s in sets:
        gid = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s)
        ids[gid] = "total" if not s else "by_" + "_".join(c.removesuffix("_id") for c in s)
    name = reduce(lambda w, kv: w.when(F.col("_gid") == kv[0], kv[1]), ids.items(), F)
    return out.withColumn(level, name).drop("_gid")


def summary_counts(df: DataFrame) -> DataFrame:
    """Counts by platform, crawl, city and date, and the grand total, in one pass."""
    return _grouping_sets(df, [("platform",), ("crawl_id",), ("city",), ("date",), ()], "level")


def nested_counts(df: DataFrame) -> DataFrame:
    """Counts by crawl and platform and by platform and city."""
    return _grouping_sets(df, [("crawl_id", "platform"), ("platform", "city")], "level")


def slice_counts(df: DataFrame) -> DataFrame:
    """What every summary level adds up from: entities per crawl, platform, city and date."""
    return df.groupBy("crawl_id", "platform", "city", "date").agg(n_rows().alias("n"))


def summary_counts_of(counts: DataFrame) -> DataFrame:
    """``summary_counts`` from slice counts."""
    return _grouping_sets(counts, [("platform",), ("crawl_id",), ("city",), ("date",), ()], "level", F.sum("n"))


def nested_counts_of(counts: DataFrame) -> DataFrame:
    """``nested_counts`` from slice counts."""
    return _grouping_sets(counts, [("crawl_id", "platform"), ("platform", "city")], "level", F.sum("n"))


def summary_of_counts(counts: DataFrame) -> DataFrame:
    """``summary_table`` from slice counts."""
    keys = ["crawl_id", "platform", "city"]
    return counts.groupBy(*keys).agg(F.sum("n").alias("restaurant_count")).orderBy(*keys)


# Sketches of 2^12 registers: the relative standard error is 1.04 / sqrt(4096), of which four are allowed.
SKETCH_BITS = 12
SKETCH_ERROR = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)


def slice_sketches(df: DataFrame, column: str = "restaurant_url") -> DataFrame:
    """Mergeable distinct sketch of the addresses of each crawl and platform; blank ones do not count."""
    known = blank_to_null(F.col(column))
    return df.groupBy("crawl_id", "platform").agg(F.hll_sketch_agg(known, SKETCH_BITS).alias("sketch"))


def distinct_rollup(sketches: DataFrame) -> DataFrame:
    """Estimated distinct addresses per slice, crawl, platform and in all, from stored sketches alone.

    ``low`` and ``high`` bound the exact number with a chance of failure below one in ten thousand.
    """
    sets = [("crawl_id", "platform"), ("crawl_id",), ("platform",), ()]
    merged = _grouping_sets(sketches, sets, "level", F.hll_sketch_estimate(F.hll_union_agg("sketch")))
    return merged.withColumnRenamed("n", "estimate").withColumns({
        "low": F.floor(F.col("estimate") / (1 + SKETCH_ERROR)), "high": F.ceil(F.col("estimate") / (1 - SKETCH_ERROR))})


def with_exact(rollup: DataFrame, df: DataFrame, wanted: Column, column: str = "restaurant_url") -> DataFrame:
    """The roll-up with exact numbers for the slices that ``wanted`` (on crawl_id and platform) names.

    Only the rows of those slices are read; all other rows of the roll-up have a null there.
    """
    exact = df.where(wanted).groupBy("crawl_id", "platform").agg(
        F.countDistinct(blank_to_null(F.col(column))).alias("exact")).withColumn("level", F.lit("by_crawl_platform"))
    return rollup.join(exact, ["level", "crawl_id", "platform"], "left")


def summary_table(df: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """Entities per crawl, platform and city, sorted."""
    keys = ["crawl_id", "platform", "city"]
    if drop_null_keys:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(n_rows().alias("restaurant_count")).orderBy(*keys)


def platform_pivot(df: DataFrame, platforms: list[str]) -> DataFrame:
    """Crawls by platforms with a row total; absent cells are zero."""
    wide = df.groupBy("crawl_id").pivot("platform", platforms).count().na.fill(0)
    total = reduce(lambda a, b: a + b, [F.col(f"`{p}`") for p in platforms])
    return wide.withColumn("total", total)


def summary_stats(summary: DataFrame) -> DataFrame:
    return summary.agg(
        n_rows().alias("n_rows"), F.countDistinct("crawl_id").alias("n_crawls"),
        F.countDistinct("platform").alias("n_platforms"), F.countDistinct("city").alias("n_cities"),
        F.sum("restaurant_count").alias("n_restaurants"))


def with_total(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key with subtotal and grand-total rows, where the dropped keys are NULL."""
    return df.rollup(*keys).agg(n_rows().alias("n"), F.grouping_id().alias("level"))


def unique_urls(df: DataFrame) -> DataFrame:
    return df.groupBy("platform", "crawl_id").agg(
        n_rows().alias("n"), F.countDistinct("url").alias("n_unique"))


def fill_rate(df: DataFrame, column: str, threshold: float = 10.0) -> DataFrame:
    """Share of rows with a value per platform and crawl."""
    pct = F.avg(F.col(column).isNotNull().cast("double")) * 100
    return df.groupBy("platform", "crawl_id").agg(
        n_rows().alias("total"), F.count(column).alias("filled"), F.round(pct, 4).alias("fill_pct"),
        F.when(pct > threshold, "OK").otherwise("LOW").alias("status"))


def url_presence(df: DataFrame, column: str = "restaurant_url") -> DataFrame:
    present = F.coalesce(F.col(column) != "", F.lit(False)).cast("double")
    return df.groupBy("platform").agg(F.round(F.avg(present) * 100, 4).alias("url_pct"))


def host_histogram(
    df: DataFrame, expected: dict[str, tuple[str, ...]], top: int = 5, column: str = "restaurant_url"
) -> DataFrame:
    """Hosts per platform over all URLs: the most frequent ones, and every one without an expected ending, flagged."""
    rows = df.where(blank_to_null(F.col(column)).isNotNull()).withColumn("host", host(F.col(column)))
    counts = rows.groupBy("platform", "host").agg(n_rows().alias("n"))
    usual = F.lit(False)
    for platform, ends in expected.items():
        for end in ends:
            usual |= (F.col("platform") == platform) & F.col("host").endswith(end)
    order = Window.partitionBy("platform").orderBy(F.desc("n"), "host")
    flagged = counts.withColumn("unexpected", (F.col("host") != NO_DOMAIN) & ~usual)
    return flagged.withColumn("rn", F.row_number().over(order)).where((F.col("rn") <= top) | F.col("unexpected"))


def type_histogram(types: DataFrame, top: int = 10, loud: int = 5) -> DataFrame:
    """JSON-LD types per platform; frequent ones nobody handles are flagged."""
    counts = top_per_group(types, ["platform"], "type", top)
    return counts.withColumn("unhandled", ~F.col("type").isin(*HANDLED_TYPES) & (F.col("n") > loud))


def segment_histogram(df: DataFrame, segment_pattern: str, category_pattern: str, top: int = 20) -> DataFrame:
    """URL segments of pages without a category in the URL; food-like ones are flagged."""
    segment = F.regexp_replace(F.regexp_extract("url", segment_pattern, 1), r"_\d+$", "")
    rows = df.where(~F.col("url").rlike(category_pattern)).withColumn("segment", segment)
    rows = rows.where(F.col("segment").rlike("^[a-z]"))
    counts = rows.groupBy("segment").agg(n_rows().alias("n")).orderBy(F.desc("n"), "segment").limit(top)
    return counts.withColumn("food_like", F.lower("segment").rlike("|".join(FOOD_WORDS)))


def category_share(df: DataFrame, category_pattern: str) -> DataFrame:
    has = F.col("url").rlike(category_pattern)
    return df.agg(
        F.count_if(has).alias("with_category"), n_rows().alias("total"),
        F.round(F.avg(has.cast("double")) * 100, 4).alias("pct"))


def marker_counts(pages: DataFrame, marker: str) -> DataFrame:
    """Pages with and without the marker anywhere in their text, per crawl; a NULL text is without."""
    has = F.coalesce(F.contains(F.col("html"), F.lit(marker)), F.lit(False))
    return pages.select("crawl_id", has.alias("has")).groupBy("crawl_id").agg(
        F.count_if("has").alias("with_marker"), F.count_if(~F.col("has")).alias("without_marker"))


def issue_histogram(issues: DataFrame, column: str = "issue") -> DataFrame:
    """Issues by the part before the colon, most common first."""
    kind = F.split_part(column, F.lit(":"), F.lit(1))
    return issues.groupBy(kind.alias("category")).agg(n_rows().alias("n")).orderBy(F.desc("n"), "category")


def path_patterns(df: DataFrame, bucket: Column, more_than: int, top: int = 30) -> DataFrame:
    """Frequent path buckets."""
    counts = df.groupBy(bucket.alias("pattern")).agg(n_rows().alias("cnt")).where(F.col("cnt") > more_than)
    return counts.orderBy(F.desc("cnt"), "pattern").limit(top)


def structure_profile(features: DataFrame, profiles: tuple[SourceProfile, ...] = PROFILES) -> DataFrame:
    """Per platform and crawl: pages, kinds of page, pages with JSON-LD and with embedded state."""
    kinds = [F.count_if(F.col("estimated_type") == k).alias(f"n_{k}") for k in ("listing", "detail", "other")]
    return features.groupBy("platform", "crawl_id").agg(
        n_rows().alias("total_files"), *kinds, F.count_if("has_json_ld").alias("n_json_ld"),
        F.count_if(F.col("has_next_data") | F.col("has_initial_state")).alias("n_state"))


def structure_types(features: DataFrame) -> DataFrame:
    """Per platform and crawl: how many pages declare each JSON-LD type."""
    types = features.select("platform", "crawl_id", F.explode(F.array_distinct("json_ld_types")).alias("type"))
    return types.groupBy("platform", "crawl_id", "type").agg(n_rows().alias("n_pages"))


def first_per_crawl(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    return first_n(df, ["crawl_id"], order_by, n)
