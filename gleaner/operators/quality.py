"""Data-quality rules on entities and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.rows import explode_once

# Fixed values.
PLATFORM_NAMES = ("glovo", "just eat", "uber eats", "ubereats", "glovoapp")
BAD_CITY_WORDS = "domicilio|delivery|glovo|banaketa"
LISTING_SIGNALS = ("/restaurantes", "/restaurants_", "/restaurants-", "/city/", "/area/")
SMALL_PAGE, LISTING_PAGE, DUPLICATE_SHARE = 1000, 5000, 0.3


def table_rules(platforms: dict[str, str] | None = None) -> dict[str, Column]:
    """Named rules over an entity row; ``platforms`` maps the site-specific rules to platform names."""
    on = platforms or {"bad_city": "Glovo", "listing_city": "Just Eat", "encoded_city": "Uber Eats"}
    name, city, platform = F.col("name"), F.col("city"), F.col("platform")
    return {
        "HTML_ENTITIES": name.contains("&#"),
        "SHORT_NAMES": F.length(name) <= 2,
        "LONG_NAMES": F.length(name) > 100,
        "HTML_ARTIFACTS": name.rlike("[<>{}]"),
        "PLATFORM_NAME": F.lower(name).isin(*PLATFORM_NAMES),
        "EMPTY_CITY": city.isNull() | (city == ""),
        "BAD_CITIES": (platform == on["bad_city"]) & F.lower(city).rlike(BAD_CITY_WORDS),
        "LISTING_CITY": (platform == on["listing_city"]) & city.startswith("Restaurants"),
        "ENCODED_CITY": (platform == on["encoded_city"]) & city.contains("%"),
        "COUNTRY_SUFFIX": (platform == on["encoded_city"]) & city.contains(", Spain"),
    }


def check_table(df: DataFrame, platforms: dict[str, str] | None = None) -> DataFrame:
    """All rules in one aggregation, as rows of rule, violations and percentage."""
    rules = table_rules(platforms)
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(k) for k, c in rules.items()])
    cells = F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("violations")) for k in rules])
    long = wide.select("_n", F.explode(cells).alias("r"))
    pct = F.when(F.col("_n") > 0, F.round(F.col("r.violations") * 100.0 / F.col("_n"), 4))
    return long.select("r.rule", "r.violations", pct.alias("pct"))


def shared_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key for keys held by more than one row; all members count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def shared_key_rows(df: DataFrame, url: str = "restaurant_url", crawl: str = "crawl_id") -> DataFrame:
    """Per crawl, the rows that share their address with another row."""
    with_url = df.where(F.col(url) != "")
    return shared_keys(with_url, [url, crawl]).groupBy(crawl).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))


def row_issues(df: DataFrame, subject: str = "source_url") -> DataFrame:
    """One row per entity and issue found in it."""
    name, city = F.col("name"), F.col("city")
    rules = {
        "LONG_NAME": F.length(name) > 120,
        "HTML_IN_NAME": name.rlike("[<>{}]"),
        "LONG_CITY": F.length(city) > 60,
        "PLATFORM_AS_NAME": F.lower(name).isin(*PLATFORM_NAMES),
        "HTML_ENTITY": name.contains("&#"),
    }
    tags = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]), lambda t: t.isNotNull())
    return explode_once(df, tags, "check", "platform", "crawl_id", F.col(subject).alias("subject"), "name")


def intra_page_duplicates(df: DataFrame, page_key: list[str]) -> DataFrame:
    """Per page: entities, repeated names, and whether the repeats exceed the accepted share."""
    key = F.coalesce(F.lower("name"), F.lit(""))
    per_name = df.groupBy(*page_key, key.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    pages = per_name.groupBy(*page_key).agg(
        F.sum("_n").alias("n_entities"),
        F.sum(F.when(F.col("_k") != "", F.col("_n") - 1).otherwise(0)).alias("n_repeats"))
    return pages.withColumn("flagged", F.col("n_repeats") > F.col("n_entities") * DUPLICATE_SHARE)


def listing_like(url: Column) -> Column:
    return reduce(lambda a, b: a | b, [url.contains(s) for s in LISTING_SIGNALS])


def page_counts(pages: DataFrame, entities: DataFrame, keys: list[str]) -> DataFrame:
    """Page sizes with the number of entities each page gave; page text is reduced to its length first."""
    slim = pages.select(*keys, "platform", "crawl_id", "url", F.length("html").alias("n_chars"))
    n = entities.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_entities"))
    return slim.join(n, keys, "left").withColumn("n_entities", F.coalesce("n_entities", F.lit(0)))


def page_issues(counts: DataFrame) -> DataFrame:
    """Tiny pages that give rows, and large listing pages that give none."""
    small = (F.col("n_chars") < SMALL_PAGE) & (F.col("n_entities") > 0)
    zero = listing_like(F.col("url")) & (F.col("n_entities") == 0) & (F.col("n_chars") > LISTING_PAGE)
    kind = F.when(small, "SMALL_HTML").when(zero, "ZERO_FROM_LISTING")
    return counts.withColumn("check", kind).where(kind.isNotNull())


def extraction_success(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.select(*keys, (F.col("n_entities") > 0).alias("success"), "n_entities")


def audit_lines(sampled: DataFrame, issues: DataFrame) -> DataFrame:
    """Per platform and crawl: sampled pages, their entities, issues and a status."""
    keys = ["platform", "crawl_id"]
    lines = sampled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("n_entities").alias("n_entities"))
    n = issues.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_issues"))
    out = lines.join(n, keys, "left").withColumn("n_issues", F.coalesce("n_issues", F.lit(0)))
    return out.withColumn(
        "status", F.when(F.col("n_issues") == 0, "OK").otherwise(
            F.concat(F.col("n_issues").cast("string"), F.lit(" issues"))))


def overall(*reports: DataFrame) -> DataFrame:
    """Broken rules of several reports, each with columns check, subject and n."""
    rows = reduce(DataFrame.unionByName, [r.select("check", "subject", "n") for r in reports])
    return rows.where(F.col("n") > 0)
