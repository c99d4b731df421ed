"""Row predicates for index rows, pages and entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import blank_to_null
from gleaner.profiles import PROFILES, SourceProfile

# Fixed values.
HTML_MIME, OK_STATUS, WARC_SUBSET, HTTPS = "text/html", 200, "warc", "https"
CRAWL_ID = r"^[A-Za-z0-9\-]+$"


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def valid_crawl_id(c: Column) -> Column:
    return c.rlike(CRAWL_ID)


def source_scope(p: SourceProfile) -> Column:
    """Domain, path prefix and, where the profile names one, host of a source."""
    scope = (F.col("url_host_registered_domain") == p.domain) & F.col("url_path").like(p.path_like)
    return scope & (F.col("url_host_name") == p.host) if p.host else scope


def fetched_html(status: int = OK_STATUS, mime: str | None = HTML_MIME, protocol: str = HTTPS) -> Column:
    test = (
        (F.col("subset") == WARC_SUBSET) & (F.col("url_protocol") == protocol) & (F.col("fetch_status") == status))
    return test & (F.col("content_mime_detected") == mime) if mime else test


def source_key(profiles: tuple[SourceProfile, ...] = PROFILES) -> Column:
    """Key of the source an index row belongs to, NULL for none."""
    return F.coalesce(*[F.when(source_scope(p), F.lit(p.key)) for p in profiles])


def _by_source(platform: Column, profiles: tuple[SourceProfile, ...], test) -> Column:
    """Literal per-source tests: patterns compile once and no lookup join is needed."""
    out = None
    for p in profiles:
        out = (F.when if out is None else out.when)(platform == p.key, test(p))
    return F.coalesce(out.otherwise(False), F.lit(False))


def is_listing(url: Column, platform: Column, profiles: tuple[SourceProfile, ...] = PROFILES) -> Column:
    """Whether any listing pattern of the source is found in the URL; false for unknown sources."""
    return _by_source(platform, profiles, lambda p: any_of([url.rlike(r) for r in p.listing_patterns]))


def is_detail(url: Column, platform: Column, profiles: tuple[SourceProfile, ...] = PROFILES) -> Column:
    return _by_source(platform, profiles, lambda p: any_of([url.rlike(r) for r in p.detail_patterns]))


def page_kind(url: Column, platform: Column, profiles: tuple[SourceProfile, ...] = PROFILES) -> Column:
    return (
        F.when(is_listing(url, platform, profiles), "listing")
        .when(is_detail(url, platform, profiles), "detail").otherwise("other"))


def listing_rows(df: DataFrame, platform: str, profiles: tuple[SourceProfile, ...] = PROFILES) -> DataFrame:
    """Listing pages of one source, with the source attached."""
    return df.where(is_listing(F.col("url"), F.lit(platform), profiles)).withColumn("platform", F.lit(platform))


def excluded(url: Column, tokens: tuple[str, ...]) -> Column:
    """Case-insensitive contains-any."""
    return any_of([F.contains(F.lower(url), F.lit(t)) for t in tokens])


def has_pointer() -> Column:
    """Rows that can be fetched."""
    return blank_to_null(F.col("filename")).isNotNull() & (F.coalesce("length", F.lit(0)) > 0)


def has_platform() -> Column:
    return blank_to_null(F.col("platform")).isNotNull()


def known_platform(df: DataFrame, profiles: tuple[SourceProfile, ...] = PROFILES) -> DataFrame:
    return df.where(F.col("platform").isin(*[p.key for p in profiles]))
