"""Joins and reconciliations between index, pages, sidecars and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import before_last, blank_to_null
from gleaner.profiles import PROFILES, SourceProfile

# Share of names or of state entities below which a page is flagged.
MISSING_SHARE, STATE_SHARE = 0.5, 0.5


# A page and its sidecar have the same place: platform, crawl, and folder with file stem.
PLACE = ["path_platform", "path_crawl", "key"]


def with_metadata(pages: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Pages with the sidecar of the same place; absent values are read from the storage path.

    Both hold ``path_platform``, ``path_crawl`` and ``key``. Page text is not needed here: join the result back by
    place, or keep the text out until the metadata is settled.
    """
    cells = ["url", "timestamp", "crawl_id", "platform"]
    side = sidecars.select(*PLACE, *[F.col(c).alias(f"_{c}") for c in cells], F.lit(True).alias("_found"))
    df = pages.join(side, PLACE, "left")
    stem = F.element_at(F.split("key", "/"), -1)
    inferred = {
        "url": F.lit(""),
        "timestamp": F.when(F.contains(stem, F.lit("_")), F.split_part(stem, F.lit("_"), F.lit(1))).otherwise(""),
        "crawl_id": F.col("path_crawl"), "platform": F.col("path_platform"),
    }
    for c in cells:
        df = df.withColumn(c, F.when(F.col("_found"), F.coalesce(f"_{c}", F.lit(""))).otherwise(inferred[c]))
    return df.withColumn("has_sidecar", F.coalesce("_found", F.lit(False))).drop(*[f"_{c}" for c in cells], "_found")


def sidecar_counts(pages: DataFrame, sidecars: DataFrame, keys: list[str]) -> DataFrame:
    """Pages with and without a sidecar per platform and crawl."""
    df = pages.join(sidecars.select(*keys).distinct().withColumn("_m", F.lit(1)), keys, "left")
    return df.groupBy("platform", "crawl_id").agg(
        F.count("_m").alias("matched"), (F.count(F.lit(1)) - F.count("_m")).alias("missing"))


def reconcile(index: DataFrame, pages: DataFrame) -> DataFrame:
    """Index rows against stored pages per platform and crawl, with a status text."""
    keys = ["platform", "crawl_id"]
    idx = index.groupBy(*keys).agg(F.count(F.lit(1)).alias("index_rows"))
    got = pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("html_rows"), F.countDistinct("url").alias("unique_urls"))
    n, h = F.col("index_rows"), F.col("html_rows")
    status = (
        F.when(n.isNull(), "NO INDEX").when(h == n, "OK")
        .when(h > n, F.concat(F.lit("+"), (h - n).cast("string"), F.lit(" ("),
                              (h - F.col("unique_urls")).cast("string"), F.lit(" dupes)")))
        .otherwise(F.concat(F.lit("MISSING "), (n - h).cast("string"))))
    return got.join(idx, keys, "left").withColumn("status", status)


def keyed_merge(entities: DataFrame, keys: list[str], **others: DataFrame) -> DataFrame:
    """Table form of the co-keyed map lookup: one left join per side table on the entity key."""
    for other in others.values():
        entities = entities.join(other, keys, "left")
    return entities


def missing_share(truth: DataFrame, extracted: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Per page: truth names, extracted names, missing names, and whether too many are missing."""
    page = [*keys, name]
    t = truth.select(*page).distinct().withColumn("_t", F.lit(1))
    e = extracted.select(*page).distinct().withColumn("_e", F.lit(1))
    both = t.join(e, page, "full").groupBy(*keys).agg(
        F.count("_t").alias("n_truth"), F.count("_e").alias("n_extracted"),
        F.count_if(F.col("_t").isNotNull() & F.col("_e").isNull()).alias("n_missing"))
    flag = (F.col("n_extracted") > 0) & (F.col("n_missing") > F.col("n_truth") * MISSING_SHARE)
    return both.where(F.col("n_truth") > 0).withColumn("flagged", flag)


def low_state_coverage(state_counts: DataFrame, entity_counts: DataFrame, keys: list[str]) -> DataFrame:
    """Pages whose state holds entities, with the number extracted and a flag for too few."""
    df = state_counts.where(F.col("n_state") > 0).join(entity_counts, keys, "left")
    n = F.coalesce("n_entities", F.lit(0))
    return df.withColumn("n_entities", n).withColumn("flagged", F.col("n_entities") < F.col("n_state") * STATE_SHARE)


def crawl_grid(crawls: DataFrame, profiles: tuple[SourceProfile, ...] = PROFILES) -> DataFrame:
    """Every crawl with every source; the sources are a literal list, so no join is involved."""
    keys = F.array(*[F.lit(p.key) for p in profiles])
    return crawls.select("crawl_id", F.explode(keys).alias("platform"))


def grid_counts(df: DataFrame, crawls: DataFrame, profiles: tuple[SourceProfile, ...] = PROFILES) -> DataFrame:
    """Rows per crawl and source, empty cells kept as zero."""
    n = df.groupBy("crawl_id", "platform").agg(F.count(F.lit(1)).alias("_n"))
    return crawl_grid(crawls, profiles).join(n, ["crawl_id", "platform"], "left").select(
        "crawl_id", "platform", F.coalesce("_n", F.lit(0)).alias("n"))


def dispatch(df: DataFrame, profiles: tuple[SourceProfile, ...], **rules) -> DataFrame:
    """Rows of known sources with one column per rule, each a function of the profile.

    The rules become literals per source, so the lookup needs neither a join nor a broadcast.
    """
    df = df.where(F.col("platform").isin(*[p.key for p in profiles]))
    for name, rule in rules.items():
        out = None
        for p in profiles:
            out = (F.when if out is None else out.when)(F.col("platform") == p.key, rule(p))
        df = df.withColumn(name, out)
    return df


def split_store_name(name: Column) -> tuple[Column, Column]:
    """Crawl and platform of a slice name ``crawl_platform``."""
    return before_last(name), blank_to_null(F.regexp_extract(name, "_([^_]*)$", 1))
