"""The sampled audit: pages against what was extracted from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import lookups, quality
from gleaner.schema import ISSUE


def audit_issues(
    counts: DataFrame, entities: DataFrame, truth: DataFrame, state_counts: DataFrame, keys: list[str]
) -> DataFrame:
    """All findings as one ``ISSUE`` table.

    ``counts`` are the sampled pages with their sizes and numbers of entities (``quality.page_counts``), ``entities`` what
    they gave, ``truth`` names that must be found (lower case), ``state_counts`` the entities their state holds. Page
    text takes no part.
    """
    page = counts.select(*keys, "platform", "crawl_id", F.col("url").alias("subject"), "n_entities")

    def found(flagged: DataFrame, check: str, n: str) -> DataFrame:
        on_page = flagged.where("flagged").select(*keys, F.col(n).alias("n")).join(page.drop("n_entities"), keys)
        return on_page.select(F.lit(check).alias("check"), "platform", "crawl_id", "subject", F.lit("").alias("detail"), "n")

    named = entities.select(*keys, F.lower("name").alias("name"))
    per_page = counts.select(*keys, "n_entities")
    tables = [
        quality.page_issues(counts).select(
            "check", "platform", "crawl_id", F.col("url").alias("subject"),
            F.col("n_chars").cast("string").alias("detail"), F.col("n_entities").alias("n")),
        quality.row_issues(entities.drop("platform").join(page.select(*keys, "platform"), keys)).select(
            "check", "platform", "crawl_id", "subject", F.col("name").alias("detail"), F.lit(1).alias("n")),
        found(quality.intra_page_duplicates(entities, keys), "INTRA_PAGE_DUPES", "n_repeats"),
        found(lookups.missing_share(truth, named, keys), "MISSING_NAMES", "n_missing"),
        found(lookups.low_state_coverage(state_counts, per_page, keys), "LOW_STATE_COVERAGE", "n_entities"),
    ]
    cells = [F.col(f.name).cast(f.dataType).alias(f.name) for f in ISSUE.fields]
    return reduce(DataFrame.unionByName, [t.select(*cells) for t in tables])
