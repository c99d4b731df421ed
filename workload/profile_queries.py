"""Every kind of page of every built-in source, and a source whose pages are read by a function."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import variants as V
from gleaner.functions.rows import explode_once
from gleaner.functions.urls import CityStep
from gleaner.operators import cards, nodes, page_state, scripts
from gleaner.plans import extract_step as ex
from gleaner.plans import steps
from gleaner.profiles import SourceProfile, profile
from gleaner.session import scratch_dir
from gleaner.sources import page_store
from workload import profile_pages as pp
from workload.fixtures import CUSTOMER_SQL, INDEX_SQL
from workload.profile_pages import ALL_SQL, GLOVO_CARD_SQL, GLOVO_LINKED_SQL, JUST_LOCATED_SQL, UBER_CARD_SQL, UBER_LINKED_SQL
from workload.registry import Tables, query

GLOVO, UBER, JUST = profile("glovo"), profile("ubereats"), profile("justeat")
_LINKED = ["page_id", "name", "city", "address", "food_type", "categories", "rating", "num_ratings", "restaurant_url"]
_GLOVO_CARDS = ["page_id", "name", "city", "food_type", "rating", "num_ratings", "delivery_time", "restaurant_url", "image_url"]
_UBER_CARDS = ["page_id", "name", "city", "food_type", "categories", "rating", "delivery_time", "restaurant_url"]
_LOCATED = ["page_id", "name", "city", "address", "neighborhood", "rating", "num_ratings", "delivery_fee", "delivery_time", "min_order",
            "is_promoted", "is_new", "latitude", "longitude", "restaurant_url"]


def _rows(pages: DataFrame, source: SourceProfile, columns: list[str]) -> DataFrame:
    rows = ex.extract_entities(pages, (source,), carry=("page_id",))
    return rows.withColumn("categories", F.array_join("categories", "|")).select(*columns)


def _sql(rows: str, columns: list[str]) -> str:
    return f"WITH {CUSTOMER_SQL} SELECT {', '.join(columns)} FROM ({rows})"


@query("x04_linked_data_glovo", _sql(GLOVO_LINKED_SQL, [*_LINKED, "price_range", "latitude", "longitude"]))
def _(t: Tables):
    return _rows(pp.glovo_linked_pages(t), GLOVO, [*_LINKED, "price_range", "latitude", "longitude"])


@query("x04_linked_data_ubereats", _sql(UBER_LINKED_SQL, [*_LINKED, "neighborhood", "image_url"]))
def _(t: Tables):
    return _rows(pp.uber_linked_pages(t), UBER, [*_LINKED, "neighborhood", "image_url"])


@query("x08_located_documents_justeat", f"WITH {CUSTOMER_SQL} SELECT page_id, 1 AS n_docs FROM fx_customer GROUP BY page_id")
def _(t: Tables):
    return pp.just_located_pages(t).select("page_id", scripts.script_elements(F.col("html")).alias("s")).select(
        "page_id", F.size(page_state.located_documents(F.col("s"), JUST.items)).alias("n_docs"))


@query("x09_located_items_justeat", f"""
WITH {CUSTOMER_SQL} SELECT page_id, c_name || CASE WHEN c_custkey % 2 = 0 THEN ' & Co' ELSE '' END AS name FROM fx_customer
""")
def _(t: Tables):
    found = page_state.located_items(
        page_state.located_documents(scripts.script_elements(F.col("html")), JUST.items), JUST.items)
    return explode_once(pp.just_located_pages(t), found, "v", "page_id").select(
        "page_id", V.first_text(F.col("v"), JUST.items.name).alias("name"))


@query("x10_located_entities_justeat", _sql(JUST_LOCATED_SQL, _LOCATED))
def _(t: Tables):
    return _rows(pp.just_located_pages(t), JUST, _LOCATED)


def _selected(pages: DataFrame, source: SourceProfile) -> DataFrame:
    table = cards.selector_table(source)
    parsed = nodes.parse_nodes(F.col("html"), cards.kept_attrs(source, table), table)
    return cards.select_cards(pages.select("page_id", parsed.alias("_nodes")), source.cards, table=table).select(
        "page_id", F.array_min(F.transform("_cards", lambda c: c["rank"])).alias("rank"), F.size("_cards").cast("bigint").alias("n"))


@query("x12_card_selection_glovo", f"""
WITH {CUSTOMER_SQL} SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END AS rank, count(*) AS n FROM ({GLOVO_CARD_SQL}) GROUP BY page_id
""")
def _(t: Tables):
    return _selected(pp.glovo_card_pages(t), GLOVO)


@query("x12_card_selection_ubereats", f"WITH {CUSTOMER_SQL} SELECT page_id, 0 AS rank, count(*) AS n FROM fx_customer GROUP BY page_id")
def _(t: Tables):
    return _selected(pp.uber_card_pages(t), UBER)


@query("x13_card_entities_glovo", _sql(GLOVO_CARD_SQL, _GLOVO_CARDS))
def _(t: Tables):
    return _rows(pp.glovo_card_pages(t), GLOVO, _GLOVO_CARDS)


@query("x13_card_entities_ubereats", _sql(UBER_CARD_SQL, _UBER_CARDS))
def _(t: Tables):
    return _rows(pp.uber_card_pages(t), UBER, _UBER_CARDS)


@query("p03_extract_step", f"""
{ALL_SQL} SELECT crawl_id, platform, city, count(DISTINCT k) AS restaurant_count FROM found GROUP BY ALL
""")
def _(t: Tables):
    # Pages of all kinds and sources; every profile reads its own slices of the store.
    pages = page_store.read_pages(t.spark, pp.stored_pages(t))
    return steps.extract_step(t.spark, pages, f"{scratch_dir(t.spark, 'p03')}/entities")


def _article_rows(html: str, page: dict):
    """Headings of a page as entities; every tenth page cannot be read."""
    if page["url"].endswith("0"):
        raise ValueError("unreadable")
    for heading in re.findall(r"<h1[^>]*>([^<]*)<", html):
        yield {"name": heading, "rating": "4.5", "num_ratings": "many", "categories": [page["crawl_id"], None, 7], "latitude": len(html)}


ARTICLES = SourceProfile(
    key="articles", name="Articles", domain="", base_url="", city_steps=(CityStep(r"/(en|de|es|fr)/"),), rows=_article_rows)
_ARTICLE_SQL = f"""
WITH {INDEX_SQL}, a AS (SELECT page_id, url || CASE WHEN page_id % 10 = 0 THEN '#0' ELSE '#1' END AS url, crawl, lang, html,
  regexp_extract_all(html, '<h1[^>]*>([^<]*)<', 1) AS h FROM fx_index JOIN (SELECT page_id, html FROM pages) USING (page_id))
"""


def _articles(t: Tables) -> DataFrame:
    from workload import fixtures as fx

    pages = fx.index(t).select("page_id", "url", "fetch_time", F.col("crawl").alias("crawl_id")).join(t.pages.select("page_id", "html"), "page_id")
    return pages.select(
        "page_id", F.concat("url", F.when(F.col("page_id") % 10 == 0, "#0").otherwise("#1")).alias("url"),
        F.date_format("fetch_time", "yyyyMMddHHmmss").alias("timestamp"), "crawl_id", F.lit("articles").alias("platform"), "html")


@query("x17_registered_profile", f"""
{_ARTICLE_SQL} SELECT page_id, 0 AS pos, 'Articles' AS platform, upper(lang[1]) || lang[2:] AS city, crawl || '|7' AS categories, 4.5 AS rating,
  CAST(NULL AS BIGINT) AS num_ratings, CAST(length(html) AS DOUBLE) AS latitude, url AS source_url, crawl AS crawl_id
FROM a WHERE page_id % 10 <> 0 AND len(h) = 1
""")
def _(t: Tables):
    rows = ex.extract_entities(_articles(t), (JUST, ARTICLES), carry=("page_id",))
    return rows.withColumn("categories", F.array_join("categories", "|")).select(
        "page_id", "pos", "platform", "city", "categories", "rating", "num_ratings", "latitude", "source_url", "crawl_id")


@query("x17_profile_errors", f"""
{_ARTICLE_SQL} SELECT page_id, 'articles' AS platform, 'ValueError: unreadable' AS error FROM a WHERE page_id % 10 = 0
""")
def _(t: Tables):
    return ex.extraction_errors(_articles(t), (JUST, ARTICLES), carry=("page_id",))
