"""Structure features of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.binding import bind
from gleaner.operators import nodes as N
from gleaner.operators import scripts
from gleaner.operators.linked_data import declared_types

# Elements that may be cards.
CARD_SELECTORS = (
    "article", 'div[class*="card"]', 'div[class*="item"]', 'div[class*="store"]', 'div[class*="restaurant"]',
    'li[class*="store"]', 'li[class*="restaurant"]',
)
LINK = "a[href]"
TABLE = N.SelectorTable(("title", LINK, *CARD_SELECTORS))
NEXT_MARKER = "__NEXT_DATA__"
STATE_MARKERS = ("__INITIAL_STATE__", "__PRELOADED_STATE__")


def _estimate(cards: Column, title: Column) -> Column:
    hint = F.lower(title).contains("restaurant") | F.lower(title).contains("store")
    return F.when(cards > 5, "listing").when((cards > 0) | hint, "detail").otherwise("other")


def page_features(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Title, JSON-LD types, state markers, links, largest card count and estimated type of each page."""
    df = pages.select(*keys, "html").withColumn("_n", N.parse_nodes(F.col("html"), frozenset(), TABLE))
    # Counts look at the selector bits of the few nodes that fit any selector.
    df = df.withColumn("_hit", F.filter("_n", lambda n: n["hits"] != 0))
    df = df.withColumn("_s", scripts.script_elements(F.col("html")))
    df = df.withColumn("_b", scripts.bodies(F.col("_s")))
    title = F.trim(bind(N.select_one(F.col("_hit"), "title", TABLE), lambda t: N.text_of(F.col("_n"), t)))
    counts = [F.size(N.select(F.col("_hit"), s, TABLE)) for s in CARD_SELECTORS]
    state = F.exists("_b", lambda b: F.greatest(*[b.contains(m) for m in STATE_MARKERS]))
    df = df.select(
        *keys, F.coalesce(title, F.lit("")).alias("title"),
        (F.size(scripts.linked_data_texts(F.col("_s"))) > 0).alias("has_json_ld"),
        declared_types(F.col("_s"), "unknown").alias("json_ld_types"),
        F.exists("_b", lambda b: b.contains(NEXT_MARKER)).alias("has_next_data"),
        state.alias("has_initial_state"),
        F.size(N.select(F.col("_hit"), LINK, TABLE)).alias("num_links"), F.greatest(*counts).alias("num_cards"))
    return df.withColumn("estimated_type", _estimate(F.col("num_cards"), F.col("title")))
