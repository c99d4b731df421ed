"""Pages to entity rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.binding import built_once
from gleaner.functions.numbers import crawl_date_text
from gleaner.functions.rows import explode_once
from gleaner.functions.text import clean_text
from gleaner.functions.urls import category_from_url, city_from_url
from gleaner.operators import cards as C
from gleaner.operators import linked_data, nodes, page_state, scripts
from gleaner.operators.page import PageContext
from gleaner.operators.predicates import excluded
from gleaner.operators.resolve import drop_duplicates_first
from gleaner.plans import code_step
from gleaner.profiles import SourceProfile, all_profiles
from gleaner.schema import ENTITY_COLUMNS, no_entities

BRANCH_STATE, BRANCH_LINKED, BRANCH_ITEMS, BRANCH_CARDS = "state", "jsonld", "script", "card"
BRANCH_CODE = "code"


def _has(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) > 0


@built_once
def json_columns(source: SourceProfile) -> dict[str, Column]:
    """Entity arrays of the JSON branches, each skipped when an earlier one already decided the page."""
    page, none = PageContext.of(source), no_entities()
    out = {"_scripts": scripts.script_elements(F.col("html"))}
    state = none
    if source.keyed_state:
        out["_doc"] = page_state.keyed_maps(F.col("html"), source.keyed_state)
        state = F.coalesce(page_state.keyed_entities(F.col("_doc"), page, source.keyed_state), none)
    out["_state"] = state
    linked = linked_data.entities(F.col("_scripts"), page) if source.linked_data else none
    out["_linked"] = F.when(_has("_state"), none).otherwise(linked)
    found = none
    if source.items:
        found = page_state.located_entities(F.col("_scripts"), page)
        if source.state_tree:
            tree = page_state.tree_entities(F.col("_scripts"), page, source.state_tree)
            found = F.concat(F.coalesce(tree, none), found)
    settled = _has("_state")
    if source.detail_page:
        settled |= page.url.rlike(source.detail_page) & _has("_linked")
    out["_items"] = F.when(settled, none).otherwise(found)
    out["_json"] = F.concat(
        _tag("_state", BRANCH_STATE), _tag("_linked", BRANCH_LINKED), _tag("_items", BRANCH_ITEMS))
    return out


@built_once
def card_rows(source: SourceProfile) -> Column:
    return F.coalesce(C.card_entities(F.col("_cards"), PageContext.of(source), C.selector_table(source)), no_entities())


@built_once
def cleaned(column: str) -> Column:
    return clean_text(F.col(column))


def _tag(rows: str, branch: str) -> Column:
    return F.transform(rows, lambda e: F.struct(F.lit(branch).alias("branch"), e.alias("entity")))


def extract_source(pages: DataFrame, source: SourceProfile, carry: tuple[str, ...] = ()) -> DataFrame:
    """Entities of one source's pages, with the branch and the position in the page.

    Branch choice and in-page duplicates are settled on arrays inside the page row: page text never takes
    part in a shuffle, and only the entity rows leave the stage.
    """
    if source.rows:
        found = code_step.code_rows(pages, source, carry).where("error IS NULL")
        return found.select(*carry, F.lit(BRANCH_CODE).alias("branch"), "pos", *ENTITY_COLUMNS)
    url = F.coalesce("url", F.lit(""))
    df = pages.where(F.col("platform") == source.key)
    if source.excluded_paths:
        df = df.where(~excluded(url, source.excluded_paths))
    rule = source.category_rule
    df = df.select(
        *carry, url.alias("url"), F.col("html"), F.col("crawl_id"),
        crawl_date_text(F.col("timestamp")).alias("_date"), city_from_url(url, source.city_steps).alias("_city"),
        (category_from_url(url, rule) if rule else F.lit(None).cast("string")).alias("_category"))
    for name, column in json_columns(source).items():
        df = df.withColumn(name, column)
    if source.cards:
        # Pages that JSON already settled skip the HTML parser, unless cards decide first.
        markup = F.col("html") if source.listing_markers else F.when(~_has("_json"), F.col("html"))
        table = C.selector_table(source)
        df = df.withColumn("_nodes", nodes.parse_nodes(markup, C.kept_attrs(source, table), table))
        if source.listing_markers:
            marked = F.exists("_nodes", lambda n: nodes.matches(n, ", ".join(source.listing_markers), table))
            df = df.withColumn("_listing", F.coalesce(marked, F.lit(False)))
        df = C.select_cards(df, source.cards, table=table)
        df = df.withColumn("_card_rows", card_rows(source))
        cards = _tag("_card_rows", BRANCH_CARDS)
        use_json = _has("_json")
        if source.listing_markers:
            use_json &= ~F.col("_listing")
        df = df.withColumn("_rows", F.when(use_json, F.col("_json")).otherwise(cards))
    else:
        df = df.withColumn("_rows", F.col("_json"))
    rows = explode_once(df, F.col("_rows"), "_row", *carry, pos="pos")
    return rows.select(*carry, F.col("_row.branch").alias("branch"), "pos", "_row.entity.*")


def extract_entities(
    pages: DataFrame, profiles: tuple[SourceProfile, ...] | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Entities of all known sources; each source reads only its own slice of a partitioned page store."""
    rows = reduce(DataFrame.unionByName, [extract_source(pages, p, carry) for p in profiles or all_profiles()])
    # Names and addresses are cleaned once, on the slim rows.
    return rows.withColumns({c: cleaned(c) for c in ("name", "address")})


def extraction_errors(
    pages: DataFrame, profiles: tuple[SourceProfile, ...] | None = None, carry: tuple[str, ...] = ()
) -> DataFrame | None:
    """(carry, platform, error) of the pages on which a source's own function failed; None without such sources."""
    found = [code_step.code_rows(pages, p, carry).where("error IS NOT NULL").select(
        *carry, F.lit(p.key).alias("platform"), "error") for p in profiles or all_profiles() if p.rows]
    return reduce(DataFrame.unionByName, found) if found else None


def entity_table(pages: DataFrame, profiles: tuple[SourceProfile, ...] | None = None) -> DataFrame:
    """Entities without duplicates, winners by page address and place in the page."""
    rows = extract_entities(pages, profiles)
    return drop_duplicates_first(rows, order_by=["source_url", "date", "branch", "pos"]).select(*ENTITY_COLUMNS)


def entity_slices(pages: DataFrame, profiles: tuple[SourceProfile, ...] | None = None) -> DataFrame:
    """Crawl and platform under which the entities of the pages are stored: pages have keys, entities names."""
    profiles = profiles or all_profiles()
    names = F.create_map(*[F.lit(x) for p in profiles for x in (p.key, p.name)])
    return pages.where(F.col("platform").isin(*[p.key for p in profiles])).select(
        "crawl_id", names[F.col("platform")].alias("platform")).distinct()
