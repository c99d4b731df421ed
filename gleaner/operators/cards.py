"""HTML cards to entity rows."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.binding import bind, built_once, first_usable, keep_if
from gleaner.functions.numbers import (
    bracketed_count, eta_text, first_number, percent_rating, rating_count,
)
from gleaner.functions.text import drop_tokens, first_item, first_present, split_list, squash_space
from gleaner.functions.urls import absolutise, style_image
from gleaner.operators import nodes as N
from gleaner.operators.page import PageContext
from gleaner.profiles import CardSpec, SourceProfile

LINK = "a[href]"


def _selectors(source: SourceProfile) -> list[str]:
    c = source.cards
    named = [s for s in (c.rating, c.count, c.eta, c.tags, c.address, c.image) if s]
    return [*source.listing_markers, *c.cards, *c.name, *c.categories, *named, LINK]


@cache
def selector_table(source: SourceProfile) -> N.SelectorTable:
    """All selectors of a profile, for ``parse_nodes`` and the card functions."""
    return N.SelectorTable(_selectors(source))


def field_attrs(source: SourceProfile) -> frozenset[str]:
    """Attributes that the profile's fields are read from, apart from those its selectors test."""
    c = source.cards
    return frozenset({"href", "title", "style", *c.image_attrs}) | ({c.name_attr} if c.name_attr else set())


def kept_attrs(source: SourceProfile, table: N.SelectorTable | None = None) -> frozenset[str]:
    """Attributes that nodes must carry: those of the fields, and of the selectors that ``table`` does not settle."""
    open_ones = [s for s in _selectors(source) if table is None or table.mask(s) is None]
    return N.selector_attrs(*open_ones) | field_attrs(source)


def name_reject(name: Column, tokens: tuple[str, ...]) -> Column:
    """Whether a name holds one of the navigation or promotion tokens."""
    return F.lower(name).rlike("|".join(re.escape(t) for t in tokens))


def name_length_ok(name: Column, spec: CardSpec) -> Column:
    return F.length(name) >= 2 if spec.name_any_length else F.length(name).between(2, 99)


class _Card:
    """Field access below one card inside a lambda."""

    def __init__(self, card: Column, table: N.SelectorTable | None):
        self.table = table
        self.node, self.inner, self.parent = card["node"], card["inner"], card["parent"]
        self.first = self.node["pre"] + F.lit(1)

    def one(self, selector: str) -> Column:
        return N.select_one(self.inner, selector, self.table)

    def text(self, n: Column) -> Column:
        return N.text_of(self.inner, n, self.first)

    def text_at(self, selector: str | None) -> Column:
        return self.text(self.one(selector)) if selector else F.lit(None).cast("string")


def _name(card: _Card, spec: CardSpec) -> Column:
    texts = [card.text_at(s) for s in spec.name]
    if spec.name_attr:
        texts = [F.coalesce(texts[0], N.attr(card.node, spec.name_attr))]
    # Lazy: a later selector is only tried when the earlier ones gave no usable text.
    found = F.coalesce(*[keep_if(squash_space(t), lambda t: name_length_ok(t, spec)) for t in texts])
    if spec.name_from_parent_title:
        title = F.when(card.parent["tag"] == "a", N.attr(card.parent, "title"))
        found = F.coalesce(found, keep_if(title, lambda t: F.length(t) > 1))
    if spec.name_reject:
        found = keep_if(found, lambda t: ~name_reject(t, spec.name_reject))
    return found


def _categories(card: _Card, spec: CardSpec) -> Column:
    if not spec.categories:
        return F.array().cast("array<string>")
    labels = bind(F.coalesce(*[card.one(s) for s in spec.categories]), lambda h: _labels(card, h, spec))
    if spec.tags:
        labels = F.coalesce(labels, bind(card.one(spec.tags), lambda box: _tags(card, box, spec)))
    return F.coalesce(labels, F.array().cast("array<string>"))


def _labels(card: _Card, holder: Column, spec: CardSpec) -> Column:
    """Category texts of the element that holds them."""
    out = split_list(card.text(holder), spec.category_split)
    if spec.category_children:
        below = F.filter(
            N.inside(card.inner, holder, card.first), lambda n: (n["parent"] == holder["pre"]) & (n["tag"] != "span"))
        direct = F.transform(
            below, lambda n: F.trim(F.when(n["tag"] == N.TEXT, n["text"]).otherwise(card.text(n))))
        direct = F.filter(direct, lambda t: t != "")
        out = first_usable([direct, out], lambda a: F.size(a) > 0)
    return F.when(holder.isNotNull(), F.coalesce(out, F.array().cast("array<string>")))


def _tags(card: _Card, box: Column, spec: CardSpec) -> Column:
    """Texts of all elements below the tag box, without promotions."""
    labels = F.transform(
        F.filter(N.inside(card.inner, box, card.first), lambda n: ~n["tag"].startswith("#")),
        lambda n: F.array_join(F.transform(
            F.filter(N.inside(card.inner, n, card.first), lambda x: x["tag"] == N.TEXT),
            lambda x: F.trim(x["text"])), ""))
    return F.filter(drop_tokens(labels, spec.tags_reject), lambda t: t != "")


def _link(card: _Card, spec: CardSpec, base: str) -> Column:
    own = F.when(card.node["tag"] == "a", F.coalesce(N.attr(card.node, "href"), F.lit("")))
    if spec.parent_link:
        own = own.when(card.parent["tag"] == "a", F.coalesce(N.attr(card.parent, "href"), F.lit("")))
    return bind(own.otherwise(N.attr(card.one(LINK), "href")), lambda u: absolutise(u, base))


def _image(card: _Card, spec: CardSpec) -> Column:
    if not spec.image:
        return F.lit(None).cast("string")
    return bind(card.one(spec.image), lambda img: _image_url(img, spec))


def _image_url(img: Column, spec: CardSpec) -> Column:
    found = first_present(*[N.attr(img, a) for a in spec.image_attrs])
    if spec.image_style:
        found = F.coalesce(found, style_image(N.attr(img, "style")))
    return found


def _entity(c: Column, page: PageContext, spec: CardSpec, table: N.SelectorTable | None) -> Column:
    card = _Card(c, table)
    parts = F.struct(
        card.text_at(spec.rating).alias("rating"), card.text_at(spec.count).alias("count"),
        squash_space(card.text_at(spec.eta)).alias("eta"), _categories(card, spec).alias("tags"))
    return bind(parts, lambda p: _assemble(c, card, p, page, spec))


def _assemble(c: Column, card: _Card, p: Column, page: PageContext, spec: CardSpec) -> Column:
    food = first_item(p["tags"])
    if page.source.category_rule:
        food = F.coalesce(food, page.category)
    return page.entity(
        name=c["name"],
        address=card.text_at(spec.address),
        food_type=food,
        categories=p["tags"],
        rating=percent_rating(p["rating"]) if spec.rating_percent else first_number(p["rating"]),
        num_ratings=bracketed_count(p["rating"]) if spec.rating_percent else rating_count(p["count"]),
        delivery_time=eta_text(p["eta"]) if spec.eta_checked else p["eta"],
        restaurant_url=_link(card, spec, page.source.base_url),
        image_url=_image(card, spec),
    )


def select_cards(
    df: DataFrame, spec: CardSpec, nodes: str = "_nodes", out: str = "_cards", table: N.SelectorTable | None = None
) -> DataFrame:
    """Adds the cards of the page as ``array<struct<rank, node, inner, parent, name>>``.

    The selectors are ranked; the winner is the first with any card, or the first with a usable card.
    Everything stays inside the page row, so no shuffle is needed. ``table`` is the one the nodes were parsed with.
    """
    for name, column in card_columns(spec, nodes, out, table):
        df = df.withColumn(name, column)
    return df.drop("_cand", "_ranked", "_names")


@built_once
def card_columns(spec: CardSpec, nodes: str, out: str, table: N.SelectorTable | None) -> list[tuple[str, Column]]:
    """The steps of card selection as successive columns."""
    steps = [("_cand", N.select(F.col(nodes), ", ".join(spec.cards), table))]
    ranked = F.flatten(F.array(*[
        F.transform(N.select(F.col("_cand"), s, table), _ranked(rank)) for rank, s in enumerate(spec.cards)]))
    steps.append(("_ranked", ranked))
    if not spec.skip_unusable:
        steps.append(("_ranked", _best_rank(F.col("_ranked"))))
    steps.append((out, F.transform("_ranked", lambda c: F.struct(
        c["rank"].alias("rank"), c["node"].alias("node"),
        N.inside(F.col(nodes), c["node"]).alias("inner"),
        F.when(c["node"]["parent"] >= 0, F.get(F.col(nodes), c["node"]["parent"])).alias("parent")))))
    named = F.transform(out, lambda c: F.struct(
        c["rank"].alias("rank"), c["node"].alias("node"), c["inner"].alias("inner"), c["parent"].alias("parent"),
        _name(_Card(c, table), spec).alias("name")))
    steps.append((out, F.filter(named, lambda c: c["name"] != "")))
    if spec.skip_unusable:
        steps.append((out, _best_rank(F.col(out))))
    if spec.unique_names:
        steps.append(("_names", F.transform(out, lambda c: F.lower(c["name"]))))
        steps.append((out, first_by_key(F.col(out), F.col("_names"))))
    return steps


def _ranked(rank: int):
    return lambda n: F.struct(F.lit(rank).alias("rank"), n.alias("node"))


def _best_rank(cards: Column) -> Column:
    """Cards of the lowest rank; the array is in rank order, so the first card has it."""
    return F.filter(cards, lambda c: c["rank"] == F.get(cards, F.lit(0))["rank"])


def first_by_key(values: Column, keys: Column) -> Column:
    """First value per key, in array order."""
    at = F.transform(keys, lambda k: F.array_position(keys, k))
    zipped = F.arrays_zip(values.alias("v"), at.alias("at"))
    return F.transform(F.filter(zipped, lambda x, i: x["at"] == i + 1), lambda x: x["v"])


def card_entities(cards: Column, page: PageContext, table: N.SelectorTable | None = None) -> Column:
    """Entities of the selected cards, in document order."""
    return F.transform(cards, lambda c: _entity(c, page, page.source.cards, table))
