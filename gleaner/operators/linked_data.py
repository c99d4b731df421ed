"""JSON-LD blocks to entity rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import variants as V
from gleaner.functions.numbers import null_if_zero, rating_value, safe_long
from gleaner.functions.text import clean_text, first_item, first_present, join_present
from gleaner.operators.page import PageContext
from gleaner.operators.scripts import linked_data_texts
from gleaner.profiles import LinkedDataSpec

NO_TYPE = "NO_TYPE"


def roots(elements: Column) -> Column:
    """Parsed JSON-LD documents; unreadable ones are left out."""
    return F.filter(
        F.transform(linked_data_texts(elements), F.try_parse_json), lambda v: v.isNotNull())


def type_of(v: Column) -> Column:
    return F.try_variant_get(v, V.TYPE_PATH, "string")


def _list_items(v: Column) -> Column:
    return V.get(v, "itemListElement", "array<variant>")


def items(docs: Column, search_page: bool = False) -> Column:
    """Candidate items: a single object, an array, an item list, and a search page around an item list."""

    def expand(v: Column) -> Column:
        branch = F.when(type_of(v) == "ItemList", _list_items(v))
        if search_page:
            inner = V.get(v, "mainEntity")
            branch = branch.when(
                type_of(v) == "SearchResultsPage", F.when(type_of(inner) == "ItemList", _list_items(inner)))
        return F.coalesce(V.as_array(v), branch.otherwise(F.array(v)))

    flat = V.flatten_variants(F.transform(docs, expand))
    return F.transform(flat, lambda v: F.when(type_of(v) == "ListItem", V.get(v, "item")).otherwise(v))


def accept(v: Column, spec: LinkedDataSpec) -> Column:
    """Whether an item is an entity of the wanted kind with a usable name."""
    name = V.scalar_text(v, "name")
    ok = type_of(v).isin(*spec.types) & (name != "")
    if spec.reject_names:
        ok &= ~F.lower(name).isin(*spec.reject_names)
    return F.coalesce(ok, F.lit(False))


def entity(v: Column, page: PageContext, spec: LinkedDataSpec) -> Column:
    """One item as an entity; values that cannot be read become NULL cells."""
    locality = V.scalar_text(v, "address.addressLocality")
    address = F.when(
        V.get(v, "address", "map<string,variant>").isNotNull(),
        join_present([V.scalar_text(v, "address.streetAddress"), locality, V.scalar_text(v, "address.postalCode")]),
    ).otherwise(V.scalar_text(v, "address"))
    cuisines = F.coalesce(
        V.get(v, "servesCuisine", "array<string>"),
        F.when(V.text(v, "servesCuisine").isNotNull(), F.array(V.text(v, "servesCuisine"))))
    count = first_present(
        V.scalar_text(v, "aggregateRating.ratingCount"), V.scalar_text(v, "aggregateRating.reviewCount"))
    fields = {
        "name": V.scalar_text(v, "name"),
        "address": address,
        "food_type": first_item(cuisines),
        "categories": cuisines,
        "rating": rating_value(V.scalar_text(v, "aggregateRating.ratingValue"), spec.percent_rating),
        "num_ratings": null_if_zero(safe_long(count, spec.thousands)),
        "price_range": V.text(v, "priceRange"),
        "restaurant_url": V.text(v, "url"),
        "image_url": V.text(v, "image"),
    }
    if spec.geo:
        fields["latitude"] = V.get(v, "geo.latitude", "double")
        fields["longitude"] = V.get(v, "geo.longitude", "double")
    if spec.locality:
        if spec.locality_strip:
            locality = F.trim(F.regexp_replace(locality, spec.locality_strip, ""))
        fields["neighborhood"] = locality
        if spec.locality_as_city:
            fields["city"] = first_present(page.city, locality)
    return page.entity(**fields)


def entities(elements: Column, page: PageContext) -> Column:
    """All entities of the page's JSON-LD, in document order."""
    spec = page.source.linked_data
    found = F.filter(items(roots(elements), spec.search_page), lambda v: accept(v, spec))
    return F.transform(found, lambda v: entity(v, page, spec))


def declared_types(elements: Column, absent: str = NO_TYPE) -> Column:
    """``@type`` of each top-level object."""
    flat = V.flatten_variants(F.transform(
        roots(elements), lambda v: F.coalesce(V.as_array(v), F.array(v))))
    objects = F.filter(flat, lambda v: V.as_map(v).isNotNull())
    return F.transform(objects, lambda v: F.coalesce(type_of(v), F.lit(absent)))


# Types that count as ground truth when an object stands alone.
TRUTH_TYPES = ("Restaurant", "FoodEstablishment", "LocalBusiness", "Store")


def truth_names(elements: Column) -> Column:
    """Distinct comparison names stated by the JSON-LD, read independently of the entity path."""

    def names(v: Column) -> Column:
        listed = F.transform(
            _list_items(v), lambda e: V.scalar_text(F.coalesce(V.get(e, "item"), e), "name"))
        alone = F.when(type_of(v).isin(*TRUTH_TYPES), F.array(V.scalar_text(v, "name")))
        return F.when(type_of(v) == "ItemList", listed).otherwise(alone)

    flat = V.flatten_variants(F.transform(
        roots(elements), lambda v: F.coalesce(V.as_array(v), F.array(v))))
    found = F.flatten(F.filter(F.transform(flat, names), lambda a: a.isNotNull()))
    present = F.filter(found, lambda n: n != "")
    return F.coalesce(
        F.array_distinct(F.transform(present, lambda n: F.lower(clean_text(n)))),
        F.array().cast("array<string>"))
