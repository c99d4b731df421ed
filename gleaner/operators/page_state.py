"""Embedded page state to entity rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import variants as V
from gleaner.functions.binding import bind, first_usable
from gleaner.functions.numbers import eta_range, null_if_zero, safe_double, safe_long
from gleaner.functions.text import (
    blank_to_null, drop_empty, first_item, first_present, join_present, unescape_basic,
)
from gleaner.functions.urls import slug_url
from gleaner.operators.page import PageContext
from gleaner.operators.scripts import bodies, script_by_id
from gleaner.profiles import ItemSpec, KeyedStateSpec, StateTreeSpec

_PAIR = "\ue000"  # private-use stand-in for an escaped backslash


def decode_js_string(c: Column) -> Column:
    """Inner text of a JavaScript string literal to the string it denotes; raw UTF-8 stays as it is."""
    s = F.replace(c, F.lit("\\\\"), F.lit(_PAIR))
    s = F.replace(F.replace(s, F.lit("\\'"), F.lit("'")), F.lit('\\"'), F.lit('"'))
    s = F.regexp_replace(s, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    s = F.replace(s, F.lit('"'), F.lit('\\"'))
    s = F.replace(F.replace(s, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    s = F.replace(F.replace(s, F.lit("\r"), F.lit("\\r")), F.lit(_PAIR), F.lit("\\\\"))
    return F.try_variant_get(F.try_parse_json(F.concat(F.lit('"'), s, F.lit('"'))), "$", "string")


def keyed_text(html: Column, marker: str) -> Column:
    """Text passed to ``JSON.parse("…")`` after the marker; a cut-off page gives NULL."""
    inner = F.regexp_extract(html, rf'(?s){marker}.*?JSON\.parse\("(.*?)"\)', 1)
    return F.when(html.contains(marker), decode_js_string(blank_to_null(inner)))


def keyed_state(html: Column, marker: str) -> Column:
    """The whole state as one value."""
    return F.try_parse_json(keyed_text(html, marker))


def keyed_maps(html: Column, spec: KeyedStateSpec) -> Column:
    """The maps of the state as a struct.

    A VARIANT carries the key dictionary of its document, here one key per entity. Parsing straight into maps
    gives each entity a value with its own few keys, so large pages stay linear.
    """
    names = (spec.entities, spec.categories, spec.ratings, spec.fees, spec.etas)
    schema = ", ".join(f"`{n}` map<string,variant>" for n in names)
    return F.from_json(keyed_text(html, spec.marker), schema)


def _member(state: Column, name: str) -> Column:
    return V.get(state, name, "map<string,variant>")


def keyed_entities(maps: Column, page: PageContext, spec: KeyedStateSpec) -> Column:
    """Entities of the main map; the other maps are looked up by the same id inside the row."""
    categories, ratings, fees, etas = (maps[n] for n in (spec.categories, spec.ratings, spec.fees, spec.etas))

    def one(entry: Column) -> Column:
        key, info = entry["key"], entry["value"]
        tags = F.try_variant_get(F.try_element_at(categories, key), "$", "array<string>")
        rating, fee, eta = (F.try_element_at(m, key) for m in (ratings, fees, etas))
        return page.entity(
            name=V.scalar_text(info, "name"),
            address=V.first_text(info, ("address",)),
            food_type=first_item(tags),
            categories=drop_empty(tags),
            rating=null_if_zero(safe_double(V.text(rating, "starRating"))),
            num_ratings=null_if_zero(safe_long(V.text(rating, "ratingCount"))),
            delivery_fee=V.text(fee, "bands[0].fee"),
            delivery_time=eta_range(V.text(eta, "deliveryEtaLowerRange"), V.text(eta, "deliveryEtaUpperRange")),
            min_order=V.text(fee, "minimumOrderValue"),
            is_new=V.any_true(info, ("isNew",)),
            restaurant_url=slug_url(V.text(info, "uniqueName"), spec.url_prefix),
            image_url=V.text(info, "logo"),
        )

    named = F.filter(
        F.map_entries(maps[spec.entities]),
        lambda e: V.scalar_text(e["value"], "name") != "")
    return F.transform(named, one)


def keyed_count(state: Column, spec: KeyedStateSpec) -> Column:
    """Number of entities the state holds, named or not."""
    return F.coalesce(F.size(_member(state, spec.entities)), F.lit(0))


def tree_entities(elements: Column, page: PageContext, spec: StateTreeSpec) -> Column:
    """Entities of the map at a fixed path inside the script with the given id."""
    data = F.try_variant_get(
        F.try_parse_json(blank_to_null(script_by_id(elements, spec.script_id))), spec.path, "map<string,variant>")

    def one(r: Column) -> Column:
        tags = F.filter(
            F.transform(V.get(r, "cuisines", "array<variant>"), lambda c: V.text(c, "name")),
            lambda t: t != "")
        return page.entity(
            name=V.scalar_text(r, "name"),
            city=first_present(V.text(r, "address.city"), page.city),
            address=V.first_text(r, ("address.firstLine",)),
            food_type=first_item(tags),
            categories=tags,
            rating=safe_double(V.text(r, "rating.starRating")),
            num_ratings=safe_long(V.text(r, "rating.count")),
            delivery_fee=V.text(r, "deliveryCost"),
            delivery_time=eta_range(
                V.text(r, "deliveryEtaMinutes.rangeLower"), V.text(r, "deliveryEtaMinutes.rangeUpper")),
            min_order=V.text(r, "minimumDeliveryValue"),
            is_new=V.any_true(r, ("isNew",)),
            latitude=safe_double(V.text(r, "address.location.coordinates[1]")),
            longitude=safe_double(V.text(r, "address.location.coordinates[0]")),
            restaurant_url=slug_url(V.text(r, "uniqueName"), spec.url_prefix),
            image_url=V.text(r, "logoUrl"),
        )

    named = F.filter(F.map_values(data), lambda r: V.scalar_text(r, "name") != "")
    return F.transform(named, one)


def located_documents(elements: Column, spec: ItemSpec) -> Column:
    """Every JSON text the patterns find in any script, parsed; matches that are not JSON are left out."""

    def found(body: Column) -> Column:
        return F.concat(*[F.regexp_extract_all(body, F.lit("(?s)" + p), F.lit(1)) for p in spec.patterns])

    texts = F.flatten(F.transform(bodies(elements), found))
    if spec.unescape:
        texts = F.transform(texts, unescape_basic)
    return F.filter(F.transform(texts, F.try_parse_json), lambda v: v.isNotNull())


def located_items(docs: Column, spec: ItemSpec) -> Column:
    """Objects of a list, or of the known containers of an object: a list, a map of objects, a map of lists."""

    def values(nested: Column) -> Column:
        members = F.transform(
            F.map_values(V.as_map(nested)), lambda x: F.coalesce(V.as_array(x), F.array(x)))
        return F.coalesce(V.as_array(nested), F.flatten(members))


    def expand(v: Column) -> Column:
        inside = F.array(*[bind(V.get(v, name), values) for name in spec.containers])
        return F.coalesce(V.as_array(v), V.flatten_variants(inside))

    return F.filter(
        V.flatten_variants(F.transform(docs, expand)), lambda v: V.first_text(v, spec.name).isNotNull())


def _rating(root: Column, spec: ItemSpec) -> tuple[Column, Column]:
    """Rating and count from the first synonym that is an object or a bare number."""
    value = count = F.lit(None).cast("double")
    for name in reversed(spec.rating):
        nested = V.get(root, name, "map<string,variant>").isNotNull()
        bare = V.get(root, name, "double")
        value = F.when(
            nested, V.first_number(root, tuple(f"{name}.{x}" for x in spec.rating_value))
        ).when(null_if_zero(bare).isNotNull(), bare).otherwise(value)
        count = F.when(
            nested, V.first_number(root, tuple(f"{name}.{x}" for x in spec.rating_count))).otherwise(count)
    return value, count


def located_entity(v: Column, page: PageContext, spec: ItemSpec) -> Column:
    """One object as an entity, through the profile's synonyms."""
    if spec.root:
        return bind(F.coalesce(V.get(v, spec.root), v), lambda root: _located(v, root, page, spec))
    return _located(v, v, page, spec)


def _located(v: Column, root: Column, page: PageContext, spec: ItemSpec) -> Column:
    rating, count = _rating(root, spec)
    count = F.coalesce(count, V.first_number(root, spec.count_fallback))
    address = V.first_text(root, spec.address)
    if spec.address_parts:
        for name in reversed(spec.address):
            parts = [V.first_text(root, tuple(f"{name}.{x}" for x in names)) for names in spec.address_parts]
            address = F.when(
                V.get(root, name, "map<string,variant>").isNotNull(), join_present(parts)).otherwise(address)

    def label(c: Column) -> Column:
        return F.when(V.as_map(c).isNotNull(), V.first_text(c, spec.category_label)).otherwise(
            F.try_variant_get(c, "$", "string"))

    raw = first_usable([V.get(root, n, "array<variant>") for n in spec.categories], lambda a: F.size(a) > 0)
    tags = F.transform(raw, label)
    delivery = F.coalesce(*[V.get(root, n) for n in spec.delivery]) if spec.delivery else root
    eta = V.first_text(delivery, spec.eta)
    if spec.eta_unit:
        eta = F.when(eta.try_cast("double").isNotNull(), F.concat(eta, F.lit(" min"))).otherwise(eta)
    if spec.eta_range:
        lo, hi = spec.eta_range
        for name in reversed(spec.eta):
            spread = F.concat(
                F.coalesce(V.text(delivery, f"{name}.{lo}"), F.lit("")), F.lit("-"),
                F.coalesce(V.text(delivery, f"{name}.{hi}"), F.lit("")), F.lit(" min"))
            eta = F.when(V.get(delivery, name, "map<string,variant>").isNotNull(), spread).otherwise(eta)
    fee, min_order = V.first_text(delivery, spec.fee), V.first_text(delivery, spec.min_order)
    if spec.delivery:
        fee, min_order = F.nullif(fee, F.lit("0")), F.nullif(min_order, F.lit("0"))
    url = V.first_text(root, spec.url)
    if spec.url_prefix:
        url = F.when(url.startswith("http"), url).otherwise(slug_url(url, spec.url_prefix))
    return page.entity(
        name=V.first_text(v, spec.name),
        address=address,
        neighborhood=V.first_text(root, spec.neighborhood),
        food_type=first_item(tags),
        categories=drop_empty(tags),
        rating=rating,
        num_ratings=F.floor(count),
        price_range=V.first_text(root, spec.price),
        delivery_fee=fee,
        delivery_time=eta,
        min_order=min_order,
        is_promoted=V.any_true(root, spec.promoted),
        is_new=V.any_true(root, spec.new),
        latitude=V.first_number(root, spec.latitude),
        longitude=V.first_number(root, spec.longitude),
        restaurant_url=url,
        image_url=V.first_text(root, spec.image),
    )


def located_entities(elements: Column, page: PageContext) -> Column:
    """All entities of the regex-located state, in script, pattern and match order."""
    spec = page.source.items
    return F.transform(
        located_items(located_documents(elements, spec), spec), lambda v: located_entity(v, page, spec))
