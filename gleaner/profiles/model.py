"""Shape of a source profile."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from gleaner.functions.urls import CategoryRule, CityStep


@dataclass(frozen=True)
class LinkedDataSpec:
    """How JSON-LD items become entities."""

    types: tuple[str, ...]
    search_page: bool = False
    percent_rating: bool = False
    thousands: bool = False
    geo: bool = False
    locality: bool = False
    locality_strip: str | None = None
    locality_as_city: bool = False
    reject_names: tuple[str, ...] = ()


@dataclass(frozen=True)
class ItemSpec:
    """How an object of regex-located page state becomes an entity; tuples are synonyms in order."""

    patterns: tuple[str, ...]
    containers: tuple[str, ...]
    name: tuple[str, ...]
    root: str | None = None
    unescape: bool = False
    rating: tuple[str, ...] = ("rating",)
    rating_value: tuple[str, ...] = ()
    rating_count: tuple[str, ...] = ()
    count_fallback: tuple[str, ...] = ()
    address: tuple[str, ...] = ()
    address_parts: tuple[tuple[str, ...], ...] = ()
    neighborhood: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    category_label: tuple[str, ...] = ("name",)
    delivery: tuple[str, ...] = ()
    fee: tuple[str, ...] = ()
    eta: tuple[str, ...] = ()
    eta_range: tuple[str, str] | None = None
    eta_unit: bool = False
    min_order: tuple[str, ...] = ()
    promoted: tuple[str, ...] = ()
    new: tuple[str, ...] = ()
    latitude: tuple[str, ...] = ()
    longitude: tuple[str, ...] = ()
    price: tuple[str, ...] = ()
    url: tuple[str, ...] = ()
    url_prefix: str | None = None
    image: tuple[str, ...] = ()


@dataclass(frozen=True)
class KeyedStateSpec:
    """State split over several maps that share the entity id."""

    marker: str
    entities: str
    categories: str
    ratings: str
    fees: str
    etas: str
    url_prefix: str


@dataclass(frozen=True)
class StateTreeSpec:
    """A script with a fixed id whose JSON holds a map of entities at a fixed path."""

    script_id: str
    path: str
    url_prefix: str


@dataclass(frozen=True)
class CardSpec:
    """How HTML cards become entities. Selector lists are in order of preference."""

    cards: tuple[str, ...]
    name: tuple[str, ...]
    # Take the first selector with a usable card rather than the first with any card.
    skip_unusable: bool = True
    unique_names: bool = True
    name_any_length: bool = False
    name_attr: str | None = None
    name_from_parent_title: bool = False
    name_reject: tuple[str, ...] = ()
    rating: str | None = None
    rating_percent: bool = False
    count: str | None = None
    eta: str | None = None
    eta_checked: bool = False
    categories: tuple[str, ...] = ()
    category_split: str | None = None
    category_children: bool = False
    tags: str | None = None
    tags_reject: tuple[str, ...] = ()
    address: str | None = None
    parent_link: bool = False
    image: str | None = None
    image_attrs: tuple[str, ...] = ("src",)
    image_style: bool = False


@dataclass(frozen=True)
class SourceProfile:
    """One site."""

    key: str
    name: str
    domain: str
    base_url: str
    host: str | None = None
    path_like: str = "/%"
    listing_patterns: tuple[str, ...] = ()
    detail_patterns: tuple[str, ...] = ()
    # Detail pages on which linked data makes embedded state redundant.
    detail_page: str | None = None
    excluded_paths: tuple[str, ...] = ()
    url_hosts: tuple[str, ...] = ()
    city_steps: tuple[CityStep, ...] = ()
    category_rule: CategoryRule | None = None
    linked_data: LinkedDataSpec | None = None
    keyed_state: KeyedStateSpec | None = None
    state_tree: StateTreeSpec | None = None
    items: ItemSpec | None = None
    cards: CardSpec | None = None
    # Selectors that mark a page as a listing; such pages are read from their cards first.
    listing_markers: tuple[str, ...] = field(default=())
    # Reads the pages instead of everything above: (html, page) to dictionaries of entity columns.
    rows: Callable[[str, dict], Iterable[dict]] | None = None
