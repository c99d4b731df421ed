"""Profiles that a user adds to the built-in ones."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from gleaner.profiles.catalog import PROFILES
from gleaner.profiles.model import SourceProfile

_ADDED: dict[str, SourceProfile] = {}


def register_profile(
    source: SourceProfile | str, rows: Callable[[str, dict], Iterable[dict]] | None = None, **fields
) -> SourceProfile:
    """Add a source: a profile as data, or a key and a function that reads its pages.

    ``rows(html, page)`` gives dictionaries of entity columns; see ``plans.code_step``. ``fields`` are further ones of
    the profile, such as name, domain, city_steps or listing_patterns. All steps use registered sources from then on.
    """
    if isinstance(source, str):
        source = SourceProfile(**{"key": source, "name": source, "domain": "", "base_url": "", **fields, "rows": rows})
    if source.key in {p.key for p in PROFILES} | set(_ADDED):
        raise ValueError(f"a source of this key exists: {source.key}")
    _ADDED[source.key] = source
    return source


def forget_profile(key: str) -> None:
    _ADDED.pop(key, None)


def all_profiles() -> tuple[SourceProfile, ...]:
    return (*PROFILES, *_ADDED.values())
