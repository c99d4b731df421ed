"""URL expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import blank_to_null, title_case

# Host and style patterns, and the characters a storage key may keep.
HOST = r"https?://([^/]+)"
STYLE_URL = r"""url\(["']?([^"']+?)["']?\)"""
SAFE_CHARS = (
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_./"
    "áéíóúñüÁÉÍÓÚÑÜàèìòùâêîôûäëïöüçÀÈÌÒÙÂÊÎÔÛÄËÏÖÜÇ"
)
NO_DOMAIN = "NO_DOMAIN"


def host(url: Column) -> Column:
    """Host of an absolute URL, ``NO_DOMAIN`` when there is none."""
    return F.coalesce(blank_to_null(F.regexp_extract(url, HOST, 1)), F.lit(NO_DOMAIN))


def scheme(url: Column) -> Column:
    return blank_to_null(F.regexp_extract(url, r"^([a-z]+)://", 1))


def path(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(url, r"^[a-z]+://[^/?#]+([^?#]*)", 1)


def registered_domain(url: Column) -> Column:
    """Last two labels of the host."""
    return blank_to_null(F.regexp_extract(url, r"^[a-z]+://(?:[^/?#.]+\.)*?([^/?#.]+\.[^/?#.]+)(?:[/?#:]|$)", 1))


def absolutise(url: Column, base: str) -> Column:
    """Put the base before a relative URL; absent stays absent."""
    return F.when(blank_to_null(url).isNull() | url.startswith("http"), url).otherwise(
        F.concat(F.lit(base), url))


def slug_url(slug: Column, prefix: str) -> Column:
    return F.when(blank_to_null(slug).isNotNull(), F.concat(F.lit(prefix), slug))


def percent_decode(c: Column) -> Column:
    """Percent decoding that keeps ``+`` and leaves broken escapes alone."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def storage_key(url: Column) -> Column:
    """A readable key for storing a page: decoded path, unsafe characters replaced, never empty."""
    decoded = F.split_part(percent_decode(path(url)), F.lit("?"), F.lit(1))
    unsafe = "[^" + SAFE_CHARS.replace("-", r"\-") + "]"
    parts = F.transform(
        F.split(F.regexp_replace(decoded, unsafe, "_"), "/"),
        lambda p: F.regexp_replace(F.regexp_replace(p, "_+", "_"), "^_|_$", ""))
    key = F.array_join(F.filter(parts, lambda p: p != ""), "/")
    return F.coalesce(blank_to_null(key), F.lit("index"))


def reversed_domain(domain: Column) -> Column:
    """``a.b.c`` to ``c,b,a``."""
    return F.array_join(F.reverse(F.split(domain, r"\.")), ",")


def style_image(style: Column) -> Column:
    """Image URL of a CSS background."""
    return blank_to_null(F.regexp_extract(style, STYLE_URL, 1))


def pattern_bucket(path_col: Column, prefixes: dict[str, str], fallback: str) -> Column:
    """Label of the first LIKE pattern that fits, else the fallback regex' first group."""
    out = None
    for pattern, label in prefixes.items():
        out = (F.when if out is None else out.when)(path_col.like(pattern), F.lit(label))
    rest = F.regexp_extract(path_col, fallback, 1)
    return rest if out is None else out.otherwise(rest)


@dataclass(frozen=True)
class CategoryRule:
    """Reads a category from a listing URL."""

    pattern: str
    reject: tuple[str, ...] = ()
    reject_prefix: str = ""


def category_from_url(url: Column, rule: CategoryRule) -> Column:
    raw = F.regexp_replace(F.regexp_extract(url, rule.pattern, 1), r"_\d+$", "")
    keep = raw != ""
    if rule.reject:
        keep &= ~raw.isin(*rule.reject)
    if rule.reject_prefix:
        keep &= ~raw.startswith(rule.reject_prefix)
    return F.when(keep, title_case(F.translate(raw, "-_", "  ")))


@dataclass(frozen=True)
class CityStep:
    """One way to read a city from a URL; steps are tried in order and the first that matches decides."""

    pattern: str
    strip: tuple[str, ...] = ()
    separators: str = "-"
    decode: bool = False
    reject_equal: tuple[str, ...] = ()
    reject_contains: tuple[str, ...] = ()
    none: bool = False


def _city(url: Column, step: CityStep) -> Column:
    if step.none:
        return F.lit(None).cast("string")
    raw = F.regexp_extract(url, step.pattern, 1)
    text = percent_decode(raw) if step.decode else raw
    for pattern in step.strip:
        text = F.regexp_replace(text, pattern, "")
    text = F.trim(F.translate(text, step.separators, " " * len(step.separators)))
    keep = text != ""
    if step.reject_equal:
        keep &= ~raw.isin(*step.reject_equal)
    if step.reject_contains:
        keep &= ~F.lower(text).rlike("|".join(step.reject_contains))
    return F.when(keep, title_case(text))


def city_from_url(url: Column, steps: tuple[CityStep, ...]) -> Column:
    out = None
    for step in steps:
        out = (F.when if out is None else out.when)(url.rlike(step.pattern), _city(url, step))
    return F.lit(None).cast("string") if out is None else out
