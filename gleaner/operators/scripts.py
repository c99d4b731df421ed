"""Script elements of a page, found without a DOM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comments are matched first so that scripts inside them do not count; an unclosed script runs to the end.
_ELEMENT = r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)"
_OPEN = r"(?is)^<script\b[^>]*>"
_BODY = r"(?is)^<script\b[^>]*>(.*?)(?:</script\s*>)?\z"


def script_elements(html: Column) -> Column:
    """All script elements as text, in document order."""
    return F.filter(
        F.regexp_extract_all(html, F.lit(_ELEMENT), F.lit(0)), lambda s: F.lower(F.substring(s, 1, 7)) == "<script")


def script_body(element: Column) -> Column:
    return F.regexp_extract(element, _BODY, 1)


def bodies(elements: Column) -> Column:
    """Script texts, empty ones left out."""
    return F.filter(F.transform(elements, script_body), lambda b: b != "")


def linked_data_texts(elements: Column) -> Column:
    """Texts of the JSON-LD scripts."""
    return bodies(F.filter(elements, lambda s: s.rlike(
        r"""(?is)^<script\b[^>]*\stype\s*=\s*["']?application/ld\+json["'\s>]""")))


def script_by_id(elements: Column, script_id: str) -> Column:
    """Text of the first script with the given id."""
    hits = F.filter(elements, lambda s: s.rlike(
        rf"""(?s)^<(?i:script)\b[^>]*\s(?i:id)\s*=\s*["']?{script_id}["'\s>]"""))
    return script_body(F.get(hits, F.lit(0)))
