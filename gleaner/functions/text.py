"""Text expressions, all built from JVM functions."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.binding import bind, first_usable

# Java's \s with (?U) plus the four separators Python's split() also treats as space.
_SPACE = r"(?U)[\s\x1c-\x1f]+"

# Names a browser accepts without the closing semicolon, longest first so that the regex prefers them.
_OPEN_NAMES = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
_SHELVES = 1024


def _shelf_of(name: str) -> int:
    first, second, third = (ord(name[i:i + 1] or "\0") for i in range(3))
    return (first * 961 + second * 31 + third + 7 * len(name)) % _SHELVES


def _shelf(name: Column) -> Column:
    """The same number as a column."""
    first, second, third = (F.ascii(F.substring(name, i, 1)) for i in (1, 2, 3))
    return F.pmod(first * 961 + second * 31 + third + F.length(name) * 7, F.lit(_SHELVES))


# Maps are searched from end to end, so the names are spread over many small ones.
_NAMED: list[dict[str, str]] = [{} for _ in range(_SHELVES)]
for _name, _char in html.entities.html5.items():
    _NAMED[_shelf_of(_name)][_name] = _char
_NAMED_JSON = json.dumps(_NAMED)
# Numeric references to the C1 range mean the Windows-1252 character.
_C1_JSON = json.dumps({
    str(b): bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xA0)
} | {"0": "�", "13": "\r"})


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_present(*cols: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return first_usable(list(cols), lambda x: x != "")


def squash_space(c: Column) -> Column:
    """Trim and collapse whitespace, no-break space included."""
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def _code_point(n: Column) -> Column:
    return bind(n, _code_point_char)


def _code_point_char(n: Column) -> Column:
    special = F.try_element_at(F.from_json(F.lit(_C1_JSON), "map<string,string>"), n.cast("string"))
    invalid = n.isNull() | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    # Non-characters and control codes are dropped.
    dropped = (
        n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF)
        | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (
        F.coalesce(special, F.when(invalid, F.lit("�")).when(dropped, F.lit("")).otherwise(char))
    )


def _piece(p: Column) -> Column:
    """Resolve the reference at the start of a piece that begins with ``&``."""
    dec = F.regexp_extract(p, r"^&#([0-9]+)", 1).try_cast("bigint")
    hexa = F.conv(F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]+)", 1), 16, 10).try_cast("bigint")
    table = F.from_json(F.lit(_NAMED_JSON), "array<map<string,string>>")
    closed = F.regexp_extract(p, r"^&([A-Za-z][A-Za-z0-9]*;)", 1)
    opened = F.regexp_extract(p, "^&(" + "|".join(_OPEN_NAMES) + ")", 1)

    def replaced(name: Column) -> Column:
        char = F.try_element_at(F.get(table, _shelf(name)), name)
        return F.when(name != "", F.concat(char, F.substr(p, F.length(name) + 2)))

    named = F.coalesce(bind(closed, replaced), bind(opened, replaced), p)

    return (
        F.when(p.rlike("^&#[0-9]"), F.concat(_code_point(dec), F.regexp_replace(p, "^&#[0-9]+;?", "")))
        .when(p.rlike("^&#[xX][0-9a-fA-F]"), F.concat(
            _code_point(hexa), F.regexp_replace(p, "^&#[xX][0-9a-fA-F]+;?", "")))
        .when(p.startswith("&"), named).otherwise(p)
    )


def unescape_entities(c: Column) -> Column:
    """HTML character references to characters; text without ``&`` is passed through untouched."""
    pieces = F.transform(
        F.split(c, "(?=&)"), _piece)
    return F.when(F.contains(c, F.lit("&")), F.array_join(pieces, "")).otherwise(c)


def unescape_basic(c: Column) -> Column:
    """Only ``&quot;`` and ``&amp;``, as used in attribute-embedded JSON."""
    return F.replace(F.replace(c, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))


def clean_text(c: Column) -> Column:
    return squash_space(unescape_entities(c))


def title_case(c: Column) -> Column:
    """Capitalise after every non-letter, so digits and apostrophes start a new word too."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    words = F.transform(
        runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))
    plain = c.rlike(r"^[\p{L} ]*$")
    return F.when(plain, F.initcap(c)).otherwise(F.array_join(words, ""))


def comparison_key(c: Column, trim: bool = True) -> Column:
    """NULL-safe lower-case key."""
    key = F.lower(F.coalesce(c, F.lit("")))
    return F.trim(key) if trim else key


def join_present(cols: list[Column], sep: str = ", ") -> Column:
    """Join the parts that are neither NULL nor empty."""
    return F.array_join(F.filter(F.array(*cols), lambda x: x.isNotNull() & (x != "")), sep)


def list_to_pipe(c: Column) -> Column:
    return F.array_join(c, "|")


def pipe_to_list(c: Column) -> Column:
    return F.when(blank_to_null(c).isNull(), F.array().cast("array<string>")).otherwise(F.split(c, r"\|"))


def split_list(c: Column, sep_regex: str) -> Column:
    """Split, trim each part, drop empty parts."""
    return F.filter(F.transform(F.split(c, sep_regex), squash_space), lambda x: x != "")


def drop_empty(c: Column) -> Column:
    return F.filter(c, lambda x: x.isNotNull() & (x != ""))


def drop_tokens(c: Column, tokens: tuple[str, ...]) -> Column:
    """Drop array items whose lower-case form is one of the tokens."""
    return F.filter(c, lambda x: ~F.lower(x).isin(*tokens)) if tokens else c


def first_item(c: Column) -> Column:
    return F.get(c, F.lit(0))


def short_hash(c: Column, n: int = 12) -> Column:
    return F.substring(F.md5(c.cast("binary")), 1, n)


def before_last(c: Column, sep: str = "_") -> Column:
    return blank_to_null(F.regexp_extract(c, f"^(.*){sep}([^{sep}]*)$", 1))


def after_last(c: Column, sep: str = "_") -> Column:
    return blank_to_null(F.regexp_extract(c, f"^(.*){sep}([^{sep}]*)$", 2))


def path_safe(c: Column) -> Column:
    """A partition-key text without the folder separator."""
    return F.replace(c, F.lit("/"), F.lit("-"))
