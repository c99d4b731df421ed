"""HTML pages as arrays of nodes, and selectors as predicates on a node.

The only Python step is one Arrow function that turns page text into its node array. Nodes are stored in
document order, so the content of an element is the slice that follows it. With a ``SelectorTable`` the same pass
notes for every node which selectors it fits, as bits of ``hits``; asking for a selector is then one mask test.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import cache, reduce
from html.parser import HTMLParser
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.binding import bind

TEXT, CODE = "#text", "#code"
NODE_TYPE = "array<struct<pre:int,last:int,parent:int,tag:string,attrs:map<string,string>,text:string,hits:bigint>>"
KNOWN_LOOKS = 50_000
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont bgsound command frame "
    "image isindex keygen menuitem nextid spacer".split())
_OPAQUE = frozenset(("script", "style", "template"))


class _Collector(HTMLParser):
    """Appends the nodes of one page to flat lists."""

    def __init__(self, keep: frozenset[str] | None, bits: _Bits):
        super().__init__(convert_charrefs=True)
        self.keep, self.bits = keep, bits
        self.read = None if keep is None else keep | bits.attrs
        self.last: list[int] = []
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.attrs: list[list[tuple[str, str]]] = []
        self.text: list[str | None] = []
        self.hits: list[int] = []
        self.open: list[int] = []

    def _add(self, tag: str, attrs: list[tuple[str, str]], text: str | None, hits: int) -> int:
        at = len(self.tag)
        self.last.append(at)
        self.parent.append(self.open[-1] if self.open else -1)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.hits.append(hits)
        return at

    def handle_starttag(self, tag, attrs):
        read = {k: v or "" for k, v in attrs if self.read is None or k in self.read}
        if "class" in read:
            read["class"] = " ".join(read["class"].split())
        kept = [(k, v) for k, v in read.items() if self.keep is None or k in self.keep]
        at = self._add(tag, kept, None, self.bits.of(tag, read))
        if tag not in _VOID:
            self.open.append(at)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.tag[self.open[depth]] == tag:
                self._close_to(depth)
                break

    def handle_data(self, data):
        inside = self.open and self.tag[self.open[-1]] in _OPAQUE
        kind = CODE if inside else TEXT
        self._add(kind, [], data, self.bits.of(kind, {}))

    def _close_to(self, depth: int) -> None:
        end = len(self.tag) - 1
        for at in self.open[depth:]:
            self.last[at] = end
        del self.open[depth:]

    def finish(self) -> None:
        self._close_to(0)


def _collect(page: str, keep: frozenset[str] | None, bits: _Bits) -> _Collector:
    nodes = _Collector(keep, bits)
    try:
        nodes.feed(page)
        nodes.close()
    except (AssertionError, ValueError):
        pass  # broken markup: the nodes read so far stand
    nodes.finish()
    return nodes


def _to_arrow(pages: pa.Array, keep: frozenset[str] | None, bits: _Bits) -> pa.Array:
    offsets, pre, last, parent, tag, text, hits = [], [], [], [], [], [], []
    attr_offsets, keys, values = [0], [], []
    for page in pages.to_pylist():
        if page is None:
            offsets.append(None)
            continue
        offsets.append(len(pre))
        got = _collect(page, keep, bits)
        pre.extend(range(len(got.tag)))
        last.extend(got.last)
        parent.extend(got.parent)
        tag.extend(got.tag)
        text.extend(got.text)
        hits.extend(got.hits)
        for pairs in got.attrs:
            for key, value in pairs:
                keys.append(key)
                values.append(value)
            attr_offsets.append(len(keys))
    offsets.append(len(pre))
    i32, string = pa.int32(), pa.string()
    attrs = pa.MapArray.from_arrays(
        pa.array(attr_offsets, i32), pa.array(keys, string), pa.array(values, string))
    nodes = pa.StructArray.from_arrays(
        [pa.array(pre, i32), pa.array(last, i32), pa.array(parent, i32), pa.array(tag, string), attrs,
         pa.array(text, string), pa.array(hits, pa.int64())],
        names=["pre", "last", "parent", "tag", "attrs", "text", "hits"])
    return pa.ListArray.from_arrays(pa.array(offsets, i32), nodes)


def parse_nodes(
    html: Column, keep_attrs: frozenset[str] | None = None, table: SelectorTable | None = None
) -> Column:
    """Node array of the page text; NULL stays NULL and costs nothing.

    ``keep_attrs`` limits the attributes that are carried to those a profile looks at. ``table`` fills ``hits``, which
    is zero without one; attributes that only its selectors test need not be carried.
    """
    selectors = table.numbered if table else ()

    @F.arrow_udf(NODE_TYPE)
    def nodes(pages: pa.Array) -> pa.Array:
        return _to_arrow(pages, keep_attrs, _Bits(selectors))

    # Declared non-deterministic so that the optimizer never copies the call into later expressions.
    return nodes.asNondeterministic()(html)


_PART = re.compile(
    r"""(?P<tag>^[a-z][a-z0-9-]*)|\.(?P<cls>[\w-]+)|"""
    r"""(?P<neg>:not\()?\[(?P<attr>[\w-]+)(?:(?P<op>[*^$]?=)"(?P<val>[^"]*)")?\](?(neg)\))""")


@cache
def _compound(selector: str) -> tuple[dict, ...]:
    parts, at = [], 0
    while at < len(selector):
        m = _PART.match(selector, at)
        if not m:
            raise ValueError(f"unsupported selector: {selector}")
        parts.append(m.groupdict())
        at = m.end()
    return tuple(parts)


def _alternatives(selector: str) -> list[str]:
    return [s.strip() for s in selector.split(",")]


class _Bits:
    """Which of the numbered selectors an element fits; elements that look alike to all of them are tested once."""

    def __init__(self, numbered: tuple[str, ...]):
        self.rules = [(1 << i, _compound(s)) for i, s in enumerate(numbered)]
        parts = [p for _, rule in self.rules for p in rule]
        values = {p["attr"] for p in parts if p["op"]} | ({"class"} if any(p["cls"] for p in parts) else set())
        self.values = sorted(values)
        self.present = sorted({p["attr"] for p in parts if p["attr"]} - values)
        self.attrs = frozenset(self.values) | frozenset(self.present)
        self.known: dict[tuple, int] = {}

    def of(self, tag: str, attrs: dict[str, str]) -> int:
        look = (tag, *map(attrs.get, self.values), *[a in attrs for a in self.present])
        bits = self.known.get(look)
        if bits is None:
            if len(self.known) >= KNOWN_LOOKS:
                self.known.clear()
            bits = sum(bit for bit, rule in self.rules if all(_fits(tag, attrs, part) for part in rule))
            self.known[look] = bits
        return bits


def _fits(tag: str, attrs: dict[str, str], part: dict) -> bool:
    if part["tag"]:
        return tag == part["tag"]
    if part["cls"]:
        return f" {part['cls']} " in f" {attrs.get('class', '')} "
    value, wanted = attrs.get(part["attr"]), part["val"]
    hit = value is not None and {
        None: lambda: True, "=": lambda: value == wanted, "*=": lambda: wanted in value,
        "^=": lambda: value.startswith(wanted), "$=": lambda: value.endswith(wanted)}[part["op"]]()
    return not hit if part["neg"] else hit


class SelectorTable:
    """Selectors with a bit each; commas separate alternatives, which share their bit with equal ones.

    A long holds 63 of them; a selector with an alternative beyond that is tested by its expression.
    """

    def __init__(self, selectors: Iterable[str]):
        found = dict.fromkeys(a for s in selectors for a in _alternatives(s))
        self.numbered = tuple(found)[:63]
        self._bit = {a: 1 << i for i, a in enumerate(self.numbered)}

    def mask(self, selector: str) -> int | None:
        bits = [self._bit.get(a) for a in _alternatives(selector)]
        return None if None in bits else reduce(or_, bits)


def attr(n: Column, name: str) -> Column:
    return F.try_element_at(n["attrs"], F.lit(name))


def _test(n: Column, part: dict) -> Column:
    if part["tag"]:
        return n["tag"] == part["tag"]
    if part["cls"]:
        return F.concat(F.lit(" "), attr(n, "class"), F.lit(" ")).contains(f" {part['cls']} ")
    value, wanted = attr(n, part["attr"]), part["val"]
    hit = {
        None: lambda: value.isNotNull(), "=": lambda: value == wanted, "*=": lambda: value.contains(wanted),
        "^=": lambda: value.startswith(wanted), "$=": lambda: value.endswith(wanted),
    }[part["op"]]()
    hit = F.coalesce(hit, F.lit(False))
    return ~hit if part["neg"] else hit


def matches(n: Column, selector: str, table: SelectorTable | None = None) -> Column:
    """Whether a node fits the selector: tag, class, attribute tests, ``:not([…])`` and commas.

    ``table`` is the one the nodes were parsed with, if any.
    """
    mask = table.mask(selector) if table else None
    if mask is not None:
        return n["hits"].bitwiseAND(F.lit(mask).cast("bigint")) != 0
    any_of = None
    for alt in _alternatives(selector):
        all_of = None
        for part in _compound(alt):
            test = _test(n, part)
            all_of = test if all_of is None else all_of & test
        any_of = all_of if any_of is None else any_of | all_of
    return F.coalesce(any_of, F.lit(False))


def selector_attrs(*selectors: str) -> frozenset[str]:
    """Attributes the selectors look at."""
    names = set()
    for selector in selectors:
        for alt in _alternatives(selector):
            for part in _compound(alt):
                names |= {part["attr"]} if part["attr"] else {"class"} if part["cls"] else set()
    return frozenset(names)


def select(nodes: Column, selector: str, table: SelectorTable | None = None) -> Column:
    """All fitting nodes in document order."""
    return F.filter(nodes, lambda n: matches(n, selector, table))


def select_one(nodes: Column, selector: str, table: SelectorTable | None = None) -> Column:
    return F.get(select(nodes, selector, table), F.lit(0))


def inside(nodes: Column, n: Column, first: Column | int = 0) -> Column:
    """Nodes below ``n``; ``first`` is the document position of the first node of ``nodes``."""
    return F.slice(nodes, n["pre"] + F.lit(2) - first, n["last"] - n["pre"])


def text_of(nodes: Column, n: Column, first: Column | int = 0) -> Column:
    """All text below ``n`` in document order; NULL without a node."""

    def joined(n: Column) -> Column:
        parts = F.filter(inside(nodes, n, first), lambda x: x["tag"] == TEXT)
        return F.array_join(F.transform(parts, lambda x: x["text"]), "")

    return bind(n, joined)
