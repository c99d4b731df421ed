"""License scans by ordered signature rules.

The words of a whole text are matched against some 250 hand-written regular expressions. A rule is tried only if its
keyword is among the words of the text, so most texts cost one set intersection. Detections may overlap; one is
suppressed if its words lie within those of another detection of higher priority, or of the same priority with more
words, or with the same words and an earlier rule. Suppression is transitive, so one sweep over the detections by start
decides it: for each priority the furthest end seen so far is all that it needs.

Phrases that the caller gives are rules of priority 0 whose every place is told and whose labels always stay.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.llm.license_rules import WEIGHTS, Rule, phrase, rules

# ASCII letters become small, digits and all bytes above 0x7F stay, everything else parts words.
_WORD_BYTES = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())
OUT_TEXTS = 2_000
SPAN = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("priority", T.IntegerType()), T.StructField("phrase", T.BooleanType()), T.StructField("kept", T.BooleanType())])


class Span(NamedTuple):
    label: str
    start: int
    end: int
    priority: int
    phrase: bool
    order: int


class Scanner:
    """Detections in one text at a time."""

    def __init__(self, table: list[Rule]):
        self.table, self.by_keyword = table, defaultdict(list)
        for i, r in enumerate(table):
            self.by_keyword[r.keyword].append(i)
        self.keywords = frozenset(self.by_keyword)

    def __call__(self, text: bytes) -> tuple[int, list[Span]]:
        """(number of words, detections in the order of their starts)."""
        words = text.translate(_WORD_BYTES).split()
        present = self.keywords.intersection(words)
        if not present:
            return len(words), []
        joined, spaces, found = b" ".join(words), None, []
        for i in sorted(i for k in present for i in self.by_keyword[k]):
            r = self.table[i]
            for m in r.pattern.finditer(joined):
                if spaces is None:
                    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
                a, b = np.searchsorted(spaces, m.span()).tolist()
                label = m.expand(r.label.encode()).decode() if "\\" in r.label else r.label
                found.append(Span(label, a, b + 1, r.priority, r.base, i))
        return len(words), sorted(found, key=lambda s: (s.start, -s.end, -s.priority, s.order))


def kept(spans: list[Span]) -> list[bool]:
    """Whether each detection, in the order of a scan, stays: none of at least its priority that came before covers it."""
    furthest, out = dict.fromkeys(WEIGHTS, -1), []
    for s in spans:
        out.append(all(end < s.end for priority, end in furthest.items() if priority >= s.priority))
        furthest[s.priority] = max(furthest[s.priority], s.end)
    return out


def certainty(spans: list[Span], stays: list[bool]) -> float:
    """One minus the chance that the best detection of every kept label is wrong."""
    best: dict[str, float] = {}
    for s, stay in zip(spans, stays):
        if stay:
            best[s.label] = max(best.get(s.label, 0.0), WEIGHTS[s.priority])
    doubt = 1.0
    for label in sorted(best):
        doubt *= 1.0 - best[label]
    return 1.0 - doubt


def _scan(phrases: list[tuple[str, str]], id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner([*rules(), *[phrase(words, label) for words, label in phrases]])
        span_type = to_arrow_type(SPAN)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_TEXTS):
                part = batch.slice(at, OUT_TEXTS)
                counts, scores, flat, ends = [], [], [], [0]
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    n, spans = scanner(text)
                    stays = kept(spans)
                    counts.append(n)
                    scores.append(certainty(spans, stays))
                    flat.extend((s.label, s.start, s.end, s.priority, s.phrase, stay) for s, stay in zip(spans, stays))
                    ends.append(len(flat))
                columns = list(zip(*flat)) if flat else [[]] * len(SPAN.fields)
                values = pa.StructArray.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, span_type)], fields=list(span_type))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(id_type), pa.array(counts, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), pa.array(scores, pa.float64())],
                    names=["doc_id", "n_words", "spans", "score"])

    return run


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = (), id_col: Column | str = "doc_id",
         text_col: Column | str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, spans (label, start, end, priority, phrase, kept), score (0 to 1).

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters of the whole text; a span has its
    words from ``start`` up to ``end``. ``phrases`` are (words, label). A null text is an empty one, which has no words,
    no spans and a score of 0. Repeated rows and null ids are rows of their own, an empty table gives none. Other
    columns do not matter.
    """
    source = docs.select(
        (F.col(id_col) if isinstance(id_col, str) else id_col).alias("doc_id"),
        F.coalesce(F.col(text_col) if isinstance(text_col, str) else text_col, F.lit("")).alias("text"))
    id_field = source.schema["doc_id"]
    schema = T.StructType([
        T.StructField("doc_id", id_field.dataType), T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(_scan(list(phrases), to_arrow_type(id_field.dataType)), schema)


def labels_of(spans: Column, which) -> Column:
    """Distinct labels of the spans for which ``which`` holds, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(spans, which), lambda s: s["label"]))), ",")
