"""Token counts of whole texts, huge documents being encoded in overlapping chunks that are spliced afterwards.

A text up to ``chunk + overlap`` characters is encoded in its own task. Words recur, so the worker encodes each
distinct piece between single spaces once: the pre-tokenizer always breaks before a single space between two other
characters, hence a text's count is the sum over its pieces. Texts with any other white space at a break are
encoded whole.

A longer text is cut into chunks that overlap their successors, and the chunks are dealt over the cluster.
Pre-tokenization looks forward only, so once the parse of a chunk starts a pre-token where the parse of its
predecessor starts one too, both agree from there on. The parse of the predecessor is proven up to a margin before its
end that covers the longest special token and the pattern's look-ahead. A pair of chunks is spliced at the first such
common boundary. Where there is none (one endless run of letters or spaces), the overlap is widened to the whole next
chunk and the chunks of that document are encoded again, until every pair aligns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import Work

CHUNK, OVERLAP = 32_768, 1_024
GROUP_CHARS = 1 << 20
CACHE_PIECES = 400_000
IRREGULAR = -(1 << 50)


@lru_cache(maxsize=4)
def _load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PieceCounter:
    """Token counts of whole texts from the counts of the pieces between single spaces."""

    def __init__(self, path: str):
        self.tokenizer, self.counts, self.heads = _load(path), {}, {}

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, known: dict, pieces: set[str], lead: str) -> None:
        if len(known) > CACHE_PIECES:
            known.clear()
        new = [p for p in pieces if p not in known]
        regular = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        known.update(dict.fromkeys(new, IRREGULAR))
        known.update(zip(regular, self._encoded([lead + p for p in regular])))

    def __call__(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP_CHARS):
                size += len(texts[end])
                end += 1
            out += self._group(texts[at:end])
            at = end
        return out

    def _group(self, texts: list[str]) -> list[int]:
        split = [t.split(" ") for t in texts]
        heads = [s.pop(0) for s in split]
        self._learn(self.heads, set(heads), "")
        self._learn(self.counts, set().union(*split), " ")
        head, count = self.heads.__getitem__, self.counts.__getitem__
        sums = [head(h) + sum(map(count, s)) if h or s else 0 for h, s in zip(heads, split)]
        slow = [i for i, n in enumerate(sums) if n < 0]
        for i, n in zip(slow, self._encoded([texts[i] for i in slow])):
            sums[i] = n
        return sums


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def _first_pass(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            short = [i for i, t in enumerate(texts) if len(t) <= chunk + overlap]
            done = dict(zip(short, count([texts[i] for i in short])))
            take = pa.array(short, pa.int32())
            yield _rows(batch, take, [None] * len(short), [None] * len(short), [None] * len(short),
                        [done[i] for i in short])
            for i, text in enumerate(texts):
                if i in done:
                    continue
                n = -(-(len(text) - overlap) // chunk)
                for k in range(n):
                    piece = text[k * chunk:(k + 1) * chunk + overlap]
                    yield _rows(batch, pa.array([i], pa.int32()), [k], [piece], [chunk], [None])

    return run


def _rows(batch, take, k, text, step, tokens) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(take), batch.column("row").take(take), batch.column("n_bytes").take(take),
         pa.array(k, pa.int32()), pa.array(text, pa.string()), pa.array(step, pa.int64()),
         pa.array(tokens, pa.int64())],
        names=["doc_id", "row", "n_bytes", "k", "text", "step", "n_tokens"])


def pretoken_starts(text: str, pattern, specials) -> list[int]:
    """Where the pre-tokens and special tokens of a text start."""
    starts, at = [], 0
    for m in specials.finditer(text) if specials else ():
        starts += [at + p.start() for p in pattern.finditer(text[at:m.start()])]
        starts.append(m.start())
        at = m.end()
    return starts + [at + p.start() for p in pattern.finditer(text[at:])]


def _encode_pass(path: str, pattern_text: str, overlap: int):
    """Total tokens of a chunk, and per pre-token start in its two overlaps the number of tokens before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, pattern = _load(path), regex.compile(pattern_text)
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        specials = regex.compile("|".join(map(regex.escape, special))) if special else None
        margin = max(map(len, special), default=0) + 3
        for batch in batches:
            cols = [[], [], [], [], []]
            for text, step in zip(batch.column("text").to_pylist(), batch.column("step").to_pylist()):
                found = tokenizer.encode(text, add_special_tokens=False)
                before: dict[int, int] = {}
                for i, (start, _) in enumerate(found.offsets):
                    before.setdefault(start, i)
                starts = [p for p in pretoken_starts(text, pattern, specials) if p in before]
                left = [p for p in starts if p < len(text) and p < overlap]
                right = [p for p in starts if step <= p <= len(text) - margin]
                # Positions count from the start of the overlap, so that both chunks of a pair use the same numbers.
                for col, value in zip(cols, (len(found.ids), left, [before[p] for p in left],
                                             [p - step for p in right], [before[p] for p in right])):
                    col.append(value)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("k"), pa.array(cols[0], pa.int64()),
                 *[pa.array(c, longs) for c in cols[1:]]],
                names=["row", "k", "total", "left", "left_before", "right", "right_before"])

    return run


def _splice(chunks: DataFrame) -> DataFrame:
    """Per pair of neighbouring chunks (row, k, the tokens counted twice); null where they do not align."""
    a = chunks.select("row", "next", "total", "right", "right_before").where("next IS NOT NULL")
    b = chunks.select("row", F.col("k").alias("next"), "left", "left_before")
    at = F.array_min(F.array_intersect("right", "left"))
    end = F.element_at("right_before", F.array_position("right", at).cast("int"))
    begin = F.element_at("left_before", F.array_position("left", at).cast("int"))
    return a.join(b, ["row", "next"]).select(
        "row", F.col("next").alias("k"), F.when(at.isNotNull(), F.col("total") - end + begin).alias("twice"))


def count_tokens(docs: DataFrame, work: Work, path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens.

    ``path`` is a file of the tokenizers library with a byte-level pre-tokenizer that splits by ``pattern``. A null
    text counts as empty: no bytes, no tokens. Repeated rows are counted each, an empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("row", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("k", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("step", T.LongType()),
        T.StructField("n_tokens", T.LongType())])
    first = work.save(texts.mapInArrow(_first_pass(path, chunk, overlap), schema), "first")
    settled = [first.where("k IS NULL").select("doc_id", "n_bytes", "n_tokens")]
    pending = first.where("k IS NOT NULL").select("row", "k", "text", "step")
    heads = first.where("k = 0").select("doc_id", "row", "n_bytes")
    sums = []
    order = Window.partitionBy("row").orderBy("k")
    while True:
        encoded = work.save(
            pending.repartition("row", "k").mapInArrow(
                _encode_pass(path, pattern, overlap),
                "row long, k int, total long, left array<long>, left_before array<long>, right array<long>, "
                "right_before array<long>"), "encoded")
        if encoded.isEmpty():
            break
        pairs = work.save(_splice(encoded.withColumn("next", F.lead("k").over(order))), "pairs")
        bad = pairs.where("twice IS NULL").select("row").distinct()
        total = encoded.groupBy("row").agg(F.sum("total").alias("total"))
        twice = pairs.groupBy("row").agg(F.sum("twice").alias("twice"))
        sums.append(total.join(twice, "row", "left").join(bad, "row", "left_anti").select(
            "row", (F.col("total") - F.coalesce("twice", F.lit(0))).alias("n_tokens")))
        apart = (pending.join(bad, "row", "left_semi")
                 .join(pairs.select("row", "k", F.col("twice").isNull().alias("joined")), ["row", "k"], "left")
                 .withColumn("part", F.sum(F.when(F.coalesce("joined", F.lit(False)), 0).otherwise(1)).over(order)))
        merged = apart.groupBy("row", "part").agg(
            F.min("k").alias("k"), F.sum("step").alias("step"),
            F.sort_array(F.collect_list(F.struct("k", "text", "step"))).alias("parts"))
        text = F.concat(
            F.array_join(F.transform(F.slice("parts", 1, F.size("parts") - 1),
                                     lambda p: F.substr(p["text"], F.lit(1), p["step"].cast("int"))), ""),
            F.element_at("parts", -1)["text"])
        pending = work.save(merged.select("row", "k", text.alias("text"), "step"), "widened")
    for found in sums:
        settled.append(heads.join(found, "row").select("doc_id", "n_bytes", "n_tokens"))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out
