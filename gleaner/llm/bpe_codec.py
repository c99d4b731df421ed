"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

A text is a sequence of pre-tokens, and each pre-token is encoded on its own. So each scan partition is read in blocks:

1. A block replaces pre-tokens by numbers, position by position, and lists its distinct pre-tokens, dealt into slices by
   hash. A pre-token that fills a third of the corpus is one entry per block from here on.
2. The lists are shuffled by slice. All occurrences of a word meet in one task, which encodes it once and sends its
   ids back to each block that asked.
3. The numbered texts lie in buckets by block, so only the answers are shuffled to them; ids take the places of the
   numbers, in order. Decoding looks every
   id up in the token-byte table, which is as large as the vocabulary and never grows with the data.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.llm.common import Work
from gleaner.llm.packed import pack, pack_rising, pack_words, spread, unpack, unpack_rising, unpack_words

BLOCK_CHARS = 24 << 20
BLOCK_WORDS = 400_000
CACHE_WORDS = 300_000
# Text for which a slice holds the distinct words; a task takes slices one after the other.
SLICE_BYTES = 32 << 20
# Spark's default limit for the buckets of a table.
MOST_BUCKETS = 100_000


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def _word_encoder(path: str):
    import tiktoken

    # The pattern takes a whole word, which has been split off before.
    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


class _Block:
    """The numbers of a block's pre-tokens, and its texts as sequences of them.

    Pre-tokens always break before a single space between two other characters. The pieces between such spaces recur,
    so a text is first read as piece numbers, and pieces are replaced by their pre-tokens when the block is complete.
    """

    def __init__(self, pattern):
        self.pattern, self.numbers = pattern, {}
        self.heads, self.pieces = {}, {}
        self.codes: list[int] = []
        self.sizes: list[int] = []
        self.rows: list[tuple[object, np.ndarray]] = []
        self.chars = 0

    def _piece(self, words: list[str]) -> int:
        numbers = self.numbers
        self.codes += [numbers.setdefault(w, len(numbers)) for w in words]
        self.sizes.append(len(words))
        return len(self.sizes) - 1

    def _learn(self, known: dict, lead: str, new) -> None:
        for p in new:
            if not p or p[0].isspace() or p[-1].isspace():
                known[p] = -1
            else:
                known[p] = self._piece([lead + p] if p.isalpha() else self.pattern.findall(lead + p))

    def add(self, doc, text: str) -> None:
        self.chars += len(text)
        head, *rest = text.split(" ")
        if head not in self.heads:
            self._learn(self.heads, "", [head])
        self._learn(self.pieces, " ", [p for p in set(rest) if p not in self.pieces])
        out = np.empty(len(rest) + 1, np.int32)
        out[0] = self.heads[head]
        out[1:] = np.fromiter(map(self.pieces.__getitem__, rest), np.int32, len(rest))
        if out.min() < 0:
            out = np.array([self._piece(self.pattern.findall(text))], np.int32)
        self.rows.append((doc, out))

    def ranked(self) -> tuple[list[str], list[np.ndarray]]:
        """Words by falling frequency, and the rows with those numbers, which pack well."""
        flat, sizes = np.array(self.codes, np.int64), np.array(self.sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        rows = [spread(flat, starts[r], sizes[r]) for _, r in self.rows]
        count = np.bincount(np.concatenate(rows), minlength=len(self.numbers))
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.numbers)
        return [words[i] for i in order], [rank[codes] for codes in rows]


def _number_pass(pattern_text: str, slices: int):
    names = ["block", "slice", "words", "codes", "doc_id", "packed"]

    def texts_of(block: int, kind, done: _Block, found: list[np.ndarray]) -> pa.RecordBatch:
        n = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
             pa.nulls(n, pa.binary()), pa.array([d for d, _ in done.rows], kind),
             pa.array([pack(c) for c in found], pa.binary())], names=names)

    def lists_of(block: int, kind, words: list[str]) -> Iterator[pa.RecordBatch]:
        dealt: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            dealt.setdefault(xxhash.xxh64_intdigest(w) % slices, []).append(i)
        for s, places in dealt.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([s], pa.int32()),
                 pa.array([pack_words([words[i].encode() for i in places])], pa.binary()),
                 pa.array([pack_rising(np.array(places, np.uint32))], pa.binary()), pa.nulls(1, kind), pa.nulls(1, pa.binary())],
                names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(pattern_text)
        block, now = TaskContext.get().partitionId() << 24, _Block(pattern)
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if now.rows and (now.chars + len(text) > BLOCK_CHARS or len(now.numbers) > BLOCK_WORDS):
                    words, found = now.ranked()
                    yield texts_of(block, kind, now, found)
                    yield from lists_of(block, kind, words)
                    block, now = block + 1, _Block(pattern)
                now.add(doc, text)
        if now.rows:
            words, found = now.ranked()
            yield texts_of(block, kind, now, found)
            yield from lists_of(block, kind, words)

    return run


def _encode_pass(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known, slice_now = _word_encoder(path).encode_ordinary, {}, None
        for batch in batches:
            for block, s, packed, codes in zip(*(batch.column(n).to_pylist() for n in ("block", "slice", "words", "codes"))):
                if s != slice_now or len(known) > CACHE_WORDS:
                    known.clear()
                    slice_now = s
                words = [w.decode() for w in unpack_words(packed)]
                for w in [w for w in set(words) if w not in known]:
                    known[w] = encode(w)
                found = list(map(known.__getitem__, words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([codes], pa.binary()),
                     pa.array([pack(np.array(list(chain.from_iterable(found)), np.uint32))], pa.binary()),
                     pa.array([pack(np.array(list(map(len, found)), np.uint32))], pa.binary())],
                    names=["block", "codes", "ids", "sizes"])

    return run


class Decoder:
    """The token-byte table; decoding joins it to ids by position."""

    def __init__(self, path: str):
        table = _token_bytes(path)
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, ids: np.ndarray) -> bytes:
        return spread(self.flat, self.starts[ids], self.sizes[ids]).tobytes()


@lru_cache(maxsize=1)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


class _Answers:
    """Ids of a block's words by number."""

    def __init__(self):
        self.parts, self.starts, self.sizes, self.total = [], np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        self.flat = None

    def add(self, codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        need = int(codes.max()) + 1 - len(self.sizes)
        if need > 0:
            self.starts = np.concatenate([self.starts, np.zeros(need, np.int64)])
            self.sizes = np.concatenate([self.sizes, np.zeros(need, np.int64)])
        self.starts[codes] = np.cumsum(sizes) - sizes + self.total
        self.sizes[codes] = sizes
        self.parts.append(ids)
        self.total += len(ids)

    def ids(self, places: np.ndarray) -> np.ndarray:
        if self.flat is None:
            self.flat = np.concatenate([*self.parts, np.zeros(0, np.uint32)]).astype(np.int32)
        return spread(self.flat, self.starts[places], self.sizes[places])


def _meet(path: str, id_type):
    """Ids of a block's texts from its answers, and the bytes they decode to."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        decode, known = _decoder(path), _Answers()
        for codes, ids, sizes in zip(*(answers.column(n).to_pylist() for n in ("codes", "ids", "sizes"))):
            known.add(unpack_rising(codes, np.uint32), unpack(ids, np.uint32), unpack(sizes, np.uint32).astype(np.int64))
        ids = [known.ids(unpack(p, np.uint32)) for p in texts.column("packed").to_pylist()]
        decoded = [decode(i) for i in ids]
        ends = np.cumsum([0, *map(len, ids)])
        return pa.Table.from_arrays(
            [texts.column("doc_id").cast(id_type),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]))),
             pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])

    return run


def encode_and_decode(docs: DataFrame, work: Work, path: str, pattern: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array<int>) and decoded, the bytes that those ids stand for.

    A null text counts as empty: no ids and no bytes. Repeated rows are encoded each, an empty table gives no rows.
    """
    # A slice of words stays as small whatever the size of the corpus.
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    slices = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))
    field = docs.schema[id_col]
    id_field = T.StructField("doc_id", field.dataType)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("slice", T.IntegerType()),
        T.StructField("words", T.BinaryType()), T.StructField("codes", T.BinaryType()),
        id_field, T.StructField("packed", T.BinaryType())])
    numbered = work.save_buckets(rows.mapInArrow(_number_pass(pattern, slices), schema), "block", min(slices, MOST_BUCKETS), "numbered")
    lists = numbered.where("slice IS NOT NULL").select("block", "slice", "words", "codes")
    answers = (lists.repartition("slice").sortWithinPartitions("slice")
               .mapInArrow(_encode_pass(path), "block long, codes binary, ids binary, sizes binary"))
    texts = numbered.where("packed IS NOT NULL").select("block", "doc_id", "packed")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _meet(path, to_arrow_type(field.dataType)), T.StructType(
            [id_field, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]))
