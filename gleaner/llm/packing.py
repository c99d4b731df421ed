"""Packing documents into as few sequences as possible by linear grouping, configurations and best fit.

Only the number of pieces of each length decides how full the sequences become, and there are at most ``capacity``
lengths. So the driver plans with that histogram, whatever the number of documents:

1. Large lengths are sorted and dealt into groups of equal cardinality; each is rounded up to its group's largest.
2. With so few sizes, configurations (which sizes share a sequence) are chosen by an exact knapsack around the
   largest size left, and each is repeated until one of its groups runs out.
3. The actual pieces take the place of the rounded ones: a run of repeated configurations breaks into segments in
   which every place has one actual length, so their free space is known exactly.
4. Small pieces, longest first, go where they fit best.

A plan is a list of runs: pieces of length l and rank r in [from, to) go to the sequences that start at some number,
at a fixed offset. The ranks of pieces within their length are counted on the cluster (per partition, then a prefix
sum over partitions), and each piece looks up its run. No piece passes through the driver.
"""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import Work

GROUPS = 256
# Pieces up to this share of a sequence are small.
SMALL_SHARE = 8
CACHE_WORDS = 700_000
GROUP_BYTES = 1 << 20


class Plan:
    """Runs of pieces of one length and the sequences they go to."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first rank, count, first sequence, offset
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space: (first sequence, count)
        self._spaces: list[int] = []

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def put(self, length: int, rank: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append((length, rank, count, sequence, offset))

    def leave(self, space: int, sequence: int, count: int) -> None:
        if space:
            if not self.free[space]:
                bisect.insort(self._spaces, space)
            self.free[space].append((sequence, count))

    def best_fit(self, length: int, count: int, rank: int) -> None:
        """Place ``count`` pieces of one length where the least space is left that holds them."""
        while count:
            at = bisect.bisect_left(self._spaces, length)
            if at == len(self._spaces):
                self.leave(self.capacity, self.open(-(-count // (self.capacity // length))), -(-count // (self.capacity // length)))
                continue
            space = self._spaces[at]
            sequence, there = self.free[space].pop()
            each = min(space // length, count)
            used = min(there, count // each)
            for k in range(each):
                self.put(length, rank + k * used, used, sequence, self.capacity - space + k * length)
            if used < there:
                self.free[space].append((sequence + used, there - used))
            if not self.free[space]:
                self._spaces.remove(space)
            self.leave(space - each * length, sequence, used)
            count -= each * used
            rank += each * used


def _configuration(sizes: list[int], left: list[int], capacity: int) -> dict[int, int]:
    """The fullest set of sizes around the largest one left; no size more often than it is left."""
    first = next(g for g, n in enumerate(left) if n)
    room = capacity - sizes[first]
    reach = np.full(room + 1, -1, np.int32)  # the group that last reached a sum
    reach[0] = len(sizes)
    for g in range(len(sizes) - 1, first - 1, -1):
        size, times = sizes[g], left[g] - (g == first)
        for _ in range(min(times, room // size) if times > 0 else 0):
            new = (reach[:-size] >= 0) & (reach[size:] < 0) if size <= room else np.zeros(0, bool)
            if not new.any():
                break
            reach[size:][new] = g
        if reach[room] >= 0:
            break
    total = int(np.flatnonzero(reach >= 0)[-1])
    found: dict[int, int] = defaultdict(int)
    found[first] = 1
    while total:
        g = int(reach[total])
        found[g] += 1
        total -= sizes[g]
    return dict(found)


def make_plan(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> Plan:
    """Plan the packing of ``counts[length]`` pieces of each length."""
    plan = Plan(capacity)
    if counts.get(capacity):
        plan.put(capacity, 0, counts[capacity], plan.open(counts[capacity]), 0)
    lengths = sorted((n for n in counts if capacity // SMALL_SHARE < n < capacity), reverse=True)
    ends = np.cumsum([counts[n] for n in lengths])  # ranks of all large pieces, longest first
    total = int(ends[-1]) if len(lengths) else 0
    edges = sorted({total * g // groups for g in range(groups + 1)})
    taken = edges[:-1]
    left = [b - a for a, b in zip(edges, edges[1:])]
    sizes = [lengths[int(np.searchsorted(ends, a, "right"))] for a in taken]
    while any(left):
        config = _configuration(sizes, left, capacity)
        times = min(left[g] // n for g, n in config.items())
        if not times:  # a group is asked for more often than is left: use it once with what there is
            config, times = {g: min(n, left[g]) for g, n in config.items()}, 1
        places = []
        for g, n in config.items():
            for _ in range(n):
                places.append(taken[g])
                taken[g] += times
                left[g] -= times
        # Segments of repetitions within which no place changes its length.
        cuts = {0, times}
        for p in places:
            lo, hi = np.searchsorted(ends, [p, p + times], "right")
            cuts.update(int(e) - p for e in ends[lo:hi] if 0 < e - p < times)
        cuts = sorted(cuts)
        for a, b in zip(cuts, cuts[1:]):
            sequence, offset = plan.open(b - a), 0
            for p in places:
                k = int(np.searchsorted(ends, p + a, "right"))
                plan.put(lengths[k], p + a - int(ends[k] - counts[lengths[k]]), b - a, sequence, offset)
                offset += lengths[k]
            plan.leave(capacity - offset, sequence, b - a)
    for length in sorted((n for n in counts if 0 < n <= capacity // SMALL_SHARE), reverse=True):
        plan.best_fit(length, counts[length], 0)
    return plan


@lru_cache(maxsize=2)
def _load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}


def _tail(word: bytes) -> bool:
    """A last ASCII mark after an ASCII letter or digit is a token of its own."""
    return len(word) > 1 and word[-2:-1].isalnum() and not word[-1:].isalnum() and word[-1] < 128


def token_ids(texts: list[str], path: str) -> list[bytes]:
    """Little-endian 32-bit ids of whole texts, for a tokenizer that lower-cases and drops white space between words.

    ASCII white space ends every token, so each distinct word is encoded once in a worker. A text that may hold a
    special token's name keeps its case until it is encoded.
    """
    tokenizer, known = _load(path)
    if len(known) > CACHE_WORDS:
        known.clear()
    raw = [t.encode() for t in texts]
    words = [(r if b"<|" in r else r.lower()).split() for r in raw]
    missing = {w for w in set().union(*words) if w not in known}
    tails = [w for w in missing if _tail(w)]
    new = missing.difference(tails)
    new.update(x for w in tails for x in (w[:-1], w[-1:]) if x not in known)
    whole = list(new)
    found = tokenizer.encode_batch_fast([w.decode() for w in whole], add_special_tokens=False)
    known.update((w, array("I", e.ids).tobytes()) for w, e in zip(whole, found))
    known.update([(w, known[w[:-1]] + known[w[-1:]]) for w in tails])
    return [b"".join(map(known.__getitem__, w)) for w in words]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP_BYTES):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def _cut(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _groups(texts):
                source, piece, start, length, crc, rank = [], [], [], [], [], []
                for i, ids in enumerate(token_ids(texts[a:b], path), a):
                    ids += last
                    for k in range(-(-len(ids) // (4 * capacity))):
                        body = ids[4 * capacity * k:4 * capacity * (k + 1)]
                        n = len(body) // 4
                        source.append(i)
                        piece.append(k)
                        start.append(k * capacity)
                        length.append(n)
                        crc.append(zlib.crc32(body))
                        rank.append(seen[n])
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(source, pa.int32())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array([part] * len(source), pa.int32()), pa.array(rank, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return run


def _place(runs: np.ndarray):
    """Look up sequence and offset by length and rank; runs are sorted by both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = runs[:, :2].copy().view([("length", np.int64), ("rank", np.int64)]).ravel()
        for batch in batches:
            table = np.stack([batch.column("length").to_numpy(), batch.column("rank").to_numpy()], 1).astype(np.int64)
            want = np.ascontiguousarray(table).view(keys.dtype).ravel()
            at = np.searchsorted(keys, want, "right") - 1
            sequence = runs[at, 3] + table[:, 1] - runs[at, 1]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence), pa.array(runs[at, 4])],
                names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, work: Work, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", groups: int = GROUPS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids (null text: none) and ``end_id``; only documents longer than ``capacity`` are cut.
    So an empty document is one piece of one token. Repeated rows are packed each; an empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    columns = [
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType())]
    pieces = work.save(texts.mapInArrow(_cut(path, end_id, capacity), T.StructType(
        [*columns, T.StructField("part", T.IntegerType()), T.StructField("rank", T.LongType())])), "pieces")
    per_part = pieces.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(sorted(make_plan(counts, capacity, groups).runs) or np.zeros((0, 5)), np.int64)
    ranked = pieces.join(base, ["length", "part"]).select(
        *[c.name for c in columns], (F.col("rank") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(_place(runs), T.StructType(
        [*columns, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
