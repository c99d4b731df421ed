"""Near-duplicate texts by an inverted join on MinHash signature coordinates.

1. A text's set of word shingles is hashed; texts of equal sets form one class, and only classes go on. A signature has
   ``COORDINATES`` minima, each tagged with its place.
2. Every class is posted under each of its (coordinate, value) pairs. Two sets of Jaccard similarity 0.8 agree in fewer
   than ``MATCHES`` of 48 coordinates about once in a million pairs. With values ordered from rare to frequent, classes
   that agree in at least ``MATCHES`` of them must already meet in the first size - MATCHES + 1 values that anybody
   shares: the prefix. Values nobody shares and the frequent end of the order are skipped.
3. Where classes meet, agreements are counted over whole signatures. A list above ``BLOCK`` classes is taken block
   against block. A task gives no pairs but, for each class, the smallest class it is joined with.
4. The components of these candidate links contain those of the true links. Within a candidate component the full
   shingle sets are intersected, block against block, and only links that hold there count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import Work, components

COORDINATES, MATCHES = 48, 24
BLOCK = 512
SET_BLOCK = 128
CACHE_WORDS = 400_000
_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 2 ** 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2 ** 63, COORDINATES, dtype=np.uint64)
_TAGS = np.arange(COORDINATES, dtype=np.uint64)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            mixed = (mixed ^ hashes[i:len(words) - width + 1 + i]) * _MIX[0]
            mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX[1]
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each coordinate's hash, with the coordinate in the low bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 2048):
        part = shingles[a:a + 2048, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(0), out=least)
    return (least >> np.uint64(6) << np.uint64(6)) | _TAGS


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in batches:
            sizes, keys, signs = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingle(text)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                signs.append(signature(found).view(np.int64) if len(found) else np.zeros(COORDINATES, np.int64))
            flat = np.concatenate(signs) if signs else np.zeros(0, np.int64)
            ends = np.arange(len(signs) + 1, dtype=np.int32) * COORDINATES
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("doc_id", "row", "digest")], pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "row", "digest", "n_shingles", "set_key", "sign"])

    return run


def by_group(rows: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """Apply ``fn(key, batch)`` to the rows of each key, read as one sorted stream per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def close():
            whole = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return fn(now, whole)

        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
            cuts = [0, *(np.flatnonzero((found[1:] != found[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                key = tuple(found[a].tolist())
                if held and key != now:
                    out = close()
                    if out is not None:
                        yield out
                    held = []
                now = key
                held.append(batch.slice(a, b - a))
        if held:
            out = close()
            if out is not None:
                yield out

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def paired_blocks(rows: DataFrame, size: str, block: int) -> DataFrame:
    """Deal classes into blocks by hash; each row goes to every pair (lo, hi) of blocks that its own is in."""
    count = F.ceil(F.col(size) / block).cast("int")
    return (rows.withColumn("block", F.pmod(F.xxhash64("cid"), count).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
            .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other"))


def _stars(ids: np.ndarray, linked: np.ndarray) -> pa.RecordBatch | None:
    """(cid, root) of a symmetric link matrix, root being the smallest class of a row's component."""
    on = linked.any(1)
    if not on.any():
        return None
    ids, linked = ids[on], linked[np.ix_(on, on)]
    root = ids.copy()
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1))
        if (new == root).all():
            break
        root = new
    use = root != ids
    return pa.RecordBatch.from_arrays([pa.array(ids[use]), pa.array(root[use])], names=["u", "v"])


def _agree(key: tuple, batch: pa.RecordBatch) -> pa.RecordBatch | None:
    if batch.num_rows < 2:
        return None
    ids = batch.column("cid").to_numpy()
    signs = batch.column("sign").flatten().to_numpy().reshape(-1, COORDINATES)
    if len(ids) == 2:
        linked = np.array([[False, True], [True, False]]) & ((signs[0] == signs[1]).sum() >= MATCHES)
        return _stars(ids, linked)
    count = np.zeros((len(ids), len(ids)), np.uint8)
    for j in range(COORDINATES):
        count += signs[:, j, None] == signs[None, :, j]
    linked = count >= MATCHES
    np.fill_diagonal(linked, False)
    return _stars(ids, linked)


def _texts_to_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in batches:
            sets = [shingle(t).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            names = ["comp", "size", "cid"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sets, pa.binary())], names=[*names, "shingles"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by multiplying incidence matrices of shingles that recur."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    number = np.full(len(values), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    owner, column = owner[column >= 0], column[column >= 0]
    out = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for a in range(0, len(shared), 8192):
        lo, hi = np.searchsorted(column, [a, a + 8192])
        m = np.zeros((len(sets), min(8192, len(shared) - a)), np.float32)
        m[owner[lo:hi], column[lo:hi] - a] = 1
        out += (m @ m.T).astype(np.int64)
    return out


def _verify(percent: int):
    def run(key: tuple, batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, first = np.unique(batch.column("cid").to_numpy(), return_index=True)
        if len(ids) < 2:
            return None
        raw = batch.column("shingles").to_pylist()
        sets = [np.frombuffer(raw[i], np.uint64) for i in first]
        size = np.array([len(s) for s in sets], np.int64)
        both = intersections(sets)
        linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        np.fill_diagonal(linked, False)
        return _stars(ids, linked)

    return run


def near_duplicates(docs: DataFrame, work: Work, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, keeper, digest (SHA-256 of the text).

    Words are runs without ASCII white space, ASCII letters lower-cased. A text of fewer than ``width`` words is one
    shingle, a null text or one without words has none and links with nothing. Texts link at
    100 * intersection >= percent * union. The component's number is its smallest doc_id, nulls aside; ``keeper`` is
    true for exactly one row of each component, one with that doc_id. Repeated rows are documents of their own that
    link. An empty table gives no rows. ``percent`` below 80 would need fewer MATCHES and is refused.
    """
    if percent < 80:
        raise ValueError("signatures are dimensioned for a similarity of 0.8 and more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    id_field = T.StructField("doc_id", docs.schema[id_col].dataType)
    schema = T.StructType([
        id_field, T.StructField("row", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()),
        T.StructField("sign", T.ArrayType(T.LongType()))])
    rows = work.save(source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_sign(width), schema), "signed")
    named = rows.where("n_shingles > 0").select("row", "set_key")
    classes = work.save(named.groupBy("set_key").agg(F.min("row").alias("cid")), "classes")
    heads = work.save(rows.join(classes.select(F.col("cid").alias("row")), "row").select(
        F.col("row").alias("cid"), "doc_id", "digest", "sign"), "heads")

    postings = heads.select("cid", F.explode("sign").alias("value"))
    shared = postings.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    lists = (postings.join(shared, "value").groupBy("cid")
             .agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("order")))
    prefix = lists.where(F.size("order") >= MATCHES).select(
        "cid", F.explode(F.slice("order", F.lit(1), F.size("order") - (MATCHES - 1))).alias("p")).select("cid", "p.value")
    prefix = work.save(prefix, "prefix")
    meeting = prefix.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    met = prefix.join(meeting, "value").join(heads.select("cid", "sign"), "cid")
    agreed = by_group(paired_blocks(met, "size", BLOCK).select("value", "lo", "hi", "cid", "sign"),
                      ["value", "lo", "hi"], _agree, "u long, v long")
    candidates = components(work, work.save(agreed, "agreed"))
    sizes = candidates.groupBy("component").agg(F.count("*").alias("size"))
    wanted = candidates.join(sizes, "component").select(
        F.col("node").alias("cid"), F.col("component").alias("comp"), "size")
    wanted = work.save(wanted.join(heads.select("cid", F.col("doc_id").alias("head_id"), F.col("digest").alias("head_digest")), "cid"), "wanted")

    # Dealt by digest and id at every size; only the slim side is held in memory, a partition at a time.
    texts = source.join(wanted.hint("shuffle_hash"), source["digest"].eqNullSafe(wanted["head_digest"])
                        & source["doc_id"].eqNullSafe(wanted["head_id"])).select("comp", "size", "cid", "text")
    sets = texts.mapInArrow(_texts_to_sets(width), "comp long, size long, cid long, shingles binary")
    links = by_group(paired_blocks(sets, "size", SET_BLOCK).select("comp", "lo", "hi", "cid", "shingles"),
                     ["comp", "lo", "hi"], _verify(percent), "u long, v long")
    joined = components(work, work.save(links, "links"))

    known = classes.join(joined.withColumnRenamed("node", "cid"), "cid", "left").select(
        "set_key", F.coalesce("component", "cid").alias("component"))
    placed = work.save(rows.select("doc_id", "row", "digest", "n_shingles", "set_key").join(known, "set_key", "left").select(
        "doc_id", "row", "digest", "n_shingles", F.coalesce("component", "row").alias("component")), "placed")
    best = placed.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    return placed.join(best, "component").select(
        "doc_id", "n_shingles", F.col("best.doc_id").alias("component_id"),
        (F.col("row") == F.col("best.row")).alias("keeper"), "digest")
