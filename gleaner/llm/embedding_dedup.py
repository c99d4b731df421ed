"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors are one class from the start. Every class descends ``TREES`` trees: a node projects its vectors on a
random direction and splits at the median; vectors within a margin of the cut go both ways. A node's cuts, several
levels at once, are fitted on a bounded sample of its own vectors, and rounds of fitting and routing go on until a node
holds ``LEAF`` vectors or cannot be split any more (a crowd of near copies).

The margin is ``SPILL`` times the spread that the difference of two unit vectors at the threshold has in a random
direction, sqrt(2 - 2 threshold) / sqrt(dimensions), so depth costs the same in every dimension. Vectors that fill the
sphere have a spread of 1 / sqrt(dimensions) themselves: at 0.95 an eighth of them goes both ways, a tree of 19 levels
(400 million vectors) holds each about ten times, and a level parts one pair in fifty at the threshold and fewer above
it; all five trees must part a pair before it is lost. A cut that would keep more than ``KEEP`` of the vectors on one
side is not made, which bounds the growth to 1.4 a level for any data.

All vectors of a leaf are compared in double precision. A leaf above ``BLOCK`` vectors is compared block against
block, each pair of blocks being a task of its own, so no size is left out. A task emits no pairs: for each linked
class it gives its number of links and the smallest class of its local component, which the connected components of
all leaves then join. A pair that several leaves share counts in the one with the smallest number only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Work, components

TREES = 5
LEAF = 768
BLOCK = 1024
SPILL = 0.5
KEEP = 0.7
# A round's lowest cuts are fitted on about SAMPLE / 2 ** LEVELS vectors.
SAMPLE = 16384
LEVELS = 8
# Numbers that one task routes at a time.
ROUTE_CELLS = 1 << 20
NODE = ["tree", "dim", "node"]


def _direction(tree: int, node: int, dim: int) -> np.ndarray:
    d = np.random.default_rng([tree, node % (1 << 62), dim]).normal(size=dim)
    return d / np.linalg.norm(d)


def _unit(vectors) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def margin(dim: int, threshold: float, spill: float | None) -> float:
    """How far from a cut vectors go both ways."""
    return SPILL * (max(2 - 2 * threshold, 0) / dim) ** 0.5 if spill is None else spill


def _fit(threshold: float, spill: float | None, leaf: int):
    """Cuts of a node's subtree in heap order, from a sample of its vectors; NaN where a cut would not part them."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree, dim, node = key
        size = int(rows["size"].iloc[0])
        near = margin(dim, threshold, spill)
        levels = int(min(LEVELS, max(1, np.ceil(np.log2(size / leaf) / 0.8))))
        x = _unit(rows["vec"])
        cuts = np.full(2 ** levels - 1, np.nan)
        members = {0: np.arange(len(x))}
        for h in range(2 ** levels - 1):
            own = members.pop(h, np.zeros(0, int))
            if not len(own):
                continue
            level = (h + 1).bit_length() - 1
            p = x[own] @ _direction(tree, (node << level) + h + 1 - (1 << level), dim)
            cut = np.median(p)
            low, high = own[p < cut + near], own[p > cut - near]
            if max(len(low), len(high)) <= KEEP * len(own):
                cuts[h], members[2 * h + 1], members[2 * h + 2] = cut, low, high
        return pd.DataFrame({"tree": [tree], "dim": [dim], "node": [node], "size": [size], "cuts": [cuts.tolist()]})

    return run


def _route(threshold: float, spill: float | None):
    """Send vectors down to the first node without a cut; ``stuck`` where the first node has none."""

    def run(key: tuple, rows: pd.DataFrame, plans: pd.DataFrame) -> pd.DataFrame:
        tree, dim, node, _ = key
        if not len(rows) or not len(plans):
            return rows.iloc[:0][["tree", "dim", "node", "cid", "vec"]].assign(stuck=pd.Series(dtype="bool"))
        cuts, near = np.array(plans["cuts"].iloc[0], float), margin(dim, threshold, spill)
        x = _unit(rows["vec"])
        at, stay = {node: np.arange(len(x))}, {}
        for level in range((len(cuts) + 1).bit_length() - 1):
            below = {}
            for n, own in at.items():
                cut = cuts[(1 << level) - 1 + n - (node << level)]
                if np.isnan(cut):
                    stay[n] = own
                    continue
                p = x[own] @ _direction(tree, n, dim)
                below[2 * n], below[2 * n + 1] = own[p < cut + near], own[p > cut - near]
            at = below
        at = {**stay, **at}
        place = np.concatenate([*at.values(), np.zeros(0, int)]).astype(int)
        out = rows.iloc[place][["tree", "dim", "cid", "vec"]].copy()
        out.insert(2, "node", np.repeat(np.array(list(at), np.int64), [len(v) for v in at.values()]))
        return out.assign(stuck=bool(np.isnan(cuts[0])))

    return run


def grow(classes: DataFrame, work: Work, trees: int, leaf: int, threshold: float, spill: float | None = None) -> DataFrame:
    """(tree, dim, node, cid, vec, size) of all leaves."""
    state = work.save(classes.select(
        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "dim", F.lit(1).cast("long").alias("node"),
        "cid", "vec", F.lit(False).alias("stuck")), "state")
    leaves = None
    while True:
        sizes = state.groupBy(*NODE).agg(F.count("*").alias("size"), F.max("stuck").alias("stuck"))
        sizes = work.save(sizes.select(
            *NODE, "size", ((F.col("size") > leaf) & ~F.col("stuck")).alias("split")), "sizes")
        sized = state.drop("stuck").join(sizes, NODE)
        done = sized.where(~F.col("split")).drop("split")
        leaves = done if leaves is None else leaves.unionByName(done)
        if sizes.where("split").isEmpty():
            return leaves
        rows = sized.where("split")
        sample = rows.where(F.pmod(F.xxhash64("cid", "tree"), F.col("size")) < SAMPLE)
        plans = work.save(sample.groupBy(*NODE).applyInPandas(
            _fit(threshold, spill, leaf), "tree int, dim int, node long, size long, cuts array<double>"), "cuts")
        # A node is routed by as many tasks as its vectors need.
        salts = F.ceil(F.col("size") * F.col("dim") / ROUTE_CELLS).cast("int")
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("cid"), salts).cast("int"))
        right = plans.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        state = work.save(salted.drop("size").groupBy(*NODE, "salt").cogroup(right.groupBy(*NODE, "salt")).applyInPandas(
            _route(threshold, spill), "tree int, dim int, node long, cid long, "
            f"vec {classes.schema['vec'].dataType.simpleString()}, stuck boolean"), "state")


def _compare(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        leaf, lo, hi = key
        empty = pd.DataFrame({"cid": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"),
                              "root": pd.Series(dtype="int64")})
        a = rows if lo == hi else rows[rows["block"] == lo]
        b = rows if lo == hi else rows[rows["block"] == hi]
        if not len(a) or not len(b):
            return empty
        x, y = np.array(a["vec"].tolist(), np.float64), np.array(b["vec"].tolist(), np.float64)
        linked = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) >= threshold
        ids_a, ids_b = a["cid"].to_numpy(), b["cid"].to_numpy()
        linked &= ids_a[:, None] != ids_b[None, :]
        on_a, on_b = linked.any(1), linked.any(0)
        if not on_a.any():
            return empty
        linked, ids_a, ids_b = linked[np.ix_(on_a, on_b)], ids_a[on_a], ids_b[on_b]
        # Pairs that meet in a leaf of a smaller number are counted there.
        earlier_a = [[n for n in own if n < leaf] for own in a["leaves"][on_a]]
        earlier_b = [[n for n in own if n < leaf] for own in b["leaves"][on_b]]
        shared = {n: i for i, n in enumerate(set().union(*earlier_a) & set().union(*earlier_b))}
        if shared:
            met = []
            for lists in (earlier_a, earlier_b):
                m = np.zeros((len(lists), len(shared)), np.float32)
                for i, own in enumerate(lists):
                    m[i, [shared[n] for n in own if n in shared]] = 1
                met.append(m)
            linked &= met[0] @ met[1].T == 0
        copies_a, copies_b = a["copies"].to_numpy()[on_a], b["copies"].to_numpy()[on_b]
        ids = np.concatenate([ids_a, ids_b])
        links = np.concatenate([linked @ copies_b, linked.T @ copies_a])
        root = _roots(linked, ids_a, ids_b)
        if lo == hi:
            ids, links, root = ids_a, links[:len(ids_a)], root[:len(ids_a)]
        use = links > 0
        return pd.DataFrame({"cid": ids[use], "links": links[use], "root": root[use]})

    return run


def _roots(linked: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> np.ndarray:
    """Smallest id of each row's and column's component in a link matrix."""
    top = np.iinfo(np.int64).max
    a, b = ids_a.copy(), ids_b.copy()
    while True:
        new_b = np.minimum(b, np.where(linked, a[:, None], top).min(0))
        new_a = np.minimum(a, np.where(linked, new_b[None, :], top).min(1))
        # A class that stands on both sides has one root.
        best = dict(zip(ids_a.tolist(), new_a.tolist()))
        new_b = np.array([min(v, best.get(i, v)) for i, v in zip(ids_b.tolist(), new_b.tolist())], np.int64)
        if (new_a == a).all() and (new_b == b).all():
            return np.concatenate([a, b])
        a, b = new_a, new_b


def near_duplicates(vectors: DataFrame, work: Work, threshold: float = 0.95, id_col: str = "vec_id",
                    vector_col: str = "embedding", trees: int = TREES, leaf: int = LEAF, block: int = BLOCK,
                    spill: float | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, and vectors of
    different lengths never link. Equal vectors link with each other. The component's number is its smallest vec_id,
    nulls aside. Repeated rows count as vectors of their own; an empty table gives no rows. ``spill`` replaces the
    margin around the cuts by a fixed one.
    """
    vec = F.col(vector_col)
    rows = work.save(vectors.select(
        F.col(id_col).alias("vec_id"), F.monotonically_increasing_id().alias("row"), vec.alias("vec")), "vectors")
    double = F.col("vec").cast("array<double>")
    sound = F.coalesce(
        (F.size("vec") > 0) & F.forall(double, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
        & F.exists(double, lambda x: x != 0), F.lit(False))
    sums = F.aggregate(double, F.lit(0.0), lambda s, x: s + x * x)
    sound = sound & F.coalesce((sums > 0) & (sums < F.lit(float("inf"))), F.lit(False))
    usable = rows.where(sound)
    classes = work.save(usable.groupBy("vec").agg(
        F.min("row").alias("cid"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .select("*", F.size("vec").alias("dim")), "classes")
    members = work.save(usable.join(classes.select("vec", "cid"), "vec").select("row", "cid"), "members")
    leaves = grow(classes, work, trees, leaf, threshold, spill).withColumn("leaf", F.xxhash64(*NODE))
    leaves = work.save(leaves, "leaves")
    own = leaves.groupBy("cid").agg(F.collect_list("leaf").alias("leaves"))
    blocks = F.ceil(F.col("size") / block).cast("int")
    placed = (leaves.join(own, "cid").join(classes.select("cid", "copies"), "cid")
              .withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))))
    found = work.save(placed.select(
        "leaf", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "cid", "copies",
        "leaves", "vec").groupBy("leaf", "lo", "hi").applyInPandas(
            _compare(threshold), "cid long, links long, root long"), "found")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(work, found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    known = work.save(
        classes.select("cid", "copies", "least").join(links, "cid", "left")
        .join(joined.withColumnRenamed("node", "cid"), "cid", "left")
        .select("cid", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "cid").alias("component")), "known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = known.join(least, "component").select("cid", "n_links", "component_id")
    answers = members.join(by_class, "cid").select("row", "n_links", "component_id")
    whole = rows.select("vec_id", "row").join(answers, "row", "left")
    number = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), number.alias("component_id"),
                        number.eqNullSafe(F.col("vec_id")).alias("kept"))
