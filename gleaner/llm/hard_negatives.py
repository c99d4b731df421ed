"""Hard-negative mining by maximum inner product over cover trees.

1. Candidates get one more component, sqrt(M^2 - |c|^2), so that all have the norm M. Then an inner product with an
   anchor falls as the distance to it grows, and a ball around a centre bounds the products of all vectors in it.
2. The top level of the tree is a bounded sample of candidates: every candidate goes to the nearest of at most
   ``PIVOTS`` of them. A cell keeps the distance of its furthest member, its covering radius. Cells above ``TREE_ROWS``
   rows are dealt into several trees by hash. Below, every tree is built in one task: a node takes centres furthest
   first until the rest lies within half its radius (or it has ``FAN`` children), and each child keeps its own radius.
3. A query has a vector and a window of scores. Queries go to the cells whose bounds meet the window, each tree descends
   best first: the node with the best bound is opened for those queries of a block that may still gain from it, nodes
   outside a window or below a query's k-th best are skipped, and leaves are scored exactly.
4. Positives are searched first, in two steps: the nearest cell gives a score to beat, then the other cells that may
   beat it. Each (anchor, positive) is then a query for rows of other labels within its window.

Scores are sums of products of integers, in double precision while they stay below 2^53 (exact) and as Python integers
beyond. Bounds of floating point are widened by a relative 1e-6 before anything is skipped.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import Work

SCALE = 256
PIVOTS, TREE_ROWS, QUERY_ROWS = 1024, 4096, 50_000
FAN, LEAF, QUERIES_AT_ONCE = 16, 128, 512
SLACK = 1e-6
EXACT = float(2 ** 53)
TOP, LOW = 2 ** 63 - 1, -2 ** 63


def lift(rows: np.ndarray, reach: float) -> np.ndarray:
    """Rows with the component that gives all of them the norm ``reach``."""
    rest = np.sqrt(np.maximum(reach * reach - np.einsum("ij,ij->i", rows, rows), 0.0))
    return np.concatenate([rows, rest[:, None]], 1)


def bounds(products: np.ndarray, norms: np.ndarray, radius: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of each query with any vector within ``radius`` of each centre.

    ``products`` are those of queries (rows) and centres (columns). On the sphere of radius ``reach`` the product with a
    query scaled to that norm is reach^2 - d^2 / 2 at distance d.
    """
    if reach == 0:
        return np.zeros_like(products), np.zeros_like(products)
    scale = (norms / reach)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        distance = np.sqrt(np.maximum(2 * reach * reach - 2 * np.where(scale > 0, products / scale, reach * reach), 0.0))
    near, far = np.maximum(distance - radius, 0.0), np.minimum(distance + radius, 2 * reach)
    room = scale * reach * reach * SLACK + SLACK
    return scale * (reach * reach - far * far / 2) - room, scale * (reach * reach - near * near / 2) + room


def widened(scores: np.ndarray, side: int) -> np.ndarray:
    """Limits of scores in floating point, moved outwards."""
    real = scores.astype(float)
    return real + side * np.abs(real) * SLACK


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 2^53 by Python integers, held within a long."""
    size = np.abs(queries).max(initial=0.0) * np.abs(rows).max(initial=0.0) * rows.shape[1]
    if size < EXACT:
        return queries @ rows.T
    whole = [[int(x) for x in r] for r in rows.tolist()]
    out = np.empty((len(queries), len(rows)), object)
    for i, q in enumerate(queries.tolist()):
        q = [int(x) for x in q]
        out[i] = [min(max(sum(map(int.__mul__, q, r)), LOW), TOP) for r in whole]
    return out


class Tree:
    """A cover tree: nodes by number, children side by side, members of a node side by side in ``order``."""

    def __init__(self, rows: np.ndarray, reach: float):
        self.rows, self.reach = rows, reach
        lifted = lift(rows, reach)
        self.order = np.arange(len(rows))
        self.centre, self.radius, self.span, self.children = [0], [0.0], [(0, len(rows))], [None]
        self.radius[0] = float(np.linalg.norm(lifted - lifted[0], axis=1).max())
        node = 0
        while node < len(self.centre):
            self._split(node, lifted)
            node += 1
        self.centre = np.array(self.centre)
        self.radius = np.array(self.radius)

    def _split(self, node: int, lifted: np.ndarray) -> None:
        lo, hi = self.span[node]
        if hi - lo <= LEAF or self.radius[node] == 0:
            return
        members = self.order[lo:hi]
        points = lifted[members]
        centres, owner = [self.centre[node]], np.zeros(len(members), np.int64)
        nearest = np.linalg.norm(points - lifted[centres[0]], axis=1)
        while len(centres) < FAN and nearest.max() > self.radius[node] / 2:
            far = int(nearest.argmax())
            away = np.linalg.norm(points - points[far], axis=1)
            closer = away < nearest
            owner[closer], nearest[closer] = len(centres), away[closer]
            centres.append(members[far])
        by_owner = np.argsort(owner, kind="stable")
        self.order[lo:hi] = members[by_owner]
        cuts = np.searchsorted(owner[by_owner], np.arange(len(centres) + 1)) + lo
        first = len(self.centre)
        for i, c in enumerate(centres):
            if cuts[i] < cuts[i + 1]:
                self.centre.append(c)
                self.radius.append(float(nearest[owner == i].max()))
                self.span.append((int(cuts[i]), int(cuts[i + 1])))
                self.children.append(None)
        self.children[node] = (first, len(self.centre))

    def search(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, allowed, ties: np.ndarray, k: int):
        """Per query the ``k`` best (score, row) with low <= score <= high: two arrays, row -1 where there is none.

        ``allowed(queries, rows)`` is a boolean matrix; of equal scores the row with the smaller ``ties`` comes first.
        """
        n = len(vectors)
        best, found = np.full((n, k), -np.inf, object if self._wide(vectors) else float), np.full((n, k), -1)
        norms = np.linalg.norm(vectors, axis=1)
        active = np.arange(n)
        least, most = bounds((vectors @ self.rows[0])[:, None], norms, self.radius[:1], self.reach)
        heap = [(-math.inf, 0, active, most[:, 0])]
        floor, ceiling = widened(low, -1), widened(high, 1)
        while heap:
            _, node, wanting, top = heapq.heappop(heap)
            wanting = wanting[top >= floor[wanting]]
            if not len(wanting):
                continue
            if self.children[node] is None:
                lo, hi = self.span[node]
                self._score(self.order[lo:hi], wanting, vectors, low, high, allowed, ties, k, best, found)
                floor[wanting] = np.maximum(floor[wanting], widened(best[wanting, k - 1], -1))
                continue
            a, b = self.children[node]
            products = vectors[wanting] @ self.rows[self.centre[a:b]].T
            least, most = bounds(products, norms[wanting], self.radius[a:b], self.reach)
            useful = (most >= floor[wanting, None]) & (least <= ceiling[wanting, None])
            for j in np.flatnonzero(useful.any(0)).tolist():
                on = useful[:, j]
                heapq.heappush(heap, (-most[on, j].max(), a + j, wanting[on], most[on, j]))
        return best, found

    def _wide(self, vectors: np.ndarray) -> bool:
        return np.abs(vectors).max(initial=0.0) * np.abs(self.rows).max(initial=0.0) * self.rows.shape[1] >= EXACT

    def _score(self, members, wanting, vectors, low, high, allowed, ties, k, best, found) -> None:
        for at in range(0, len(members), 4 * LEAF):  # a ball of equal vectors may be of any size
            rows = members[at:at + 4 * LEAF]
            scores = exact_scores(vectors[wanting], self.rows[rows])
            fits = allowed(wanting, rows) & (scores >= low[wanting, None]) & (scores <= high[wanting, None])
            fits &= scores >= best[wanting, k - 1][:, None]
            gains = np.flatnonzero(fits.any(1))
            for i in gains.tolist():
                q = wanting[i]
                new = np.flatnonzero(fits[i])
                held = found[q] >= 0
                all_scores = np.concatenate([best[q][held], scores[i, new]])
                all_rows = np.concatenate([found[q][held], rows[new]])
                order = np.lexsort((ties[all_rows], -all_scores.astype(float))) if all_scores.dtype != object else np.array(
                    sorted(range(len(all_rows)), key=lambda j: (-all_scores[j], ties[all_rows[j]])))
                order = order[:k]
                best[q, :len(order)], found[q, :len(order)] = all_scores[order], all_rows[order]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dim)


_QUERY = "query long, label long, vector array<double>, low long, high long, self long"
_FOUND = "query long, score long, row long, vec_id long"


def _stream(dim: int, reach: float, same: bool, k: int):
    """Search the tree whose rows open a group with the queries that follow them in the sorted stream."""

    def answer(tree: Tree, rows: dict, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, QUERIES_AT_ONCE):
            part = batch.slice(at, QUERIES_AT_ONCE)
            vectors, label, own = _matrix(part.column("vector"), dim), _ints(part, "label"), _ints(part, "row")

            def allowed(queries: np.ndarray, members: np.ndarray) -> np.ndarray:
                equal = label[queries][:, None] == rows["label"][members][None, :]
                return (equal & (own[queries][:, None] != rows["row"][members][None, :])) if same else ~equal

            low, high = (part.column(c).to_numpy() for c in ("low", "high"))
            best, found = tree.search(vectors, low, high, allowed, rows["ties"], k)
            query, place = np.nonzero(found >= 0)
            hits = found[query, place]
            scores = best[query, place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_ints(part, "query")[query]), pa.array([int(s) for s in scores], pa.int64()),
                 pa.array(rows["row"][hits]), rows["vec_id"].take(pa.array(hits))],
                names=["query", "score", "row", "vec_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, tree, rows = None, [], None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([_ints(batch, c) for c in ("cell", "part", "share")], 1)
            kinds = _ints(batch, "kind")
            marks = np.concatenate([keys, kinds[:, None]], 1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                now = tuple(keys[a].tolist())
                if now != key:
                    key, held, tree = now, [], None
                piece = batch.slice(a, b - a)
                if kinds[a] == 0:
                    held.append(piece)
                    continue
                if tree is None and held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    ids = table.column("vec_id").combine_chunks()
                    rows = {"row": table.column("row").to_numpy(), "label": table.column("label").to_numpy(), "vec_id": ids,
                            "ties": ids.fill_null(TOP).to_numpy(zero_copy_only=False)}
                    tree = Tree(np.concatenate([_matrix(p.column("vector"), dim) for p in held]), reach)
                    held = []
                if tree is not None:
                    yield from answer(tree, rows, piece)

    return run


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


class Forest:
    """The candidates of one dimension, dealt into cells and trees."""

    def __init__(self, candidates: DataFrame, work: Work, dim: int):
        self.work, self.dim, self.spark = work, dim, candidates.sparkSession
        norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
        n, reach = candidates.agg(F.count("*"), F.max(norm)).first()
        self.reach = math.sqrt(reach)
        # At most PIVOTS rows, by hash: one bounded sample, whatever the size of the table.
        share = min(1.0, 4.0 * PIVOTS / n)
        wanted = min(PIVOTS, max(1, n // TREE_ROWS))
        sample = candidates.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
        chosen = sample.orderBy(F.xxhash64("row"), "row").limit(wanted).collect()
        self.pivots = np.array([r["vector"] for r in chosen], float).reshape(len(chosen), dim)
        self.cells = work.save(candidates.mapInArrow(self._assign(), "cell int, away double, row long, vec_id long, label long, "
                                                     "vector array<double>"), "cells")
        stats = self.cells.groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect()  # PIVOTS rows at most
        self.radius = np.full(len(self.pivots), -1.0)
        self.parts = {}
        for r in stats:
            self.radius[r["cell"]], self.parts[r["cell"]] = r["radius"], math.ceil(r["n"] / TREE_ROWS)

    def _assign(self):
        pivots, reach, dim = lift(self.pivots, self.reach), self.reach, self.dim

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = lift(_matrix(batch.column("vector"), dim), reach)
                square = np.maximum(2 * reach * reach - 2 * points @ pivots.T, 0.0)
                cell = square.argmin(1)
                away = np.linalg.norm(points - pivots[cell], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), pa.array(away), *[batch.column(c) for c in ("row", "vec_id", "label", "vector")]],
                    names=["cell", "away", "row", "vec_id", "label", "vector"])

        return run

    def _route(self, nearest: bool | None):
        """Queries with the cells they need; ``nearest`` keeps only the cell with the best bound, or all others."""
        pivots, radius, reach, dim = self.pivots, self.radius, self.reach, self.dim

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = _matrix(batch.column("vector"), dim)
                least, most = bounds(vectors @ pivots.T, np.linalg.norm(vectors, axis=1), np.maximum(radius, 0.0), reach)
                low, high = (widened(batch.column(c).to_numpy(), side)[:, None] for c, side in (("low", -1), ("high", 1)))
                useful = (most >= low) & (least <= high) & (radius >= 0)
                if nearest is not None:
                    first = np.zeros_like(useful)
                    first[np.arange(len(vectors)), np.where(radius >= 0, most, -np.inf).argmax(1)] = True
                    useful &= first if nearest else ~first
                query, cell = np.nonzero(useful)
                whole = pa.Table.from_batches([batch]).take(pa.array(query)).combine_chunks()
                for part in whole.append_column("cell", pa.array(cell, pa.int32())).to_batches():
                    yield part

        return run

    def search(self, queries: DataFrame, same: bool, k: int, nearest: bool | None = None) -> DataFrame:
        """(query, score, row, vec_id): up to ``k`` best of each tree for each query; see ``best_of``."""
        routed = queries.mapInArrow(self._route(nearest), f"{_QUERY}, cell int")
        parts = F.element_at(F.create_map(*[F.lit(x) for kv in self.parts.items() for x in kv]), F.col("cell"))
        routed = routed.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        shares = max(1, math.ceil(queries.count() / QUERY_ROWS))
        # A tree with very many queries is built in several tasks, each of which answers a share of them.
        trees = self.cells.withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int")).withColumn(
            "share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        stream = trees.select(
            "cell", "part", "share", F.lit(0).alias("kind"), "row", "vec_id", "label", "vector", F.lit(0).cast("long").alias("low"),
            F.lit(0).cast("long").alias("high"), F.lit(None).cast("long").alias("query")).unionByName(routed.select(
                "cell", "part", F.pmod(F.xxhash64("query"), F.lit(shares)).cast("int").alias("share"), F.lit(1).alias("kind"),
                F.col("self").alias("row"), F.lit(None).cast("long").alias("vec_id"), "label", "vector", "low", "high", "query"))
        keys = ["cell", "part", "share"]
        return stream.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(
            _stream(self.dim, self.reach, same, k), _FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` answers of each query, with their rank from 1."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, work: Work, anchors: Column, vec_id: Column, label: Column, vector: Column, k: int = 5,
         percent: int = 80) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components x count as floor(256 * x); a score is the integer inner product, and higher ones come first, ties by
    smaller vec_id. An anchor's positives are its first ``k`` other rows of its label, the negatives of an (anchor,
    positive) the first ``k`` rows of another label with percent * positive <= 100 * negative <= 100 * positive.

    Rows with a null label, a null vector, or a null or non-finite component take no part. ``anchors`` says which rows
    are anchors; a null vec_id may be a candidate, which comes after all others of its score, if ``anchors`` is not true
    for it. Rows with one vec_id are rows of their own, as anchors as well. Vectors meet only vectors of their length;
    empty ones score zero. Scores are held within a long. An empty table gives no rows.
    """
    usable = vector.isNotNull() & label.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ready = work.save(rows.where(usable).select(
        F.monotonically_increasing_id().alias("row"), vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor")), "ready")
    parts = [_mine_one(ready.where(F.size("vector") == dim), work, dim, k, percent) for (dim,) in
             ready.where("anchor").select(F.size("vector")).distinct().orderBy(F.size("vector")).collect()]
    if not parts:
        parts = [work.spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                "positive_score long, negative_score long")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _mine_one(ready: DataFrame, work: Work, dim: int, k: int, percent: int) -> DataFrame:
    forest = Forest(ready.drop("anchor"), work, dim)
    anchors = ready.where("anchor").select(
        F.col("row").alias("query"), "label", "vector", F.lit(LOW).alias("low"), F.lit(TOP).alias("high"),
        F.col("row").alias("self"))
    near = work.save(best_of(forest.search(anchors, True, k, nearest=True), k), "near")
    beaten = near.where(F.col("rank") == k).select("query", F.col("score").alias("to_beat"))
    others = anchors.join(beaten, "query", "left").withColumn("low", F.coalesce("to_beat", "low")).drop("to_beat")
    rest = forest.search(others.select(*anchors.columns), True, k, nearest=False)
    positives = best_of(near.drop("rank").unionByName(rest), k).select(
        F.col("query").alias("anchor"), F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"),
        F.monotonically_increasing_id().alias("query"))
    positives = work.save(positives, "positives")
    # 100 * negative >= percent * positive, in whole numbers
    score = F.col("positive_score")
    low = F.ceil(score.cast("decimal(38,0)") * percent / 100)
    windows = positives.where(score >= 0).join(
        anchors.select(F.col("query").alias("anchor"), "label", "vector", "self"), "anchor").select(
            "query", "label", "vector", low.cast("long").alias("low"), score.alias("high"), "self")
    negatives = best_of(forest.search(windows, False, k), k).select(
        "query", "rank", F.col("score").alias("negative_score"), F.col("vec_id").alias("negative_id"))
    names = ready.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negatives.join(positives, "query").join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
