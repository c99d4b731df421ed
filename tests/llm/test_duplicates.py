"""Exact, near and embedding duplicates against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import common, embedding_dedup, exact_dedup, minhash_dedup


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)

    def least(self, ids):
        out = {}
        for k, i in enumerate(ids):
            r = self.find(k)
            if i is not None:
                out[r] = min(out.get(r, i), i)
        return [out.get(self.find(k)) for k in range(len(ids))]


def test_components_of_paths_stars_and_rings(spark, work):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["component"] for r in common.components(work, df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200, 202: 200}
    assert common.components(work, df.limit(0)).collect() == []


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(awkward, work, keep):
    found = exact_dedup.exact_duplicates(awkward.repartition(7), work, keep=keep).collect()
    groups = defaultdict(list)
    for r in awkward.collect():
        groups[hashlib.sha256((r["text"] or "").encode()).digest()].append(r["doc_id"])
    assert Counter((r["doc_id"], bytes(r["digest"])) for r in found) == Counter((i, d) for d, ids in groups.items() for i in ids)
    kept = Counter()
    for r in found:
        ids = [i for i in groups[bytes(r["digest"])] if i is not None]
        assert r["group_size"] == len(groups[bytes(r["digest"])])
        assert r["keep_id"] == ((max if keep == "largest" else min)(ids) if ids else None)
        kept[bytes(r["digest"])] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}


def test_exact_dedup_runs_no_python(documents, work):
    plan = exact_dedup.exact_duplicates(documents, work)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def near(rows, width):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        n = min(width, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    joined = Sets(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                joined.join(a, b)
    return [len(s) for s in sets], joined.least([i for i, _ in rows]), len({joined.find(k) for k in range(len(rows))})


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, awkward, work, width):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 120))]
        for c in range(rnd.randint(1, 25)):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 14))):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append((1000 + len(rows), (" " if c % 3 else "  ").join(own).title()))
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, sign string")
    found = minhash_dedup.near_duplicates(df, work, width).collect()
    sizes, least, groups = near(rows, width)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == Counter(
        (i, n, c) for (i, _), n, c in zip(rows, sizes, least))
    assert sum(r["keeper"] for r in found) == groups


def test_near_duplicates_of_nothing(awkward, work):
    assert minhash_dedup.near_duplicates(awkward.limit(0), work).collect() == []


def test_prefix_blocks_do_not_lose_links(spark, work, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    monkeypatch.setattr(minhash_dedup, "SET_BLOCK", 4)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(rnd.randint(0, 12)):
            own[rnd.randrange(150)] = f"n{rnd.randrange(10_000)}"
        rows.append((i, " ".join(own)))
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), work, 2).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(zip(range(60), near(rows, 2)[1]))


def brute_vectors(ids, vectors):
    ok = [k for k, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    joined, links = Sets(len(ids)), [0] * len(ids)
    for a in ok:
        for b in ok:
            if a != b and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a]), np.array(vectors[b])
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95:
                    links[a] += 1
                    joined.join(a, b)
    return list(zip(ids, links, joined.least(ids)))


@pytest.mark.parametrize("sizes", [{"leaf": 60, "block": 16, "spill": 0.05}, {}])
def test_embedding_links(spark, work, sizes):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(120, 16))
    vectors = [v.tolist() for v in base]
    vectors += [(base[i % 20] + rng.normal(size=16) * 0.2).tolist() for i in range(120)]
    vectors += [vectors[0]] * 30 + [None, [], [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [None], [1.0] * 15, [2.0] * 15]
    ids = list(range(len(vectors)))
    df = spark.createDataFrame(list(zip(ids, vectors, ids)), "vec_id long, embedding array<double>, node long")
    got = embedding_dedup.near_duplicates(df, work, **sizes).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute_vectors(ids, vectors)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert embedding_dedup.near_duplicates(df.limit(0), work).collect() == []


def test_embedding_recall_on_the_table(spark, work, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    got = embedding_dedup.near_duplicates(df, work).collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = int((x @ x.T >= 0.95).sum() - len(x))
    assert sum(r["n_links"] for r in got) >= 0.9 * want


@pytest.mark.parametrize("dim, size", [(16, 3000), (64, 3000), (768, 900)])
def test_embedding_recall_of_deep_trees(spark, work, dim, size):
    """Pairs just above the threshold, in trees of five levels with the margin as shipped."""
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(size, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    x = np.concatenate([x, 0.955 * x + (1 - 0.955 ** 2) ** 0.5 * off])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    leaf = 2 * size // 24
    want = np.zeros(len(x), int)
    for a in range(0, len(x), 1024):
        want[a:a + 1024] = (x[a:a + 1024] @ x.T >= 0.95).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df, work, leaf=leaf).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.97 * want.sum()
    classes = df.select(F.col("vec_id").alias("cid"), F.col("embedding").alias("vec"), F.lit(dim).alias("dim"))
    leaves = embedding_dedup.grow(classes, work, 2, leaf, 0.95)
    assert leaves.agg(F.max("size")).first()[0] <= leaf
    rows = leaves.count() / (2 * len(x))
    print(f"dimensions {dim}: recall {found.sum() / want.sum():.4f}, {rows:.2f} rows per vector and tree")
    assert rows < 2.5


def test_crowds_stay_whole(spark, work):
    """A crowd that no cut divides is one leaf in every tree, and no link in it is lost."""
    rng = np.random.default_rng(1)
    crowd = 0.98 * np.eye(32)[0] + 0.03 * rng.normal(size=(300, 32))
    rest = rng.normal(size=(300, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([crowd, rest]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicates(df, work, leaf=50, block=64).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute_vectors(*zip(*rows))
