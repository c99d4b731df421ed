"""URL verdicts: rules over host and path first, gradient-boosted trees on lexical features for the rest.

The trees are fitted in numpy on the driver by Newton boosting of the logistic loss over binned features. They see at
most ``SAMPLE_ROWS`` labelled URLs, chosen by hash; everything else (suffix statistics, judging) covers all rows.
Suffix statistics are the number of labelled URLs under a host's last label and its last two labels, and the smoothed
share of blocked ones among them. They are a written table of all labelled suffixes, which is joined to the sample and
to the pages; suffixes with more than one in ``HOT_PARTS`` of the rows are dealt over ``SALTS`` keys of that join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Work

SAMPLE_ROWS = 20_000
HOT_PARTS, SALTS = 1_024, 64
UNSEEN = (0.0, 0.5)
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.3
FEATURES = (
    "length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "letter_ratio", "entropy",
    "parameters", "query_length", "fragment", "hyphens", "longest_part", "secure", "tld_seen", "tld_blocked",
    "domain_seen", "domain_blocked")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower-case ASCII and path; both empty for a null or a text without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_match(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, host, path prefix) that fits, as text and as verdict; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, said).otherwise(verdict)
    return text, verdict


def suffixes(host: Column) -> tuple[Column, Column]:
    """Keys of a host's last label and of its last two labels."""
    parts = F.split(host, r"\.")
    last_two = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".")
    return F.concat(F.lit("1 "), F.element_at(parts, -1)), F.concat(F.lit("2 "), last_two)


def suffix_table(urls: DataFrame) -> DataFrame:
    """(suffix, seen, share) of every suffix of labelled rows (host, blocked): log count and smoothed blocked share."""
    each = urls.select(F.explode(F.array(*suffixes(F.col("host")))).alias("suffix"), F.col("blocked").cast("int").alias("b"))
    counted = each.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("b").alias("b"))
    return counted.select("suffix", F.log1p("n").alias("seen"), ((F.col("b") + 1) / (F.col("n") + 2)).alias("share"))


def hot_suffixes(hosts: DataFrame) -> list[str]:
    """The suffixes that more than one in ``HOT_PARTS`` rows (host) has; so there are fewer than twice ``HOT_PARTS``."""
    each = hosts.select(F.explode(F.array(*suffixes(F.col("host")))).alias("suffix"))
    least = hosts.count() / HOT_PARTS
    return sorted(r["suffix"] for r in each.groupBy("suffix").count().where(F.col("count") > least).collect())


def with_suffixes(rows: DataFrame, table: DataFrame, hot: list[str] = ()) -> DataFrame:
    """Rows (url, …) with seen1, share1, seen2, share2 of their host's suffixes, null where a suffix has no label."""
    keys = suffixes(split_url(F.col("url"))[0])
    for k, key in enumerate(keys, 1):
        salt, salts = F.lit(0), F.array(F.lit(0))
        if hot:
            salt = F.when(key.isin(*hot), F.pmod(F.xxhash64("url", F.lit("salt")), F.lit(SALTS)).cast("int")).otherwise(0)
            salts = F.when(F.col("suffix").isin(*hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(salts)
        known = table.select(F.col("suffix").alias("key_"), F.explode(salts).alias("salt_"),
                             F.col("seen").alias(f"seen{k}"), F.col("share").alias(f"share{k}"))
        rows = rows.withColumns({"key_": key, "salt_": salt}).join(known, ["key_", "salt_"], "left").drop("key_", "salt_")
    return rows


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def features(url: str | None, host: str, path: str, tld: tuple[float, float], domain: tuple[float, float]) -> list[float]:
    """Lexical features in the order of ``FEATURES``, with (seen, blocked) of both suffixes; a null URL is an empty one."""
    url = url or ""
    n = len(url) or 1
    query = url.partition("?")[2].partition("#")[0]
    return [
        len(url), len(host), len(path), host.count(".") + 1 if host else 0, sum(1 for p in path.split("/") if p),
        sum(c.isdigit() for c in url) / n, sum(c.isalpha() for c in url) / n, entropy(url),
        sum(1 for p in query.split("&") if p), len(query), float("#" in url), url.count("-"),
        max(map(len, path.split("/"))), float(url.startswith("https:")),
        *tld, *domain]


def _edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> dict:
    """Boosted trees for blocked (1) against allowed (0). A tree is arrays by heap position of feature, cut and value."""
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    edges = _edges(x)
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    score = np.full(len(y), base)
    nodes = 2 ** (depth + 1) - 1
    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        place = np.zeros(len(y), np.int64)
        for level in range(depth + 1):
            first, width = 2 ** level - 1, 2 ** level
            here = place - first
            live = here >= 0  # rows of a leaf further up have place -1
            g_node = np.bincount(here[live], grad[live], width)
            h_node = np.bincount(here[live], hess[live], width)
            value[first:first + width] = -g_node / (h_node + 1)
            if level == depth:
                break
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                slot = here[live] * BINS + binned[live, f]
                g = np.cumsum(np.bincount(slot, grad[live], width * BINS).reshape(width, BINS), 1)[:, :len(e)]
                h = np.cumsum(np.bincount(slot, hess[live], width * BINS).reshape(width, BINS), 1)[:, :len(e)]
                other_g, other_h = g_node[:, None] - g, h_node[:, None] - h
                gain = g * g / (h + 1) + other_g ** 2 / (other_h + 1) - (g_node ** 2 / (h_node + 1))[:, None]
                gain[(h < 1e-3) | (other_h < 1e-3)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                won = top > best
                best[won] = top[won]
                feature[first:first + width][won] = f
                cut[first:first + width][won] = e[at[won]]
            f = np.where(live, feature[place], -1)
            go = live & (f >= 0)
            right = x[np.arange(len(y)), np.maximum(f, 0)] > cut[place]
            place = np.where(go, 2 * place + 1 + right, -1)
        tree = (feature, cut, value * rate)
        score += _tree_score(x, tree, depth)
        out.append(tree)
    return {"base": base, "trees": out, "depth": depth}


def _tree_score(x: np.ndarray, tree: tuple, depth: int) -> np.ndarray:
    feature, cut, value = tree
    place, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(depth):
        f = feature[place]
        right = x[rows, np.maximum(f, 0)] > cut[place]
        place = np.where(f >= 0, 2 * place + 1 + right, place)
    return value[place]


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of block."""
    score = np.full(len(x), model["base"])
    for tree in model["trees"]:
        score += _tree_score(x, tree, model["depth"])
    return 1 / (1 + np.exp(-score))


def learn(urls: DataFrame, table: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """Fit on distinct labelled rows (url, host, path, blocked), those of lowest hash; None without any."""
    rows = urls.distinct().orderBy(F.xxhash64("url", F.lit("sample")), "url", "blocked").limit(sample_rows)
    found = with_suffixes(rows, table).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["url"] or "", r["blocked"]))
    # A third of the sample, by hash, is read as if its suffixes were unseen, or new suffixes would be judged by chance.
    x = np.array([features(r["url"], r["host"], r["path"], *(
        ((r["seen1"], r["share1"]), (r["seen2"], r["share2"])) if zlib.crc32((r["url"] or "").encode()) % 3 else (UNSEEN, UNSEEN)))
        for r in found], float)
    return fit_trees(x, np.array([float(r["blocked"]) for r in found]))


def _judge(model: dict):
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for urls, hosts, paths, *known in batches:
            if not len(urls):
                yield pd.Series([], dtype=float)
                continue
            x = np.array([features(u, h, p, k[:2], k[2:]) for u, h, p, *k in zip(urls, hosts, paths, *known)], float)
            yield pd.Series(probability(model, x))

    return F.pandas_udf(run, "double")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], labelled: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, block_probability.

    ``labelled`` (url, blocked) trains the trees; without it the URLs that a rule decides are the labelled ones. The
    trees decide where no rule fits. A null URL has an empty host and path and is judged as an empty URL. Without any
    labelled URL the rest is allowed. Repeated rows get equal answers; an empty table gives no rows.
    """
    work = Work(pages.sparkSession, "url-filter")
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = split_url(F.col("url"))
    rule, said = rule_match(F.col("host"), F.col("path"), rules)

    def ruled(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "said": said})

    if labelled is None:
        train = ruled(base).where("said IS NOT NULL").select("url", "host", "path", (F.col("said") == "block").alias("blocked"))
    else:
        train = labelled.where("blocked IS NOT NULL").select("url", host.alias("host"), path.alias("path"), "blocked")
    table = work.save(suffix_table(train), "suffixes")
    model = learn(train, table)
    if model:
        # Only id and URL go through the join; the rest is computed from the URL afterwards.
        base = ruled(with_suffixes(base, table, hot_suffixes(base.select(host.alias("host")))))
        known = [F.coalesce(f"{c}{k}", F.lit(d)) for k in (1, 2) for c, d in zip(("seen", "share"), UNSEEN)]
        block = _judge(model)("url", "host", "path", *known)
    else:
        base, block = ruled(base), F.lit(0.0)
    return base.withColumn("block_probability", block).select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("block_probability") >= threshold, "block").otherwise("allow")).alias("verdict"),
        "block_probability")
