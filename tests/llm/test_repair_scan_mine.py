"""Conversation repair, license scans and hard negatives against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import conversation_repair, hard_negatives, license_rules, license_scan, queries

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Cost, audit and text by trying every edit of every row, with up to two inserts before it and at the end."""
    legal = re.compile(r"(s?(ua)+)?")
    best = None
    seen, kinds = set(), []
    for role, text in rows:
        mark = text.rstrip(SPACE)
        kinds.append("forced" if not mark or (role, text) in seen else "cut" if mark[-1] not in ".!?" else "")
        seen.add((role, text))

    def grow(i, cost, audit, lines):
        nonlocal best
        if best and cost > best[0]:
            return
        for added in ([], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
            head = [*lines, *[(r, "") for r in added]]
            c, a = cost + 5 * len(added), audit + "I" * len(added)
            if i == len(rows):
                if legal.fullmatch("".join((r[:1] or "-") for r, _ in head)):
                    found = (c, a, "\n".join(f"{r}:{t}" for r, t in head))
                    best = min(best, found) if best else found
                continue
            role, text = rows[i]
            grow(i + 1, c + 2, a + "D", head)
            if kinds[i] != "forced":
                extra = 5 if kinds[i] == "cut" else 0
                grow(i + 1, c + extra, a + "K", [*head, (role, text)])
                for other in ("user", "assistant"):
                    grow(i + 1, c + extra + 1, a + "R", [*head, (other, text)])

    grow(0, 0, "", [])
    return best


def talk_table(spark, talks):
    rows = [(c, t, r, x, "n", 7) for c, lines in talks.items() for t, r, x in lines]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, fault string, place int")


def repaired(table, work, **limits):
    lines, talks = conversation_repair.repair(
        table, work, F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"), **limits)
    return {r["conv_id"]: r for r in conversation_repair.digests(lines, talks).collect()}, lines


@pytest.mark.parametrize("limits", [{}, {"block_rows": 1}, {"block_rows": 2}, {"block_bytes": 6}])
def test_repair_is_cheapest_and_least(spark, work, limits):
    rnd = random.Random(11)
    texts = ["a.", "b!", "c", "", " \t", "d?  ", "e ", None, "f.\x1c"]
    roles = ["user", "assistant", "system", "tool", "", None, "sue"]
    talks = {}
    for conv in [None, *range(120)]:
        n = rnd.randint(1, 4)
        talks[conv] = [(rnd.choice([None, 0, 1, 2, 5, 9]), rnd.choice(roles[:3] if rnd.random() < 0.7 else roles),
                        rnd.choice(texts[:3] if rnd.random() < 0.6 else texts)) for _ in range(n)]
    found, _ = repaired(talk_table(spark, talks), work, **limits)
    assert set(found) == set(talks)
    for conv, lines in talks.items():
        rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in lines))
        cost, audit, text = cheapest([(r, x) for _, _, r, x in rows])
        got = found[conv]
        assert (got["cost"], got["audit"]) == (cost, audit), (conv, rows)
        assert got["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        turns = [t for t, _, _ in lines if t is not None]
        assert got["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        pairs = zip(rows, rows[1:])
        assert got["illegal"] == sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in pairs)


def test_giant_conversation_is_spilled_and_settled(spark, work):
    rnd = random.Random(5)
    talk = [(i, rnd.choice(["user", "assistant"]), f"{i}{rnd.choice(['.', ''])}") for i in range(3000)]
    table = talk_table(spark, {1: talk, 2: [(0, "user", "q?"), (1, "assistant", "a.")]})
    whole, _ = repaired(table, work)
    blocks, lines = repaired(table, work, block_rows=100)
    assert whole == blocks
    assert lines.where("conv_id = 2 AND edit = 'K'").count() == 2


def test_repair_of_nothing(spark, work):
    table = talk_table(spark, {1: [(0, "user", "q?")]})
    found, lines = repaired(table.limit(0), work)
    assert found == {} and lines.collect() == []
    lines, talks = conversation_repair.repair(
        table, work, F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"), F.lit(False))
    (row,) = conversation_repair.digests(lines, talks).collect()
    assert row["audit"] == "" and row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert [row[c] for c in conversation_repair.TOTALS] == [0] * 7


def test_damage_of_nulls(spark):
    table = spark.createDataFrame([(None, None, None, None), (1, 2, "user", "a.")], "conv_id long, turn long, role string, text string")
    rows = queries.damaged(table).collect()
    assert {r["conv_id"] for r in rows} == {None, 1}
    assert all(r["role"] is not None and r["text"] is not None for r in rows)


STATEMENTS = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "GNU General Public License, version 3",
    "licensed under CC BY-NC-SA 4.0!", "All rights reserved", "SPDX-License-Identifier: BSD-3-Clause", "copyright (c) 2020 x. all rights reserved",
    "gnu lesser general public license v2.1", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files", "cc by cc by", "the software is provided 'as is', without warranty of any kind",
    "CC BY", "cc bye", "occ by", "dual licensed under GPLv2 or later", "mozilla public license 2.0 mpl 2.0", "İ cc by ß"]


def slow_scan(text):
    """Every rule on every text, suppression by comparing all pairs."""
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)
    joined = " ".join(words).encode()
    table = [*license_rules.rules(), *[license_rules.phrase(*p) for p in queries.LICENSE_PHRASES]]
    found = []
    for i, r in enumerate(table):
        for m in r.pattern.finditer(joined):
            label = m.expand(r.label.encode()).decode()
            found.append((m.start(), m.end(), r.priority, i, label, r.base))
    stays = [f for f in found if not any(
        g is not f and g[0] <= f[0] and g[1] >= f[1] and g[2] >= f[2]
        and (g[:2] != f[:2] or g[2] > f[2] or g[3] < f[3]) for g in found)]
    base = [p.split() for p, _ in queries.LICENSE_PHRASES]
    places = [(i, lab) for (p, lab) in zip(base, [lab for _, lab in queries.LICENSE_PHRASES])
              for i in range(len(words)) if words[i:i + len(p)] == p]
    labels = {lab for _, lab in places} | {f[4] for f in stays}
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({lab for _, lab in places})), ",".join(sorted(labels)))


def test_license_scan_by_brute_force(spark, awkward):
    rnd = random.Random(2)
    fill = ["lorem", "license", "by", "cc", "rights", "ü", "the", "v2", "mit", "gpl", ".", "-", "3"]
    texts = [None, "", " ", *STATEMENTS, *[" ".join(rnd.choice([*fill, *STATEMENTS]) for _ in range(rnd.randint(0, 60))) for _ in range(150)],
             "all rights reserved " * 3000]
    rows = [(i, t, 3, "k", 0.5) for i, t in enumerate(texts)] + [(None, texts[5], 0, "", 0.0), (4, texts[4], 3, "k", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, label string, score double")
    found = queries.op12_license_scan(lambda name: docs, None).collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, *[repr(r[c]) for c in names]) for r in found))
    want = sorted(((i is None, i or 0, *[repr(v) for v in slow_scan(t or "")]) for i, t, *_ in rows))
    assert got == want
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in found)
    assert queries.op12_license_scan(lambda name: docs.limit(0), None).collect() == []


def expansions(parsed):
    """Texts that a pattern matches: every branch, every optional part with and without, one character of each class."""
    out = [b""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            tails = [bytes([arg])]
        elif name == "IN":
            kind, first = arg[0]
            tails = [b"q" if str(kind) == "NEGATE" else bytes([first if str(kind) == "LITERAL" else first[0]])]
        elif name == "NOT_LITERAL":
            tails = [b"q"]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            tails = [b"".join(t) for n in {arg[0], min(arg[1], arg[0] + 1)} for t in itertools.product(expansions(arg[2]), repeat=n)]
        elif name == "SUBPATTERN":
            tails = expansions(arg[3])
        elif name == "BRANCH":
            tails = [t for branch in arg[1] for t in expansions(branch)]
        else:
            assert name in ("ASSERT_NOT", "AT"), name
            continue
        out = [a + b for a in out for b in tails]
    return out


def test_license_rules():
    table = license_rules.rules()
    assert len(table) > 200
    for r in table:  # a rule is not tried without its keyword, so every match must hold it
        for text in expansions(re._parser.parse(r.pattern.pattern)):
            assert r.pattern.fullmatch(text) and r.keyword in text.split(), (r, text)
    scanner = license_scan.Scanner(table)

    def labels(text):
        _, spans = scanner(text.lower().encode())
        return {s.label for s, k in zip(spans, license_scan.kept(spans)) if k}

    assert labels("GNU Lesser General Public License v2.1") == {"lgpl-2.1"}
    assert labels("Licensed under CC BY-NC-SA 4.0") == {"cc-by-nc-sa-4.0"}
    assert labels("GNU Affero General Public License, version 3") == {"agpl-3.0"}
    assert labels("nothing of the kind") == set()


def slow_mine(rows, k=5):
    kept = []
    for i, (v, label, e) in enumerate(rows):
        if label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            shifted = (label + 1) % 10 if v is not None and v % 7 == 0 else label
            kept.append((i, v, shifted, [int(np.floor(256 * float(np.float32(x)))) for x in e]))
    out = []
    for i, v, label, e in kept:
        if v is None or v % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(e, f)), w if w is not None else 2 ** 63, j, w, other)
                         for j, w, other, f in kept if j != i and len(e) == len(f)))
        for p in [s for s in scored if s[4] == label][:k]:
            fit = [s for s in scored if s[4] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:k]
            out += [(v, p[3], n, s[3], -p[0], -s[0]) for n, s in enumerate(fit, 1)]
    return out


def mined(spark, work, rows):
    table = spark.createDataFrame([(v, e, lab, 1, "q") for v, lab, e in rows],
                                  "vec_id long, embedding array<float>, label int, row int, query string")
    return [tuple(r) for r in queries.op13_hard_negatives(lambda name: table, work).collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("dim,spread,leaf", [(4, 0.05, 8), (16, 0.3, 4), (3, 0.0, 4), (1, 1.0, 2)])
def test_hard_negatives_by_brute_force(spark, work, monkeypatch, dim, spread, leaf):
    for name, value in (("LEAF", leaf), ("FAN", 3), ("TREE_ROWS", 64), ("QUERY_ROWS", 20)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(dim)
    heart = rng.normal(size=(6, dim))
    rows = []
    for i in range(700):
        g = int(rng.integers(6))
        e = (heart[g] + spread * rng.normal(size=dim)) * rng.choice([0.0, 0.5, 1.0])
        rows.append((i * 10, int(rng.integers(3)), [float(np.float32(x)) for x in e]))
    rows += [(100, 1, rows[0][2]), (100, 1, rows[0][2]), (None, 2, rows[10][2]), (55, None, rows[1][2]), (56, 1, None),
             (300, 1, [None] * dim), (400, 2, [float("nan")] * dim), (500, 0, [float("inf")] * dim), (600, 0, [1.0] * (dim + 1)),
             (700, 0, [2.0] * (dim + 1)), (701, 1, [1.5] * (dim + 1)), (800, 1, []), (801, 2, []), (802, 1, [])]
    got, want = mined(spark, work, rows), slow_mine(rows)
    # Rows of one vec_id and score may stand for each other; the values are the same.
    assert order(got) == order(want)
    assert len(want) > 50


def test_hard_negatives_of_very_large_components(spark, work):
    rng = np.random.default_rng(1)
    rows = [(i * 50, i % 2, [float(np.float32(x)) for x in rng.uniform(0.9, 1.0, 3) * 1e6]) for i in range(60)]
    assert order(mined(spark, work, rows)) == order(slow_mine(rows))
    assert mined(spark, work, [(100, 1, [1.0])]) == []
    assert mined(spark, work, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_cover_tree_bounds_hold():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * rng.normal(size=(3000, 8)))
    reach = float(np.sqrt((rows * rows).sum(1).max()))
    tree = hard_negatives.Tree(rows, reach)
    query = np.floor(256 * rng.normal(size=(20, 8)))
    least, most = hard_negatives.bounds(
        query @ rows[tree.centre].T, np.linalg.norm(query, axis=1), tree.radius, reach)
    opened = 0
    for node, (lo, hi) in enumerate(tree.span):
        scores = query @ rows[tree.order[lo:hi]].T
        assert (scores >= least[:, node, None]).all() and (scores <= most[:, node, None]).all()
        opened += tree.children[node] is not None
    assert opened > 10 and sorted(tree.order.tolist()) == list(range(3000))


def test_states_of_the_repair_are_few():
    """Fronts are finite, so the memo of steps stays small whatever a conversation holds."""
    fronts, todo = set(), [conversation_repair.FRESH]
    while todo:
        front = todo.pop()
        if front not in fronts:
            fronts.add(front)
            todo += [conversation_repair.advance(front, *row)[0] for row in itertools.product(["s", "u", "a", ""], [False, True], [False, True])]
    assert len(fronts) < 5000
