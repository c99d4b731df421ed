"""Language ID, language-model scores, URL verdicts and transcripts: brute force, gradients, held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import katz, language_id, queries, transcripts, url_filter


def remainder(n):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(n))


def test_gradients_of_the_network():
    weights = {k: v.astype(np.float64) for k, v in language_id.fresh_weights(3, 4).items()}
    rng = np.random.default_rng(0)
    codes, mask, labels = rng.integers(0, 256, (5, 6)).astype(np.uint8), np.ones((5, 6), bool), np.array([0, 1, 2, 1, 0])
    mask[1, 3:] = mask[2, 1:] = False
    _, grads = language_id.gradients(weights, codes, mask, labels)
    for k in weights:
        at = tuple(rng.integers(0, n) for n in weights[k].shape)
        if k[0] == "x":
            at = (codes[0, 0], at[1])
        before, losses = weights[k][at], []
        for step in (1e-3, -1e-3):
            weights[k][at] = before + step
            losses.append(language_id.gradients(weights, codes, mask, labels)[0])
        weights[k][at] = before
        assert abs((losses[0] - losses[1]) / 2e-3 - grads[k][at]) < 2e-4


def test_held_out_languages(spark, work, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    held = remainder(4) == 2
    model = language_id.learn(docs.where(~held))
    found = language_id.identify(docs, model, [F.col("doc_id"), F.col("lang"), held.alias("held")]).where("held").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_texts_without_letters(awkward, work):
    model = language_id.learn(awkward.withColumn("lang", F.lit("xx")))
    found = {(r["doc_id"], r["text"]): r for r in language_id.identify(
        awkward, model, [F.col("doc_id"), F.col("text"), F.col("row")]).collect()}
    assert len(found) == awkward.distinct().count()
    for (_, text), r in found.items():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert r["lang_pred"] != "und" or r["score"] == 0
    assert language_id.learn(awkward.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in language_id.identify(awkward, None, [F.col("doc_id")]).collect()} == {"und"}
    assert language_id.identify(awkward.limit(0), model, [F.col("doc_id")]).collect() == []


def brute_katz(rows, order):
    """Probabilities by the definition, with tuples of words as keys and one dictionary per order."""
    tokens = lambda t: [*(t or "").encode().lower().split(), "</s>"]
    counts = [Counter() for _ in range(order + 1)]
    contexts = [Counter() for _ in range(order + 1)]
    for _, held, t in rows:
        if not held:
            own = ["<s>", *tokens(t)]
            counts[1].update((w,) for w in own[1:])
            for n in range(2, order + 1):
                grams = list(zip(*[own[k:] for k in range(n)]))
                counts[n].update(grams)
                contexts[n].update(g[:-1] for g in grams)
    total = sum(counts[1].values())
    top = katz.TRUSTED + 1
    rate = [None] + [katz.discounts([sum(x == r for x in c.values()) for r in range(1, top + 1)]) for c in counts[1:]]
    mass = lambda g: rate[len(g)][min(counts[len(g)][g], top)] * counts[len(g)][g]
    unknown = 1 - sum(map(mass, counts[1])) / total if total else 1.0
    after, size, weight = defaultdict(list), {}, {}
    for n in range(2, order + 1):
        for g in counts[n]:
            after[g[:-1]].append(g[-1])

    def p(gram):
        if len(gram) == 1:
            return mass(gram) / total if counts[1][gram] else unknown
        if counts[len(gram)][gram]:
            return mass(gram) / size[gram[:-1]]
        return weight.get(gram[:-1], 1.0) * p(gram[1:])

    for n in range(2, order + 1):
        for k, (context, times) in enumerate(contexts[n].items()):
            own = after[context]
            left = times - sum(mass((*context, w)) for w in own)
            size[context], left = (times + 1, 1.0) if left < 1e-9 else (times, left)
            weight[context] = left / size[context] / (1 - sum(p((*context[1:], w)) for w in own))
            if k % 997 == 0:  # the sum over the vocabulary is checked for some contexts
                whole = sum(p((*context, w)) for (w,) in counts[1]) + p((*context, "no word of any text"))
                assert abs(whole - 1) < 1e-9
    out = {}
    for i, held, t in rows:
        own = ["<s>", *tokens(t)]
        base = sum(math.log10((counts[1][w,] + 1) / (total + len(counts[1]) + 1)) for w in own[1:])
        score = sum(math.log10(p(tuple(own[max(0, k - order + 1):k + 1]))) for k in range(1, len(own)))
        out[i] = (held, len(own) - 1, sum(counts[1][w,] > 0 for w in own[1:]), total), base, score
    return out


def test_katz_distinct_keys():
    rng = np.random.default_rng(1)
    near = (rng.integers(0, 3, 4000).astype(np.uint64) << np.uint64(60)) | rng.integers(0, 900, 4000).astype(np.uint64)
    for keys in (np.zeros(0, np.uint64), np.array([5], np.uint64), rng.integers(0, 2 ** 64, 5000, dtype=np.uint64), near):
        for got, want in zip(katz._distinct(keys), np.unique(keys, return_index=True, return_inverse=True)):
            assert len(got) == len(want) and (got == want).all()


@pytest.mark.parametrize("parts, order", [(1, 2), (6, 2), (1, 3), (6, 3), (6, 4)])
def test_katz_scores(documents, awkward, work, parts, order):
    docs = documents.select("doc_id", "text").unionByName(
        awkward.where("doc_id IS NOT NULL").select((F.col("doc_id") + 10_000).alias("doc_id"), "text").dropDuplicates(["doc_id"]))
    held = remainder(7) == 2
    got = {r["doc_id"]: r for r in katz.score(docs.repartition(parts), work, held, order=order).collect()}
    want = brute_katz([tuple(r) for r in docs.select("doc_id", held.alias("h"), "text").collect()], order)
    assert got.keys() == want.keys()
    for i, (counts, base, score) in want.items():
        assert tuple(got[i])[1:5] == counts
        assert got[i]["base_score"] == pytest.approx(base, abs=1e-6) and got[i]["score"] == pytest.approx(score, abs=1e-6)


def test_katz_backs_off_word_by_word(spark, work):
    texts = ["a b c"] * 3 + ["a b d", "x b e", "x b e", "q r"]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)] + [(9, "x b c", True), (10, "zz b d", True)],
                                 "doc_id long, text string, held boolean")
    got = {r["doc_id"]: r["score"] for r in katz.score(docs.repartition(4), work, F.col("held")).collect()}
    want = brute_katz([(r["doc_id"], r["held"], r["text"]) for r in docs.collect()], 3)
    assert got == {i: pytest.approx(score) for i, (_, _, score) in want.items()}
    with pytest.raises(ValueError):
        katz.score(docs, work, F.col("held"), order=1)


def test_katz_slices_grow_with_the_texts(documents, awkward, work, monkeypatch):
    docs = documents.select("doc_id", "text").unionByName(awkward.where("doc_id > 1000000").select("doc_id", "text"))
    held = remainder(7) == 2
    few = {r["doc_id"]: r for r in katz.score(docs.repartition(5), work, held).collect()}
    monkeypatch.setattr(katz, "SLICE_BYTES", 1000)
    many = {r["doc_id"]: r for r in katz.score(docs.repartition(5), work, held).collect()}
    assert few.keys() == many.keys()
    for i, r in few.items():
        assert tuple(r)[:5] == tuple(many[i])[:5]
        assert r["base_score"] == pytest.approx(many[i]["base_score"]) and r["score"] == pytest.approx(many[i]["score"])


@pytest.mark.parametrize("texts", [["a b c", "b c d", "a b d c", "c d"] * 30 + ["rare"], ["a b x", "a b y", "b x", "q a b"] * 30 + ["rare"]])
def test_katz_sends_weights_only_where_a_word_is_unseen(spark, work, monkeypatch, texts):
    """A context's weight is the bulk of the last answers; all blocks train on all words, but one held-out text asks for it."""
    names = []
    monkeypatch.setattr(work, "table_name", lambda name: names.append(f"{name}_{len(names)}_{id(texts)}") or names[-1])
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)] + [(-1, "a b new", True)],
                                 "doc_id long, text string, held boolean")
    rows = katz.score(docs.repartition(6, "doc_id"), work, F.col("held")).collect()
    want = brute_katz([(r["doc_id"], r["held"], r["text"]) for r in docs.collect()], 3)
    assert {r["doc_id"]: r["score"] for r in rows} == {i: pytest.approx(score) for i, (_, _, score) in want.items()}
    sent = {}
    for r in spark.table(next(n for n in names if n.startswith("answers"))).where("kind < 0").collect():
        sent[r["kind"]] = sent.get(r["kind"], 0) + len(katz.unpack(r["b"], np.float64))
    assert sent == {-2: 1, -3: 1}  # of b, then of a b


def test_katz_without_training(awkward, work):
    rows = katz.score(awkward, work, F.lit(True)).collect()
    assert len(rows) == awkward.count() and all(r["score"] == 0 and r["n_known"] == 0 for r in rows)
    assert katz.score(awkward.limit(0), work, F.lit(True)).collect() == []


def plain_host(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    cut2 = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return rest[:cut].translate({c: c + 32 for c in range(65, 91)}), path[:cut2]


def test_url_rules(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    odd = [None, "", "http://A.ORG", "x://Example.ORG:80/ES/", "http://a.example.org/en/12?x#y", "a://b://c/d", "http://com/fr/",
           "http://notexample.org/es/", "http://xcom/de/", "http://É.com/de/", "no scheme"]
    pages = pages.unionByName(spark.createDataFrame([(None if i == 1 else -i - 1, u) for i, u in enumerate(odd)], "page_id long, url string"))
    judged = url_filter.judge(pages, queries.URL_RULES).collect()
    assert len(judged) == pages.count()
    want = {r["page_id"]: r["url"] for r in pages.collect()}
    for r in judged:
        host, path = plain_host(want[r["page_id"]])
        fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r["host"], r["path"], r["rule"]) == (host, path, max(fits)[1] if fits else None)
        assert r["verdict"] == (max(fits)[2] if fits else "block" if r["block_probability"] >= 0.5 else "allow")
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).collect() == []


def test_trees_learn_from_labelled_urls(spark, sf):
    pages = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/pages.parquet").select("page_id", "url")
    label = F.col("url").contains("page=") | (F.length("url") > 45)
    held = F.col("page_id") % 4 == 2
    judged = url_filter.judge(pages, [], pages.where(~held).select("url", label.alias("blocked")))
    found = pages.where(held).select("page_id", label.alias("blocked")).join(judged, "page_id").collect()
    assert np.mean([(r["verdict"] == "block") == r["blocked"] for r in found]) > 0.95


def test_every_labelled_suffix_counts(spark, work):
    """12,000 domains of three labelled URLs each; nothing but the domain's own share tells blocked from allowed."""
    urls = spark.range(48_000).select(
        F.col("id").alias("page_id"), (F.col("id") % 4 == 3).alias("held"),
        F.format_string("http://a.d%05d.net/%05d", F.floor(F.col("id") / 4), F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("url"),
        (F.pmod(F.xxhash64(F.floor(F.col("id") / 4), F.lit("x")), F.lit(2)) == 0).alias("blocked"))
    labelled = urls.where("NOT held").select("url", "blocked")
    table = url_filter.suffix_table(labelled.select(url_filter.split_url(F.col("url"))[0].alias("host"), "blocked"))
    assert table.count() == 12_001 and table.where("suffix <> '1 net' AND share NOT IN (0.2, 0.8)").count() == 0
    judged = url_filter.judge(urls.where("held"), [], labelled)
    found = urls.where("held").select("page_id", "blocked").join(judged, "page_id").collect()
    assert len(found) == 12_000
    assert np.mean([(r["verdict"] == "block") == r["blocked"] for r in found]) > 0.97


def test_hot_suffixes_join_once(spark):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate([None, "", "http://a.b.c/", "http://b.c/x", "http://q.c/"] * 50)], "i int, url string")
    table = spark.createDataFrame([("1 c", 1.0, 0.1), ("2 b.c", 2.0, 0.2), ("1 ", 3.0, 0.3)], "suffix string, seen double, share double")
    hot = url_filter.hot_suffixes(rows.select(url_filter.split_url(F.col("url"))[0].alias("host")))
    assert hot == ["1 ", "1 c", "2 ", "2 b.c", "2 q.c"]
    for keys in ([], hot):
        got = {r["i"]: (r["seen1"], r["seen2"]) for r in url_filter.with_suffixes(rows, table, keys).collect()}
        assert got == {i: [(3.0, None), (3.0, None), (1.0, 2.0), (1.0, 2.0), (1.0, None)][i % 5] for i in range(250)}


def test_roles_of_held_out_conversations(spark, sf):
    rows = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/conversations.parquet")
    held = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4)) == 2
    parsed = transcripts.parse(rows.where(held).drop("role"), transcripts.learn(rows.where(~held)))
    found = rows.where(held).alias("a").join(
        parsed.alias("b"), (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("a.turn") == F.col("b.source_turn")), "left")
    assert np.mean([r[0] == r[1] for r in found.select("a.role", "b.role").collect()]) > 0.85


def test_transcripts_with_markers(spark, sf):
    model = transcripts.learn(spark.read.parquet(f"{sf}/conversations.parquet"))
    rows = spark.createDataFrame(
        [(1, None, "System: be nice\nUser: hi\nthere?\nAssistant: hello\nmore"), (None, 0, None), (None, 0, None), (2, 5, ""),
         (3, 1, "### Human: what?"), (3, 3000, "a long line\nmore"), (3, 6000, "ASSISTANT: ok")],
        "conv_id long, turn long, text string")
    parsed = transcripts.parse(rows, model).collect()
    first = [(r["role"], r["rendered"]) for r in sorted((r for r in parsed if r["conv_id"] == 1), key=lambda r: r["turn_no"])]
    assert first == [("system", "<|system|>\nbe nice\n<|end|>"), ("user", "<|user|>\nhi\nthere?\n<|end|>"),
                     ("assistant", "<|assistant|>\nhello\nmore\n<|end|>")]
    assert sum(r["n_lines"] for r in parsed) == 12
    assert transcripts.parse(rows.limit(0), model).collect() == []


def test_chunked_viterbi_equals_one_pass(spark, sf):
    model = transcripts.learn(spark.read.parquet(f"{sf}/conversations.parquet"))
    seen = np.log(np.random.default_rng(0).dirichlet(np.ones(transcripts.STATES), 50))
    whole = transcripts.best_path(model, seen, None, None)
    ways = (transcripts.chunk_matrix(model, seen[20:]))
    first = (model["start"] + seen[0])[None]
    for row in seen[1:20]:
        first = (first[:, :, None] + model["step"][None]).max(1) + row
    score = first[0][:, None] + ways
    last = int(score.max(0).argmax())
    mid = int(score[:, last].argmax())
    parts = [transcripts.best_path(model, seen[:20], None, mid), transcripts.best_path(model, seen[20:], mid, last)]
    assert (np.concatenate(parts) == whole).all()


def awkward_transcripts(spark):
    """Null ids with ordinary turns, null turns, one turn number for all rows, and one row of many lines."""
    names = ["System: x", "User: hello there", "Assistant: of course", "why?", "yes", "", "> a longer line without any marker at all"]
    rnd = np.random.default_rng(3)
    text = lambda n: "\n".join(names[k] for k in rnd.integers(0, len(names), n))
    rows = [(None, int(t), text(2)) for t in rnd.integers(0, 9, 300)] + [(1, None, text(1)) for _ in range(300)]
    rows += [(2, 7, text(3)) for _ in range(200)] + [(3, 0, text(700)), (4, 5, text(1)), (4, 9, None), (5, 1, text(40))]
    return spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(5).cache()


@pytest.fixture
def many_ranges(spark):
    """Small partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_chunk_has_more_lines_than_its_size(spark, work, monkeypatch, many_ranges):
    monkeypatch.setattr(transcripts, "CHUNK_LINES", 16)
    rows = awkward_transcripts(spark)
    lines = transcripts.numbered_lines(rows, work).collect()
    assert len(lines) == sum(len((r["text"] or "").split("\n")) for r in rows.collect())
    assert max(Counter((r["conv_id"], r["chunk"]) for r in lines).values()) == 16
    for conv in (None, 1, 2, 3, 4, 5):
        own = sorted((r["number"], r["turn"]) for r in lines if r["conv_id"] == conv)
        assert [n for n, _ in own] == list(range(len(own))) and [t for _, t in own] == sorted(t for _, t in own)


def test_any_chunks_give_the_best_path(spark, sf, work, monkeypatch, many_ranges):
    model = transcripts.learn(spark.read.parquet(f"{sf}/conversations.parquet"))
    rows = awkward_transcripts(spark)
    lines = transcripts.numbered_lines(rows, work).collect()
    want = {}
    for conv in (None, 1, 2, 3, 4, 5):
        own = sorted((r for r in lines if r["conv_id"] == conv), key=lambda r: r["number"])
        seen = sum(model[c][:, [r[c] for r in own]].T for c in transcripts.FEATURES)
        path = transcripts.best_path(model, seen, None, None)
        want.update({(conv, r["number"]): transcripts.ROLES[s // 2] for r, s in zip(own, path)})
    monkeypatch.setattr(transcripts, "CHUNK_LINES", 16)
    got = {(r["conv_id"], r["turn_no"] + k): r["role"] for r in transcripts.parse(rows, model).collect() for k in range(r["n_lines"])}
    assert got == want


@pytest.mark.parametrize("parts", [1, 7])
def test_each_row_adds_one_transition(spark, parts, many_ranges):
    """Repeated and null turns, null ids, gaps, conversations that begin at turn 1, and rows of unknown role."""
    rnd = np.random.default_rng(4)
    rows = [(None if c == 0 else int(c), None if t == 12 else int(t) * 2 + 1, k, int(r), int(m)) for k, (c, t, r, m) in enumerate(zip(
        rnd.integers(0, 30, 3000) * rnd.integers(0, 2, 3000), rnd.integers(0, 13, 3000), rnd.integers(-1, 3, 3000), rnd.integers(0, 2, 3000)))]
    rows = [(c, -1 if t is None else t, k, r, m) for c, t, k, r, m in rows]
    got = transcripts.transitions(
        spark.createDataFrame(rows, "conv_id long, turn long, copy long, role int, more int").repartition(parts))
    steps, first, before = Counter(), Counter(), {}
    for c, _, _, r, m in sorted(rows, key=lambda x: (x[1], x[2])):
        if c not in before:
            first[r] += r >= 0
        elif before[c][0] >= 0 and r >= 0:
            steps[(*before[c], r)] += 1
        before[c] = (r, m)
    assert got == (steps, first)


def test_repeated_turns_do_not_multiply(spark):
    """The counts of one conversation of 300 rows at turn 1 and 300 at turn 2 are 599 transitions and one start."""
    rows = spark.createDataFrame([(None, 1 + i % 2, "user" if i % 2 else "assistant", "a") for i in range(600)],
                                 "conv_id long, turn long, role string, text string")
    step = np.exp(transcripts.learn(rows)["step"])
    # Rows of turn 1 are the assistant's, those of turn 2 the user's: 299 and 299 stay, one changes.
    assert step[4, 4] > 0.9 and step[2, 2] > 0.9 and step[4, 2] < 0.01


def test_every_label_is_learned_from_distinct_texts(spark, monkeypatch):
    """A label of few large groups of copies is in the sample, each text once, with spans of its own."""
    seen = []
    monkeypatch.setattr(language_id, "train", lambda spans, labels, n: seen.append(Counter(labels)))
    rows = spark.range(9000).select(
        F.when(F.col("id") < 6000, "aa").otherwise("bb").alias("lang"),
        F.when(F.col("id") < 6000, F.format_string("copied text%d", F.col("id") % 3)).otherwise(F.format_string("single t%d", F.col("id"))).alias("text"))
    labels, _ = language_id.learn(rows, docs_per_label=50)
    assert labels == ["aa", "bb"] and seen == [Counter({0: 3, 1: 50})]


def test_documents_give_different_spans():
    import pyarrow as pa

    texts = [" ".join(f"w{k}" for k in range(200)) + f" own{i} é" for i in range(20)]
    batch = pa.RecordBatch.from_pydict({"label": ["x"] * 20, "text": texts})
    spans = next(language_id._sample_spans(4)(iter([batch]))).column("span").to_pylist()
    assert len(spans) >= 75 and len(set(spans)) > 60 and all(s.decode() for s in spans)


def _direct(weights, text):
    """Probabilities of one whole text by one forward pass over all of its bytes."""
    codes = np.frombuffer(text, np.uint8)[None, :]
    probs, *_ = language_id._outputs(weights, codes, np.ones(codes.shape, bool))
    return probs[0].mean(0)


def test_texts_are_read_as_by_one_pass(monkeypatch):
    """Short texts exactly; long ones up to what lies beyond the context, which the states forget."""
    weights = language_id.fresh_weights(4, seed=3)
    rng = np.random.default_rng(1)
    letters = list("abcdefgh  é日🙂")
    texts = ["".join(rng.choice(letters, n)).encode() for n in (1, 2, 30, 200, 250, 383, 384, 385, 900, 5000, 0, 3)]
    got = language_id.Reader(weights)(texts)
    for text, probs in zip(texts, got):
        if not text:
            assert not probs.any()
        elif len(text) <= language_id.CORE:
            assert np.abs(probs - _direct(weights, text)).max() < 1e-5
        else:
            assert np.abs(probs - _direct(weights, text)).max() < 2e-3
    monkeypatch.setattr(language_id, "GROUP_BYTES", 100)
    monkeypatch.setattr(language_id, "WINDOWS_AT_ONCE", 3)
    assert np.abs(language_id.Reader(weights)(texts) - got).max() < 1e-6


def test_windows_cover_every_byte_once():
    rng = np.random.default_rng(2)
    for n in (1, 100, 384, 385, 2000):
        text = "".join(rng.choice(list("aé日🙂"), n)).encode()
        data = np.frombuffer(b"xx" + text, np.uint8)
        found = language_id.windows(data, 2, len(data))
        assert [a for _, a, _, _ in found] == [2, *[b for _, _, b, _ in found][:-1]] and found[-1][2] == len(data)
        for start, a, b, end in found:
            assert 2 <= start <= a < b <= end <= len(data) and b - a <= language_id.CORE
            assert data[a] & 0xC0 != 0x80
    # Bytes that are no characters still end.
    assert len(language_id.windows(np.full(2000, 0x80, np.uint8), 0, 2000)) > 1


@pytest.fixture(scope="module")
def learned(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    return docs, language_id.learn(docs.where((remainder(4) != 2) & (F.col("lang") != "fr")))


def test_noise_and_unlearned_languages_score_low(learned):
    docs, model = learned
    held = language_id.identify(docs.where(remainder(4) == 2), model, [F.col("lang")])
    least = language_id.least_scores(held, "lang")
    assert set(least) == set(model[0]) and all(0 < v <= language_id.ENOUGH for v in least.values())
    rows = held.collect()
    known = [r for r in rows if r["lang"] in model[0]]
    assert np.mean([r["score"] >= least[r["lang_pred"]] for r in known]) >= 0.98
    new = [r for r in rows if r["lang"] == "fr"]
    assert len(new) > 10 and np.mean([r["score"] < least[r["lang_pred"]] for r in new]) >= 0.95
    rng = np.random.default_rng(6)
    junk = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), 300)).encode() for _ in range(100)]
    junk += ["".join(chr(0x530 + i) for i in rng.integers(1, 38, 200)).encode() for _ in range(100)]  # a script never drawn
    probs = language_id.Reader(model[1])(junk)[:, :len(model[0])]
    assert np.mean(probs.max(1) < min(least.values())) >= 0.95


def test_lowest_digests_rank_a_bounded_part(spark):
    from pyspark.sql import functions as F

    rows = spark.range(40_000).select(
        F.when(F.col("id") < 39_000, "hot").otherwise("cold").alias("g"), F.sha2((F.col("id") % 20_000).cast("string"), 256).alias("digest"))
    got = language_id.lowest_digests(rows, "g", "digest", 50).collect()
    want = {}
    for r in rows.distinct().collect():
        want.setdefault(r["g"], []).append(r["digest"])
    assert {(r["g"], r["digest"]) for r in got} == {(g, d) for g, ds in want.items() for d in sorted(ds)[:50]}
