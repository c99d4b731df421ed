"""The stages on awkward rows, and all queries of the subpackage on the smallest tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check_oracles
import corpus_pipeline
from gleaner.llm import queries


def test_stages_keep_and_drop(spark, awkward, work):
    docs = awkward.withColumn("lang", F.lit("xx")).withColumn("digest_", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = work.save(stage(spark, docs, ""), name)
        assert kept.columns == docs.columns
        docs = kept
    texts = [r["text"] or "" for r in awkward.collect()]
    left = [r["text"] for r in docs.collect()]
    assert len(left) == len(set(left))
    assert set(left) <= {t for t in texts if any(c.isalpha() for c in t)}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_exact_stage_keeps_one_of_each(spark, awkward):
    kept = corpus_pipeline.drop_exact_copies(spark, awkward, "").collect()
    digest = lambda t: hashlib.sha256((t or "").encode()).digest()
    assert sorted(digest(r["text"]) for r in kept) == sorted({digest(r["text"]) for r in awkward.collect()})


def test_of_repeated_rows_the_same_one_stays(spark, work):
    from gleaner.llm.common import keep_rows

    rows = [(1, "a", "en", "s2"), (1, "a", "de", "s1"), (1, "a", None, "s3"), (1, "b", "en", "s"), (None, "c", "x", "y"), (None, "c", "x", "y"),
            (2, None, "q", "q"), (2, "", "p", "q"), (3, "gone", "e", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    found = docs.select("doc_id", digest.alias("digest"), (F.coalesce("text", F.lit("")) != "gone").alias("keep"))
    seen = {tuple(sorted(map(str, keep_rows(work, docs.repartition(n), found, "doc_id", "text").collect()))) for n in (1, 3, 7)}
    (only,) = seen
    assert len(only) == 4 and not any("gone" in r for r in only)


def test_language_stage_rejects_what_it_did_not_learn(spark, sf):
    import random

    rnd = random.Random(4)
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    spaced = "abcdefghijklmnopqrstuvwxyz    "
    planted = [(10 ** 6 + i, "".join(rnd.choice(spaced) for _ in range(400)), None, "planted", 400) for i in range(60)]
    planted += [(2 * 10 ** 6 + i, "".join(chr(0x10D0 + rnd.randrange(33)) if rnd.random() < 0.85 else " " for _ in range(300)), None, "planted", 300)
                for i in range(60)]
    mixed = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    left = corpus_pipeline.keep_languages(spark, mixed, "")
    assert left.where("source = 'planted'").count() <= 6
    assert left.where("source <> 'planted'").count() >= 0.99 * docs.where(F.col("text").rlike(r"\p{L}")).count()
    # A language that nothing is labelled with: its documents go, the others stay.
    unlabelled = docs.withColumn("source", F.col("lang")).withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang")))
    left = corpus_pipeline.keep_languages(spark, unlabelled, "").groupBy("source").count().collect()
    left = {r["source"]: r["count"] for r in left}
    total = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    assert left.get("fr", 0) <= 0.05 * total["fr"]
    assert sum(n for y, n in left.items() if y not in ("fr", None)) >= 0.985 * sum(n for y, n in total.items() if y not in ("fr", None))


def test_stages_of_nothing(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), "").collect() == []


@pytest.mark.parametrize("name", sorted([*queries.QUERIES, "pipeline"]))
def test_query_runs_and_matches_its_sql(spark, sf, name):
    ok, note = check_oracles.compare(spark, check_oracles.connect(sf), name, sf)
    assert ok, note


def test_entry_registers_the_queries():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
