"""The corpus pipeline: documents to packed training sequences.

Every stage takes the documents that its predecessor kept and gives the columns of documents, the last one the pieces
of packed sequences. Stages follow the operators for nulls, empty texts and repeated rows; of repeated rows one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import exact_dedup, language_id, minhash_dedup, packing
from gleaner.llm.common import Work, free_name, keep_rows, prepare


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in none of the learned languages, or have no letter, go.

    The network learns from labelled documents whose crc32(doc_id) mod 4 is not 2. The others say what a right answer
    scores at least (``language_id.least_scores``); an answer below that is none. A language without a right answer
    among them must reach ``language_id.ENOUGH``. Without any labelled document there is nothing to judge by,
    and only texts without a letter go.
    """
    work = Work(prepare(spark), "pipeline-language")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    model = language_id.learn(docs.where(~held_out))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = (free_name(docs, "lang_pred"), free_name(docs, "lang_score"))
    # Judging is the dear part, so it is done once and written.
    judged = work.save(language_id.identify(docs, model, [docs[c] for c in docs.columns], names=names), "judged")
    least = language_id.least_scores(judged.where(held_out), "lang", names)
    bounds = F.create_map(*[F.lit(x) for y in model[0] for x in (y, least.get(y, language_id.ENOUGH))])
    answer, score = F.col(names[0]), F.col(names[1])
    return judged.where((answer != language_id.UNKNOWN) & (score >= bounds[answer])).drop(*names)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest doc_id."""
    work = Work(prepare(spark), "pipeline-exact")
    found = exact_dedup.exact_duplicates(docs, work, keep="largest")
    return keep_rows(work, docs, found.select("doc_id", "digest", F.col("kept").alias("keep")), "doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more stays, the one with the smallest doc_id."""
    work = Work(prepare(spark), "pipeline-near")
    found = minhash_dedup.near_duplicates(docs, work, width=5, percent=80)
    return keep_rows(work, docs, found.select("doc_id", "digest", F.col("keeper").alias("keep")), "doc_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of at most 4096 tokens."""
    prepare(spark)
    return packing.pack(docs, Work(spark, "pipeline-pack"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_languages), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
    ("packing", pack)]

# Language ID is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    work = Work(prepare(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
