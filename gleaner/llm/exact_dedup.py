"""Exact de-duplication by a tree-merge of sorted digest runs, with DataFrame functions only.

Every scan partition is one run of (digest, smallest or largest identifier, number of rows), one entry per digest.
In each round a run joins the runs whose numbers differ from it in the next ``FAN_BITS`` bits only, so that after
ceil(bits / FAN_BITS) rounds run 0 holds every digest once. A run is spread over all partitions by its digests:
a round is a sorted partial aggregate, an exchange of (run, digest), and the merge of the sorted parts that arrive.

A digest that a third of all rows share has one entry per run already before the first exchange. On the way back
the answer goes from the root to the runs, and only then to the rows of each run, so that no join meets more rows
of one key than a scan partition holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Work

FAN_BITS = 3
# SHA-256, byte length and a second, independent hash must all agree before two texts count as equal.
KEY = ["digest", "n_bytes", "second"]


def _entries(df: DataFrame, run: Column, best, keep: Column, size: Column) -> DataFrame:
    return df.groupBy(run.alias("run"), *KEY).agg(best(keep).alias("keep"), F.sum(size).alias("size"))


def exact_duplicates(docs: DataFrame, work: Work, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest (binary SHA-256 of the text).

    A null text counts as an empty one. ``keep`` names the identifier that stays in a group; a null identifier
    stays only if the group has no other. Of rows that repeat an identifier and its text exactly one is kept.
    An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = work.save(docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("second")), "digests")
    # The smallest identifier must not be a null, which sorts first in a struct.
    order = F.struct(F.col("doc_id").isNull().alias("none") if keep == "smallest" else F.col("doc_id").isNotNull().alias("some"), "doc_id", "row")
    best = F.min if keep == "smallest" else F.max
    runs = _entries(rows, F.col("run"), best, order, F.lit(1))
    level = runs
    last = rows.agg(F.max("run")).first()[0] or 0
    while last:
        level = _entries(level, F.shiftright("run", FAN_BITS), best, F.col("keep"), F.col("size"))
        last >>= FAN_BITS
    root = level.select(*KEY, F.col("keep").alias("root_keep"), F.col("size").alias("group_size"))
    answers = runs.join(root, KEY).select("run", *KEY, "root_keep", "group_size")
    return rows.join(answers, ["run", *KEY]).select(
        "doc_id", F.col("root_keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("root_keep.row")).alias("kept"), "digest")
