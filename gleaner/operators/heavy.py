"""The most frequent keys in two passes, without shuffling the long tail.

The first pass keeps, per partition, a bounded summary of counts: when it holds too many keys, the count of the largest
one that must go is taken off all of them. A key's true count is at least its summed estimate and at most that plus all
that was taken off, ``lost``. The second pass counts exactly, but only keys that may still be among the first. The
result is complete if the last of them is more frequent than any key outside can be; this is checked, and where it does
not hold all keys are counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

CAPACITY = 20_000
# Candidates are broadcast, so their number is bounded; more of them mean a full count.
MAX_CANDIDATES = 50_000


class Top(NamedTuple):
    """The first keys (key, n, rn), and how they were found."""

    rows: DataFrame
    proof: dict


def _summaries(capacity: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        lost = 0

        def shrink(to: int) -> int:
            if len(counts) <= to:
                return 0
            off = sorted(counts.values(), reverse=True)[to]
            for key in [k for k, n in counts.items() if n <= off]:
                del counts[key]
            for key in counts:
                counts[key] -= off
            return off

        for batch in batches:
            found = pc.value_counts(batch.column("key"))
            counts.update(dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist())))
            if len(counts) > 2 * capacity:
                lost += shrink(capacity)
        lost += shrink(capacity)
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*keys, None], kind), pa.array([*counts.values(), lost], pa.int64()), pa.array([False] * len(keys) + [True])],
            names=["key", "n", "lost"])

    return run


def top_keys(df: DataFrame, key: str, k: int, capacity: int = CAPACITY, max_candidates: int = MAX_CANDIDATES) -> Top:
    """The ``k`` most frequent values of ``key``, ties by value; NULL is a value like others.

    ``proof`` says how: ``lost`` (no key left out has more rows than that), ``least`` (rows of the last one given),
    ``candidates`` (keys counted exactly) and ``method`` (candidates, or full where the bound does not settle it).
    """
    slim = df.select(F.col(key).alias("key"))
    field = slim.schema["key"]
    schema = T.StructType([T.StructField("key", field.dataType), T.StructField("n", T.LongType()), T.StructField("lost", T.BooleanType())])
    spark = df.sparkSession
    passed = slim.mapInArrow(_summaries(capacity, to_arrow_type(field.dataType)), schema)
    merged = passed.groupBy("key", "lost").agg(F.sum("n").alias("n"))
    # One row of what was taken off, and the first keys by estimate: both small.
    seen = merged.orderBy(F.desc("lost"), F.desc("n")).limit(max_candidates + 2).collect()
    lost = sum(r["n"] for r in seen if r["lost"])
    held = [(r["key"], r["n"]) for r in seen if not r["lost"]]
    floor = held[k - 1][1] if len(held) >= k else 0
    chosen = [key for key, n in held if n + lost >= floor]
    counted, method, least = None, "full", None
    if len(chosen) <= max_candidates:
        wanted = spark.createDataFrame([(c,) for c in chosen], T.StructType([T.StructField("wanted", field.dataType)]))
        hits = slim.join(F.broadcast(wanted), slim["key"].eqNullSafe(wanted["wanted"]), "left_semi")
        counted = _first(hits, k).collect()
        least = counted[-1]["n"] if counted else 0
        if lost == 0 or (len(counted) == k and least > lost):
            method = "candidates"
    if method == "full":
        rows = _first(slim, k)
    else:
        rows = spark.createDataFrame([(r["key"], r["n"]) for r in counted], T.StructType([schema.fields[0], schema.fields[1]]))
    # At most k rows are left, so one window ranks them.
    numbered = rows.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("n"), F.col("key").asc())))
    return Top(numbered.withColumnRenamed("key", key), {
        "lost": lost, "least": least, "candidates": len(chosen), "method": method})


def _first(rows: DataFrame, k: int) -> DataFrame:
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("key").asc()).limit(k)
