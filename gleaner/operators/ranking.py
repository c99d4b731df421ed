"""Limits, top-k, samples and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.numbers import timestamp_suffix


def first_n(df: DataFrame, keys: list[str], order_by: list[Column | str], n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows per group; the limit is applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_groups(df: DataFrame, key: str, n: int, count: str = "n") -> DataFrame:
    """The ``n`` most frequent values; ties by value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.desc(count), F.asc_nulls_first(key)).limit(n)


def top_per_group(df: DataFrame, keys: list[str], value: str, n: int, count: str = "n") -> DataFrame:
    """The ``n`` most frequent values per group; rows are counted before they are ranked."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count))
    return first_n(counts, keys, [F.desc(count), F.asc_nulls_first(value)], n)


def limit_by(df: DataFrame, order_by: list[Column | str], n: int) -> DataFrame:
    """A reproducible LIMIT."""
    return df.orderBy(*order_by).limit(n)


def seeded_sample(df: DataFrame, keys: list[str], url: str, n: int, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows per group in the order of a seeded hash of the URL."""
    order = F.md5(F.concat(F.col(url), F.lit(str(seed))).cast("binary"))
    return first_n(df, keys, [order, url], n).drop("rn")


def collision_versions(df: DataFrame, keys: list[str], key: str, timestamp: str, prefix: int = 13,
                       ties: tuple[str, ...] = ("url",)) -> DataFrame:
    """Number the rows that share a storage key; all but the first get a timestamp suffix.

    ``ties`` orders rows of one timestamp; the later ones of those get their ``number`` as well, so that stored keys differ.

    A key such as the start page may hold very many rows. They are ranked within one timestamp only, and the counts of
    the earlier timestamps of the same hour (the ``prefix`` of the timestamp) and of the earlier hours are added: no task
    ever ranks a whole key or a busy hour. Run it on slim rows (pointers), before any page text is attached.
    """
    slot, hour = [*keys, key], [*keys, key, "_hour"]
    moment = [*hour, "_moment"]
    df = df.withColumn("_moment", F.coalesce(timestamp, F.lit(""))).withColumn("_hour", F.substring("_moment", 1, prefix))
    counts = df.groupBy(*moment).agg(F.count(F.lit(1)).alias("_n"))

    def earlier(by: list[str], order: str) -> Column:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    hours = counts.groupBy(*hour).agg(F.sum("_n").alias("_n")).withColumn("_hours", earlier(slot, "_hour")).drop("_n")
    before = counts.withColumn("_moments", earlier(hour, "_moment")).drop("_n").join(hours, hour)
    same = F.row_number().over(Window.partitionBy(*moment).orderBy(*ties)).cast("long")
    df = df.withColumn("number", same).join(before, moment)
    df = df.withColumn("version", F.col("number") + F.col("_moments") + F.col("_hours"))
    return df.withColumn("stored_key", numbered_key(key, timestamp)).drop("_hour", "_moment", "_moments", "_hours")


def numbered_key(key: str, timestamp: str) -> Column:
    """The key itself for the first version, else with the timestamp and, within one timestamp, the number."""
    number = F.when(F.col("number") > 1, F.concat(F.lit("_"), F.col("number").cast("string"))).otherwise("")
    suffix = timestamp_suffix(F.coalesce(F.col(timestamp), F.lit("")))
    return F.when(F.col("version") == 1, F.col(key)).otherwise(F.concat(F.col(key), F.lit("_"), suffix, number))
