"""The list of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with its oracle."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add
