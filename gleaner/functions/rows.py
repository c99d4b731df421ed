"""Arrays to rows without evaluating the array twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AT = "_at"


def explode_once(df: DataFrame, values: Column, name: str, *keep: str | Column, pos: str | None = None) -> DataFrame:
    """One row per array item.

    A plain explode makes the optimizer infer a size filter and push it to the scan, where it evaluates the
    array expression, and all it was built from, a second time. The outer form has no such filter; the row
    that stands for an empty array is dropped afterwards.
    """
    at = pos or _AT
    out = df.select(*keep, F.posexplode_outer(values).alias(at, name)).where(F.col(at).isNotNull())
    return out if pos else out.drop(at)
