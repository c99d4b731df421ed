"""Name a value inside an expression, so that it is written and evaluated once."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def keep_if(value: Column, usable: Callable[[Column], Column]) -> Column:
    """The value when usable, else NULL."""
    return F.get(F.filter(F.array(value), lambda v: usable(v)), F.lit(0))


def first_usable(values: list[Column], usable: Callable[[Column], Column]) -> Column:
    """The first usable value, else NULL."""
    return F.get(F.filter(F.array(*values), lambda v: usable(v)), F.lit(0))


def built_once(build: Callable) -> Callable:
    """Keep the columns a function builds from hashable arguments for the life of the Spark context.

    A large expression takes seconds to assemble through the Python gateway, and it only names columns.
    """
    kept: dict = {}

    @wraps(build)
    def wrapper(*args):
        key = (SparkContext.getOrCreate().applicationId, args)
        if key not in kept:
            kept[key] = build(*args)
        return kept[key]

    return wrapper
