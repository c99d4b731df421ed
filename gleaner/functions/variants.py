"""Access to schemaless JSON held in VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.binding import first_usable

TYPE_PATH = '$["@type"]'


def json_path(name: str) -> str:
    return name if name.startswith("$") else f"$.{name}"


def get(v: Column, name: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(v, json_path(name), as_type)


def text(v: Column, name: str) -> Column:
    return get(v, name, "string")


def as_array(v: Column) -> Column:
    """Elements of a JSON array, NULL for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def as_map(v: Column) -> Column:
    """Members of a JSON object, NULL for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def scalar_text(v: Column, name: str) -> Column:
    """Text of a scalar member; objects and arrays give NULL instead of their JSON text."""
    value = text(v, name)
    nested = F.schema_of_variant(get(v, name)).rlike("^(OBJECT|ARRAY)")
    return F.when(~value.rlike(r"^[\[{]"), value).when(~nested, value)


def first_text(v: Column, names: tuple[str, ...]) -> Column:
    """First synonym that is present and not empty."""
    if not names:
        return F.lit(None).cast("string")
    return first_usable([scalar_text(v, n) for n in names], lambda t: t != "")


def first_number(v: Column, names: tuple[str, ...]) -> Column:
    """First synonym that holds a number other than zero."""
    if not names:
        return F.lit(None).cast("double")
    return first_usable([get(v, n, "double") for n in names], lambda x: x != 0)


def any_true(v: Column, names: tuple[str, ...]) -> Column:
    if not names:
        return F.lit(False)
    return F.coalesce(F.exists(F.array(*[get(v, n, "boolean") for n in names]), lambda b: b), F.lit(False))


def flatten_variants(c: Column) -> Column:
    return F.coalesce(F.flatten(F.filter(c, lambda x: x.isNotNull())), no_variants())


def no_variants() -> Column:
    return F.array().cast("array<variant>")
