"""Fields without a fixed type, as VARIANT: parsed once, tested and cast in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("missing", "null", "bool", "number", "string", "array", "object")


def parse(text: Column) -> Column:
    """A variant from JSON text; null for null and for anything that is no JSON."""
    return F.try_parse_json(text)


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def kind_of(v: Column, path: str = "$") -> Column:
    """The kind of the value at ``path``, one of ``KINDS``; a null there is a value, a field that isn't there is missing."""
    name = F.schema_of_variant(field(v, path))
    return (
        F.when(name.isNull(), "missing").when(name == "VOID", "null").when(name == "BOOLEAN", "bool").when(name == "STRING", "string")
        .when(F.startswith(name, F.lit("ARRAY")), "array").when(F.startswith(name, F.lit("OBJECT")), "object").otherwise("number")
    )


def is_kind(v: Column, path: str, *kinds: str) -> Column:
    """Whether the field has one of the kinds; false, not null, where it is missing and that isn't asked for."""
    unknown = set(kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"no such kinds: {sorted(unknown)}")
    return kind_of(v, path).isin(*kinds)


def as_text(v: Column, path: str) -> Column:
    """The field as text: strings as they are, other values as JSON; null for null and missing."""
    return F.when(is_kind(v, path, "array", "object"), F.to_json(field(v, path))).otherwise(F.try_variant_get(v, path, "string"))


def as_long(v: Column, path: str) -> Column:
    """The field as a whole number, from a number or its text; null where it is none."""
    number = F.when(is_kind(v, path, "number"), F.try_variant_get(v, path, "bigint"))
    digits = F.when(is_kind(v, path, "string"), F.try_variant_get(v, path, "string"))
    return F.coalesce(number, F.when(digits.rlike(r"^\s*[+-]?\d{1,18}\s*$"), F.trim(digits).try_cast("bigint")))
