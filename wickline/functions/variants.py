"""Typed access to JSON values: a value of another JSON type is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wickline.functions.numbers import text_to_double

_FRACTION = r"^(DOUBLE|FLOAT|DECIMAL)"
_PLAIN_INTEGER = r"^\s*[+-]?\d+(_\d+)*\s*$"


def kind_of(value: Column) -> Column:
    """JSON type name: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, OBJECT.., ARRAY.."""
    return F.schema_of_variant(value)


def item(value: Column, path: str) -> Column:
    """The value at ``path``, still untyped."""
    return F.try_variant_get(value, path, "variant")


def items(value: Column) -> Column:
    """Elements of a JSON array; NULL when the value is no array."""
    return F.try_variant_get(value, "$", "array<variant>")


def text_of(value: Column) -> Column:
    """A JSON string."""
    return F.when(kind_of(value) == "STRING", F.try_variant_get(value, "$", "string"))


def integer_of(value: Column) -> Column:
    """A JSON integer."""
    return F.when(kind_of(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def boolean_of(value: Column) -> Column:
    """A JSON boolean."""
    return F.when(kind_of(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def number_of(value: Column, path: str = "$") -> Column:
    """DOUBLE from a JSON number or a JSON string holding a number; never from a boolean.

    Every JSON value has a text form, and only those of numbers read as one.
    """
    return text_to_double(F.try_variant_get(value, path, "string"))


def whole_number_of(value: Column, path: str = "$") -> Column:
    """BIGINT from a JSON number (fraction cut) or a JSON string of digits."""
    text = F.try_variant_get(value, path, "string")
    digits = F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint")
    fraction = kind_of(item(value, path)).rlike(_FRACTION)
    cut = F.try_variant_get(value, path, "double").try_cast("bigint")
    return F.when(text.rlike(_PLAIN_INTEGER), digits).when(fraction, cut)


def is_null(value: Column) -> Column:
    """Absent or JSON null."""
    return value.isNull() | (kind_of(value) == "VOID")
