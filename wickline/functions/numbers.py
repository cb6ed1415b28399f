"""Tolerant and strict numeric conversion, chosen by the stored type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Number texts: decimal notation with single underscores between digits, and
# nan / inf. Spark alone would also take a trailing type letter and hexadecimals.
_DIGITS = r"\d+(_\d+)*"
_NUMBER = (
    rf"^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?"
    r"|(?i:nan|inf|infinity))\s*$"
)


def _number_text(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit("")))


def text_to_double(text: Column) -> Column:
    """DOUBLE from text, NULL when it is no number."""
    return _number_text(text).try_cast("double")


def text_to_long(text: Column) -> Column:
    """BIGINT from text; fractions round half away from zero, NULL when it is no number."""
    number = _number_text(text)
    rounded = F.round(number.try_cast("decimal(38,6)")).try_cast("bigint")
    return F.coalesce(number.try_cast("bigint"), rounded)


def to_double(df: DataFrame, name: str) -> Column:
    """``df[name]`` as DOUBLE; text is converted tolerantly, numbers are cast."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_double(F.col(name))
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    return F.lit(None).cast("double")


def to_long(df: DataFrame, name: str) -> Column:
    """``df[name]`` as BIGINT; text is converted tolerantly, fractions are rounded."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_long(F.col(name))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.NumericType):
        return F.rint(F.col(name).cast("double")).try_cast("bigint")
    return F.lit(None).cast("bigint")


def first_present(df: DataFrame, candidates: tuple[str, ...]) -> str | None:
    """The first of ``candidates`` that is a column of ``df``."""
    return next((name for name in candidates if name in df.columns), None)


def trade_count(df: DataFrame, candidates: tuple[str, ...]) -> Column:
    """The first non-NULL trade count among the candidate columns present, else 0."""
    counts = [to_long(df, name) for name in candidates if name in df.columns]
    return F.coalesce(*counts, F.lit(0).cast("bigint"))


def all_present(*names: str) -> Column:
    """True when every named column is not NULL (NaN counts as present)."""
    return reduce(lambda left, right: left & right, [F.col(name).isNotNull() for name in names])
