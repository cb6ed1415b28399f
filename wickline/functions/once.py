"""Keeping an expensive value from being evaluated several times per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_value(df: DataFrame, name: str, value: Column, drop: str | None = None) -> DataFrame:
    """``df`` with ``value`` as column ``name``, computed once per row.

    The optimizer copies a plain column into every later condition that uses it.
    A one-element explode stops that; it suits parsed documents, where the copy
    costs far more than the extra step.
    """
    rest = [F.col(f"`{column}`") for column in df.columns if column != drop]
    held = F.explode(F.array(F.struct(value.alias(name)))).alias("__held")
    return df.select(*rest, held).select(*rest, F.col(f"__held.{name}"))
