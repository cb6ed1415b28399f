"""Classification of fetch errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wickline.constants import MISSING_ARCHIVE_TEXTS, MISSING_REST_TEXTS


def _mentions(message: Column, groups: tuple[tuple[str, ...], ...]) -> Column:
    text = F.lower(message)
    hits = [
        reduce(lambda left, right: left & right, [text.contains(part) for part in group])
        for group in groups
    ]
    return F.coalesce(reduce(lambda left, right: left | right, hits), F.lit(False))


def is_missing_archive(message: Column) -> Column:
    """The archive is not published."""
    return _mentions(message, MISSING_ARCHIVE_TEXTS)


def is_missing_rest(message: Column) -> Column:
    """The funding endpoint has nothing for this symbol."""
    return _mentions(message, MISSING_REST_TEXTS)
