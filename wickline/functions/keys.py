"""Symbol keys, intervals, dataset names, quote assets and archive addresses."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

from wickline.constants import (
    ARCHIVE_KEY_ROOT,
    DATASET_ALIASES,
    FUNDING,
    INTERVAL_PATTERN,
    SYMBOL_KEY_PATTERN,
    UNIT_MILLIS,
)

_BLANKS = " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0      　"
#: A percent sign that begins no escape, and what stands for bytes that are no UTF-8.
_STRAY_PERCENT = "%(?![0-9A-Fa-f]{2})"
_NOT_UTF8 = "\ufffd"


def _replace(column: Column, *pairs: tuple[str, str]) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), pairs, column)


def _percent_encode(column: Column) -> Column:
    """Percent-encode UTF-8, leaving letters, digits and ``_.-~=`` as they are."""
    form = F.url_encode(column)
    return _replace(form, ("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%3D", "="))


def _checked(key: Column, valid: Column, original: Column, what: str) -> Column:
    message = F.concat(F.lit(f"invalid {what}: "), F.coalesce(original, F.lit("NULL")))
    return F.when(valid, key).otherwise(F.raise_error(message).cast("string"))


def symbol_key(symbol: Column, strict: bool = True) -> Column:
    """Canonical key: trimmed, upper case, percent-encoded (``%`` itself kept).

    An impossible key raises, or is NULL with ``strict=False``.
    """
    encoded = _percent_encode(F.upper(F.btrim(symbol, F.lit(_BLANKS))))
    # Last, so that a literal "%3D" in the input is not taken for "=".
    key = _replace(encoded, ("%25", "%"))
    valid = key.rlike(SYMBOL_KEY_PATTERN)
    return _checked(key, valid, symbol, "symbol") if strict else F.when(valid, key)


def storage_key(symbol: Column, strict: bool = True) -> Column:
    """Path segment of a symbol: percent-encoded as it stands, ``%`` included."""
    key = _percent_encode(symbol)
    valid = (key != "") & ~key.isin(".", "..") & ~key.contains("/")
    return _checked(key, valid, symbol, "storage key") if strict else F.when(valid, key)


def symbol_of_key(key: Column) -> Column:
    """The symbol behind a canonical or storage key.

    Only well-formed escapes are decoded, a stray ``%`` stays; a key whose
    escapes are no UTF-8 is taken as it stands. Never NULL for a key.
    """
    form = F.regexp_replace(_replace(key, ("+", "%2B")), _STRAY_PERCENT, "%25")
    decoded = F.try_url_decode(form)
    return F.when(decoded.contains(_NOT_UTF8), key).otherwise(F.coalesce(decoded, key))


def canonical_symbol(symbol: Column, strict: bool = True) -> Column:
    """The partition value of a symbol: the decoded canonical key."""
    return symbol_of_key(symbol_key(symbol, strict))


def symbol_from_prefix(prefix: Column) -> Column:
    """Symbol named by the last segment of a listing prefix."""
    segments = F.split(F.regexp_replace(prefix, "/+$", ""), "/")
    return symbol_of_key(F.element_at(segments, -1))


def require_symbol(symbol: str) -> str:
    """Driver-side :func:`symbol_key` for one argument."""
    key = quote(symbol.strip().upper(), safe="%=")
    if re.fullmatch(SYMBOL_KEY_PATTERN, key) is None:
        raise ValueError(f"invalid symbol: {symbol!r}")
    return key


def partition_symbol(symbol: str) -> str:
    """Driver-side :func:`canonical_symbol` for one argument."""
    key = require_symbol(symbol)
    decoded = unquote(re.sub(_STRAY_PERCENT, "%25", key))
    return key if _NOT_UTF8 in decoded else decoded


def require_interval(interval: str) -> str:
    """``interval`` when it is a count and one of ``m h d w M``, else an error."""
    if re.fullmatch(INTERVAL_PATTERN, interval) is None:
        raise ValueError(f"invalid interval: {interval!r}")
    return interval


def interval_millis(interval: str) -> int:
    """Milliseconds of a minute, hour or day interval; weeks and months have no fixed width."""
    unit = require_interval(interval)[-1]
    if unit not in UNIT_MILLIS:
        raise ValueError(f"unsupported interval: {interval}")
    return int(interval[:-1]) * UNIT_MILLIS[unit]


def interval_millis_column(interval: Column) -> Column:
    """As :func:`interval_millis` for a column; anything unsupported is NULL."""
    count = F.regexp_extract(interval, r"^([0-9]+)[mhd]$", 1).try_cast("bigint")
    unit = F.right(interval, F.lit(1))
    width = reduce(
        lambda c, item: c.when(unit == item[0], F.lit(item[1])), UNIT_MILLIS.items(), F
    )
    return count * width


def require_dataset(name: str) -> str:
    """Dataset name behind any of its accepted spellings."""
    if name not in DATASET_ALIASES:
        raise ValueError(f"invalid dataset: {name!r}")
    return DATASET_ALIASES[name]


def dataset_name(name: Column) -> Column:
    """As :func:`require_dataset` for a column."""
    table = F.create_map(*[F.lit(x) for pair in DATASET_ALIASES.items() for x in pair])
    known = F.element_at(table, name)
    return _checked(known, known.isNotNull(), name, "dataset")


def quote_asset(symbol: Column, quotes: tuple[str, ...]) -> Column:
    """First of ``quotes`` that ends the symbol, else NULL."""
    return F.coalesce(*[F.when(symbol.endswith(q), F.lit(q)) for q in quotes], F.lit(None))


def symbol_order(symbol: Column, quotes: tuple[str, ...]) -> list[Column]:
    """Sort keys: base asset, then rank of the quote asset, then the whole symbol."""
    quote_column = quote_asset(symbol, quotes)
    base = F.when(
        quote_column.isNull(), symbol
    ).otherwise(F.left(symbol, F.length(symbol) - F.length(quote_column)))
    rank = F.array_position(F.array(*[F.lit(q) for q in quotes]), quote_column)
    return [base, F.coalesce(rank, F.lit(len(quotes) + 1)), symbol]


def archive_key(dataset: Column, symbol: Column, interval: Column, period: Column) -> Column:
    """Key of an archive below the archive root; monthly when the period is ``YYYY-MM``.

    Funding archives have no interval level and repeat the dataset name instead.
    """
    is_funding = dataset == FUNDING
    key = F.when(is_funding, storage_key(symbol, strict=False)).otherwise(
        symbol_key(symbol, strict=False)
    )
    span = F.when(F.length(period) == 7, F.lit("monthly")).otherwise(F.lit("daily"))
    label = F.when(is_funding, dataset).otherwise(interval)
    file_name = F.concat(F.concat_ws("-", key, label, period), F.lit(".zip"))
    folder = F.when(~is_funding, interval)
    return F.concat_ws("/", F.lit(ARCHIVE_KEY_ROOT), span, dataset, key, folder, file_name)


def archive_url(base_url: str, key: Column) -> Column:
    """Address of an archive under the publisher's base address."""
    return F.concat(F.lit(base_url.rstrip("/") + "/"), key)


def raw_file_key(dataset: Column, symbol: Column, interval: Column, period: Column) -> Column:
    """Key of the one-file-per-period layout: ``dataset/KEY/KEY_dataset[_interval]_period``."""
    is_funding = dataset == FUNDING
    key = F.when(is_funding, storage_key(symbol, strict=False)).otherwise(
        symbol_key(symbol, strict=False)
    )
    name = F.concat_ws("_", key, dataset, F.when(~is_funding, interval), period)
    return F.concat_ws("/", dataset, key, F.concat(name, F.lit(".parquet")))
