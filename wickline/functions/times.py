"""Epoch arithmetic, buckets, periods and file-name dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.constants import MILLIS_THRESHOLD
from wickline.functions.numbers import to_long

# --- Fixed values: names of stored files, symbol_dataset[_interval]_period.parquet ---
# Funding files, and only these, have no interval.
STORED_FILE = (
    r"^(.+)_(?:(klines|premiumIndexKlines)_([A-Za-z0-9]+)|(fundingRate))"
    r"_(\d{4}-\d{2}(?:-\d{2})?)\.parquet$"
)

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"


def _text_to_timestamp(text: Column) -> Column:
    # Digits alone are an epoch number, never a year.
    return F.when(~text.rlike(_INTEGER_TEXT), text.try_cast("timestamp"))


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Epoch seconds of a time column, halves rounded to even."""
    kind = df.schema[name].dataType
    if isinstance(kind, _TIMES):
        stamp = F.col(name).cast("timestamp")
    elif isinstance(kind, T.StringType):
        stamp = _text_to_timestamp(F.col(name))
    else:
        raise TypeError(f"{name} must be a time column, not {kind.simpleString()}")
    return F.rint(F.unix_micros(stamp) / F.lit(1e6)).cast("bigint")


def timestamp_millis(stamp: Column) -> Column:
    """Epoch milliseconds of a timestamp, half a millisecond rounded away from zero."""
    micros = F.unix_micros(stamp.cast("timestamp"))
    half = F.when(micros < 0, -500).otherwise(500)
    return ((micros + half) / 1000).cast("bigint")


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds of a timestamp, an ISO text, an integer or an integer text."""
    kind = df.schema[name].dataType
    if isinstance(kind, _TIMES):
        return timestamp_millis(F.col(name))
    if isinstance(kind, T.StringType):
        return F.coalesce(timestamp_millis(_text_to_timestamp(F.col(name))), to_long(df, name))
    return to_long(df, name)


def seconds_from_any_unit(value: Column) -> Column:
    """Seconds from an epoch number that is milliseconds when large, else seconds."""
    unit = F.when(value > F.lit(MILLIS_THRESHOLD), 1000).otherwise(1)
    return F.floor(value / unit).cast("bigint")


def bucket_start(value: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``value`` (exact, also for negatives)."""
    if width <= 0:
        raise ValueError(f"bucket width must be positive: {width}")
    step = F.lit(width).cast("bigint")
    return value - F.pmod(value, step)


def period_end_day(period: Column) -> Column:
    """Last day (text) of a ``YYYY-MM`` or ``YYYY-MM-DD`` period; NULL for no date."""
    month_end = F.last_day(F.try_to_date(period, "yyyy-MM"))
    day = F.try_to_date(period, "yyyy-MM-dd")
    return F.date_format(F.when(F.length(period) == 7, month_end).otherwise(day), "yyyy-MM-dd")


def period_start_day(period: Column) -> Column:
    """First day of a ``YYYY-MM`` or ``YYYY-MM-DD`` period."""
    month = F.try_to_date(period, "yyyy-MM")
    return F.when(F.length(period) == 7, month).otherwise(F.try_to_date(period, "yyyy-MM-dd"))


def day_start_millis(day: Column) -> Column:
    """Epoch milliseconds of 00:00:00.000 UTC of a DATE."""
    return F.unix_date(day).cast("bigint") * F.lit(86_400_000)


def day_end_millis(day: Column) -> Column:
    """Epoch milliseconds of 23:59:59.999 UTC of a DATE."""
    return day_start_millis(day) + F.lit(86_399_999)


def file_name_parts(name: Column) -> Column:
    """ARRAY of symbol, dataset, interval and period of a stored file name.

    The interval of funding files is empty. Any other name gives an array of one.
    Read it with :func:`part` from a column of its own, so that the pattern is
    matched once per name.
    """
    return F.split(F.regexp_replace(name, STORED_FILE, "$1\u0001$2$4\u0001$3\u0001$5"), "\u0001")


_PARTS = ("symbol", "dataset", "interval", "period")


def part(name: str, parts: str = "parts") -> Column:
    """One of symbol, dataset, interval, period of a parsed file name; NULL if it has none."""
    value = F.get(F.col(parts), F.lit(_PARTS.index(name)))
    if name == "symbol":
        return F.when(F.size(parts) == len(_PARTS), value)
    return F.nullif(value, F.lit(""))


def timestamp_literal(df: DataFrame, name: str, epoch: int) -> Column:
    """A literal of the column's own time type, so that it can reach the scan."""
    moment = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=epoch)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.timestamp_seconds(F.lit(epoch))
