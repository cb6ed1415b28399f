"""Candle operators. Every function takes candles of many symbols at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.constants import BASE_SECONDS, DAY_SECONDS, TRADE_COUNT_NAMES
from wickline.functions import numbers, times
from wickline.functions.keys import interval_millis

PRICES = ("open", "high", "low", "close")
OHLCV = (*PRICES, "volume")


def time_window(
    df: DataFrame,
    start_ts: int | None = None,
    end_ts: int | None = None,
    column: str = "open_time",
) -> DataFrame:
    """Rows with a time whose rounded epoch second lies in ``[start_ts, end_ts]``.

    The exact test wraps the column and cannot reach a Parquet scan, so a plain
    range one second wider goes with it: that one prunes row groups and files.
    """
    out = df.where(F.col(column).isNotNull())
    second = times.epoch_seconds(df, column)
    if start_ts is not None:
        bound = times.timestamp_literal(df, column, start_ts - 1)
        out = out.where((F.col(column) >= bound) & (second >= F.lit(start_ts)))
    if end_ts is not None:
        bound = times.timestamp_literal(df, column, end_ts + 1)
        out = out.where((F.col(column) < bound) & (second <= F.lit(end_ts)))
    return out


def _typed(
    df: DataFrame, values: Sequence[str], keys: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    """Keys, epoch second and tolerant DOUBLE values; rows lacking a value are dropped."""
    typed = df.select(
        *keys,
        times.epoch_seconds(df, "open_time").alias("timestamp"),
        *[numbers.to_double(df, name).alias(name) for name in values],
        *extra,
    )
    return typed.where(numbers.all_present(*values))


def candle_rows(
    df: DataFrame,
    start_ts: int | None = None,
    end_ts: int | None = None,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Complete candles of the window: keys, timestamp, OHLCV."""
    return _typed(time_window(df, start_ts, end_ts), OHLCV, keys)


def first_and_last_order(
    time: Column, tie_key: Column | None, tie_bits: int | None, span: int | None
) -> tuple[Column, Column]:
    """Ordering values whose minimum is the first row and whose maximum is the last.

    Among rows of equal time the lowest ``tie_key`` (a non-negative BIGINT) is
    both first and last. One number per row keeps ``min_by``/``max_by`` on the
    hash aggregate; a struct would force a sort. With ``time`` relative to a
    bucket of ``span`` and a key below ``2**tie_bits`` the number is a BIGINT,
    otherwise a DECIMAL(38, 0) which holds any time and any key.
    """
    if tie_key is None:
        return time, time
    if tie_bits is not None and span is not None and span.bit_length() + tie_bits <= 62:
        base = F.shiftleft(time, tie_bits)
        return base + tie_key, base - tie_key
    base = time.cast("decimal(18,0)") * F.lit(str(10**19)).cast("decimal(20,0)")
    key = tie_key.cast("decimal(19,0)")
    return (base + key).cast("decimal(38,0)"), (base - key).cast("decimal(38,0)")


def _ohlcv(first: Column, last: Column) -> list[Column]:
    return [
        F.min_by("open", first).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", last).alias("close"),
        F.sum("volume").alias("volume"),
    ]


def resample(
    df: DataFrame,
    bucket_seconds: int,
    start_ts: int | None = None,
    end_ts: int | None = None,
    keys: Sequence[str] = ("symbol",),
    tie_key: str | None = None,
    tie_bits: int | None = None,
) -> DataFrame:
    """OHLCV per bucket of ``bucket_seconds``, aligned to the epoch.

    Partial aggregation runs before the shuffle, so a symbol or bucket holding
    most of the rows arrives as one row per task. Without ``tie_key`` the times
    of a symbol must be unique, as they are in compacted candles.
    """
    extra = [] if tie_key is None else [F.col(tie_key).cast("bigint").alias("tie_key")]
    rows = _typed(time_window(df, start_ts, end_ts), OHLCV, keys, extra)
    rows = rows.withColumn("bucket", times.bucket_start(F.col("timestamp"), bucket_seconds))
    first, last = first_and_last_order(
        F.col("timestamp") - F.col("bucket"),
        None if tie_key is None else F.col("tie_key"),
        tie_bits,
        bucket_seconds,
    )
    buckets = rows.groupBy(*keys, "bucket").agg(*_ohlcv(first, last))
    return buckets.withColumnRenamed("bucket", "timestamp")


def timeframe(
    df: DataFrame,
    timeframe_seconds: int,
    start_ts: int | None = None,
    end_ts: int | None = None,
    keys: Sequence[str] = ("symbol",),
    tie_key: str | None = None,
) -> DataFrame:
    """One-minute candles as they are for 60 seconds, resampled ones otherwise."""
    if timeframe_seconds == BASE_SECONDS:
        return candle_rows(df, start_ts, end_ts, keys)
    return resample(df, timeframe_seconds, start_ts, end_ts, keys, tie_key)


def compact(
    df: DataFrame,
    interval: str,
    keys: Sequence[str] = ("symbol",),
    tie_key: str | None = None,
    tie_bits: int | None = None,
) -> DataFrame:
    """Candles of ``interval`` from raw rows of any tolerated column types.

    Times may be timestamps, ISO text, integer milliseconds or integer text,
    prices may be text, and trade counts may come under either name or not at all.
    """
    width = interval_millis(interval)
    extra = [] if tie_key is None else [F.col(tie_key).cast("bigint").alias("tie_key")]
    rows = df.select(
        *keys,
        times.epoch_millis(df, "open_time").alias("open_millis"),
        *[numbers.to_double(df, name).alias(name) for name in OHLCV],
        numbers.trade_count(df, TRADE_COUNT_NAMES).alias("trade_count"),
        *extra,
    ).where(numbers.all_present("open_millis", *OHLCV))
    rows = rows.withColumn("bucket", times.bucket_start(F.col("open_millis"), width))
    first, last = first_and_last_order(
        F.col("open_millis") - F.col("bucket"),
        None if tie_key is None else F.col("tie_key"),
        tie_bits,
        width,
    )
    buckets = rows.groupBy(*keys, "bucket").agg(
        *_ohlcv(first, last), F.sum("trade_count").alias("trade_count")
    )
    return buckets.select(
        *keys, F.timestamp_millis("bucket").alias("open_time"), *OHLCV, "trade_count"
    )


def latest_per_time(
    df: DataFrame, rank: str, keys: Sequence[str], time: str, values: Sequence[str]
) -> DataFrame:
    """One row per (keys, time): the one of the highest ``rank`` (a number)."""
    return df.groupBy(*keys, time).agg(
        *[F.max_by(name, F.col(rank)).alias(name) for name in values]
    )


def intrabar(
    df: DataFrame,
    bucket_seconds: int,
    start_ts: int | None = None,
    end_ts: int | None = None,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Bars with the start of the primary bucket they fall in: keys, bucket, timestamp, OHLC.

    Buckets are aligned to the epoch, so the first one may be partial. A missing
    volume does not drop a bar here.
    """
    rows = _typed(time_window(df, start_ts, end_ts), PRICES, keys)
    return rows.select(
        *keys,
        times.bucket_start(F.col("timestamp"), bucket_seconds).alias("bucket"),
        "timestamp",
        *PRICES,
    )


def nest_intrabar(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Bars of each bucket as one time-ordered array: one row per bucket, whatever its width.

    Over compacted minute candles a bucket holds one bar a minute, so the array
    is bounded by the width asked for.
    """
    return bars.groupBy(*keys, "bucket").agg(
        F.array_sort(F.collect_list(F.struct("timestamp", *PRICES))).alias("bars")
    )
