"""Funding-rate events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.constants import FUNDING_RATE_NAMES, FUNDING_TIME_NAMES
from wickline.functions import numbers, times


def funding_events(
    df: DataFrame,
    start_ts: int | None = None,
    end_ts: int | None = None,
    keys: tuple[str, ...] = ("symbol",),
) -> DataFrame:
    """Events of the inclusive window: keys, timestamp (seconds), funding_rate.

    The time and rate columns are found under any name they have been stored
    under; without one of them there are no events. Repeated events stay.
    """
    time = numbers.first_present(df, FUNDING_TIME_NAMES)
    rate = numbers.first_present(df, FUNDING_RATE_NAMES)
    if time is None or rate is None:
        empty = df.select(
            *keys,
            F.lit(None).cast("bigint").alias("timestamp"),
            F.lit(None).cast("double").alias("funding_rate"),
        )
        return empty.where(F.lit(False))
    source = df
    if df.schema[time].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        # Reaches the scan; the exact test below decides.
        if start_ts is not None:
            source = source.where(F.col(time) >= times.timestamp_literal(df, time, start_ts - 1))
        if end_ts is not None:
            source = source.where(F.col(time) < times.timestamp_literal(df, time, end_ts + 2))
    events = source.select(
        *keys,
        times.seconds_from_any_unit(times.epoch_millis(df, time)).alias("timestamp"),
        numbers.to_double(df, rate).alias("funding_rate"),
    ).where(numbers.all_present("funding_rate"))
    if start_ts is None and end_ts is None:
        return events.where(numbers.all_present("timestamp"))
    # A bound also drops events without a time.
    if start_ts is not None:
        events = events.where(F.col("timestamp") >= start_ts)
    if end_ts is not None:
        events = events.where(F.col("timestamp") <= end_ts)
    return events


def merge_pages(
    items: DataFrame,
    start_millis: int | None = None,
    end_millis: int | None = None,
    keys: tuple[str, ...] = ("symbol",),
) -> DataFrame:
    """Overlapping pages merged to one event per time: the last page wins.

    Takes keys, ``page_no``, ``position``, ``funding_millis``, ``funding_rate``,
    ``mark_price``. The winner is a hash aggregate over one packed number, so a
    time repeated very often is reduced before the shuffle.
    """
    kept = items
    if start_millis is not None:
        kept = kept.where(F.col("funding_millis") >= start_millis)
    if end_millis is not None:
        kept = kept.where(F.col("funding_millis") <= end_millis)
    page = F.col("page_no").cast("decimal(18,0)") * F.lit(str(10**19)).cast("decimal(20,0)")
    order = (page + F.col("position").cast("decimal(19,0)")).cast("decimal(38,0)")
    merged = kept.groupBy(*keys, "funding_millis").agg(
        F.max_by("funding_rate", order).alias("funding_rate"),
        F.max_by("mark_price", order).alias("mark_price"),
    )
    return merged.select(
        *keys,
        F.timestamp_millis("funding_millis").alias("funding_time"),
        "funding_rate",
        "mark_price",
    )
