"""Compaction of raw candles, all symbols in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.constants import DEFAULT_INTERVAL, FUNDING, KLINES
from wickline.functions import keys, times
from wickline.operators import candles
from wickline.session import Scratch
from wickline.sources import ledgers, tables
from wickline.sources.tables import Layout

DAY_MILLIS = 86_400_000

_VALUES = [*candles.OHLCV, "trade_count"]


def _year(time: Column) -> Column:
    return F.lpad(F.year(time).cast("string"), 4, "0")


def row_rank(period: Column, source_row: Column) -> Column:
    """Order of raw rows as one BIGINT: end of the period, month after day, line in the file.

    Digits of the period serve as its end, a month counting as day 31, so that no
    date is parsed per row. Lines take the lower 36 bits.
    """
    digits = F.replace(period, F.lit("-"), F.lit("")).try_cast("bigint")
    monthly = F.length(period) == 7
    end = F.when(monthly, digits * 200 + 63).otherwise(digits * 2)
    return F.shiftleft(end, 36) + source_row


def compacted_rows(raw: DataFrame, interval: str, dedupe: str | None) -> DataFrame:
    """Candles by (symbol, interval, year), clustered for :func:`tables.write_compacted`.

    ``dedupe="latest_period"`` keeps one raw row per (symbol, time): overlapping
    daily and monthly archives then count once. ``None`` adds all of them up.

    Either way the rows cross the network twice: once reduced map-side by
    (symbol, time), and once by (symbol, year), where a group cannot exceed one
    candle per interval and is therefore bounded whatever the skew. The interval
    stays the column of the raw table: as a constant it would drop out of the
    clustering, and the writer would sort the rows again, losing their order.
    """
    owner, place = ["symbol", "interval"], ["symbol", "interval", "year"]
    ranked = raw.withColumn("rank", row_rank(F.col("period"), F.col("source_row")))
    if dedupe is None:
        rows = candles.compact(ranked, interval, owner, tie_key="rank")
        return rows.withColumn("year", _year(F.col("open_time"))).repartition(*place)
    if dedupe != "latest_period":
        raise ValueError(f"unknown dedupe: {dedupe!r}")
    complete = ranked.where(_complete())
    unique = candles.latest_per_time(complete, "rank", owner, "open_time", _VALUES)
    # The year of the bucket, not of the row: a bucket must not be split. The
    # aggregation by (symbol, interval, year, bucket) needs no shuffle of its own.
    width = keys.interval_millis(interval)
    bucket = times.bucket_start(times.timestamp_millis(F.col("open_time")), width)
    clustered = unique.withColumn("year", _year(F.timestamp_millis(bucket))).repartition(*place)
    return candles.compact(clustered, interval, place)


def _complete() -> Column:
    return F.col("open_time").isNotNull() & F.col("period").isNotNull() & _all_values()


def _all_values() -> Column:
    present = F.lit(True)
    for name in candles.OHLCV:
        present = present & F.col(name).isNotNull()
    return present


def store_raw_candles(rows: DataFrame, layout: Layout) -> None:
    """Replace raw partitions and note those that hold rows of other days."""
    with layout.changing(rows.sparkSession) as inside:
        tables.write_raw_candles(rows, inside)
        ledgers.record_strays(rows, "open_time", inside)


def store_raw_funding(rows: DataFrame, layout: Layout) -> None:
    """As :func:`store_raw_candles` for funding events."""
    placed = rows.withColumn("dataset", F.lit(FUNDING))
    placed = placed.withColumn("interval", F.lit(None).cast("string"))
    with layout.changing(rows.sparkSession) as inside:
        tables.write_raw_funding(rows, inside)
        ledgers.record_strays(placed, "funding_time", inside)


def touched_years(rows: DataFrame) -> DataFrame:
    """Distinct (symbol, interval, year) of the buckets that raw rows fall in."""
    width = keys.interval_millis_column(F.col("interval"))
    time = times.timestamp_millis(F.col("open_time"))
    year = _year(F.timestamp_millis(time - F.pmod(time, width)))
    years = rows.select("symbol", "interval", year.alias("year"))
    return years.where(F.col("year").isNotNull()).distinct()


def compact_klines(
    spark: SparkSession,
    root: str,
    symbols: Sequence[str] | None = None,
    interval: str = DEFAULT_INTERVAL,
    dedupe: str | None = "latest_period",
    touched: DataFrame | None = None,
    layout: Layout | None = None,
) -> None:
    """Recompute compacted candles from all their raw rows.

    ``symbols`` limits the work to these. ``touched`` (symbol, interval, year)
    limits it to partitions that received rows; the others stay as they are, and
    those without a raw row left are removed. ``layout`` is the one of a change
    that this is a part of.
    """
    keys.interval_millis(interval)  # An unsupported interval fails before any write.
    layout = layout or Layout(root)
    named = None if symbols is None else [keys.partition_symbol(s) for s in symbols]
    if touched is None:
        raw = _raw(spark, layout, named, interval)
        tables.write_compacted(compacted_rows(raw, interval, dedupe), layout)
        return
    with Scratch(spark, root) as scratch:
        # One row per symbol and year: small, and needed several times.
        touched = scratch.keep(touched.where(F.col("interval") == interval).distinct())
        if named is not None:
            touched = touched.where(F.col("symbol").isin(named))
        raw = _rows_of_years(spark, layout, touched, interval)
        tables.write_compacted(compacted_rows(raw.drop("year"), interval, dedupe), layout, touched)


def _raw(
    spark: SparkSession, layout: Layout, symbols: Sequence[str] | None, interval: str
) -> DataFrame:
    raw = tables.read_raw_candles(spark, layout, KLINES, symbols, interval)
    raw = raw.where(F.col("interval") == interval)
    return raw if symbols is None else raw.where(F.col("symbol").isin(list(symbols)))


def _bucket_year(time: str, width: int) -> Column:
    """The year a row's bucket starts in: what the compacted partition is named after."""
    return _year(F.timestamp_millis(times.bucket_start(times.timestamp_millis(F.col(time)), width)))


def _rows_of_years(
    spark: SparkSession, layout: Layout, touched: DataFrame, interval: str
) -> DataFrame:
    """All raw rows of the touched years with their year, opening only directories that can hold some."""
    width = keys.interval_millis(interval)
    # Symbols and years of the refresh: bounded by what is traded and by the calendar.
    owners = [row["symbol"] for row in touched.select("symbol").distinct().collect()]
    years = [int(row["year"]) for row in touched.select("year").distinct().collect()]
    # A bucket that does not divide the day may hold rows of the following year.
    later = 0 if DAY_MILLIS % width == 0 else 1 + width // (365 * DAY_MILLIS)
    years = [str(year + more) for year in years for more in range(later + 1)]
    strays = ledgers.stray_periods(spark, layout, KLINES)
    raw = _raw(spark, layout, owners, interval)
    raw = raw.where(F.left("period", F.lit(4)).isin(years) | F.col("period").isin(strays))
    placed = raw.withColumn("year", _bucket_year("open_time", width))
    return placed.join(touched, ["symbol", "interval", "year"], "left_semi")


def import_stored_klines(
    spark: SparkSession,
    root: str,
    raw_root: str,
    dataset: str = KLINES,
    symbol: str | None = None,
    interval: str | None = None,
) -> None:
    """Take one-file-per-period archives written by others into the raw table."""
    rows = tables.read_stored_klines(spark, raw_root, dataset, symbol, interval)
    store_raw_candles(rows, Layout(root))


def import_stored_funding(
    spark: SparkSession, root: str, raw_root: str, symbol: str | None = None
) -> None:
    """As :func:`import_stored_klines` for funding archives."""
    store_raw_funding(tables.read_stored_funding(spark, raw_root, symbol), Layout(root))


def import_stored_compacted(spark: SparkSession, root: str, optimized_root: str) -> None:
    """Take compacted files written by others into the compacted table as they are."""
    tables.write_compacted(tables.read_stored_compacted(spark, optimized_root), Layout(root))
