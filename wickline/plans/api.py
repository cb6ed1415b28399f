"""Reads over the stored tables: many symbols at once, results as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.constants import BASE_SECONDS, DEFAULT_INTERVAL, PREMIUM
from wickline.constants import FUNDING as FUNDING_DATASET
from wickline.functions import keys
from wickline.operators import candles, funding, gaps
from wickline.schemas import FUNDING
from wickline.sources import ledgers, tables, versions
from wickline.sources.tables import Layout

Symbols = str | Sequence[str] | None


def _names(symbols: Symbols) -> list[str] | None:
    if symbols is None:
        return None
    names = [symbols] if isinstance(symbols, str) else symbols
    return [keys.partition_symbol(name) for name in names]


def _of_symbols(df: DataFrame, symbols: Symbols) -> DataFrame:
    names = _names(symbols)
    return df if names is None else df.where(F.col("symbol").isin(names))


def _compacted(
    spark: SparkSession,
    root: str,
    symbols: Symbols,
    interval: str,
    start_ts: int | None,
    end_ts: int | None,
) -> DataFrame:
    """Compacted candles, pruned to the directories of the symbols, interval and years."""
    width = keys.require_interval(interval)
    rows = tables.read_compacted(spark, Layout(root), _names(symbols), width)
    rows = _of_symbols(rows, symbols).where(F.col("interval") == width)
    # One second of slack: the window compares rounded seconds.
    if start_ts is not None:
        year = F.date_format(F.timestamp_seconds(F.lit(start_ts - 1)), "yyyy")
        rows = rows.where(F.col("year") >= year)
    if end_ts is not None:
        year = F.date_format(F.timestamp_seconds(F.lit(end_ts + 1)), "yyyy")
        rows = rows.where(F.col("year") <= year)
    return rows


def _raw_of_window(
    df: DataFrame,
    root: str,
    dataset: str,
    start_ts: int | None,
    end_ts: int | None,
) -> DataFrame:
    """Raw rows, pruned to the periods that can hold rows of the window."""
    if start_ts is None and end_ts is None:
        return df
    strays = ledgers.stray_periods(df.sparkSession, Layout(root), dataset)
    inside = F.lit(True)
    if start_ts is not None:
        day = F.date_format(F.timestamp_seconds(F.lit(start_ts - 1)), "yyyy-MM-dd")
        # A month is compared as a month, a day as a day.
        inside = inside & (F.col("period") >= F.left(day, F.length("period")))
    if end_ts is not None:
        day = F.date_format(F.timestamp_seconds(F.lit(end_ts + 1)), "yyyy-MM-dd")
        inside = inside & (F.col("period") <= F.left(day, F.length("period")))
    return df.where(inside | F.col("period").isin(strays))


def _in_order(df: DataFrame, ordered: bool, *columns: str) -> DataFrame:
    return df.orderBy(*columns) if ordered else df


def load_klines(
    spark: SparkSession,
    root: str,
    symbols: Symbols = None,
    interval: str = DEFAULT_INTERVAL,
    start_ts: int | None = None,
    end_ts: int | None = None,
    record_gaps: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Compacted candles: symbol, timestamp (epoch seconds), open, high, low, close, volume.

    The window includes both ends. ``record_gaps`` first adds the missing ranges
    of the window to the gap ledger. ``ordered=False`` saves the global sort.
    """
    if record_gaps:
        record_kline_gaps(spark, root, symbols, interval, start_ts, end_ts)
    rows = _compacted(spark, root, symbols, interval, start_ts, end_ts)
    return _in_order(candles.candle_rows(rows, start_ts, end_ts), ordered, "symbol", "timestamp")


def load_resampled_klines(
    spark: SparkSession,
    root: str,
    symbols: Symbols = None,
    timeframe_seconds: int = BASE_SECONDS,
    start_ts: int | None = None,
    end_ts: int | None = None,
    record_gaps: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Candles of any timeframe, made of the compacted minute candles."""
    if record_gaps:
        record_kline_gaps(spark, root, symbols, DEFAULT_INTERVAL, start_ts, end_ts)
    rows = _compacted(spark, root, symbols, DEFAULT_INTERVAL, start_ts, end_ts)
    frames = candles.timeframe(rows, timeframe_seconds, start_ts, end_ts)
    return _in_order(frames, ordered, "symbol", "timestamp")


def load_intrabar_buckets(
    spark: SparkSession,
    root: str,
    symbols: Symbols = None,
    primary_timeframe_seconds: int = BASE_SECONDS,
    start_ts: int | None = None,
    end_ts: int | None = None,
    record_gaps: bool = False,
    nested: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Minute bars with their primary bucket; with ``nested`` as one array per bucket."""
    if record_gaps:
        record_kline_gaps(spark, root, symbols, DEFAULT_INTERVAL, start_ts, end_ts)
    rows = _compacted(spark, root, symbols, DEFAULT_INTERVAL, start_ts, end_ts)
    bars = candles.intrabar(rows, primary_timeframe_seconds, start_ts, end_ts)
    if nested:
        return _in_order(candles.nest_intrabar(bars), ordered, "symbol", "bucket")
    return _in_order(bars, ordered, "symbol", "timestamp")


def load_funding_rates(
    spark: SparkSession,
    root: str,
    symbols: Symbols = None,
    start_ts: int | None = None,
    end_ts: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Funding events: symbol, timestamp, funding_rate; those of one second in source order."""
    names = _names(symbols)
    rows = _of_symbols(tables.read_raw_funding(spark, Layout(root), names), symbols)
    rows = _raw_of_window(rows, root, FUNDING_DATASET, start_ts, end_ts)
    place = ("symbol", "period", "source_row")
    rows = rows.select(*place, *FUNDING.names)
    events = funding.funding_events(rows, start_ts, end_ts, place)
    # Events of one second stay in the order of their source.
    events = _in_order(events, ordered, "symbol", "timestamp", "period", "source_row")
    return events.drop("period", "source_row")


def load_premium_index_klines(
    spark: SparkSession,
    root: str,
    symbols: Symbols = None,
    interval: str = DEFAULT_INTERVAL,
    start_ts: int | None = None,
    end_ts: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Raw premium-index candles of the window."""
    width = keys.require_interval(interval)
    rows = tables.read_raw_candles(spark, Layout(root), PREMIUM, _names(symbols), width)
    rows = _of_symbols(rows, symbols).where(F.col("interval") == width)
    rows = _raw_of_window(rows, root, PREMIUM, start_ts, end_ts)
    return _in_order(candles.candle_rows(rows, start_ts, end_ts), ordered, "symbol", "timestamp")


def find_kline_gaps(
    spark: SparkSession,
    root: str,
    symbols: Symbols = None,
    interval: str = DEFAULT_INTERVAL,
    start_ts: int | None = None,
    end_ts: int | None = None,
    expected_seconds: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Missing ranges of compacted candles as ledger rows, by symbol and time.

    ``expected_seconds`` is the width of the interval unless given.
    """
    step = expected_seconds or keys.interval_millis(interval) // 1000
    rows = _compacted(spark, root, symbols, interval, start_ts, end_ts)
    # A compacted table has one candle per time.
    found = gaps.find_gaps(rows, step, start_ts, end_ts, times_unique=True)
    return _in_order(gaps.as_ledger(found, interval), ordered, "symbol", "missing_start_ts")


def record_kline_gaps(
    spark: SparkSession,
    root: str,
    symbols: Symbols = None,
    interval: str = DEFAULT_INTERVAL,
    start_ts: int | None = None,
    end_ts: int | None = None,
    expected_seconds: int | None = None,
) -> None:
    """Add the missing ranges of compacted candles to the gap ledger; known ones stay."""
    found = find_kline_gaps(
        spark, root, symbols, interval, start_ts, end_ts, expected_seconds, ordered=False
    )
    ledgers.record_gaps(found, Layout(root))


def available_klines(
    spark: SparkSession, root: str, symbols: Symbols = None, interval: str | None = None
) -> DataFrame:
    """Compacted (symbol, interval) pairs, ordered. No file of the table is opened."""
    found = tables.partitions(spark, Layout(root), versions.KLINES)
    rows = _of_symbols(found, symbols)
    if interval is not None:
        rows = rows.where(F.col("interval") == keys.require_interval(interval))
    return rows.select("symbol", "interval").distinct().orderBy("symbol", "interval")
