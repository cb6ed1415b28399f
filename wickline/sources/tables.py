"""Stored tables: layout, reads and writes of raw rows and compacted candles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wickline.constants import (
    FUNDING,
    FUNDING_RATE_NAMES,
    FUNDING_TIME_NAMES,
    MILLIS_THRESHOLD,
    TRADE_COUNT_NAMES,
)
from wickline.functions import keys, numbers, times
from wickline.operators.candles import OHLCV
from wickline.schemas import COMPACTED, KLINE, RAW_FUNDING, RAW_KLINE, RESAMPLED
from wickline.sources import listing, mixed, versions

RAW_PARTITIONS = versions.PLACES[versions.RAW_CANDLES]
FUNDING_PARTITIONS = versions.PLACES[versions.RAW_FUNDING]
COMPACTED_PARTITIONS = versions.PLACES[versions.KLINES]
RESAMPLED_PARTITIONS = versions.PLACES[versions.RESAMPLED]


@dataclass(frozen=True)
class Layout:
    """The tables under one root (any Spark path or URI), as readers or as one unfinished change sees them."""

    root: str
    commit: versions.Commit | None = None

    def version(self, spark: SparkSession) -> versions.Version:
        return self.commit.version if self.commit else versions.latest(spark, self.root)

    @contextmanager
    def changing(self, spark: SparkSession) -> Iterator[Layout]:
        """The layout within a change; what is written through it becomes visible when the outermost block ends."""
        if self.commit:
            yield self
            return
        with versions.commit(spark, self.root) as commit:
            yield Layout(self.root, commit)

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw_candles(self) -> str:
        return self._at("raw_candles")

    @property
    def raw_funding(self) -> str:
        return self._at("raw_funding")


def _segments(symbols: Sequence[str] | None) -> str:
    """Glob of the ``symbol=`` directories. Spark writes special characters as ``%XX``."""
    if symbols is None:
        return "symbol=*"
    special = "\"#%'*/:=?\\\x7f{[]^"
    names = [
        "".join(f"%{ord(c):02X}" if c in special or c < " " else "?" if c == "," else c for c in name)
        for name in symbols
    ]
    return "symbol=" + listing.one_of(names)


def _scope(symbols: Sequence[str] | None, **values: str | None) -> Column:
    """A test of partition columns: the symbols and values asked for, where any are."""
    asked = F.lit(True) if symbols is None else F.col("symbol").isin(list(symbols))
    for name, value in values.items():
        asked = asked if value is None else asked & (F.col(name) == value)
    return asked


def read_raw_candles(
    spark: SparkSession,
    layout: Layout,
    dataset: str,
    symbols: Sequence[str] | None = None,
    interval: str | None = None,
) -> DataFrame:
    """Raw candles of a dataset; what is named here is all that is listed.

    Filters on symbol, interval and period prune directories.
    """
    below = f"dataset={dataset}/{_segments(symbols)}/interval={interval or '*'}"
    scope = _scope(symbols, dataset=dataset, interval=interval)
    rows = versions.read(spark, layout.version(spark), versions.RAW_CANDLES, below, RAW_KLINE, scope)
    return rows.where(F.col("dataset") == dataset)


def read_raw_funding(
    spark: SparkSession, layout: Layout, symbols: Sequence[str] | None = None
) -> DataFrame:
    version = layout.version(spark)
    return versions.read(spark, version, versions.RAW_FUNDING, _segments(symbols), RAW_FUNDING, _scope(symbols))


def read_compacted(
    spark: SparkSession,
    layout: Layout,
    symbols: Sequence[str] | None = None,
    interval: str | None = None,
) -> DataFrame:
    """Compacted candles; no rows where nothing has been compacted. Raw rows are never used."""
    below = f"{_segments(symbols)}/interval={interval or '*'}"
    scope = _scope(symbols, interval=interval)
    return versions.read(spark, layout.version(spark), versions.KLINES, below, COMPACTED, scope)


def read_resampled(spark: SparkSession, layout: Layout, bucket_seconds: int) -> DataFrame:
    """Stored candles of one timeframe, see ``streaming.incremental.resample_new_rows``."""
    below, scope = f"timeframe={bucket_seconds}", _scope(None, timeframe=str(bucket_seconds))
    rows = versions.read(spark, layout.version(spark), versions.RESAMPLED, below, RESAMPLED, scope)
    return rows.drop("timeframe", "year")


def partitions(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The partition columns of a table's partitions. No directory is listed and no file of the table opened."""
    return layout.version(spark).index(spark, name).drop("batch")


def _replace(df: DataFrame, layout: Layout, name: str, covering: DataFrame | None = None) -> None:
    """Replace the partitions that ``df`` holds, and remove those of ``covering`` that it does not hold."""
    with layout.changing(df.sparkSession) as inside:
        inside.commit.replace(df, name, covering)


def _named(rows: DataFrame) -> DataFrame:
    """``rows``; a row without a symbol is an error, as all such would share a partition."""
    message = F.lit("raw row without a symbol")
    return rows.withColumn("symbol", F.coalesce("symbol", F.raise_error(message).cast("string")))


def write_raw_candles(rows: DataFrame, layout: Layout) -> None:
    """Replace the raw (dataset, symbol, interval, period) partitions of ``rows``.

    An archive is one partition and comes out of one task, so nothing is shuffled.
    """
    _replace(_named(rows).select(*RAW_KLINE.names), layout, versions.RAW_CANDLES)


def write_raw_funding(rows: DataFrame, layout: Layout) -> None:
    _replace(_named(rows).select(*RAW_FUNDING.names), layout, versions.RAW_FUNDING)


def write_compacted(rows: DataFrame, layout: Layout, covering: DataFrame | None = None) -> None:
    """Replace the compacted (symbol, interval, year) partitions of ``rows``.

    Those of ``covering`` for which ``rows`` has none are removed.

    ``rows`` must already be clustered by these columns. A year of minute
    candles is some half a million rows, so one file per partition stays small
    however much of the data one symbol holds.
    """
    ordered = rows.select(*COMPACTED.names).sortWithinPartitions(
        *COMPACTED_PARTITIONS, "open_time"
    )
    _replace(ordered, layout, versions.KLINES, covering)


def write_resampled(rows: DataFrame, layout: Layout) -> None:
    """Replace the (timeframe, symbol, year) partitions of ``rows``, clustered by these columns."""
    ordered = rows.select(*RESAMPLED.names).sortWithinPartitions(
        *RESAMPLED_PARTITIONS, "timestamp"
    )
    _replace(ordered, layout, versions.RESAMPLED)


def remove_raw(places: DataFrame, layout: Layout, dataset: str) -> None:
    """Remove the raw partitions of ``places`` that exist: periods replaced by nothing.

    Their completion is in the source ledger.
    """
    spark = places.sparkSession
    with layout.changing(spark) as inside:
        if dataset == FUNDING:
            inside.commit.remove(places, versions.RAW_FUNDING)
        else:
            inside.commit.remove(places.withColumn("dataset", F.lit(dataset)), versions.RAW_CANDLES)


# --- archives written by others: one file per period, column types vary by file ---


def _with_place(df: DataFrame) -> DataFrame:
    """Adds symbol, interval and period of each row's file.

    They come from the file name and directory, or from ``symbol=`` and
    ``interval=`` directories.
    """
    parsed = df.withColumn("parts", times.file_name_parts(listing.segment("path", 1)))
    named = F.regexp_extract("path", "/symbol=([^/]+)/interval=[^/]+/[^/]+$", 1)
    folder = F.coalesce(F.nullif(named, F.lit("")), listing.segment("path", 2))
    width = F.nullif(F.regexp_extract("path", "/interval=([^/]+)/[^/]+$", 1), F.lit(""))
    return parsed.select(
        "*",
        keys.canonical_symbol(folder, strict=False).alias("symbol"),
        F.coalesce(times.part("interval"), width).alias("interval"),
        times.part("period").alias("period"),
    )


def _klines_of(found: DataFrame) -> DataFrame:
    """Candles of the files found, whatever the types of their columns; prices or volumes not stored are NULL."""
    names = ("open_time", *OHLCV, *TRADE_COUNT_NAMES)
    df = mixed.read_columns(found, {name: (name,) for name in names}, required=("open_time",))
    counts = [mixed.of_any(df, name, numbers.to_long) for name in TRADE_COUNT_NAMES]
    return _with_place(df).select(
        F.timestamp_millis(mixed.of_any(df, "open_time", times.epoch_millis)).alias("open_time"),
        *[mixed.of_any(df, name, numbers.to_double).alias(name) for name in OHLCV],
        F.coalesce(*counts, F.lit(0).cast("bigint")).alias("trade_count"),
        "source_row",
        "symbol",
        "interval",
        "period",
    )


def _funding_of(found: DataFrame) -> DataFrame:
    """Funding events of the files found; a file without a time or a rate has none."""
    names = {"time": FUNDING_TIME_NAMES, "rate": FUNDING_RATE_NAMES, "mark_price": ("mark_price",)}
    df = mixed.read_columns(found, names, required=("time", "rate"))
    value = mixed.of_any(df, "time", times.epoch_millis)
    millis = value * F.when(value > MILLIS_THRESHOLD, 1).otherwise(1000)
    return _with_place(df).select(
        F.timestamp_millis(millis).alias("funding_time"),
        mixed.of_any(df, "rate", numbers.to_double).alias("funding_rate"),
        mixed.of_any(df, "mark_price", numbers.to_double).alias("mark_price"),
        "source_row",
        "symbol",
        "period",
    )


def read_stored_klines(
    spark: SparkSession,
    raw_root: str,
    dataset: str,
    symbol: str | None = None,
    interval: str | None = None,
) -> DataFrame:
    """Candles of stored one-file-per-period archives, as raw rows."""
    found = listing.find_raw_archives(spark, raw_root, dataset, symbol, interval, ordered=False)
    named = _klines_of(found).withColumn("dataset", F.lit(keys.require_dataset(dataset)))
    return named.select(*RAW_KLINE.names)


def read_stored_compacted(spark: SparkSession, optimized_root: str) -> DataFrame:
    """Candles of ``symbol=<KEY>/interval=<I>/candles.parquet`` files, as compacted rows."""
    rows = _klines_of(listing.files(spark, optimized_root, "candles.parquet"))
    complete = rows.where(numbers.all_present("open_time", *OHLCV))
    placed = complete.withColumn("year", F.date_format("open_time", "yyyy"))
    return placed.select(*COMPACTED.names).repartition(*COMPACTED_PARTITIONS)


def read_stored_funding(
    spark: SparkSession, raw_root: str, symbol: str | None = None
) -> DataFrame:
    """Funding events of stored one-file-per-period archives, as raw rows."""
    found = listing.find_raw_archives(spark, raw_root, "fundingRate", symbol, ordered=False)
    return _funding_of(found).select(*RAW_FUNDING.names)


def normalise_strict(df: DataFrame) -> DataFrame:
    """KLINE columns by plain casts: text that is no number is an error."""
    return df.select(
        F.timestamp_millis(F.col("open_time").cast("bigint")).alias("open_time"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in KLINE.fields[1:]],
    )
