"""Universe, liquidity and status reports over landed pages and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.constants import (
    DEFAULT_LIQUIDITY_QUOTES,
    DEFAULT_QUOTES,
    FUNDING,
    KLINES,
    PREMIUM,
)
from wickline.functions import times
from wickline.operators import status as status_operators
from wickline.operators import universe as universe_operators
from wickline.sources import ledgers, listing, pages, tables, versions
from wickline.sources.tables import Layout


def discover_universe(
    spark: SparkSession, landed: str, quotes: tuple[str, ...] = DEFAULT_QUOTES
) -> DataFrame:
    """Universe from landed listing pages ``listings/<dataset>/*.xml``, ordered."""
    texts = pages.read_texts(spark, f"{landed.rstrip('/')}/listings", "*.xml")
    named = texts.select(listing.segment(F.col("path"), 2).alias("dataset"), "text")
    prefixes = pages.listed_prefixes(named, keep=["dataset"])
    # The universe aggregates by symbol itself; repeated listings need no removal before.
    listed = pages.prefix_symbols(prefixes, ["dataset"])
    found = universe_operators.build_universe(listed, quotes)
    return universe_operators.ordered_universe(found, quotes)


def publish_universe(
    spark: SparkSession, root: str, landed: str, quotes: tuple[str, ...] = DEFAULT_QUOTES
) -> None:
    """Discover the universe and store it."""
    ledgers.publish_universe(discover_universe(spark, landed, quotes), Layout(root))


def quote_liquidity(
    spark: SparkSession, landed: str, quotes: tuple[str, ...] = DEFAULT_LIQUIDITY_QUOTES
) -> DataFrame:
    """Symbols and quote volume per quote asset from landed ticker pages ``tickers/*.json``."""
    texts = pages.read_texts(spark, f"{landed.rstrip('/')}/tickers", "*.json")
    return universe_operators.quote_liquidity(pages.ticker_rows(texts), quotes)


def status(spark: SparkSession, root: str) -> DataFrame:
    """The published status, one row."""
    return ledgers.read_status(spark, Layout(root))


def local_symbols(spark: SparkSession, root: str) -> DataFrame:
    """Symbols with raw candles, ordered. No file of the table is opened."""
    found = tables.partitions(spark, Layout(root), versions.RAW_CANDLES).where(F.col("dataset") == KLINES)
    return found.select("symbol").distinct().orderBy("symbol")


def plan(spark: SparkSession, root: str) -> DataFrame:
    """One row: number of local symbols and the published status word."""
    count = local_symbols(spark, root).agg(F.count("*")).first()[0]
    return status(spark, root).select(
        F.lit(count).cast("bigint").alias("local_symbol_count"), "status"
    )


def validate(spark: SparkSession, root: str) -> DataFrame:
    """One row: whether a run has published a status, the status and its failure count."""
    document = status(spark, root)
    valid = status_operators.is_valid(F.col("status"), F.col("last_run"))
    return document.select(valid.alias("valid"), "status", "failed_item_count")


def local_observations(spark: SparkSession, root: str) -> DataFrame:
    """What the stored tables show per dataset, interval, symbol and period."""
    layout = Layout(root)
    candles = status_operators.compacted_observations(tables.read_compacted(spark, layout))
    premium = tables.partitions(spark, layout, versions.RAW_CANDLES).where(F.col("dataset") == PREMIUM)
    funding = tables.partitions(spark, layout, versions.RAW_FUNDING)

    def of_periods(rows: DataFrame, dataset: str, interval: str | None) -> DataFrame:
        column = F.col(interval) if interval else F.lit(None).cast("string")
        periods = rows.select(column.alias("interval"), "symbol", "period").distinct()
        return periods.select(
            F.lit(dataset).alias("dataset"),
            "interval",
            "symbol",
            times.period_end_day(F.col("period")).alias("latest_complete_utc_day"),
            F.lit(1).cast("bigint").alias("source_count"),
        )

    return candles.unionByName(of_periods(premium, PREMIUM, "interval")).unionByName(
        of_periods(funding, FUNDING, None)
    )


def scan_local_status(spark: SparkSession, root: str) -> DataFrame:
    """Freshness of the stored tables per dataset and interval, ordered."""
    rolled = status_operators.freshness(local_observations(spark, root))
    return status_operators.ordered_freshness(rolled)


def scan_stored_status(spark: SparkSession, raw_root: str, optimized_root: str) -> DataFrame:
    """Freshness of one-file-per-period archives and of compacted files with manifests.

    ``optimized_root`` holds ``symbol=*/interval=*/candles.parquet``, where a
    ``candles.manifest.json`` beside it may name the last source and their number.
    """
    archives = status_operators.file_observations(
        listing.stored_files(listing.files(spark, raw_root, "*.parquet")).where(
            F.col("dataset") != KLINES
        )
    )
    return status_operators.ordered_freshness(
        status_operators.freshness(archives.unionByName(_manifests(spark, optimized_root)))
    )


def _manifests(spark: SparkSession, optimized_root: str) -> DataFrame:
    def placed(df: DataFrame) -> DataFrame:
        folder = F.regexp_extract("path", r"(symbol=[^/]+/interval=[^/]+)/[^/]+$", 1)
        return df.withColumn("folder", folder).where(F.col("folder") != "")

    candles = placed(listing.files(spark, optimized_root, "candles.parquet")).select("folder")
    texts = placed(pages.read_texts(spark, optimized_root, "candles.manifest.json"))
    document = F.from_json("text", "last_source string, source_files bigint")
    manifests = texts.select("folder", document.alias("manifest"))
    joined = candles.join(manifests, "folder", "left").select(
        F.regexp_extract("folder", "symbol=([^/]+)/", 1).alias("symbol"),
        F.regexp_extract("folder", "interval=([^/]+)$", 1).alias("interval"),
        F.col("manifest.last_source").alias("last_source"),
        F.col("manifest.source_files").alias("source_files"),
    )
    return status_operators.manifest_observations(joined)
