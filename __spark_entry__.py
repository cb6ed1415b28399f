"""

Every query reads the whole driver tables through the adapters of
``wickline.plans.adapters`` and applies one operator (or a few) to them.
"""

from __future__ import annotations

import atexit
import contextlib
import datetime as dt
import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickline import configure
from wickline.constants import DATASETS, KLINES
from wickline.functions import errors, keys, numbers, times
from wickline.operators import candles, coverage, funding, gaps, status, universe
from wickline.plans import adapters, api, compaction, ingest
from wickline.schemas import SOURCE
from wickline.session import Scratch, remove_folders
from wickline.sources import archives, ledgers, listing, pages, tables

try:  # The training-data operators are an optional part.
    from wickline.llm import queries as llm
except ImportError as missing:
    # Left out where the part, or a module that it alone needs, is not installed.
    if missing.name is None or (missing.name.startswith("wickline") and missing.name != "wickline.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Windows and ranges used by the registered queries.
WINDOW = (1704412800, 1705622400)  # 2024-01-05 .. 2024-01-19
FUNDING_WINDOW = (852076800, 915148799)  # 1997 .. 1998
DAYS = (dt.date(2024, 1, 1), dt.date(2024, 2, 10))
#: A range around all events.
EVENT_DAYS = (dt.date(2023, 12, 1), dt.date(2024, 3, 31))
QUOTES = ("USDT", "USDC")
FALLBACK_URL = "premium-endpoint"
REST_URL = "funding-endpoint"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """15-minute candles of every symbol."""
    return queries()["resample_15m"](spark, SMOKE_DIR)


@functools.cache
def _input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the driver tables, from their file listing."""
    found = listing.files(spark, sf_dir, "*.parquet")
    return int(found.agg(F.sum("length")).first()[0] or 0)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.withColumn(name, F.round(name, 6))
    return df


def _seconds(df: DataFrame, name: str = "open_time") -> DataFrame:
    """``name`` as epoch milliseconds, so that no time type is compared."""
    return df.withColumn(name, F.unix_millis(name))


# --- candles ---


def load_klines_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = candles.candle_rows(adapters.event_candles(spark, sf), *WINDOW)
    return rows.orderBy("symbol", "timestamp")


def _resample(seconds: int) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = candles.resample(
            adapters.event_candles(spark, sf), seconds, tie_key="source_key"
        )
        return _rounded(rows, "volume").orderBy("symbol", "timestamp")

    return query


def resample_window_1h(spark: SparkSession, sf: str) -> DataFrame:
    rows = candles.resample(
        adapters.event_candles(spark, sf), 3600, *WINDOW, tie_key="source_key"
    )
    return _rounded(rows, "volume")


def resample_ties_1d(spark: SparkSession, sf: str) -> DataFrame:
    rows = candles.resample(adapters.line_candles(spark, sf), 86_400, tie_key="source_key")
    return _rounded(rows, "volume")


def resample_ties_1w(spark: SparkSession, sf: str) -> DataFrame:
    rows = candles.resample(adapters.line_candles(spark, sf), 604_800, tie_key="source_key")
    return _rounded(rows, "volume")


def compact_klines_1h(spark: SparkSession, sf: str) -> DataFrame:
    rows = candles.compact(adapters.text_candles(spark, sf), "1h", tie_key="source_key")
    return _seconds(_rounded(rows, "volume"))


def compact_klines_1d(spark: SparkSession, sf: str) -> DataFrame:
    rows = candles.compact(adapters.line_candles(spark, sf), "1d", tie_key="source_key")
    return _seconds(_rounded(rows, "volume"))


def latest_row_per_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.line_candles(spark, sf)
    latest = candles.latest_per_time(
        rows, "source_key", ["symbol"], "open_time", ["open", "volume", "trade_count"]
    )
    return latest.withColumn("open_time", F.unix_millis(F.col("open_time").cast("timestamp")))


def intrabar_flat_3h(spark: SparkSession, sf: str) -> DataFrame:
    return candles.intrabar(adapters.event_candles(spark, sf), 10_800, *WINDOW)


def intrabar_count_3h(spark: SparkSession, sf: str) -> DataFrame:
    bars = candles.intrabar(adapters.event_candles(spark, sf), 10_800)
    return bars.groupBy("symbol", "bucket").agg(F.count("*").alias("bars"))


def intrabar_nested_3h(spark: SparkSession, sf: str) -> DataFrame:
    # Minute candles first: at most 180 of them fall into three hours.
    minutes = candles.compact(adapters.text_candles(spark, sf), "1m", tie_key="source_key")
    nested = candles.nest_intrabar(candles.intrabar(minutes, 10_800))
    return nested.select(
        "symbol",
        "bucket",
        F.size("bars").cast("bigint").alias("bars"),
        F.array_join(F.transform("bars", lambda b: b["timestamp"].cast("string")), " ").alias(
            "timestamps"
        ),
        F.get("bars", F.lit(0))["open"].alias("first_open"),
        F.element_at("bars", -1)["close"].alias("last_close"),
    )


# --- gaps ---


def _minutes(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.event_candles(spark, sf)
    return rows.withColumn("open_time", F.date_trunc("minute", "open_time"))


def gap_ranges_1m(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.find_gaps(_minutes(spark, sf), 60)


def gap_ranges_window(spark: SparkSession, sf: str) -> DataFrame:
    """Unrounded times: fractional counts, and a window with open edges."""
    return gaps.find_gaps(adapters.event_candles(spark, sf), 240, *WINDOW)


def gap_ranges_lines(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.find_gaps(adapters.line_candles(spark, sf), 86_400)


def gap_merge_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    found = gaps.as_ledger(gaps.find_gaps(_minutes(spark, sf), 60), "1m")
    early = gaps.as_ledger(gaps.find_gaps(_minutes(spark, sf), 60, end_ts=WINDOW[0]), "1m")
    existing = early.withColumn("reason", F.lit("reviewed"))
    return gaps.merge_gaps(existing, found)


# --- funding ---


def funding_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.order_funding(spark, sf).select("symbol", "funding_time", "funding_rate")
    return funding.funding_events(rows, *FUNDING_WINDOW)


def funding_mixed_units(spark: SparkSession, sf: str) -> DataFrame:
    """Times as text: milliseconds, seconds or ISO, by order status; rates as text."""
    rows = adapters.order_funding(spark, sf)
    second = F.unix_seconds(F.col("funding_time").cast("timestamp"))
    text = (
        F.when(F.col("o_orderstatus") == "F", (second * 1000).cast("string"))
        .when(F.col("o_orderstatus") == "O", second.cast("string"))
        .otherwise(F.date_format("funding_time", "yyyy-MM-dd HH:mm:ss"))
    )
    legacy = rows.select(
        "symbol",
        text.alias("fundingTime"),
        F.col("o_totalprice").cast("string").alias("fundingRate"),
    )
    return funding.funding_events(legacy, *FUNDING_WINDOW)


def _funding_items(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.order_funding(spark, sf).select(
        "symbol",
        F.unix_millis(F.col("funding_time").cast("timestamp")).alias("funding_millis"),
        "funding_rate",
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("mark_price"),
        F.floor(F.col("o_orderkey") / 1000).alias("page_no"),
        F.pmod("o_orderkey", F.lit(1000)).alias("position"),
    )


def funding_page_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _seconds(funding.merge_pages(_funding_items(spark, sf)), "funding_time")


def funding_page_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """As ``funding_page_merge``, of the events within two bounds."""
    merged = funding.merge_pages(_funding_items(spark, sf), *(second * 1000 for second in FUNDING_WINDOW))
    return _seconds(merged, "funding_time")


# --- pages, archives, listings ---


def premium_payload_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = pages.parse_premium_pages(adapters.premium_pages(spark, sf))
    return _seconds(pages.premium_rows(parsed, ["symbol", "page_no"]))


def premium_page_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    parsed = pages.parse_premium_pages(adapters.premium_pages(spark, sf))
    return pages.page_outcomes(parsed, ["symbol", "page_no"])


def premium_window(spark: SparkSession, sf: str) -> DataFrame:
    parsed = pages.parse_premium_pages(adapters.premium_pages(spark, sf))
    return candles.candle_rows(pages.premium_rows(parsed, ["symbol"]), *WINDOW)


def funding_payload_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = pages.parse_funding_pages(adapters.funding_pages(spark, sf))
    return pages.funding_rows(parsed, ["symbol", "page_no"])


def _fresh_folder(spark: SparkSession, use: str) -> str:
    """A folder for tables that lazy results read; removed when the process ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:  # machine-local only where the session is
        alone = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        base = tempfile.mkdtemp(prefix="wickline-") if alone else spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/{use}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        remove_folders(spark, [folder])


def _extracted(spark: SparkSession, sf: str, funding: bool = False) -> tuple[DataFrame, DataFrame]:
    """Extraction, written once as a refresh does, and its outcomes."""
    zips, checksums = (adapters.funding_archives if funding else adapters.archives)(spark, sf)
    folder = _fresh_folder(spark, "extracted")
    archives.extract(zips, funding).write.parquet(folder)
    extracted = spark.read.parquet(folder)
    return extracted, archives.archive_outcomes(extracted, checksums)


def archive_zip_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _seconds(archives.kline_rows(archives.good_rows(*_extracted(spark, sf))))


def archive_zip_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    _, outcomes = _extracted(spark, sf)
    return outcomes.select(
        "path",
        "row_count",
        "error_code",
        F.col("error_message").isNotNull().alias("failed"),
        F.length("checksum").cast("bigint").alias("checksum_length"),
    )


def checksum_failures(spark: SparkSession, sf: str) -> DataFrame:
    _, outcomes = _extracted(spark, sf)
    return outcomes.where(F.col("error_code").isNotNull()).select(
        "path", "error_code", F.length("error_message").cast("bigint").alias("message_length")
    )


def _prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return pages.listed_prefixes(adapters.listing_pages(spark, sf), keep=["dataset"])


def listing_xml(spark: SparkSession, sf: str) -> DataFrame:
    return pages.listed_symbols(_prefixes(spark, sf), ["dataset"])


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    return pages.prefix_symbols(_prefixes(spark, sf), ["dataset"])


# --- universe ---


def universe_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = universe.build_universe(_listed(spark, sf), QUOTES)
    return rows.select(
        "symbol",
        "quote_asset",
        "storage_key",
        F.element_at("datasets", "klines").alias("has_klines"),
        F.element_at("datasets", "premium_index_klines").alias("has_premium"),
    )


def universe_order(spark: SparkSession, sf: str) -> DataFrame:
    ordered = universe.ordered_universe(universe.build_universe(_listed(spark, sf), QUOTES), QUOTES)
    base, rank, _ = keys.symbol_order(F.col("symbol"), QUOTES)
    return ordered.select("symbol", base.alias("base_asset"), rank.alias("quote_rank"))


def quote_liquidity(spark: SparkSession, sf: str) -> DataFrame:
    tickers = pages.ticker_rows(adapters.ticker_pages(spark, sf))
    rows = universe.quote_liquidity(tickers, ("USDC", "USDT", "BUSD"))
    return _rounded(rows, "aggregate_quote_volume")


# --- targets and outcomes ---


def _symbols(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.table(spark, sf, "events")
    symbol = F.concat(F.upper("event_type"), "user_id", F.lit("USDT"))
    return events.select(symbol.alias("symbol")).distinct()


def refresh_targets_daily(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.refresh_targets(_symbols(spark, sf), DATASETS, *DAYS)


def refresh_targets_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.refresh_targets(_symbols(spark, sf), DATASETS, *DAYS, granularity="monthly")


def funding_calendar_split(spark: SparkSession, sf: str) -> DataFrame:
    targets = coverage.funding_targets(
        _symbols(spark, sf), dt.date(2023, 12, 30), dt.date(2024, 3, 2), "monthly"
    )
    return targets.groupBy("symbol", "route").agg(
        F.count("*").alias("targets"), F.min("period").alias("first_period")
    )


def missing_targets(spark: SparkSession, sf: str) -> DataFrame:
    targets = coverage.archive_targets(_symbols(spark, sf), ("klines",), *DAYS)
    events = adapters.table(spark, sf, "events")
    sources = events.select(
        F.lit("klines").alias("dataset"),
        F.concat(F.upper("event_type"), "user_id", F.lit("USDT")).alias("symbol"),
        F.lit("1m").alias("interval"),
        F.date_format("ts", "yyyy-MM-dd").alias("target_date"),
    )
    return coverage.missing_targets(targets, sources).select("symbol", "target_date")


def target_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    targets = coverage.archive_targets(_symbols(spark, sf), ("klines",), *DAYS)
    events = adapters.table(spark, sf, "events")
    rows = events.select(
        F.concat(F.upper("event_type"), "user_id", F.lit("USDT")).alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd").alias("period"),
    )
    counted = coverage.with_row_counts(targets, rows, ["symbol", "period"])
    return counted.select("symbol", "period", "row_count")


def archive_fallback_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.resolve_archives(*adapters.fetch_outcomes(spark, sf), FALLBACK_URL)


def funding_fallback_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's symbol wants January 2024 by archive; its pages cover the event's day."""
    _, outcomes, page_outcomes = adapters.fetch_outcomes(spark, sf)
    month = outcomes.select(
        "symbol", F.lit("2024-01").alias("period"), *coverage.OUTCOME
    )
    targets = coverage.funding_targets(
        outcomes.select("symbol"), dt.date(2023, 12, 31), dt.date(2024, 1, 31), "monthly"
    )
    addressed = targets.withColumn("source_url", F.concat(F.lit("archive/"), "symbol")).withColumn(
        "output_path", F.concat(F.lit("raw/"), "symbol")
    )
    return coverage.resolve_funding(addressed, month, page_outcomes, REST_URL)


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.table(spark, sf, "events")
    message = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("HTTP 404 Not Found for "), "props"))
        .when(F.col("event_type") == "view", F.concat(F.lit("400 BAD REQUEST "), "user_id"))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"code":-1121} '), "event_id"))
        .when(F.col("event_type") == "signup", F.concat(F.lit("Invalid Symbol "), "event_id"))
        .otherwise(F.concat(F.lit("timeout 404 after "), F.col("value")))
    )
    return events.select("event_id", message.alias("message"))


def error_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _messages(spark, sf).select(
        "event_id",
        errors.is_missing_archive(F.col("message")).alias("missing_archive"),
        errors.is_missing_rest(F.col("message")).alias("missing_rest"),
    )


# --- status ---


def _file_names(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.table(spark, sf, "events")
    symbol = F.concat(F.upper("event_type"), "user_id", F.lit("USDT"))
    month, day = F.date_format("ts", "yyyy-MM"), F.date_format("ts", "yyyy-MM-dd")
    name = (
        F.when(F.col("event_type") == "click", F.concat_ws("_", symbol, F.lit("klines_1m"), month))
        .when(F.col("event_type") == "view", F.concat_ws("_", symbol, F.lit("premiumIndexKlines_1m"), day))
        .when(F.col("event_type") == "error", F.concat_ws("_", symbol, F.lit("premiumIndexKlines_5m"), month))
        .when(F.col("event_type") == "signup", F.concat_ws("_", symbol, F.lit("fundingRate"), day))
        .otherwise(F.concat_ws("_", symbol, F.lit("other"), day))
    )
    return events.select(F.concat(name, F.lit(".parquet")).alias("name")).distinct()


def freshness_rollup(spark: SparkSession, sf: str) -> DataFrame:
    observed = status.file_observations(_file_names(spark, sf))
    return status.ordered_freshness(status.freshness(observed))


def file_name_parts(spark: SparkSession, sf: str) -> DataFrame:
    return status.file_observations(_file_names(spark, sf))


def period_end_day(spark: SparkSession, sf: str) -> DataFrame:
    orders = adapters.table(spark, sf, "orders")
    period = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey",
        times.period_end_day(period).alias("end_day"),
        times.day_start_millis(day).alias("day_start"),
        times.day_end_millis(day).alias("day_end"),
    )


def published_freshness(spark: SparkSession, sf: str) -> DataFrame:
    resolved = coverage.resolve_archives(*adapters.fetch_outcomes(spark, sf), FALLBACK_URL)
    return status.published_freshness(coverage.sources_of(resolved))


def run_rollup(spark: SparkSession, sf: str) -> DataFrame:
    resolved = coverage.resolve_archives(*adapters.fetch_outcomes(spark, sf), FALLBACK_URL)
    order = [F.col("dataset"), F.col("target_date"), F.col("symbol")]
    return status.run_rollup(resolved, order)


def status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    resolved = coverage.resolve_archives(*adapters.fetch_outcomes(spark, sf), FALLBACK_URL)
    rolled = status.status_rollup(coverage.failures_of(resolved), coverage.sources_of(resolved))
    return rolled.withColumn("valid", status.is_valid(F.col("status"), F.lit("run")))


# --- stored forms ---


def compact_overlap_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = compaction.compacted_rows(adapters.overlapping_raw(spark, sf), "1m", "latest_period")
    return _seconds(_rounded(rows, "volume")).select(
        "symbol", "year", "open_time", *candles.OHLCV, "trade_count"
    )


def compact_overlap_summed(spark: SparkSession, sf: str) -> DataFrame:
    rows = compaction.compacted_rows(adapters.overlapping_raw(spark, sf), "1h", None)
    return _seconds(_rounded(rows, "volume")).select(
        "symbol", "year", "open_time", *candles.OHLCV, "trade_count"
    )


def touched_years(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.line_candles(spark, sf).withColumn("interval", F.lit("1d"))
    return compaction.touched_years(rows)


def strict_normalise(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.text_candles(spark, sf).withColumn("trade_count", F.col("number_of_trades"))
    return _seconds(tables.normalise_strict(rows))


def gap_ledger_records(spark: SparkSession, sf: str) -> DataFrame:
    return ledgers.gap_records(adapters.gap_lines(spark, sf))


def source_ledger_records(spark: SparkSession, sf: str) -> DataFrame:
    return ledgers.strict_records(adapters.source_lines(spark, sf), SOURCE)


def universe_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = universe.universe_from_json(adapters.universe_documents(spark, sf))
    return rows.select(
        "symbol",
        "quote_asset",
        "storage_key",
        F.element_at("datasets", "klines").alias("has_klines"),
        F.element_at("datasets", "premium_index_klines").alias("has_premium"),
    )


def raw_archive_listing(spark: SparkSession, sf: str) -> DataFrame:
    return listing.stored_files(adapters.stored_paths(spark, sf)).drop("name")


def local_symbol_list(spark: SparkSession, sf: str) -> DataFrame:
    found = listing.stored_files(adapters.stored_paths(spark, sf))
    return found.select("symbol").distinct().orderBy("symbol")


def manifest_freshness(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.table(spark, sf, "events")
    symbol = F.concat(F.upper("event_type"), "user_id", F.lit("USDT"))
    source = F.concat(symbol, F.lit("_klines_1m_"), F.date_format("ts", "yyyy-MM"), F.lit(".parquet"))
    manifests = events.select(
        symbol.alias("symbol"),
        F.lit("1m").alias("interval"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("raw/"), source)).alias("last_source"),
        F.when(F.col("event_type") != "view", F.col("user_id")).alias("source_files"),
    )
    observed = status.manifest_observations(manifests)
    return observed.groupBy("dataset", "interval", "symbol").agg(
        F.max("latest_complete_utc_day").alias("latest_complete_utc_day"),
        F.sum("source_count").alias("source_count"),
    )


def dataset_names(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.table(spark, sf, "events")
    alias = (
        F.when(F.col("event_type") == "click", "premium_index_klines")
        .when(F.col("event_type") == "view", "premiumIndexKlines")
        .when(F.col("event_type") == "error", "funding_rate")
        .when(F.col("event_type") == "signup", "fundingRate")
        .otherwise("klines")
    )
    return events.select("event_id", keys.dataset_name(alias).alias("dataset"))


def checksum_tokens(spark: SparkSession, sf: str) -> DataFrame:
    customers = adapters.table(spark, sf, "customer")
    digest = F.sha2("c_name", 256)
    text = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(digest, F.lit("  "), "c_name"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("\n "), digest, F.lit("\tx\n")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat("c_name", F.lit(" "), digest))
        .otherwise(F.left(digest, F.lit(63)))
    )
    return customers.select("c_custkey", archives.checksum_token(text).alias("token"))


def funding_archive_ingest(spark: SparkSession, sf: str) -> DataFrame:
    rows = archives.funding_rows(archives.good_rows(*_extracted(spark, sf, funding=True)))
    return _seconds(rows, "funding_time").drop("source_row")


def ledger_append(spark: SparkSession, sf: str) -> DataFrame:
    resolved = coverage.resolve_archives(*adapters.fetch_outcomes(spark, sf), FALLBACK_URL)
    existing = ledgers.strict_records(adapters.source_lines(spark, sf), SOURCE)
    appended = existing.unionByName(coverage.sources_of(resolved))
    return appended.groupBy("dataset", "interval", "target_date").agg(
        F.count("*").alias("sources"), F.sum("row_count").alias("row_count")
    )


# --- stored tables: written to a fresh folder and read back ---


@functools.cache
def _stored_root(spark: SparkSession, sf: str, use: str) -> str:
    """A root with the overlapping archives of all events, compacted. Removed when the process ends."""
    root = _fresh_folder(spark, f"stored-{use}")
    compaction.store_raw_candles(adapters.overlapping_raw(spark, sf), tables.Layout(root))
    compaction.compact_klines(spark, root)
    return root


def stored_candles(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(api.load_klines(spark, _stored_root(spark, sf, "read")), "volume")


def stored_resampled(spark: SparkSession, sf: str) -> DataFrame:
    rows = api.load_resampled_klines(spark, _stored_root(spark, sf, "read"), None, 3600)
    return _rounded(rows, "volume")


def stored_funding(spark: SparkSession, sf: str) -> DataFrame:
    """Funding events of orders as they are read back: ``place`` is the position of the sorted result itself.

    Orders of one symbol and day share their second and stay in the order of their source.
    """
    root = _fresh_folder(spark, "funding")
    time = F.col("funding_time").cast("timestamp")
    events = adapters.order_funding(spark, sf).select(
        "symbol",
        F.concat(F.date_format(time, "yyyy"), F.lit("-12")).alias("period"),  # a file a year
        F.col("o_orderkey").alias("source_row"),
        time.alias("funding_time"),
        "funding_rate",
        F.col("o_totalprice").alias("mark_price"),
    )
    compaction.store_raw_funding(events.repartition("symbol", "period"), tables.Layout(root))
    read = api.load_funding_rates(spark, root)
    # Positions within the partitions of the global sort: no order is computed again.
    placed = read.withColumn("at", F.monotonically_increasing_id())
    within = Window.partitionBy("symbol").orderBy("at")
    return placed.withColumn("place", F.row_number().over(within).cast("bigint")).drop("at")


def stored_gap_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded twice: a known range keeps its one record. The rank tells the order."""
    root = _stored_root(spark, sf, "read")
    for _ in range(2):
        api.record_kline_gaps(spark, root)
    order = Window.partitionBy("symbol").orderBy("missing_start_ts")
    found = ledgers.read_gaps(spark, tables.Layout(root))
    return found.withColumn("place", F.row_number().over(order).cast("bigint"))


def stored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return api.available_klines(spark, _stored_root(spark, sf, "read"))


def stored_universe(spark: SparkSession, sf: str) -> DataFrame:
    layout = tables.Layout(_stored_root(spark, sf, "read"))
    ledgers.publish_universe(universe.build_universe(_listed(spark, sf), QUOTES), layout)
    return ledgers.read_universe(spark, layout).select(
        "symbol",
        "quote_asset",
        "storage_key",
        F.element_at("datasets", "klines").alias("has_klines"),
        F.element_at("datasets", "premium_index_klines").alias("has_premium"),
    )


def stored_empty_days(spark: SparkSession, sf: str) -> DataFrame:
    """Raw partitions and compacted candles after every tenth day was replaced by nothing."""
    layout = tables.Layout(_stored_root(spark, sf, "replaced"))
    rows = tables.read_raw_candles(spark, layout, "klines")
    places = rows.select("dataset", "symbol", "interval", "period").distinct()
    empty = places.where((F.length("period") == 10) & F.col("period").endswith("0"))
    touched = compaction.touched_years(rows.join(empty, list(tables.RAW_PARTITIONS), "left_semi"))
    with Scratch(spark, layout.root) as scratch:
        empty, touched = scratch.keep(empty), scratch.keep(touched)
        tables.remove_raw(empty, layout, "klines")
        compaction.compact_klines(spark, layout.root, touched=touched)
    return _rounded(api.load_klines(spark, layout.root, ordered=False), "volume")


def _refreshed(spark: SparkSession, sf: str, times_: int) -> DataFrame:
    """Candles after archives of all events landed, and maybe corrected ones of even days, and were refreshed each time."""
    root = _fresh_folder(spark, "refreshed")
    symbols = adapters.event_candles(spark, sf).select("symbol").distinct()
    request = ingest.Request(symbols, *EVENT_DAYS, datasets=[KLINES], base_url="https://host")
    for turn in range(times_):
        landed = _fresh_folder(spark, "landed")
        adapters.land(adapters.daily_archives(spark, sf, again=turn > 0), landed)
        ingest.ingest_landed(spark, root, landed, request)
    return _rounded(api.load_klines(spark, root, ordered=False), "volume")


def refresh_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf, 1)


def refresh_twice(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf, 2)


def mixed_files_union(spark: SparkSession, sf: str) -> DataFrame:
    """Candles of files whose column names and types differ, united."""
    folder = _fresh_folder(spark, "mixed")
    adapters.land(adapters.mixed_files(spark, sf), folder)
    rows = tables.read_stored_klines(spark, folder, KLINES)
    return _seconds(rows.drop("dataset", "interval"))


# --- keys ---


def _names(spark: SparkSession, sf: str) -> DataFrame:
    customers = adapters.table(spark, sf, "customer")
    text = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("  "), "c_name", F.lit("왜%3D=+* ")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat("c_name", F.lit(".x")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("/"), "c_name", F.lit("~")))
        .otherwise(F.concat("c_name", F.lit("-é_ü%"), "c_nationkey"))
    )
    return customers.select("c_custkey", text.alias("name"))


def symbol_key(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf).select(
        "c_custkey", keys.symbol_key(F.col("name"), strict=False).alias("key")
    )


def storage_key(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf).select(
        "c_custkey", keys.storage_key(F.col("name"), strict=False).alias("key")
    )


def canonical_symbols(spark: SparkSession, sf: str) -> DataFrame:
    symbol = keys.canonical_symbol(F.col("name"), strict=False)
    return _names(spark, sf).select("c_custkey", symbol.alias("symbol"))


def interval_widths(spark: SparkSession, sf: str) -> DataFrame:
    lines = adapters.table(spark, sf, "lineitem")
    unit = (
        F.when(F.col("l_returnflag") == "A", "m")
        .when(F.col("l_returnflag") == "N", "h")
        .otherwise(F.when(F.col("l_linestatus") == "O", "d").otherwise("w"))
    )
    interval = F.concat("l_linenumber", unit)
    rows = lines.select(
        interval.alias("interval"), keys.interval_millis_column(interval).alias("millis")
    )
    return rows.groupBy("interval", "millis").agg(F.count("*").alias("lines"))


def archive_addresses(spark: SparkSession, sf: str) -> DataFrame:
    targets = coverage.refresh_targets(_symbols(spark, sf), DATASETS, *DAYS, granularity="monthly")
    parts = [F.col(n) for n in ("dataset", "symbol", "interval", "period")]
    return targets.where(F.col("route") == "archive").select(
        "dataset",
        "symbol",
        "period",
        keys.archive_url("https://archive.example/", keys.archive_key(*parts)).alias("url"),
        keys.raw_file_key(*parts).alias("file"),
    )


def tolerant_numbers(spark: SparkSession, sf: str) -> DataFrame:
    lines = adapters.table(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 1, F.concat(price, F.lit("d")))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(F.col("l_linenumber") == 3, F.concat(F.lit("1_"), price))
        .when(F.col("l_linenumber") == 4, F.concat(F.lit("_"), price))
        .when(F.col("l_linenumber") == 5, F.lit(""))
        .otherwise(price)
    )
    texts = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", text.alias("text"))
    return texts.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        numbers.to_double(texts, "text").alias("as_double"),
        numbers.to_long(texts, "text").alias("as_long"),
    )


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "resample_1m": _resample(60),
        "resample_15m": _resample(900),
        "resample_1d": _resample(86_400),
    }
    for function in (
        load_klines_window,
        resample_window_1h,
        resample_ties_1d,
        resample_ties_1w,
        compact_klines_1h,
        compact_klines_1d,
        latest_row_per_time,
        intrabar_flat_3h,
        intrabar_count_3h,
        intrabar_nested_3h,
        gap_ranges_1m,
        gap_ranges_window,
        gap_ranges_lines,
        gap_merge_first_wins,
        funding_window,
        funding_mixed_units,
        funding_page_merge,
        funding_page_bounds,
        premium_payload_parse,
        premium_page_outcomes,
        premium_window,
        funding_payload_parse,
        archive_zip_ingest,
        archive_zip_outcomes,
        checksum_failures,
        listing_xml,
        universe_flags,
        universe_order,
        quote_liquidity,
        refresh_targets_daily,
        refresh_targets_monthly,
        funding_calendar_split,
        missing_targets,
        target_row_counts,
        archive_fallback_outcome,
        funding_fallback_outcome,
        error_classify,
        freshness_rollup,
        file_name_parts,
        period_end_day,
        published_freshness,
        run_rollup,
        status_rollup,
        compact_overlap_latest,
        compact_overlap_summed,
        touched_years,
        strict_normalise,
        gap_ledger_records,
        source_ledger_records,
        universe_documents,
        raw_archive_listing,
        local_symbol_list,
        manifest_freshness,
        dataset_names,
        checksum_tokens,
        funding_archive_ingest,
        ledger_append,
        symbol_key,
        storage_key,
        canonical_symbols,
        mixed_files_union,
        stored_funding,
        refresh_round_trip,
        refresh_twice,
        stored_candles,
        stored_resampled,
        stored_gap_ledger,
        stored_pairs,
        stored_universe,
        stored_empty_days,
        interval_widths,
        archive_addresses,
        tolerant_numbers,
    ):
        named[function.__name__] = function

    def configured(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark, _input_bytes(spark, sf_dir)), sf_dir)

        return run

    return {name: configured(query) for name, query in named.items()} | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    from wickline.plans.oracles import ORACLES

    return dict(ORACLES) | (llm.oracle_sql() if llm else {})
