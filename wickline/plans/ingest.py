"""Refresh from landed archives and pages: verify, extract, store, record, compact.

A downloader (not part of this package) leaves files below one folder:

* archives under their public key, ``data/futures/um/{daily,monthly}/...zip``,
  each with ``<archive>.CHECKSUM``;
* pages under ``pages/premiumIndexKlines/<KEY>/<interval>/<day>/<n>.json`` and
  ``pages/fundingRate/<KEY>/<day>/<n>.json``;
* where a fetch failed, a text file with the message, named like the wanted file
  with ``.ERROR`` added.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.constants import (
    ARCHIVE_KEY_ROOT,
    DATASETS,
    DEFAULT_INTERVAL,
    FUNDING,
    FUNDING_ARCHIVE_EXCEPTION,
    KLINES,
    PREMIUM,
)
from wickline.functions import keys, times
from wickline.operators import coverage, funding, status
from wickline.plans import compaction
from wickline.schemas import RUN, STATUS
from wickline.session import Scratch
from wickline.sources import archives, ledgers, listing, pages, tables
from wickline.sources.tables import Layout


@dataclass(frozen=True)
class Request:
    """What a refresh wants. ``symbols`` may be names or a DataFrame with ``symbol``."""

    symbols: Sequence[str] | DataFrame
    start_day: dt.date
    end_day: dt.date
    datasets: Sequence[str] = DATASETS
    interval: str = DEFAULT_INTERVAL
    granularity: str = "daily"
    compact: bool = True
    base_url: str = ""
    premium_url: str = "premiumIndexKlines"
    funding_url: str = FUNDING


def _symbols(spark: SparkSession, symbols: Sequence[str] | DataFrame) -> DataFrame:
    if isinstance(symbols, DataFrame):
        named = symbols.select(keys.canonical_symbol(F.col("symbol")).alias("symbol"))
        return named.distinct()
    names = dict.fromkeys(keys.partition_symbol(name) for name in symbols)
    return spark.createDataFrame([(name,) for name in names], "symbol string")


def _between(period: Column, start: dt.date, end: dt.date) -> Column:
    """Whether a period, a day or a month as text, meets the days from ``start`` to ``end``."""
    first, last = (F.left(F.lit(day.isoformat()), F.length(period)) for day in (start, end))
    return (period >= first) & (period <= last)


def _archives_of(
    landed: str, dataset: str, spans: Sequence[str], names: Sequence[tuple[str, str]], interval: str
) -> str:
    """Glob of the landed folders that can hold the archives asked for: one for each symbol."""
    span = listing.one_of(list(spans))
    owner = listing.one_of([stored if dataset == FUNDING else key for key, stored in names])
    below = "" if dataset == FUNDING else f"/{interval}"
    return f"{landed.rstrip('/')}/{ARCHIVE_KEY_ROOT}/{span}/{dataset}/{owner}{below}"


def _archive_period(path: Column) -> Column:
    return F.regexp_extract(path, r"-(\d{4}-\d{2}(?:-\d{2})?)\.zip(?:\.[A-Z]+)?$", 1)


def _archive_key(path: Column) -> Column:
    return F.regexp_extract(path, rf"({ARCHIVE_KEY_ROOT}/.*?\.zip)", 1)


def _addressed(targets: DataFrame, request: Request, layout: Layout) -> DataFrame:
    """Targets with archive key, address and the partition they are stored in."""
    parts = [F.col(name) for name in ("dataset", "symbol", "interval", "period")]
    key = keys.archive_key(*parts)
    return targets.withColumn("archive_key", key).select(
        "*",
        keys.archive_url(request.base_url, key).alias("source_url"),
        _output_path(layout, *parts).alias("output_path"),
    )


def _output_path(
    layout: Layout, dataset: Column, symbol: Column, interval: Column, period: Column
) -> Column:
    candles = F.concat(
        F.lit(f"{layout.raw_candles}/dataset="), dataset, F.lit("/symbol="), symbol,
        F.lit("/interval="), interval, F.lit("/period="), period,
    )
    events = F.concat(
        F.lit(f"{layout.raw_funding}/symbol="), symbol, F.lit("/period="), period
    )
    return F.when(dataset == FUNDING, events).otherwise(candles)


def _landed_errors(
    spark: SparkSession, path: str, glob: str, named: Column | None = None
) -> DataFrame:
    """Messages of failed fetches: path of the wanted file, ``error_message``."""
    texts = pages.read_texts(spark, path, f"{glob}.ERROR", named)
    return texts.select(
        F.regexp_replace("path", r"\.ERROR$", "").alias("path"),
        F.col("text").alias("error_message"),
    )


class _Job:
    """One refresh: what it was asked for, and where its intermediate tables lie."""

    def __init__(
        self,
        spark: SparkSession,
        landed: str,
        layout: Layout,
        request: Request,
        targets: DataFrame,
        names: Sequence[tuple[str, str]],
        scratch: Scratch,
    ) -> None:
        self.spark, self.landed, self.layout, self.request = spark, landed, layout, request
        self.targets, self.names, self.scratch = targets, names, scratch

    def extracted(self, dataset: str) -> tuple[DataFrame, DataFrame]:
        """Data rows and outcomes of the targeted archives of one dataset, from a single pass.

        Only folders of the symbols asked for are listed, and only files of the
        periods asked for are opened. The result of the pass is written once:
        rows and outcomes are both read from there, so no archive is opened twice.
        """
        request, spark = self.request, self.spark
        spans = ["monthly" if dataset == FUNDING else request.granularity]
        folder = _archives_of(self.landed, dataset, spans, self.names, request.interval)
        period = _archive_period(F.col("_metadata.file_name"))
        named = _between(period, request.start_day, request.end_day)
        wanted = self.targets.where((F.col("dataset") == dataset) & (F.col("route") == "archive"))
        wanted = wanted.select("archive_key", *coverage.TARGET[:4])
        is_funding = dataset == FUNDING
        zips = archives.read_zips(spark, folder, named=named)
        extracted = self.scratch.keep(archives.extract(zips, is_funding))
        checksums = archives.read_checksums(spark, folder, named=named)
        found = self.scratch.keep(archives.archive_outcomes(extracted, checksums))
        errors = _landed_errors(spark, folder, "*.zip", named).select(
            _archive_key(F.col("path")).alias("archive_key"),
            F.lit(None).cast("string").alias("checksum"),
            F.lit(None).cast("bigint").alias("row_count"),
            F.lit(None).cast("string").alias("error_code"),
            "error_message",
        )
        keyed = found.withColumn("archive_key", _archive_key(F.col("path")))
        failed = keyed.select("archive_key", *coverage.OUTCOME).unionByName(errors)
        outcomes = wanted.join(coverage.one_outcome(failed, ["archive_key"]), "archive_key")
        # The archive of a month that is fetched day by day was opened, but not asked for.
        asked = wanted.select("archive_key", F.lit(True).alias("asked"))
        usable = keyed.join(asked, "archive_key", "left")
        usable = usable.withColumn("row_count", F.when(F.col("asked"), F.col("row_count")))
        good = archives.good_rows(extracted, usable)
        rows = archives.funding_rows(good) if is_funding else archives.kline_rows(good)
        placed = rows.withColumn("place", _place(_archive_key(F.col("path"))))
        placed = placed.select("*", "place.*").drop("place", "path")
        return placed, outcomes.drop("archive_key")

    def pages(self, dataset: str, names: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
        """Landed pages and fetch errors of the named symbols and the requested days."""
        owner = listing.one_of([stored if dataset == FUNDING else key for key, stored in names])
        below = "" if dataset == FUNDING else f"/{self.request.interval}"
        folder = f"{self.landed.rstrip('/')}/pages/{dataset}/{owner}{below}"
        day = listing.segment(F.col("_metadata.file_path"), 2)
        named = day.between(*(d.isoformat() for d in _whole_days(self.request)))

        def placed(df: DataFrame) -> DataFrame:
            interval = listing.segment(F.col("path"), 3)
            symbol = listing.segment(F.col("path"), 3 if dataset == FUNDING else 4)
            number = F.regexp_extract(listing.segment(F.col("path"), 1), r"^(\d+)", 1)
            return df.select(
                "*",
                keys.canonical_symbol(symbol, strict=False).alias("symbol"),
                (F.lit(None).cast("string") if dataset == FUNDING else interval).alias("interval"),
                listing.segment(F.col("path"), 2).alias("day"),
                number.try_cast("bigint").alias("page_no"),
            ).drop("path")

        return (
            placed(pages.read_texts(self.spark, folder, "*.json", named)),
            placed(_landed_errors(self.spark, folder, "*.json", named)),
        )


def _place(key: Column) -> Column:
    """STRUCT(dataset, symbol, interval, period) of an archive key."""
    tail = F.split(F.regexp_replace(key, rf"^{ARCHIVE_KEY_ROOT}/[^/]*/", ""), "/")
    dataset, symbol = F.get(tail, F.lit(0)), F.get(tail, F.lit(1))
    interval = F.when(dataset != FUNDING, F.get(tail, F.lit(2)))
    return F.struct(
        dataset.alias("dataset"),
        keys.canonical_symbol(symbol, strict=False).alias("symbol"),
        interval.alias("interval"),
        F.regexp_extract(key, r"-(\d{4}-\d{2}(?:-\d{2})?)\.zip$", 1).alias("period"),
    )


_DAY = ["symbol", "interval", "day"]


def _day_outcomes(parsed: DataFrame, errors: DataFrame, counts: DataFrame | None) -> DataFrame:
    """One outcome per day of pages: a single bad page or failed fetch is the day's outcome.

    ``counts`` (symbol, day, n) replaces the number of parsed items where merged
    pages hold fewer rows.
    """
    seen = pages.page_outcomes(parsed, _DAY).unionByName(
        errors.select(*_DAY, F.lit(None).cast("bigint").alias("row_count"),
                      F.col("error_message").alias("error"))
    )
    days = seen.groupBy(*_DAY).agg(
        F.array_min(F.collect_set("error")).alias("error_message"),
        F.sum("row_count").alias("row_count"),
    )
    good = F.col("error_message").isNull()
    if counts is not None:
        days = days.join(counts, ["symbol", "day"], "left")
        days = days.withColumn("row_count", F.coalesce("n", F.lit(0).cast("bigint"))).drop("n")
    text = F.lit(None).cast("string")
    return days.select(
        *_DAY,
        text.alias("checksum"),
        F.when(good, F.col("row_count")).alias("row_count"),
        text.alias("error_code"),
        "error_message",
    )


def _stored_days(rows: DataFrame, resolved: DataFrame, dataset: str, url: str) -> DataFrame:
    """Page rows of the days that became sources."""
    chosen = resolved.where(
        (F.col("kind") == "source") & (F.col("dataset") == dataset) & (F.col("source_url") == url)
        & F.col("checksum").isNull()
    )
    days = chosen.select("symbol", F.col("target_date").alias("day"))
    return rows.join(days, ["symbol", "day"], "left_semi")


def _emptied(resolved: DataFrame, dataset: str) -> DataFrame:
    """Partitions of completed targets without a row."""
    done = (F.col("kind") == "source") & (F.col("dataset") == dataset) & (F.col("row_count") == 0)
    return resolved.where(done).select(
        "dataset", "symbol", "interval", F.col("target_date").alias("period")
    )


def _outcome_places(outcomes: DataFrame, empty: bool) -> DataFrame:
    """Partitions that archives with a good outcome replace; of the empty ones, or of all."""
    good = F.col("row_count") == 0 if empty else F.col("row_count").isNotNull()
    return outcomes.where(good).select("dataset", "symbol", "interval", "period")


def _refresh_candles(job: _Job) -> tuple[DataFrame, DataFrame | None]:
    """Store raw candles; returns resolved targets and the touched years of klines."""
    spark, layout, request, scratch = job.spark, job.layout, job.request, job.scratch
    outcomes, touched = None, None
    for dataset in [name for name in request.datasets if name != FUNDING]:
        rows, found = job.extracted(dataset)
        found = scratch.keep(found)
        if dataset == KLINES:
            # Years that the replaced partitions fed, before they are replaced.
            start, end = _whole_days(request)
            old = tables.read_raw_candles(spark, layout, KLINES, interval=request.interval)
            old = old.where(_between(F.col("period"), start, end)).join(
                _outcome_places(found, empty=False), list(tables.RAW_PARTITIONS), "left_semi"
            )
            touched = compaction.touched_years(old).unionByName(compaction.touched_years(rows))
            touched = scratch.keep(touched.distinct())
        compaction.store_raw_candles(rows, layout)
        tables.remove_raw(_outcome_places(found, empty=True), layout, dataset)
        outcomes = found if outcomes is None else outcomes.unionByName(found)
    wanted = job.targets.where(F.col("dataset") != FUNDING)
    failed = _failed_premium(wanted, outcomes) if PREMIUM in request.datasets else None
    # Keys of the symbols whose archives failed: bounded by what is traded.
    names = [] if failed is None else _names(failed.select("symbol").distinct())
    if not names:
        none = spark.createDataFrame([], _FALLBACK)
        resolved = coverage.resolve_archives(wanted, outcomes, none, request.premium_url)
        return scratch.keep(resolved), touched
    texts, errors = job.pages(PREMIUM, names)
    parsed = scratch.keep(pages.parse_premium_pages(texts))
    place = [F.lit(PREMIUM), F.col("symbol"), F.col("interval"), F.col("day")]
    fallbacks = _day_outcomes(parsed, errors, None)
    fallbacks = fallbacks.withColumn("output_path", _output_path(layout, *place))
    resolved = scratch.keep(
        coverage.resolve_archives(wanted, outcomes, fallbacks, request.premium_url)
    )
    rows = pages.premium_rows(parsed, [*_DAY, "page_no"])
    stored = _stored_days(rows, resolved, PREMIUM, request.premium_url)
    by_page = resolved.where(F.col("source_url") == request.premium_url)
    compaction.store_raw_candles(
        stored.select(
            "*",
            F.lit(PREMIUM).alias("dataset"),
            F.col("day").alias("period"),
            _page_row(F.col("page_no"), F.col("position")).alias("source_row"),
        ),
        layout,
    )
    tables.remove_raw(_emptied(by_page, PREMIUM), layout, PREMIUM)
    return resolved, touched


#: Columns of the outcomes of page days.
_FALLBACK = (
    "symbol string, interval string, day string, checksum string, row_count bigint, "
    "error_code string, error_message string, output_path string"
)


def _failed_premium(targets: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Premium targets whose archive gave no rows."""
    premium = targets.where(F.col("dataset") == PREMIUM)
    good = outcomes.where(F.col("row_count").isNotNull())
    same = [premium[n].eqNullSafe(good[n]) for n in ("dataset", "symbol", "interval", "period")]
    return premium.join(good, same, "left_anti")


def _names(symbols: DataFrame) -> list[tuple[str, str]]:
    """The two storage forms of each symbol."""
    forms = symbols.select(
        keys.symbol_key(F.col("symbol"), strict=False).alias("key"),
        keys.storage_key(F.col("symbol"), strict=False).alias("stored"),
    )
    return [(row["key"], row["stored"]) for row in forms.where("key is not null").collect()]


def _page_row(page_no: Column, position: Column) -> Column:
    """Place of an item within a day: page, then position."""
    return F.shiftleft(F.coalesce(page_no, F.lit(0).cast("bigint")), 20) + position


def _whole_days(request: Request) -> tuple[dt.date, dt.date]:
    """The days that pages can be of; monthly archives are replaced day by day, so whole months."""
    start, end = request.start_day, request.end_day
    if request.granularity == "monthly":
        start = start.replace(day=1)
        end = (end.replace(day=1) + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
    return start, end


def _refresh_funding(job: _Job) -> DataFrame:
    """Store funding events; returns resolved targets."""
    layout, request, scratch = job.layout, job.request, job.scratch
    rows, outcomes = job.extracted(FUNDING)
    outcomes = scratch.keep(outcomes)
    compaction.store_raw_funding(rows, layout)
    tables.remove_raw(_outcome_places(outcomes, empty=True), layout, FUNDING)
    texts, errors = job.pages(FUNDING, job.names)
    parsed = scratch.keep(pages.parse_funding_pages(texts))
    items = pages.funding_rows(parsed, [*_DAY, "page_no"])
    date = F.col("day").cast("date")
    inside = F.col("funding_millis").between(
        times.day_start_millis(date), times.day_end_millis(date)
    )
    events = funding.merge_pages(items.where(inside), keys=("symbol", "day"))
    counts = events.groupBy("symbol", "day").agg(F.count("*").alias("n"))
    days = _day_outcomes(parsed, errors, counts)
    place = [F.lit(FUNDING), F.col("symbol"), F.col("interval"), F.col("day")]
    days = days.withColumn("output_path", _output_path(layout, *place)).drop("interval")
    wanted = job.targets.where(F.col("dataset") == FUNDING)
    archived = outcomes.withColumn(
        "error_code",
        F.coalesce(
            "error_code",
            F.when(F.col("error_message").isNotNull(), FUNDING_ARCHIVE_EXCEPTION),
        ),
    )
    resolved = scratch.keep(
        coverage.resolve_funding(wanted, archived, days, request.funding_url)
    )
    stored = _stored_days(events, resolved, FUNDING, request.funding_url)
    by_page = resolved.where(F.col("source_url") == request.funding_url)
    compaction.store_raw_funding(
        stored.select(
            "*",
            F.col("day").alias("period"),
            F.unix_millis("funding_time").alias("source_row"),
        ),
        layout,
    )
    tables.remove_raw(_emptied(by_page, FUNDING), layout, FUNDING)
    return resolved


def ingest_landed(spark: SparkSession, root: str, landed: str, request: Request) -> DataFrame:
    """Refresh the tables below ``root`` from what was landed; returns the run, one row.

    Raw partitions of the archives and pages found are replaced, the ledgers and
    the status document are published, and the touched years are compacted again
    from all their raw rows. All of it is one change: readers see it when it is
    complete, and a refresh that fails leaves everything as it was.
    """
    keys.interval_millis(request.interval)
    started = dt.datetime.now(dt.UTC)
    symbols = _symbols(spark, request.symbols)
    datasets = [keys.require_dataset(name) for name in request.datasets]
    request = Request(**{**request.__dict__, "datasets": datasets})
    with Scratch(spark, root) as scratch, Layout(root).changing(spark) as layout:
        symbols = scratch.keep(symbols)
        targets = coverage.refresh_targets(
            symbols,
            datasets,
            request.start_day,
            request.end_day,
            request.interval,
            request.granularity,
        )
        targets = scratch.keep(_addressed(targets, request, layout))
        # One pair of names per symbol, from which the folders to list are named.
        job = _Job(spark, landed, layout, request, targets, _names(symbols), scratch)
        parts, touched = [], None
        if any(name != FUNDING for name in datasets):
            resolved, touched = _refresh_candles(job)
            parts.append(resolved)
        if FUNDING in datasets:
            parts.append(_refresh_funding(job))
        resolved = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if request.compact and touched is not None:
            compaction.compact_klines(spark, root, None, request.interval, touched=touched, layout=layout)
        return _publish(spark, layout, request, symbols, resolved, started)


def _plan_order(request: Request) -> list[Column]:
    """Order in which the targets were asked for."""

    def rank(values: Sequence[str], column: str) -> Column:
        return F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))

    given = [] if isinstance(request.symbols, DataFrame) else list(request.symbols)
    by_symbol = [rank([keys.partition_symbol(s) for s in given], "symbol")] if given else []
    return [*by_symbol, F.col("symbol"), rank(request.datasets, "dataset"), F.col("target_date")]


def _publish(
    spark: SparkSession,
    layout: Layout,
    request: Request,
    symbols: DataFrame,
    resolved: DataFrame,
    started: dt.datetime,
) -> DataFrame:
    sources, failures = coverage.sources_of(resolved), coverage.failures_of(resolved)
    # One row of counts, and one freshness row per dataset: bounded at any scale.
    rolled = status.run_rollup(resolved, _plan_order(request)).first().asDict()
    run = {
        "id": str(uuid.uuid4()),
        "mode": "manual",
        "started_at": started.isoformat(),
        "finished_at": dt.datetime.now(dt.UTC).isoformat(),
        "symbol_count": symbols.count(),
        **rolled,
    }
    counts = status.status_rollup(failures, sources).first().asDict()
    published = status.nested_freshness(status.published_freshness(sources)).first()
    document = {**counts, "last_run": run, "freshness": published["freshness"]}
    ledgers.publish(layout, spark.createDataFrame([document], STATUS), failures, sources)
    return spark.createDataFrame([run], RUN)
