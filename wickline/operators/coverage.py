"""Refresh targets, their coverage, and what became of each of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.constants import (
    ARCHIVE_EXCEPTION,
    ARCHIVE_NOT_FOUND,
    DEFAULT_INTERVAL,
    FUNDING,
    FUNDING_REST_EXCEPTION,
    PREMIUM,
    PREMIUM_FALLBACK_EXCEPTION,
)
from wickline.functions import errors, times
from wickline.schemas import FAILURE, SOURCE

#: Columns of a target.
TARGET = ("dataset", "symbol", "interval", "period", "target_date", "route")
#: What a fetch left behind: a row count, or an error.
OUTCOME = ("checksum", "row_count", "error_code", "error_message")
#: A resolved target: a ledger row of either kind, with the place in the plan.
RESOLVED = (
    "kind",
    *SOURCE.names,
    *[name for name in FAILURE.names if name not in SOURCE.names],
)


def _granular(granularity: str) -> bool:
    if granularity not in ("daily", "monthly"):
        raise ValueError(f"unsupported archive granularity: {granularity}")
    return granularity == "monthly"


def _day_list(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``; none when the order is reversed."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def _month_list(start: Column, end: Column) -> Column:
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def _iso(day: Column, monthly: bool) -> Column:
    return F.date_format(day, "yyyy-MM" if monthly else "yyyy-MM-dd")


def archive_targets(
    symbols: DataFrame,
    datasets: Sequence[str],
    start_day: dt.date,
    end_day: dt.date,
    interval: str = DEFAULT_INTERVAL,
    granularity: str = "daily",
) -> DataFrame:
    """Candle and premium-index targets: each symbol, dataset, and day or month.

    The dates and datasets are a constant per symbol row, so this is two
    explodes and neither a join nor a shuffle.
    """
    monthly = _granular(granularity)
    start, end = F.lit(start_day), F.lit(end_day)
    dates = _month_list(start, end) if monthly else _day_list(start, end)
    wanted = [name for name in datasets if name != FUNDING]
    names = F.array(*[F.lit(name) for name in wanted]).cast("array<string>")
    rows = symbols.select("symbol", F.explode(names).alias("dataset")).select(
        "*", F.explode(dates).alias("day")
    )
    return rows.select(
        "dataset",
        "symbol",
        F.lit(interval).alias("interval"),
        _iso(F.col("day"), monthly).alias("period"),
        _iso(F.col("day"), False).alias("target_date"),
        F.lit("archive").alias("route"),
    )


def funding_targets(
    symbols: DataFrame, start_day: dt.date, end_day: dt.date, granularity: str = "daily"
) -> DataFrame:
    """Funding targets: months wholly inside the range by archive, other days by page.

    Daily granularity takes every day by page. Whether a day belongs to a whole
    month follows from the calendar, so nothing is joined.
    """
    monthly = _granular(granularity)
    start, end = F.lit(start_day), F.lit(end_day)

    def whole(day: Column) -> Column:
        inside = (F.trunc(day, "month") >= start) & (F.last_day(day) <= end)
        return inside if monthly else F.lit(False)

    months = F.transform(
        F.filter(_month_list(start, end), whole),
        lambda day: F.struct(_iso(day, True).alias("period"), F.lit("archive").alias("route")),
    )
    days = F.transform(
        F.filter(_day_list(start, end), lambda day: ~whole(day)),
        lambda day: F.struct(_iso(day, False).alias("period"), F.lit("rest").alias("route")),
    )
    return symbols.select("symbol", F.inline(F.concat(months, days))).select(
        F.lit(FUNDING).alias("dataset"),
        "symbol",
        F.lit(None).cast("string").alias("interval"),
        "period",
        F.col("period").alias("target_date"),
        "route",
    )


def refresh_targets(
    symbols: DataFrame,
    datasets: Sequence[str],
    start_day: dt.date,
    end_day: dt.date,
    interval: str = DEFAULT_INTERVAL,
    granularity: str = "daily",
) -> DataFrame:
    """All targets of a refresh."""
    targets = archive_targets(symbols, datasets, start_day, end_day, interval, granularity)
    if FUNDING not in datasets:
        return targets
    return targets.unionByName(funding_targets(symbols, start_day, end_day, granularity))


def _ledger_key(df: DataFrame) -> DataFrame:
    return df.withColumn("interval_key", F.coalesce("interval", F.lit("")))


_KEY = ["dataset", "symbol", "interval_key", "target_date"]


def missing_targets(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Targets without a source row."""
    done = _ledger_key(sources).select(*_KEY)
    return _ledger_key(targets).join(done, _KEY, "left_anti").select(*targets.columns)


def with_row_counts(targets: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Targets with the number of rows stored for each, 0 for a completed empty one."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return targets.join(counts, list(keys), "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0).cast("bigint"))
    )


def one_outcome(outcomes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One outcome per key: a successful one when there is any, else the smallest error."""
    packed = F.struct(
        F.col("row_count").isNull().alias("failed"),
        F.col("row_count"),
        F.col("checksum"),
        F.col("error_code"),
        F.col("error_message"),
    )
    # A set of distinct outcomes is collected by hash; the minimum of a struct would sort.
    best = outcomes.groupBy(*keys).agg(F.array_min(F.collect_set(packed)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{name}").alias(name) for name in OUTCOME])


def _state(prefix: str, missing: Column) -> Column:
    """``ok``, ``missing``, ``failed``; NULL when nothing was landed."""
    return (
        F.when(F.col(f"{prefix}row_count").isNotNull(), "ok")
        .when(missing, "missing")
        .when(
            F.col(f"{prefix}error_message").isNotNull() | F.col(f"{prefix}error_code").isNotNull(),
            "failed",
        )
    )


def _prefixed(outcomes: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return outcomes.select(*keys, *[F.col(name).alias(prefix + name) for name in OUTCOME])


def _source(**columns: Column) -> Column:
    fields = {"kind": F.lit("source"), **columns}
    return _row(fields)


def _failure(**columns: Column) -> Column:
    fields = {
        "kind": F.lit("failure"),
        "attempt_count": F.lit(1).cast("bigint"),
        "retryable": F.lit(True),
        **columns,
    }
    return _row(fields)


def _row(fields: dict[str, Column]) -> Column:
    kinds = {"attempt_count": "bigint", "row_count": "bigint", "retryable": "boolean"}
    return F.struct(
        *[
            fields.get(name, F.lit(None)).cast(kinds.get(name, "string")).alias(name)
            for name in RESOLVED
        ]
    )


def resolve_archives(
    targets: DataFrame, archives: DataFrame, fallbacks: DataFrame, fallback_url: str
) -> DataFrame:
    """What became of the candle and premium-index targets.

    ``targets`` carries ``source_url`` and ``output_path``. ``archives`` holds one
    outcome per (dataset, symbol, interval, period), ``fallbacks`` one per
    (symbol, interval, day) of premium-index pages, with ``output_path``.

    An archive that worked is a source. A missing one is nothing. A failed
    premium-index archive is replaced, day by day, by its landed pages: a source
    when they parse, nothing when they are missing, a failure of their own code
    when they fail. Without pages, and for candles, the archive's failure stands.
    """
    keys = ["dataset", "symbol", "interval", "period"]
    joined = targets.join(_prefixed(archives, keys, "a_"), keys, "left")
    missing = (F.col("a_error_code") == ARCHIVE_NOT_FOUND) | errors.is_missing_archive(
        F.col("a_error_message")
    )
    stated = joined.withColumn("a_state", _state("a_", F.coalesce(missing, F.lit(False))))
    replaceable = (F.col("a_state") == "failed") & (F.col("dataset") == PREMIUM)
    first, last = times.period_start_day(F.col("period")), times.period_end_day(F.col("period"))
    days = F.when(replaceable, _day_list(first, last.cast("date"))).otherwise(
        F.array(F.lit(None).cast("date"))
    )
    daily = stated.withColumn("date", F.explode(days)).withColumn("day", _iso(F.col("date"), False))
    pages = fallbacks.select(
        "symbol",
        "interval",
        "day",
        F.col("output_path").alias("f_output_path"),
        *[F.col(name).alias(f"f_{name}") for name in OUTCOME],
    )
    resolved = daily.join(pages, ["symbol", "interval", "day"], "left").withColumn(
        "f_state", _state("f_", errors.is_missing_archive(F.col("f_error_message")))
    )
    common = {name: F.col(name) for name in ("dataset", "symbol", "interval")}
    archive_source = _source(
        **common,
        target_date=F.col("target_date"),
        source_url=F.col("source_url"),
        output_path=F.col("output_path"),
        checksum=F.col("a_checksum"),
        row_count=F.col("a_row_count"),
    )
    page_source = _source(
        **common,
        target_date=F.col("day"),
        source_url=F.lit(fallback_url),
        output_path=F.col("f_output_path"),
        row_count=F.col("f_row_count"),
    )
    page_failure = _failure(
        **common,
        target_date=F.col("day"),
        source_url=F.lit(fallback_url),
        error_code=F.lit(PREMIUM_FALLBACK_EXCEPTION),
        error_message=F.col("f_error_message"),
    )
    # An archive that raised has no code and no address of its own.
    raised = F.col("a_error_code").isNull()
    archive_failure = _failure(
        **common,
        target_date=F.col("target_date"),
        source_url=F.when(raised, F.lit("")).otherwise(F.col("source_url")),
        error_code=F.coalesce("a_error_code", F.lit(ARCHIVE_EXCEPTION)),
        error_message=F.col("a_error_message"),
    )
    outcome = (
        F.when(F.col("a_state") == "ok", archive_source)
        .when(F.col("f_state") == "ok", page_source)
        .when(F.col("f_state") == "failed", page_failure)
        .when((F.col("a_state") == "failed") & F.col("f_state").isNull(), archive_failure)
    )
    rows = resolved.select(outcome.alias("row")).where(F.col("row").isNotNull()).select("row.*")
    # Several days without pages repeat the one failure of their monthly archive.
    return rows.distinct()


def resolve_funding(
    targets: DataFrame, archives: DataFrame, pages: DataFrame, rest_url: str
) -> DataFrame:
    """What became of the funding targets.

    ``archives`` holds one outcome per (symbol, period), ``pages`` one per
    (symbol, day) with ``output_path``. A failed monthly archive is replaced by
    the pages of all its days and leaves no failure itself; a missing archive
    leaves nothing. Of the days, a missing one leaves nothing.
    """
    joined = targets.join(_prefixed(archives, ["symbol", "period"], "a_"), ["symbol", "period"], "left")
    missing = (F.col("a_error_code") == ARCHIVE_NOT_FOUND) | errors.is_missing_archive(
        F.col("a_error_message")
    )
    stated = joined.withColumn(
        "a_state",
        F.when(
            F.col("route") == "archive", _state("a_", F.coalesce(missing, F.lit(False)))
        ),
    )
    first, last = times.period_start_day(F.col("period")), times.period_end_day(F.col("period"))
    by_page = (F.col("route") == "rest") | (F.col("a_state") == "failed")
    days = F.when(by_page, _day_list(first, last.cast("date"))).otherwise(
        F.array(F.lit(None).cast("date"))
    )
    daily = stated.withColumn("date", F.explode(days)).withColumn("day", _iso(F.col("date"), False))
    landed = pages.select(
        "symbol",
        "day",
        F.col("output_path").alias("f_output_path"),
        *[F.col(name).alias(f"f_{name}") for name in OUTCOME],
    )
    resolved = daily.join(landed, ["symbol", "day"], "left").withColumn(
        "f_state", _state("f_", errors.is_missing_rest(F.col("f_error_message")))
    )
    common = {name: F.col(name) for name in ("dataset", "symbol", "interval")}
    archive_source = _source(
        **common,
        target_date=F.col("target_date"),
        source_url=F.col("source_url"),
        output_path=F.col("output_path"),
        checksum=F.col("a_checksum"),
        row_count=F.col("a_row_count"),
    )
    page_source = _source(
        **common,
        target_date=F.col("day"),
        source_url=F.lit(rest_url),
        output_path=F.col("f_output_path"),
        row_count=F.col("f_row_count"),
    )
    page_failure = _failure(
        **common,
        target_date=F.col("day"),
        source_url=F.lit(rest_url),
        error_code=F.lit(FUNDING_REST_EXCEPTION),
        error_message=F.col("f_error_message"),
    )
    outcome = (
        F.when(F.col("a_state") == "ok", archive_source)
        .when(F.col("f_state") == "ok", page_source)
        .when(F.col("f_state") == "failed", page_failure)
    )
    rows = resolved.select(outcome.alias("row")).where(F.col("row").isNotNull())
    return rows.select("row.*")


def sources_of(resolved: DataFrame) -> DataFrame:
    """Source-ledger rows of resolved targets."""
    return resolved.where(F.col("kind") == "source").select(*SOURCE.names)


def failures_of(resolved: DataFrame) -> DataFrame:
    """Failure-ledger rows of resolved targets."""
    return resolved.where(F.col("kind") == "failure").select(*FAILURE.names)
