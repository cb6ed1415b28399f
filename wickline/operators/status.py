"""Freshness, run and status rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions import times


def file_observations(files: DataFrame) -> DataFrame:
    """What each stored file shows: dataset, interval, symbol, last day, number of sources.

    Takes ``name``; files of other names are ignored.
    """
    named = files.select(times.file_name_parts(F.col("name")).alias("parts"))
    return named.where(times.part("dataset").isNotNull()).select(
        times.part("dataset").alias("dataset"),
        times.part("interval").alias("interval"),
        times.part("symbol").alias("symbol"),
        times.period_end_day(times.part("period")).alias("latest_complete_utc_day"),
        F.lit(1).cast("bigint").alias("source_count"),
    )


def compacted_observations(candles: DataFrame) -> DataFrame:
    """What the compacted candles show: the day of the last candle of each symbol and interval."""
    return candles.groupBy("interval", "symbol").agg(F.max("open_time").alias("last")).select(
        F.lit("klines").alias("dataset"),
        "interval",
        "symbol",
        F.date_format("last", "yyyy-MM-dd").alias("latest_complete_utc_day"),
        F.lit(1).cast("bigint").alias("source_count"),
    )


def manifest_observations(manifests: DataFrame) -> DataFrame:
    """What compaction manifests show.

    Takes ``symbol``, ``interval``, ``last_source`` and ``source_files``: the day
    comes from the name of the last source, the count is at least one.
    """
    name = F.element_at(F.split("last_source", "/"), -1)
    day = F.when(times.part("dataset") == "klines", times.period_end_day(times.part("period")))
    count = F.when(F.col("source_files") > 0, F.col("source_files")).otherwise(F.lit(1))
    return manifests.withColumn("parts", times.file_name_parts(name)).select(
        F.lit("klines").alias("dataset"),
        "interval",
        "symbol",
        day.alias("latest_complete_utc_day"),
        count.cast("bigint").alias("source_count"),
    )


def freshness(observations: DataFrame) -> DataFrame:
    """Per dataset and interval: distinct symbols, last day, sources."""
    # Days are compared as dates: a maximum of texts would sort the rows.
    day = F.col("latest_complete_utc_day").try_cast("date").alias("day")
    dated = observations.select("dataset", "interval", "symbol", day, "source_count")
    rolled = dated.groupBy("dataset", "interval").agg(
        F.count_distinct("symbol").alias("symbol_count"),
        F.max("day").alias("day"),
        F.sum("source_count").alias("source_count"),
    )
    return rolled.select(
        "dataset",
        "interval",
        "symbol_count",
        F.date_format("day", "yyyy-MM-dd").alias("latest_complete_utc_day"),
        "source_count",
    )


def ordered_freshness(rows: DataFrame) -> DataFrame:
    """Freshness by dataset, then interval, a missing interval first."""
    return rows.orderBy("dataset", F.coalesce("interval", F.lit("")))


def published_freshness(sources: DataFrame) -> DataFrame:
    """Freshness as the source ledger proves it, per dataset and interval."""
    observed = sources.select(
        "dataset",
        "interval",
        "symbol",
        times.period_end_day(F.col("target_date")).alias("latest_complete_utc_day"),
        F.lit(1).cast("bigint").alias("source_count"),
    )
    return freshness(observed).drop("source_count")


def run_rollup(resolved: DataFrame, plan_order: Sequence[Column] = ()) -> DataFrame:
    """One row: counts of a run, its status and the message of its first failure.

    Takes ``kind`` and ``error_message``. "First" is the order of ``plan_order``.
    """
    failed = F.col("kind") == "failure"
    order = F.struct(*plan_order) if plan_order else F.col("error_message")
    counts = resolved.agg(
        F.count_if(F.col("kind") == "source").alias("success_count"),
        F.count_if(failed).alias("failure_count"),
        F.min_by(F.col("error_message"), F.when(failed, order)).alias("last_error"),
    )
    clean = F.col("failure_count") == 0
    return counts.select(
        F.when(clean, "succeeded").otherwise("failed").alias("status"),
        (F.col("success_count") + F.col("failure_count")).alias("item_count"),
        "success_count",
        "failure_count",
        F.when(~clean, F.col("last_error")).alias("last_error"),
    )


def status_rollup(failures: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: ``ok`` or ``degraded``, and how many failures and sources there are.

    The failure rows stay a table of their own: a list of all of them inside one
    row would pass through a single task.
    """
    tagged = failures.select(F.lit(1).alias("failed")).unionAll(
        sources.select(F.lit(0).alias("failed"))
    )
    counts = tagged.agg(
        F.count_if(F.col("failed") == 1).alias("failed_item_count"),
        F.count_if(F.col("failed") == 0).alias("source_count"),
    )
    word = F.when(F.col("failed_item_count") == 0, "ok").otherwise("degraded")
    return counts.select(word.alias("status"), "failed_item_count", "source_count")


def nested_freshness(rows: DataFrame) -> DataFrame:
    """One row with the freshness list.

    Bounded: a row per dataset and interval, however many symbols there are.
    """
    sorted_rows = F.array_sort(
        F.collect_list(
            F.struct(
                "dataset",
                F.coalesce("interval", F.lit("")).alias("rank"),
                "interval",
                "symbol_count",
                "latest_complete_utc_day",
            )
        )
    )
    return rows.agg(sorted_rows.alias("sorted")).select(
        F.transform(
            "sorted",
            lambda x: F.struct(
                x["dataset"].alias("dataset"),
                x["interval"].alias("interval"),
                x["symbol_count"].alias("symbol_count"),
                x["latest_complete_utc_day"].alias("latest_complete_utc_day"),
            ),
        ).alias("freshness")
    )


def is_valid(status: Column, last_run: Column) -> Column:
    """A status that was published by a run."""
    return F.coalesce(status.isin("ok", "degraded") & last_run.isNotNull(), F.lit(False))
