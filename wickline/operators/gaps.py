"""Missing-candle ranges and their first-wins ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.constants import DAY_SECONDS, GAP_REASON, KLINES
from wickline.functions import times
from wickline.operators.candles import time_window
from wickline.schemas import GAP, GAP_KEY


def find_gaps(
    df: DataFrame,
    expected_seconds: int,
    start_ts: int | None = None,
    end_ts: int | None = None,
    keys: Sequence[str] = ("symbol",),
    times_unique: bool = False,
) -> DataFrame:
    """Ranges where consecutive candles lie more than ``expected_seconds`` apart.

    Every row with a time counts, also one whose prices are missing; the edges
    of the window are no gaps.

    The neighbour of a row is found in two levels of one pass. Within a day (at
    most 86,400 distinct seconds per key) a window runs over the rows; what goes
    on are the rows behind a gap and the first and last of each day, and a second
    window finds the neighbours of the latter. No task holds the whole history
    of a symbol. ``times_unique`` skips the removal of repeated times when the
    table cannot hold any.
    """
    if expected_seconds <= 0:
        raise ValueError(f"expected_seconds must be positive: {expected_seconds}")
    stamped = time_window(df, start_ts, end_ts).select(
        *keys, times.epoch_seconds(df, "open_time").alias("second")
    )
    dated = stamped.where(F.col("second").isNotNull()).withColumn(
        "day", times.bucket_start(F.col("second"), DAY_SECONDS)
    )
    seconds = dated.repartition(*keys, "day")
    if not times_unique:
        seconds = seconds.dropDuplicates([*keys, "day", "second"])

    step = F.lit(expected_seconds).cast("bigint")
    within = Window.partitionBy(*keys, "day").orderBy("second")
    marked = seconds.select(
        *keys,
        "day",
        "second",
        F.lag("second").over(within).alias("before"),
        F.lead("second").over(within).isNull().alias("last"),
    )
    edge = F.col("before").isNull() | F.col("last")
    kept = marked.where(edge | (F.col("second") - F.col("before") > step))
    # The edges of a key's days meet; rows behind a gap stay with their day.
    between = Window.partitionBy(*keys, F.when(~edge, F.col("day"))).orderBy("second")
    before = F.coalesce("before", F.lag("second").over(between))
    pairs = kept.select(*keys, before.alias("before"), F.col("second").alias("after"))
    distance = F.col("after") - F.col("before")
    return pairs.where(distance > step).select(
        *keys,
        (F.col("before") + step).alias("missing_start_ts"),
        (F.col("after") - step).alias("missing_end_ts"),
        F.rint(distance / step - F.lit(1)).cast("bigint").alias("missing_count"),
        F.col("before").alias("observed_before_ts"),
        F.col("after").alias("observed_after_ts"),
    )


def as_ledger(gaps: DataFrame, interval: str | None = None, dataset: str = KLINES) -> DataFrame:
    """Gap ranges as ledger rows."""
    interval_column = F.col("interval") if interval is None else F.lit(interval)
    return gaps.select(
        F.lit(dataset).alias("dataset"),
        "symbol",
        interval_column.alias("interval"),
        *[f for f in GAP.names if f.endswith(("_ts", "_count"))],
        F.lit(GAP_REASON).alias("reason"),
    ).select(*GAP.names)


def new_gaps(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Ledger rows of ``found`` whose key ``existing`` lacks, one per key."""
    # A key fixes the range and so its counts and ends; only the reason may differ.
    numbers = [name for name in GAP.names if name not in GAP_KEY and name != "reason"]
    unique = found.groupBy(*GAP_KEY).agg(
        *[F.min(name).alias(name) for name in numbers],
        F.array_min(F.collect_set("reason")).alias("reason"),
    )
    return unique.join(existing.select(*GAP_KEY), list(GAP_KEY), "left_anti").select(*GAP.names)


def merge_gaps(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Ledger where an existing row wins over a found one of the same key."""
    return existing.select(*GAP.names).unionByName(new_gaps(existing, found))
