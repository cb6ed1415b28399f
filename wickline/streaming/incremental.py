"""Incremental runs over newly landed raw candles with Structured Streaming.

The batch functions stay the reference for results; these pick up only what is
new since the last run, as a refresh does, and then stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from wickline.constants import DEFAULT_INTERVAL, KLINES
from wickline.functions import times
from wickline.operators import candles
from wickline.plans import compaction
from wickline.schemas import RAW_KLINE
from wickline.session import Scratch
from wickline.sources import tables, versions
from wickline.sources.tables import Layout


def raw_candle_stream(
    spark: SparkSession, root: str, dataset: str = KLINES, files_per_batch: int | None = None
) -> DataFrame:
    """New raw candles of a dataset as a stream of files, with the batch that brought them."""
    reader = spark.readStream.schema(StructType([*RAW_KLINE.fields, StructField("batch", StringType())]))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(Layout(root).raw_candles).where(F.col("dataset") == dataset)


def _settled(batch: DataFrame, root: str) -> None:
    """An error where the rows may be of a refresh that is not committed yet: the next run takes them again."""
    found = [row["batch"] for row in batch.select("batch").distinct().collect()]
    if open_ := versions.unsettled(batch.sparkSession, root, versions.RAW_CANDLES, found):
        raise RuntimeError(f"a refresh is still writing {open_[0]}; run again when it has ended")


def compact_new_rows(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    interval: str = DEFAULT_INTERVAL,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Compact the years touched by raw files that arrived since the last run, then stop.

    Each batch recomputes whole (symbol, interval, year) partitions from all
    their raw rows and replaces them, so a repeated batch gives the same table.
    """
    rows = raw_candle_stream(spark, root, files_per_batch=files_per_batch)
    rows = rows.where(F.col("interval") == interval).select("symbol", "interval", "open_time", "batch")

    def replace(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        _settled(batch, root)
        with Scratch(session, root) as scratch:
            touched = scratch.keep(compaction.touched_years(batch))
            compaction.compact_klines(session, root, interval=interval, touched=touched)

    writer = rows.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def resample_new_rows(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    bucket_seconds: int,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bring the stored candles of one timeframe up to date with new raw minutes, then stop.

    Each batch first compacts the years it touches. Then the years that hold a
    bucket of one of its rows are resampled again from all their compacted
    minutes and replaced, by the same function as the batch read. Late, repeated
    and incomplete rows so count as they do there, and nothing is withheld.
    """
    rows = raw_candle_stream(spark, root, files_per_batch=files_per_batch)
    rows = rows.where(F.col("interval") == DEFAULT_INTERVAL)
    rows = rows.select("symbol", "interval", "open_time", "batch")

    def bucket_year(second: Column) -> Column:
        start = times.bucket_start(second, bucket_seconds)
        return F.date_format(F.timestamp_seconds(start), "yyyy")

    def replace(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        _settled(batch, root)
        with Scratch(session, root) as scratch, Layout(root).changing(session) as layout:
            second = times.epoch_seconds(batch, "open_time")
            new = batch.select("symbol", "interval", "open_time", bucket_year(second).alias("year"))
            new = scratch.keep(new.where(F.col("open_time").isNotNull()).distinct())
            touched = scratch.keep(compaction.touched_years(new))
            compaction.compact_klines(session, root, interval=DEFAULT_INTERVAL, touched=touched, layout=layout)
            # Symbols of a batch and years of the calendar: bounded.
            places = scratch.keep(new.select("symbol", "year").distinct())
            owners = [row["symbol"] for row in places.select("symbol").distinct().collect()]
            if not owners:
                return
            minutes = tables.read_compacted(session, layout, owners, DEFAULT_INTERVAL).drop("year")
            year = bucket_year(times.epoch_seconds(minutes, "open_time"))
            minutes = minutes.withColumn("year", year).join(places, ["symbol", "year"], "left_semi")
            frames = candles.resample(minutes, bucket_seconds, keys=("symbol", "year"))
            frames = frames.withColumn("timeframe", F.lit(bucket_seconds).cast("bigint"))
            tables.write_resampled(frames.repartition("timeframe", "symbol", "year"), layout)

    writer = rows.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
