"""Run ledgers as JSON-lines tables with sorted keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.functions import once, times, variants
from wickline.operators import universe as universe_operators
from wickline.operators.gaps import new_gaps
from wickline.schemas import (
    FAILURE,
    GAP,
    GAP_KEY,
    OPTIONAL_FIELDS,
    SOURCE,
    STATUS,
    STRAY,
    UNIVERSE,
)
from wickline.sources import listing
from wickline.sources.tables import Layout

_TEXT = T.StructType([T.StructField("value", T.StringType())])
_GETTERS = {
    "string": variants.text_of,
    "long": variants.integer_of,
    "boolean": variants.boolean_of,
}


def _lines(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    folders = layout.version(spark).folders(name)
    return spark.read.text(folders) if folders else spark.createDataFrame([], _TEXT)


def _json(spark: SparkSession, layout: Layout, name: str, schema: T.StructType, **options: str) -> DataFrame:
    folders = layout.version(spark).folders(name)
    reader = spark.read.schema(schema).options(**options)
    return reader.json(folders) if folders else spark.createDataFrame([], schema)


def _records(lines: DataFrame) -> DataFrame:
    """Lines (``value``) as JSON values; malformed JSON is an error."""
    written = lines.where(F.col("value") != "").select("value")
    return once.with_value(written, "record", F.parse_json("value"), drop="value")


def _typed(field: T.StructField) -> Column:
    value = variants.item(F.col("record"), f"$.{field.name}")
    return _GETTERS[field.dataType.typeName()](value)


def _strict(field: T.StructField) -> Column:
    """The field, or an error when it has another type (or is absent and required)."""
    value = variants.item(F.col("record"), f"$.{field.name}")
    message = f"ledger field {field.name} must be a {field.dataType.typeName()}"
    wrong = F.raise_error(F.lit(message)).cast(field.dataType)
    if field.name in OPTIONAL_FIELDS:
        wrong = F.when(~variants.is_null(value), wrong)
    return F.coalesce(_typed(field), wrong)


def strict_records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Ledger rows of JSON lines; a field of another type is an error."""
    return _records(lines).select(*[_strict(f).alias(f.name) for f in schema.fields])


def gap_records(lines: DataFrame) -> DataFrame:
    """Gap rows of JSON lines; records with a field of another type are left out."""
    return _records(lines).select(*[_typed(f).alias(f.name) for f in GAP.fields]).dropna()


def _write(df: DataFrame, layout: Layout, name: str, keep: bool = False) -> None:
    """Replace a ledger, or with ``keep`` add to it: one JSON object a line, its keys sorted."""
    record = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    with layout.changing(df.sparkSession) as inside:
        inside.commit.write_ledger(df.select(record.alias("value")), name, keep)


def read_failures(spark: SparkSession, layout: Layout) -> DataFrame:
    return strict_records(_lines(spark, layout, "failures"), FAILURE)


def read_sources(spark: SparkSession, layout: Layout) -> DataFrame:
    return strict_records(_lines(spark, layout, "sources"), SOURCE)


def append_failures(failures: DataFrame, layout: Layout) -> None:
    """Add failures; the status document stays as it is."""
    _write(failures.select(*FAILURE.names), layout, "failures", keep=True)


def append_sources(sources: DataFrame, layout: Layout) -> None:
    """Add sources; the status document stays as it is."""
    _write(sources.select(*SOURCE.names), layout, "sources", keep=True)


def read_gaps(spark: SparkSession, layout: Layout) -> DataFrame:
    """Missing-candle ranges by key. Records with a field of another type are left out."""
    return gap_records(_lines(spark, layout, "gaps")).orderBy(*GAP_KEY)


def record_gaps(found: DataFrame, layout: Layout) -> None:
    """Add the ranges the ledger does not know yet; a known one keeps its record.

    Only new rows are written: the ledger is never rewritten, and a repeated run
    adds nothing.
    """
    existing = read_gaps(found.sparkSession, layout)
    _write(new_gaps(existing, found), layout, "gaps", keep=True)


def _read_strays(spark: SparkSession, layout: Layout) -> DataFrame:
    return _json(spark, layout, "strays", STRAY)


def record_strays(rows: DataFrame, time: str, layout: Layout) -> None:
    """Note which of the raw partitions of ``rows`` have rows outside their own period.

    Takes raw rows with their partition columns; earlier notes of these partitions
    go. Reads of a time range open the partitions of the range and the noted
    ones, so none has to open them all.
    """
    day = F.col(time).cast("date")
    period = F.col("period")
    outside = (day < times.period_start_day(period)) | (
        day > times.period_end_day(period).cast("date")
    )
    known = _read_strays(rows.sparkSession, layout)
    places = rows.groupBy(*STRAY.names).agg(F.coalesce(F.bool_or(outside), F.lit(False)).alias("stray"))
    strays = places.where("stray").select(*STRAY.names)
    if known.isEmpty():
        if not strays.isEmpty():
            _write(strays, layout, "strays")
        return
    same = [known[name].eqNullSafe(places[name]) for name in STRAY.names]
    _write(known.join(places, same, "left_anti").unionByName(strays), layout, "strays")


def stray_periods(spark: SparkSession, layout: Layout, dataset: str) -> list[str]:
    """Periods of noted partitions: at most one per day or month of the calendar."""
    noted = _read_strays(spark, layout).where(F.col("dataset") == dataset)
    return [row["period"] for row in noted.select("period").distinct().collect()]


def read_status(spark: SparkSession, layout: Layout) -> DataFrame:
    """The published status, one row; status ``missing`` when none has been published."""
    stored = _json(spark, layout, "status", STATUS, mode="FAILFAST")
    default = spark.range(1).select(
        F.lit("missing").alias("status"),
        F.lit(None).cast(STATUS["last_run"].dataType).alias("last_run"),
        F.lit(0).cast("bigint").alias("failed_item_count"),
        F.lit(0).cast("bigint").alias("source_count"),
        F.array().cast(STATUS["freshness"].dataType).alias("freshness"),
    )
    # The published row sorts first; one row either way.
    ranked = stored.withColumn("rank", F.lit(0)).unionByName(default.withColumn("rank", F.lit(1)))
    return ranked.orderBy("rank").limit(1).drop("rank")


def publish(
    layout: Layout, status: DataFrame, failures: DataFrame, sources: DataFrame
) -> None:
    """Replace the status document, the failures and the sources, all at once."""
    with layout.changing(status.sparkSession) as inside:
        _write(failures.select(*FAILURE.names), inside, "failures")
        _write(sources.select(*SOURCE.names), inside, "sources")
        _write(status.select(*STATUS.names), inside, "status")


def publish_universe(universe: DataFrame, layout: Layout) -> None:
    """Replace the stored universe."""
    _write(universe.select(*UNIVERSE.names), layout, "universe")


def publish_symbols(symbols: DataFrame, layout: Layout) -> None:
    """Replace the stored universe by a plain symbol list."""
    publish_universe(universe_operators.simple_universe(symbols).orderBy("symbol"), layout)


def read_universe(spark: SparkSession, layout: Layout) -> DataFrame:
    return _json(spark, layout, "universe", UNIVERSE, mode="FAILFAST")


def read_universe_document(spark: SparkSession, path: str) -> DataFrame:
    """Universe stored elsewhere as one JSON document, full or plain form."""
    reader = spark.read.option("wholetext", True)
    documents = listing.or_empty(spark, lambda: reader.text(path), _TEXT)
    entries = universe_operators.universe_from_json(documents)
    return entries.orderBy("position").select(*UNIVERSE.names)
