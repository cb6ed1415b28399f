"""File listings as DataFrames, and what the stored file names tell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.constants import FUNDING, KLINES
from wickline.functions import keys, times

_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """``read()``, or no rows of ``schema`` where the path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def files(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    content: bool = False,
    named: Column | None = None,
) -> DataFrame:
    """Files below ``path``: ``path``, ``length``, ``modificationTime`` and maybe ``content``.

    Without ``content`` no file is opened. ``named`` is a test of ``_metadata``
    columns, so that files which fail it are never opened either.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob)

    def load() -> DataFrame:
        found = reader.load(path)
        return found if named is None else found.where(named)

    found = or_empty(spark, load, _FILE)
    return found if content else found.drop("content")


def one_of(names: list[str]) -> str:
    """A path segment that matches any of ``names`` (names of keys, without glob characters)."""
    return "{" + ",".join(names) + "}"


def partition_values(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Distinct partition values below a table, from the names of its files' directories alone.

    ``folder`` is the innermost directory.
    """
    found = files(spark, path, "*.parquet").select(
        F.regexp_replace("path", "/[^/]+$", "").alias("folder")
    )
    columns = []
    for name in names:
        value = F.regexp_extract("folder", f"/{name}=([^/]*)", 1)
        value = F.when(value != "__HIVE_DEFAULT_PARTITION__", keys.symbol_of_key(value))
        columns.append(value.alias(name))
    return found.distinct().select("folder", *columns)


def segment(path: Column | str, from_end: int) -> Column:
    """Path segment counted from the end, 1 being the file name."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def stored_files(found: DataFrame) -> DataFrame:
    """One-file-per-period archives among listed files.

    Adds ``dataset``, ``symbol``, ``interval``, ``period`` from the file name and
    ``name``. The symbol comes from the directory, made canonical, so that
    encoded and plain directory names meet.
    """
    name = segment(F.col("path"), 1)
    parsed = found.select("path", name.alias("name"), times.file_name_parts(name).alias("parts"))
    return parsed.where(times.part("dataset").isNotNull()).select(
        "path",
        "name",
        times.part("dataset").alias("dataset"),
        keys.canonical_symbol(segment(F.col("path"), 2), strict=False).alias("symbol"),
        times.part("interval").alias("interval"),
        times.part("period").alias("period"),
    )


def find_raw_archives(
    spark: SparkSession,
    raw_root: str,
    dataset: str | None = None,
    symbol: str | None = None,
    interval: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Stored archives by optional dataset, symbol and interval, ordered by path.

    Funding archives have no interval, so asking for one leaves them out.
    """
    wanted = None if dataset is None else keys.require_dataset(dataset)
    below = raw_root if wanted is None else f"{raw_root.rstrip('/')}/{wanted}"
    found = stored_files(files(spark, below, "*.parquet"))
    if wanted is not None:
        found = found.where(F.col("dataset") == wanted)
    if symbol is not None:
        found = found.where(F.col("symbol") == keys.partition_symbol(symbol))
    if interval is not None:
        checked = keys.require_interval(interval)
        found = found.where((F.col("dataset") != FUNDING) & (F.col("interval") == checked))
    return found.orderBy("path") if ordered else found


def local_symbols(spark: SparkSession, raw_root: str) -> DataFrame:
    """Symbols with stored candle archives, ordered."""
    found = stored_files(files(spark, f"{raw_root.rstrip('/')}/{KLINES}", "*.parquet"))
    return found.select("symbol").distinct().orderBy("symbol")
