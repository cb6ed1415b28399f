"""Landed zip archives: checksum verification and extraction on the executors."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.constants import (
    ARCHIVE_COLUMNS,
    ARCHIVE_HEADER_PREFIX,
    ARCHIVE_HEADER_TRADES,
    CHECKSUM_MISMATCH,
    FUNDING_ARCHIVE_RATE,
    FUNDING_ARCHIVE_TIME,
    SHA256_HEX_LENGTH,
)
from wickline.sources import listing

#: Bytes of CSV per Arrow batch.
BLOCK_BYTES = 4 * 1024 * 1024

_SUFFIX = ".CHECKSUM"


def read_zips(
    spark: SparkSession, path: str, glob: str = "*.zip", named: Column | None = None
) -> DataFrame:
    """Landed archives: ``path``, ``content``. ``named`` limits them by file metadata, unopened."""
    found = listing.files(spark, path, glob, content=True, named=named)
    return found.select("path", "content")


def read_checksums(
    spark: SparkSession, path: str, glob: str = "*.zip", named: Column | None = None
) -> DataFrame:
    """Landed checksum texts under the path of their archive: ``path``, ``checksum_text``."""
    found = listing.files(spark, path, glob + _SUFFIX, content=True, named=named)
    return found.select(
        F.regexp_replace("path", r"\.CHECKSUM$", "").alias("path"),
        F.decode("content", "UTF-8").alias("checksum_text"),
    )


def checksum_token(text: Column) -> Column:
    """First token of a checksum text when it has the length of a SHA-256, else NULL."""
    token = F.element_at(F.split(F.regexp_replace(text, r"^\s+", ""), r"\s+"), 1)
    return F.when(F.length(token) == SHA256_HEX_LENGTH, token)


# Arrow forms of the two kinds of extracted rows.
_KLINE_FIELDS = [
    ("open_millis", pa.int64()),
    ("open", pa.float64()),
    ("high", pa.float64()),
    ("low", pa.float64()),
    ("close", pa.float64()),
    ("volume", pa.float64()),
    ("trade_count", pa.int64()),
]
_FUNDING_FIELDS = [("funding_millis", pa.int64()), ("funding_rate", pa.float64())]

_CARRIED = "path string, checksum string, error_message string"
#: Row schemas of the extraction. ``source_row`` is NULL on the one outcome row
#: each archive gives behind its data rows; that row carries the row count.
KLINE_EXTRACT = (
    f"{_CARRIED}, row_count bigint, source_row bigint, open_millis bigint, open double, "
    "high double, low double, close double, volume double, trade_count bigint"
)
FUNDING_EXTRACT = (
    f"{_CARRIED}, row_count bigint, source_row bigint, funding_millis bigint, funding_rate double"
)


def _typed(text: pa.Array, kind: pa.DataType) -> pa.Array:
    """Numbers of a text column; raises on a bad cell. Whole numbers may be written as 1e3."""
    try:
        return pc.cast(text, kind)
    except pa.ArrowInvalid:
        number = pc.cast(pc.utf8_trim_whitespace(text), pa.float64())
        return pc.cast(pc.trunc(number), kind) if pa.types.is_integer(kind) else number


class _Member:
    """The single CSV member of an archive, read as typed Arrow batches."""

    def __init__(self, content: bytes, funding: bool) -> None:
        self._archive = zipfile.ZipFile(io.BytesIO(content))
        names = [n for n in self._archive.namelist() if n.endswith(".csv")]
        if len(names) != 1:
            raise ValueError(f"expected exactly one CSV in archive, got {names}")
        self._name = names[0]
        self._fields = _FUNDING_FIELDS if funding else _KLINE_FIELDS
        if funding:
            header, wanted = True, [FUNDING_ARCHIVE_TIME, FUNDING_ARCHIVE_RATE]
        else:
            with self._archive.open(self._name) as start:
                header = start.read(len(ARCHIVE_HEADER_PREFIX)) == ARCHIVE_HEADER_PREFIX
            trades = ARCHIVE_HEADER_TRADES if header else "trade_count"
            wanted = [*ARCHIVE_COLUMNS[:6], trades]
        # Spark runs a task per core already.
        self._read = pacsv.ReadOptions(
            use_threads=False,
            block_size=BLOCK_BYTES,
            column_names=None if header else list(ARCHIVE_COLUMNS),
        )
        # Cells are read as text first, so that a bad cell is an error of the
        # whole archive and the type never depends on the first block.
        self._convert = pacsv.ConvertOptions(
            include_columns=wanted,
            column_types={name: pa.string() for name in wanted},
            null_values=[""],
            strings_can_be_null=True,
        )

    def batches(self) -> Iterator[pa.RecordBatch]:
        with self._archive.open(self._name) as stream:
            # A fresh iterator each time; only one block is held.
            for batch in pacsv.open_csv(
                stream, read_options=self._read, convert_options=self._convert
            ):
                columns = []
                for (_, kind), column in zip(self._fields, batch.columns, strict=True):
                    columns.append(_typed(column, kind))
                yield pa.RecordBatch.from_arrays(columns, names=[n for n, _ in self._fields])


def _extractor(funding: bool):
    fields = _FUNDING_FIELDS if funding else _KLINE_FIELDS
    schema = pa.schema(
        [(n, pa.string()) for n in ("path", "checksum", "error_message")]
        + [("row_count", pa.int64()), ("source_row", pa.int64())]
        + fields
    )

    def filled(n: int, known: dict[str, pa.Array]) -> pa.RecordBatch:
        arrays = [known[f.name] if f.name in known else pa.nulls(n, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def one(path: str, checksum: str, content: bytes) -> Iterator[pa.RecordBatch]:
        total, error = 0, None
        try:
            for batch in _Member(content, funding).batches():
                n = batch.num_rows
                known = dict(zip(batch.schema.names, batch.columns, strict=True))
                known["source_row"] = pa.array(np.arange(total, total + n))
                known["path"] = pa.repeat(pa.scalar(path, pa.string()), n)
                known["checksum"] = pa.repeat(pa.scalar(checksum, pa.string()), n)
                yield filled(n, known)
                total += n
        except (OSError, ValueError, KeyError, zipfile.BadZipFile, pa.ArrowException) as exc:
            error = str(exc)
        outcome = {"path": path, "checksum": checksum, "error_message": error}
        outcome["row_count"] = total if error is None else None
        yield filled(1, {n: pa.array([v], schema.field(n).type) for n, v in outcome.items()})

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from one(*(batch.column(n)[i].as_py() for n in ("path", "checksum", "content")))

    return extract


def extract(zips: DataFrame, funding: bool = False) -> DataFrame:
    """Rows and outcomes of archives (``path``, ``content``) in one streaming pass where they are read.

    Data rows have ``source_row`` (their line number). Behind them each archive
    gives one outcome row, without ``source_row``: its ``row_count``, or why it
    cannot be read. Whether it counts is for :func:`archive_outcomes` to say; no
    join ever carries the bytes.
    """
    hashed = zips.select("path", F.sha2("content", 256).alias("checksum"), "content")
    return hashed.mapInArrow(_extractor(funding), FUNDING_EXTRACT if funding else KLINE_EXTRACT)


def archive_outcomes(extracted: DataFrame, checksums: DataFrame) -> DataFrame:
    """One row per archive: ``path``, ``checksum``, ``row_count``, ``error_code``, ``error_message``.

    An archive without its landed checksum, or with another one, has failed
    whatever it holds. One row an archive is joined.
    """
    side = checksums.select(
        "path",
        checksum_token(F.col("checksum_text")).alias("expected"),
        F.lit(True).alias("landed"),
    )
    outcome = extracted.where(F.col("source_row").isNull())
    joined = outcome.select("path", "checksum", "row_count", "error_message").join(side, "path", "left")
    invalid = F.col("expected").isNull()
    differs = ~invalid & (F.col("checksum") != F.col("expected"))
    message = (
        F.when(F.col("landed").isNull(), F.lit("no checksum landed"))
        .when(invalid, F.lit("invalid checksum payload"))
        .when(differs, F.concat_ws(" ", F.lit("expected"), "expected", F.lit("got"), "checksum"))
        .otherwise(F.col("error_message"))
    )
    return joined.select(
        "path",
        "checksum",
        F.when(message.isNull(), F.col("row_count")).alias("row_count"),
        # NULL code with a message: the archive raised instead of failing its checksum.
        F.when(differs, F.lit(CHECKSUM_MISMATCH)).alias("error_code"),
        message.alias("error_message"),
    )


def good_rows(extracted: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Data rows of the archives that did not fail: all of an archive or nothing of it."""
    bad = outcomes.where(F.col("row_count").isNull()).select("path")
    return extracted.where(F.col("source_row").isNotNull()).join(bad, "path", "left_anti")


def kline_rows(rows: DataFrame) -> DataFrame:
    """Data rows of a kline extraction: ``path``, ``source_row``, KLINE columns."""
    return rows.select(
        "path",
        "source_row",
        F.timestamp_millis("open_millis").alias("open_time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "trade_count",
    )


def funding_rows(rows: DataFrame) -> DataFrame:
    """Data rows of a funding extraction: ``path``, ``source_row``, FUNDING columns."""
    return rows.select(
        "path",
        "source_row",
        F.timestamp_millis("funding_millis").alias("funding_time"),
        "funding_rate",
        F.lit(None).cast("double").alias("mark_price"),
    )
