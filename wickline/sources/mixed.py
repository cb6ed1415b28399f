"""Parquet files whose column names and types differ from file to file, read by tasks.

Paths stay rows of a DataFrame: they are dealt out to tasks, each of which opens
its files one after the other, looks at the footer, and sends the wanted columns
on in batches of bounded size. A column arrives in one of four variants, by the
type it is stored in, so that Spark's own expressions convert it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Variants of a column: stored as text, as a number, as a whole number, as a time.
VARIANTS = {"text": T.StringType(), "real": T.DoubleType(), "whole": T.LongType(), "time": T.TimestampType()}
_ARROW = {"text": pa.string(), "real": pa.float64(), "whole": pa.int64(), "time": pa.timestamp("us", "UTC")}
#: Rows of a file sent on at a time.
BATCH_ROWS = 65_536


def _variant(kind: pa.DataType) -> str | None:
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "text"
    if pa.types.is_integer(kind):
        return "whole"
    if pa.types.is_floating(kind) or pa.types.is_decimal(kind):
        return "real"
    if pa.types.is_timestamp(kind):
        return "time"
    return None  # booleans and nested values are no numbers


def _opened(path: str):
    import pyarrow.fs as pafs

    uri = path.replace("s3a://", "s3://")
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    system, place = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
    return system.open_input_file(place)


def read_columns(
    found: DataFrame, wanted: Mapping[str, Sequence[str]], required: Sequence[str] = ()
) -> DataFrame:
    """Rows of the files at ``path``: path, source_row, and ``<name>__<variant>`` of every wanted name.

    ``wanted`` gives for each name the columns it may have; the first that a file
    has counts. A name that a file has none of is NULL, and the file has no rows
    where that name is ``required``.
    """
    columns = [(name, variant) for name in wanted for variant in VARIANTS]
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("source_row", T.LongType()),
            *(T.StructField(f"{name}__{variant}", VARIANTS[variant]) for name, variant in columns),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for paths in batches:
            for path in paths.column(0).to_pylist():
                with _opened(path) as source:
                    file = pq.ParquetFile(source)
                    stored = {field.name: _variant(field.type) for field in file.schema_arrow}
                    chosen = {n: next((c for c in names if c in stored), None) for n, names in wanted.items()}
                    if any(chosen[name] is None for name in required):
                        continue
                    at, read_names = 0, sorted({c for c in chosen.values() if c and stored[c]})
                    for rows in file.iter_batches(BATCH_ROWS, columns=read_names):
                        made = [pa.array([path] * rows.num_rows, pa.string()), pa.array(range(at, at + rows.num_rows), pa.int64())]
                        for name, variant in columns:
                            if chosen[name] and stored[chosen[name]] == variant:
                                made.append(rows.column(chosen[name]).cast(_ARROW[variant], safe=variant == "whole"))
                            else:
                                made.append(pa.nulls(rows.num_rows, _ARROW[variant]))
                        at += rows.num_rows
                        yield pa.RecordBatch.from_arrays(made, names=schema.names)

    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.select("path").repartition(tasks).mapInArrow(read, schema)


def of_any(df: DataFrame, name: str, convert: Callable[[DataFrame, str], Column]) -> Column:
    """``convert``, which looks at the type of a column, of whichever variant a row has."""
    return F.coalesce(*(convert(df, f"{name}__{variant}") for variant in VARIANTS))
