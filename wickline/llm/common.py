"""What the operators share: driver tables, scratch tables in the shared folder, blank-safe columns."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Written tables by their path.
_made: dict[str, SparkSession] = {}
_own: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Unset, a local session gets a temporary folder and a cluster its warehouse,
    so that no machine-local folder is ever used on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="wickline-llm-"))
        return f"file://{_own[0]}"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to a fresh table of the shared folder and read back.

    It cuts the lineage and outlives executors. ``release`` removes a table once
    nothing reads it any more; what lazy results still read goes with the driver
    process.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove)
    _made[path] = spark
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` returned; they must not be read again."""
    for table in tables:
        _delete(_made.pop(table.stored_at), table.stored_at)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _remove() -> None:
    for path, spark in _made.items():
        try:
            _delete(spark, path)
        except (Py4JError, AttributeError, OSError):
            return  # the session has ended; the folder is the cluster's to clean


#: Keys up to this many (about 100 MB with their hash table) are broadcast.
BROADCAST_KEYS = 1_000_000


def counted_small(table: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """A stored table to join with: broadcast if it has at most ``most`` rows of a few numbers, else as it is."""
    return F.broadcast(table) if table.count() <= most else table


def row_key(docs: DataFrame) -> Column:
    """A row's id and text as one value, never null: ids in their order, null ids behind, then a 128-bit hash of the text."""
    kind, text = docs.schema["doc_id"].dataType, text_or_empty()
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"),
        F.coalesce(F.col("doc_id"), F.lit(0).cast(kind)).alias("id"),
        F.xxhash64(text).alias("text"),
        F.xxhash64(F.lit(1), text).alias("text_too"),
    )


def by_row(docs: DataFrame) -> DataFrame:
    """doc_id and text for an operator that names rows by id, so that it names them by :func:`row_key` instead."""
    return docs.select(row_key(docs).alias("doc_id"), "text")


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose :func:`row_key` is a ``doc_id`` of ``rejected``.

    Counted first: few keys are broadcast and no text moves, more are joined by shuffle.
    """
    keys = stored(rejected.select(F.col("doc_id").alias("rejected")).distinct(), "rejected")
    return docs.join(counted_small(keys), row_key(docs) == F.col("rejected"), "left_anti").select(*docs.columns)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def per_text(
    df: DataFrame, keys: Sequence[str], make: Callable[[], Callable[[str], tuple]], fields: str, text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: its ``keys`` as they are, and what a function makes of its text.

    ``make`` is called once in a task and returns the function; ``fields`` is
    the DDL of the tuple it returns. Null texts arrive empty. Batches travel as
    Arrow, so ids keep their type and nulls.
    """
    made = StructType.fromDDL(fields)
    schema = StructType([*(df.schema[k] for k in keys), *made.fields])
    kinds = [to_arrow_type(f.dataType) for f in made.fields]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            found = [function(value) for value in batch.column(len(keys)).to_pylist()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*found, strict=True), kinds, strict=True)]
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], names=schema.names)

    return df.select(*keys, text_or_empty(text).alias(text)).mapInArrow(apply, schema)


def outside(spans: Iterable[tuple[str, int, int]]) -> Callable[[int, int], bool]:
    """Whether a stretch touches none of the (kind, start, end) given: these are merged once, then searched."""
    merged: list[list[int]] = []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    starts = [start for start, _ in merged]

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end) - 1
        return before < 0 or merged[before][1] <= start

    return free
