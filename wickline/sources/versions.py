"""Versions of a store: changes of several tables that readers see all at once, or not at all.

Rows that are written together lie in a folder of their own, ``<table>/batch=<id>``,
and run records in ``ledger/<name>/<id>``. A version says for each table which
batches it is made of and where the index of its partitions lies (the batch that
holds each), and for each ledger its folders. It is one small file,
``versions/<number>.json``, and the highest number is what readers see. Creating
that file is the commit: before it nobody reads the new folders, after it nobody
reads what they replaced, and a job that fails in between leaves the old version
as it was. Of two jobs that change the same version only one can create the next.

The index has one row a partition and is a Parquet table: it grows with symbols
and periods, not with rows, and is joined by Spark. What reaches the driver are
batch names and, while few partitions are read, their names. Replaced folders
stay for readers that began before; ``vacuum`` removes them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wickline.session import create_file, file_names, read_file, remove_folders
from wickline.sources import listing

RAW_CANDLES, RAW_FUNDING, KLINES, RESAMPLED = "raw_candles", "raw_funding", "klines", "resampled"
#: The partition columns of each table.
PLACES = {
    RAW_CANDLES: ("dataset", "symbol", "interval", "period"),
    RAW_FUNDING: ("symbol", "period"),
    KLINES: ("symbol", "interval", "year"),
    RESAMPLED: ("timeframe", "symbol", "year"),
}
#: Up to this many partitions are named in the filter of a read; more are joined.
NAMED_PARTITIONS = 10_000
#: Folders of a ledger that only grows, before they are merged into one.
MOST_RUNS = 16
#: Hours for which replaced folders stay.
KEPT_HOURS = 48

_DOCUMENT = re.compile(r"(\d{12})\.json")


class Conflict(RuntimeError):
    """Another job has changed the store since this one read it."""


@dataclass(frozen=True)
class Table:
    """A table of a version. ``stale``: its batches also hold partitions that were replaced."""

    batches: tuple[str, ...] = ()
    index: str = ""
    partitions: int = 0
    stale: bool = False


@dataclass(frozen=True)
class Version:
    root: str
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    ledgers: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def table(self, name: str) -> Table:
        return self.tables.get(name, Table())

    def index(self, spark: SparkSession, name: str) -> DataFrame:
        """The partitions of a table: its partition columns and ``batch``."""
        schema = _index_schema(name)
        at = self.table(name).index
        return spark.read.schema(schema).parquet(f"{self.root}/versions/{at}") if at else spark.createDataFrame([], schema)

    def folders(self, ledger: str) -> list[str]:
        return [f"{self.root}/ledger/{ledger}/{run}" for run in self.ledgers.get(ledger, ())]


def _index_schema(name: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in (*PLACES[name], "batch")])


def latest(spark: SparkSession, root: str) -> Version:
    """What readers see now; a version without tables where nothing was committed."""
    root = root.rstrip("/")
    numbers = [int(m[1]) for name in file_names(spark, f"{root}/versions") if (m := _DOCUMENT.fullmatch(name))]
    if not numbers:
        return Version(root)
    told = json.loads(read_file(spark, f"{root}/versions/{max(numbers):012}.json"))
    tables = {name: Table(**{**t, "batches": tuple(t["batches"])}) for name, t in told["tables"].items()}
    return Version(root, max(numbers), tables, {name: tuple(runs) for name, runs in told["ledgers"].items()})


def read(
    spark: SparkSession, version: Version, name: str, below: str, schema: StructType, scope: Column | None = None
) -> DataFrame:
    """Rows of a table from the directories below its batches that match ``below`` on.

    ``scope`` is a test of partition columns that holds for these. Where batches
    hold replaced partitions, the current ones are named to the scan, which
    opens no other, or joined where they are many.
    """
    table, base = version.table(name), f"{version.root}/{name}"
    if not table.batches:
        return spark.createDataFrame([], schema)
    held = StructType([*schema.fields, StructField("batch", StringType())])
    reader = spark.read.schema(held).option("basePath", base)
    batches = listing.one_of([f"batch={batch}" for batch in table.batches])
    rows = listing.or_empty(spark, lambda: reader.parquet(f"{base}/{batches}/{below}"), held)
    if table.stale:
        columns = (*PLACES[name], "batch")
        current = version.index(spark, name)
        current = current if scope is None else current.where(scope)
        named = [row["name"] for row in current.select(_name(columns).alias("name")).limit(NAMED_PARTITIONS + 1).collect()]
        if len(named) <= NAMED_PARTITIONS:
            rows = rows.where(_name(columns).isin(named))
        else:
            current = current.select(*(F.col(c).alias(f"_{c}") for c in columns))
            same = reduce(Column.__and__, (F.col(c).cast("string").eqNullSafe(F.col(f"_{c}")) for c in columns))
            rows = rows.join(current, same, "left_semi")
    return rows.drop("batch")


def _name(columns: Sequence[str]) -> Column:
    return F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


class Commit:
    """Changes to a store that no reader sees before :meth:`publish`.

    Reads through ``version`` see the changes made so far.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._begun = latest(spark, root)
        self.version = self._begun
        # Tells incremental runs that folders they find may not be committed yet.
        self._mark = f"{self.version.root}/versions/open/{uuid.uuid4().hex}"
        create_file(spark, self._mark, "")

    def replace(self, rows: DataFrame, name: str, covering: DataFrame | None = None) -> None:
        """Replace the partitions that ``rows`` holds, and remove those of ``covering`` that it does not hold.

        The places are taken from the directories just written, so ``rows`` runs once.
        """
        places, batch = PLACES[name], uuid.uuid4().hex
        folder = f"{self.version.root}/{name}/batch={batch}"
        rows.write.option("compression", "zstd").partitionBy(*places).parquet(folder)
        written = listing.partition_values(self._spark, folder, places).select(*places)
        gone = written if covering is None else written.unionByName(covering.select(*places))
        self._change(name, gone, written.withColumn("batch", F.lit(batch)), batch)

    def remove(self, places: DataFrame, name: str) -> None:
        """Remove the partitions of ``places`` that exist."""
        if self.version.table(name).batches:
            self._change(name, places.select(*PLACES[name]), None, None)

    def _change(self, name: str, gone: DataFrame, new: DataFrame | None, batch: str | None) -> None:
        spark, before = self._spark, self.version.table(name)
        index = self.version.index(spark, name)
        gone = gone.select(*(F.col(c).cast("string").alias(f"_{c}") for c in PLACES[name])).distinct()
        same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACES[name]))
        index = index.join(gone, same, "left_anti")
        added = 0
        if new is not None:
            added = new.count()
            index = index.unionByName(new)
        at = f"index/{name}-{uuid.uuid4().hex}"
        index.write.parquet(f"{self.version.root}/versions/{at}")
        left = spark.read.schema(_index_schema(name)).parquet(f"{self.version.root}/versions/{at}").count()
        batches = (*before.batches, batch) if added else before.batches
        table = Table(batches, at, left, before.stale or left != before.partitions + added)
        self.version = replace(self.version, tables={**self.version.tables, name: table})

    def write_ledger(self, lines: DataFrame, name: str, keep: bool = False) -> None:
        """Replace a ledger by ``lines`` (``value``), or add them to it with ``keep``."""
        run, runs = uuid.uuid4().hex, self.version.ledgers.get(name, ()) if keep else ()
        lines.write.text(f"{self.version.root}/ledger/{name}/{run}")
        if len(runs) >= MOST_RUNS:
            merged = uuid.uuid4().hex
            whole = self._spark.read.text([*self.version.folders(name), f"{self.version.root}/ledger/{name}/{run}"])
            whole.write.text(f"{self.version.root}/ledger/{name}/{merged}")
            runs, run = (), merged
        self.version = replace(self.version, ledgers={**self.version.ledgers, name: (*runs, run)})

    def publish(self) -> None:
        """Make all changes what readers see, or raise :class:`Conflict`."""
        if self.version != self._begun:
            spark, number = self._spark, self._begun.number + 1
            tables = {}
            for name, table in self.version.tables.items():
                if table != self._begun.table(name):
                    live = self.version.index(spark, name).select("batch").distinct().collect()
                    alive = {row["batch"] for row in live}
                    table = replace(table, batches=tuple(b for b in table.batches if b in alive))
                tables[name] = vars(table)
            told = json.dumps({"tables": tables, "ledgers": self.version.ledgers}, sort_keys=True)
            if not create_file(spark, f"{self.version.root}/versions/{number:012}.json", told):
                raise Conflict(f"version {number} of {self.version.root} was written by another job")

    def close(self) -> None:
        remove_folders(self._spark, [self._mark])


@contextmanager
def commit(spark: SparkSession, root: str) -> Iterator[Commit]:
    """A commit that is published when the block ends, and forgotten when it fails."""
    made = Commit(spark, root)
    try:
        yield made
        made.publish()
    finally:
        made.close()


def unsettled(spark: SparkSession, root: str, name: str, batches: Sequence[str]) -> list[str]:
    """Those of ``batches`` that a job may still be writing: neither in the latest version nor given up."""
    marks = f"{root.rstrip('/')}/versions/open"
    if not set(file_names(spark, marks)) - set(file_names(spark, marks, KEPT_HOURS)):
        return []  # a mark that old is of a job that was killed
    known = latest(spark, root).table(name).batches
    return sorted(set(batches) - set(known))


def vacuum(spark: SparkSession, root: str, kept_hours: float = KEPT_HOURS) -> None:
    """Remove what no version of the last ``kept_hours`` reads: old versions, batches, partitions, ledger folders.

    Names of folders to remove are what reaches the driver.
    """
    root = root.rstrip("/")
    old = file_names(spark, f"{root}/versions", kept_hours)
    now = latest(spark, root)
    remove_folders(spark, [f"{root}/versions/open/{name}" for name in file_names(spark, f"{root}/versions/open", kept_hours)])
    ended = [name for name in old if (m := _DOCUMENT.fullmatch(name)) and int(m[1]) < now.number]
    remove_folders(spark, [f"{root}/versions/{name}" for name in ended])
    if any((m := _DOCUMENT.fullmatch(name)) and int(m[1]) < now.number for name in file_names(spark, f"{root}/versions")):
        return  # readers of a former version may still be at work
    indexes = {table.index for table in now.tables.values()}
    aged = [f"index/{name}" for name in file_names(spark, f"{root}/versions/index", kept_hours)]
    remove_folders(spark, [f"{root}/versions/{name}" for name in aged if name not in indexes])
    for name, runs in now.ledgers.items():
        gone = set(file_names(spark, f"{root}/ledger/{name}", kept_hours)) - set(runs)
        remove_folders(spark, [f"{root}/ledger/{name}/{run}" for run in gone])
    tables = {}
    for name, table in now.tables.items():
        live = {f"batch={batch}" for batch in table.batches}
        gone = [b for b in file_names(spark, f"{root}/{name}", kept_hours) if b.startswith("batch=") and b not in live]
        remove_folders(spark, [f"{root}/{name}/{batch}" for batch in gone])
        if table.stale:
            columns = [*PLACES[name], "batch"]
            batches = listing.one_of(sorted(live)) if live else "batch="
            found = listing.partition_values(spark, f"{root}/{name}/{batches}", columns)
            same = reduce(Column.__and__, (F.col(f"f.{c}").eqNullSafe(F.col(f"i.{c}")) for c in columns))
            dead = found.alias("f").join(now.index(spark, name).alias("i"), same, "left_anti")
            remove_folders(spark, [row["folder"] for row in dead.select("folder").collect()])
            tables[name] = replace(table, stale=False)
    if tables:
        with commit(spark, root) as made:
            made.version = replace(made.version, tables={**made.version.tables, **tables})
