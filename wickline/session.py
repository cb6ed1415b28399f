"""Session settings and the shared scratch location."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on. All can be changed on a live session.
SQL_SETTINGS = {
    # Epoch arithmetic on zone-less timestamps and text times means UTC.
    "spark.sql.session.timeZone": "UTC",
    # A write replaces only the partitions it contains.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Symbols such as 007 are text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Archive bytes travel to Python in batches of bounded size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


#: Input bytes per shuffle partition.
PARTITION_BYTES = 256 * 1024 * 1024


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply :data:`SQL_SETTINGS` to ``spark`` and return it.

    Given the size of the input, the number of shuffle partitions is raised to
    fit it (never lowered); adaptive execution merges what turns out small.
    """
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    wanted = -(-input_bytes // PARTITION_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def _file_system(spark: SparkSession, uri: str):
    """The file system of a path, the qualified path, and the name of its scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(path), system.getUri().getScheme()


class Scratch:
    """Intermediate tables of one job, all in one folder that is removed when the job ends.

    The folder lies in the one named by ``spark.checkpoint.dir``. Where that is
    unset, or is machine-local while the data root is not, it lies below the
    data root. What a killed driver leaves behind is removed by the next job once
    it is older than ``KEPT_HOURS``.
    """

    KEPT_HOURS = 48
    _NAME = "wickline-"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared and _file_system(spark, shared)[2] == "file" != _file_system(spark, root)[2]:
            shared = None
        self._base = (shared or f"{root.rstrip('/')}/scratch").rstrip("/")
        self.folder = f"{self._base}/{self._NAME}{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        system, base, _ = _file_system(self._spark, self._base)
        if system.exists(base):
            oldest = (time.time() - self.KEPT_HOURS * 3600) * 1000
            for entry in system.listStatus(base):
                if entry.getPath().getName().startswith(self._NAME) and entry.getModificationTime() < oldest:
                    system.delete(entry.getPath(), True)
        return self

    def __exit__(self, *_failure: object) -> None:
        system, folder, _ = _file_system(self._spark, self.folder)
        system.delete(folder, True)
        if self._base.endswith("/scratch"):
            system.delete(folder.getParent(), False) if not system.listStatus(folder.getParent()) else None

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written once as a Parquet table and read back.

        Used where one expensive result feeds several outputs: the written table
        survives the loss of executors, and each consumer prunes its own columns.
        """
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)


def file_names(spark: SparkSession, path: str, older_than_hours: float | None = None) -> list[str]:
    """Names of what a folder holds, none where it does not exist; maybe only what is old enough."""
    system, folder, _ = _file_system(spark, path)
    if not system.exists(folder):
        return []
    entries = system.listStatus(folder)
    if older_than_hours is not None:
        newest = (time.time() - older_than_hours * 3600) * 1000
        entries = [entry for entry in entries if entry.getModificationTime() <= newest]
    return [entry.getPath().getName() for entry in entries]


def read_file(spark: SparkSession, path: str) -> str:
    system, place, _ = _file_system(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of its content at once; False where there is one of this name."""
    system, place, _ = _file_system(spark, path)
    jvm = spark._jvm
    system.mkdirs(place.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # fails where the name is taken
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, place, options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        system, folder, _ = _file_system(spark, path)
        system.delete(folder, True)
