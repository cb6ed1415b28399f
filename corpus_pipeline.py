"""The corpus pipeline: five filters and the packing of what they keep.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``. Texts reach Python in batches of at most
``BATCH_BYTES`` (a longer text alone in one), since each task holds a batch and
what is made of it several times over, in the JVM and in its worker.

Filters judge rows, by id and text: a null id is no exemption, and of rows that
share an id each is judged by its own text. Defined cases: a null text is empty,
never toxic, never contaminated and near to nothing, and of all empty texts one
stays (that with the largest id); of a component of near copies the smallest id
stays, null ids last, and of one id's texts one; a text of any length is read
whole; repeated rows are one after exact dedup; an empty table passes through
all stages; further columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wickline.llm import decontaminate, exact_dedup, jaccard_join, packing, toxicity
from wickline.llm.common import stored, table

TOKENIZER = "byte_bpe_50k.json"
#: Of texts on their way to Python.
BATCH_BYTES = 4 * 1024 * 1024

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """``stage`` with the session's limit of a batch set to ``BATCH_BYTES``.

    The limit stays set, as what the stage returns runs only when it is written.
    """

    @wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return limited


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    return exact_dedup.keep(docs)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the smallest id stays."""
    return jaccard_join.keep(docs)


@in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left and their places in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: The stages learn, hash and tokenize, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; each stage's result is a written table of the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
