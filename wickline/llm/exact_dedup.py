"""Exact dedup with a heavy-hitter split, DataFrame functions only.

A Misra-Gries summary (Spark's ``freqItems``) names at most ``1 / support``
digests, among them every digest of more than ``support`` of the rows. Their
exact counts and winners come from a map-side combined aggregate and are
broadcast, so rows of large groups are resolved where they are read. The other
digests, each of a small share of the rows, go through an ordinary shuffle.

Defined cases: null text is the empty text, so all empty texts form one group;
a null ``doc_id`` loses against any other; of rows that repeat the same winning
``doc_id`` exactly one stays; an empty table gives an empty result; further
columns of the input, whatever their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import BROADCAST_KEYS, stored, text_or_empty

#: Share of the rows from which a digest counts as frequent; 1 / SUPPORT rows are broadcast at most.
SUPPORT = 0.001


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, a row number and the SHA-256 of each text: 48 bytes a row, written once."""
    rows = docs.select(
        F.col("doc_id"),
        F.unhex(F.sha2(text_or_empty(), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(rows, "digests")


def _winners(rows: DataFrame) -> DataFrame:
    grouped = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")
    )
    return grouped.select(
        "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"
    )


def resolve(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digests(docs)
    frequent = rows.stat.freqItems(["digest"], support).select(
        F.explode("digest_freqItems").alias("digest")
    )
    # At most 1 / support rows, whatever the input: safe to broadcast.
    hot = stored(_winners(rows.join(F.broadcast(frequent), "digest", "left_semi")), "winners")
    in_place = rows.join(F.broadcast(hot), "digest")
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    shuffled = rest.join(_winners(rest), "digest")
    return in_place.unionByName(shuffled).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of wholly repeated rows one."""
    keys = stored(
        resolve(docs, support)
        .groupBy("doc_id", "text_sha256")
        .agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        .where("not kept or n > 1"),
        "gone",
    )
    sizes = {r["kept"]: r["many"] for r in keys.groupBy("kept").agg(F.count("*").alias("many")).collect()}

    def matched(rows: DataFrame, kept: bool, how: str) -> DataFrame:
        side = keys.where(F.col("kept") == kept).select(F.col("doc_id").alias("key_id"), F.col("text_sha256").alias("key_sha"))
        side = F.broadcast(side) if sizes.get(kept, 0) <= BROADCAST_KEYS else side
        sha = F.sha2(F.coalesce(rows["text"].cast("string"), F.lit("")), 256)
        return rows.join(side, rows["doc_id"].eqNullSafe(side["key_id"]) & (sha == side["key_sha"]), how)

    staying = matched(docs, False, "left_anti") if sizes.get(False) else docs
    if not sizes.get(True):
        return staying
    repeated = matched(staying, True, "left_semi").dropDuplicates(["doc_id", "text"])
    return matched(staying, True, "left_anti").unionByName(repeated)
