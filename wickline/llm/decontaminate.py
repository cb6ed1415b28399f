"""Benchmark decontamination by spaced-seed hashing, DataFrame functions only.

A mask fixes which tokens of a window are hashed and which are ignored, so a
substituted token breaks only the windows that look at it. Masked hashes of the
benchmark are joined with those of every window of every document. Each hit
names a diagonal, along which all tokens of the item are compared with the
document where it stands; the tokens found on any diagonal of an item are counted
once, so that an inserted or lost word does not hide the rest of a passage.

The benchmark is taken in blocks of about ``BLOCK_ITEMS`` items and
``BLOCK_TOKENS`` tokens, one after the other, each with one pass over the
documents. What is broadcast of a block is three numbers a seed, and the hashes
of each item once, so that a block is small whatever the size of the benchmark
and however long its items (an item is in one block); the documents' text never
crosses the network.

Items shorter than the longest mask are looked for with the masks that fit them,
and all of their tokens must be found on one document; items shorter than every
mask are found where they are all that a document says.

Tokens are runs of letters and digits, lower-cased. Defined cases: null or empty
texts, null ids' texts included, meet no item unless they hold one; an item
without a token matches nothing; each row of a repeated or null id is matched by
itself, and its best row answers for the id; items that share an id are matched
each; a null item text is empty; an empty table gives an empty result; further
columns are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import by_row, stored, text_or_empty, without

#: 1: the token is hashed, 0: it is ignored. Five tokens in windows of five to nine.
MASKS = ("11111", "1101011", "111001001", "100101101")
#: Share of an item's tokens that must be found for a document to be contaminated.
COVERAGE = 0.6
#: Items whose seeds are broadcast together.
BLOCK_ITEMS = 2000
#: Their tokens, with a seed of each mask: about 25 MB with their hash table.
BLOCK_TOKENS = 80_000


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hashed(df: DataFrame, *keys: Column | str) -> DataFrame:
    """``keys`` and ``h``, the 64-bit hashes of the tokens in order, of texts that have some."""
    words = df.select(*keys, _tokens(text_or_empty()).alias("words")).where(F.size("words") > 0)
    return words.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("h")).drop("words")


def _seeds(tokens: Column, at: Column, masks: Sequence[str]) -> Column:
    """One hash per mask of the window that starts at ``at``, null where it does not fit, and one of a short text."""
    whole = F.when(F.size(tokens) < min(map(len, masks)), F.xxhash64(F.lit(len(masks)), tokens))
    return F.array(
        *(
            F.when(
                at + len(mask) <= F.size(tokens),
                F.xxhash64(F.lit(k), *(F.get(tokens, at + i) for i, bit in enumerate(mask) if bit == "1")),
            )
            for k, mask in enumerate(masks)
        ),
        whole,
    )


def _windows(df: DataFrame, masks: Sequence[str]) -> DataFrame:
    """One row per window and mask: all columns, ``at``, ``mask`` and ``seed``."""
    last = F.greatest(F.size("h") - min(map(len, masks)), F.lit(0))
    starts = df.select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return starts.select("*", F.posexplode(_seeds(F.col("h"), F.col("at"), masks)).alias("mask", "seed")).where(
        "seed is not null"
    )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: Sequence[str] = MASKS,
    coverage: float = COVERAGE,
    block_items: int = BLOCK_ITEMS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, matched, item_tokens, coverage, first_token."""
    items = stored(
        _hashed(benchmark.select("item_id", "text").distinct(), "item_id").withColumn(
            "number", F.monotonically_increasing_id()
        ),
        "items",
    )
    size = items.groupBy().agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("h")), F.lit(0)).alias("tokens")).first()
    blocks = max(1, -(-size["n"] // block_items), -(-size["tokens"] // block_tokens))
    # Rows are told apart within a block, which reads the documents once.
    hashed = _hashed(docs, "doc_id", F.monotonically_increasing_id().alias("row"))
    if blocks == 1:
        evidence = _evidence(hashed, items, masks, coverage)
    else:  # stored, so that one block is broadcast at a time
        dealt = F.pmod(F.xxhash64("number"), F.lit(blocks))
        evidence = reduce(
            DataFrame.unionByName,
            [stored(_evidence(hashed, items.where(dealt == k), masks, coverage), "evidence") for k in range(blocks)],
        )
    best = evidence.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("matched") / F.col("item_tokens")).alias("coverage"), "matched", "item_tokens", (-F.col("first_token")).alias("before"))).alias("best")
    )
    return best.select(
        "doc_id",
        "item_id",
        "best.matched",
        F.col("best.item_tokens").cast("long").alias("item_tokens"),
        "best.coverage",
        (-F.col("best.before")).cast("long").alias("first_token"),
    )


def _evidence(hashed: DataFrame, items: DataFrame, masks: Sequence[str], coverage: float) -> DataFrame:
    """Documents' rows that hold an item: doc_id, row, item_id, number, item_tokens, matched, first_token."""
    tokens = _diagonals(hashed, items, masks).select(
        "doc_id",
        "row",
        "item_id",
        "number",
        "item_tokens",
        "start",
        F.explode(
            F.filter(F.sequence(F.lit(0), F.col("item_tokens") - 1), lambda j: F.get("h", F.col("start") + j) == F.get("item_h", j))
        ).alias("token"),
    )
    # Distinct item tokens of a document: combined before the shuffle, bounded by the item's length.
    item = ["doc_id", "row", "item_id", "number", "item_tokens"]
    once = tokens.groupBy(*item, "token").agg(F.min(F.col("start") + F.col("token")).alias("place"))
    counted = once.groupBy(*item).agg(F.count("*").alias("matched"), F.min("place").alias("first_token"))
    short = F.col("item_tokens") < max(map(len, masks))
    share = F.col("matched") / F.col("item_tokens")
    return counted.where(F.when(short, F.col("matched") == F.col("item_tokens")).otherwise(share >= coverage))


def _diagonals(hashed: DataFrame, items: DataFrame, masks: Sequence[str]) -> DataFrame:
    """Diagonals on which a document's row meets an item: doc_id, row, h, start, and the item's id, number and hashes.

    A hit whose neighbour before it on the diagonal is a hit of the same mask is
    left to that one, so a passage names its diagonal a few times, not at every token.
    """
    seeds = _windows(items, masks).select("seed", "number", F.col("at").alias("item_at"))
    texts = items.select("number", "item_id", F.col("h").alias("item_h"))
    hits = _windows(hashed, masks).join(F.broadcast(seeds), "seed").join(F.broadcast(texts), "number")
    # Places before the first token are null.
    same = [
        reduce(
            Column.__and__,
            (F.get("h", F.col("at") + (i - 1)) == F.get("item_h", F.col("item_at") + (i - 1)) for i, bit in enumerate(mask) if bit == "1"),
        )
        for mask in masks
    ]
    follows = F.coalesce(F.get(F.array(*same, F.lit(False)), F.col("mask")), F.lit(False))
    return hits.where(~follows).select(
        "doc_id",
        "row",
        "h",
        (F.col("at") - F.col("item_at")).alias("start"),
        "item_id",
        "number",
        F.size("item_h").alias("item_tokens"),
        "item_h",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows are told apart by id and text."""
    return without(docs, matches(by_row(docs), benchmark).select("doc_id"))
