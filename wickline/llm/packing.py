"""Best-fit packing by minimum bin slack.

Documents are tokenized where they are read and cut into pieces of at most the
capacity; the first piece takes the remainder, all others are full. What goes
to the driver is the histogram of piece lengths, at most ``capacity`` numbers.
There each bin takes the longest length left and, by bitset subset-sum dynamic
programming over the lengths available, the fullest feasible combination with
it; the combination is removed as often as the histogram allows. The outcome is
a bounded list of combinations. A piece finds its place from its rank among the
pieces of its length: a running number within its task plus the counts of the
tasks before it, so no length, however common, is gathered anywhere.

Defined cases: null text is empty and packs as its end mark alone; a null
``doc_id`` is kept; repeated rows are packed each; lone surrogates cannot occur
in UTF-8; an empty table gives an empty result; further columns are not
touched.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wickline.llm.common import stored, text_or_empty

CAPACITY = 2048
#: Appended to every document.
END_ID = 0
#: Fixed value: how byte-level BPE files of this kind split a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the letters from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@cache
def token_ids(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids by the tokenizer file at ``path``, special tokens' strings being ordinary text.

    A byte-level BPE whose ids are its merge order is run by the faster of the
    installed libraries, which gives the same ids; any other file by its own, and
    so are texts with runs of white space too long for the faster one.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain_bpe = (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if plain_bpe:
        letters, vocab = _byte_letters(), model["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        special = {t["content"] for t in spec.get("added_tokens") or ()}
        ranks = {bytes(letters[c] for c in word): k for word, k in vocab.items() if word not in special}
        if merged == sorted(merged) and len(merged) + 256 == len(ranks) and sorted(ranks.values()) == list(range(len(ranks))):
            import tiktoken

            encoding = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

            def encode(text: str) -> np.ndarray:
                try:
                    return encoding.encode_to_numpy(text, disallowed_special=())
                except ValueError:  # its words are found by backtracking, on a stack of fixed size
                    return _own_ids(path)(text)

            return encode
    return _own_ids(path)


@cache
def _own_ids(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids by the library that the file is written for."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, task, rank, and the ids where wanted.

    ``rank`` numbers the pieces of equal length within ``task``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long"
    schema += ", ids array<int>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = token_ids(tokenizer), [0] * (capacity + 1), TaskContext.get().partitionId()
        for batch in batches:
            rows, source, kept = [], [], []
            for at, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py()), END_ID).astype("<u4")
                first = len(ids) % capacity or capacity
                start, end, number = 0, first, 0
                while start < len(ids):
                    part = ids[start:end]
                    size = end - start
                    rows.append((number, start, size, zlib.crc32(part.tobytes()), task, seen[size]))
                    source.append(at)
                    if with_ids:
                        kept.append(part.astype(np.int32))
                    seen[size] += 1
                    start, end, number = end, end + capacity, number + 1
            if not rows:
                continue
            columns = [batch.column(0).take(pa.array(source, pa.int32()))]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns += [pa.array(values, type_) for values, type_ in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut, schema)


def _fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """The combination with the longest length left that fills ``capacity`` best.

    ``reach`` is a bitset of the sums that some subset of the items so far has;
    the sets before each item are kept to walk the best sum back.
    """
    first = max(counts)
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach, before = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left = min(counts[length] - (length == first), room // length)
        use = 1
        while left > 0:  # items of 1, 2, 4, ... pieces stand for any number up to the count
            take = min(use, left)
            before.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            use *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, [first]
    for earlier, length, take in reversed(before):
        if not earlier >> total & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


def combinations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(times, lengths): bins that together hold the whole histogram of lengths."""
    counts = {length: n for length, n in histogram.items() if n}
    bins = []
    while counts:
        chosen = _fullest(counts, capacity)
        uses = {length: chosen.count(length) for length in set(chosen)}
        times = min(counts[length] // n for length, n in uses.items())
        for length, n in uses.items():
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        bins.append((times, sorted(chosen, reverse=True)))
    return bins


def _slots(bins: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces a bin, first sequence, offset in the bin), ranks ascending."""
    taken: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for times, lengths in bins:
        offset = 0
        for length in dict.fromkeys(lengths):
            uses = lengths.count(length)
            slots.setdefault(length, []).append((taken.get(length, 0), uses, sequence, offset))
            taken[length] = taken.get(length, 0) + uses * times
            offset += uses * length
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in slots.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (see :func:`pieces`, read from a written table) with sequence_id and offset."""
    counts = stored(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(combinations(histogram, capacity))  # bounded by the capacity, whatever the input
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # One row per task and length: it grows with the input, so it is never broadcast.
    ranked = cut.join(bases.hint("shuffle_merge"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base")
    placed = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    schema = StructType([*ranked.schema.fields, *placed])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            for rows in np.split(order, cuts) if len(order) else ():
                length = int(lengths[rows[0]])
                table, rank = slots[length], ranks[rows]
                found = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
                bin_, within = np.divmod(rank - found[:, 0], found[:, 1])
                sequences[rows], offsets[rows] = found[:, 2] + bin_, found[:, 3] + within * length
            columns = [*batch.columns, pa.array(sequences), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their places; tokenized once, into a written table."""
    cut = stored(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    return pack(cut, capacity).drop("task", "rank")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, its ids in order, and the documents' starts (needs ``ids``)."""
    gathered = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")
    )
    return gathered.select(
        "sequence_id",
        F.flatten("parts.ids").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("offsets"),
    )
