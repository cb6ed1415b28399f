"""Compression of vectors to short codes, with codebooks from an active-entry Lloyd iteration.

A vector's components become integers, floor(``SCALE`` * x), and the vector is cut
into ``PARTS`` equal consecutive parts. Every part position has a codebook of at
most ``ENTRIES`` entries, which begins as that part of the smallest vector ids.
Each of ``ROUNDS`` rounds assigns every part to its nearest entry and then moves
each entry to the floored mean of its parts; at the end parts are assigned again.

Active entries: an assignment is kept with its exact squared distance. Where the
assigned entry of a part did not move, the entries that did not move either are
as far as they were, so the part is compared with the moved entries alone; other
parts are compared with every entry. Ties go to the lower index in both cases,
so the codes are those of full scans.

The rows with their integers, codes and distances are a written table that each
round replaces. What the driver holds is the codebooks: ``ENTRIES`` times the
dimension of a vector, whatever the number of vectors. Entry sums are added up
in each task before they are shuffled. All arithmetic is in integers; products
run in doubles where these are exact.

Defined cases: a vector that is null, holds null or a non-finite component is
dropped, and so is one whose length is not that of the smallest id's vector,
since no codebook fits it; a length that ``PARTS`` does not divide is filled up
with zeros; integers are held within 2**27 on either side, so that a distance
fits a long; a null id comes after all others; rows of one id are ordered by
their components, and each row of a repeated id is coded; with fewer rows than
entries the codebook is as short as that; an empty table gives an empty result;
further columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from wickline.llm.common import BROADCAST_KEYS, release, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers are held within this on either side.
LARGEST = 2**27
#: Salts of a label's error where the labels are too many to broadcast.
SALTS = 32
#: Parts compared with a codebook at a time in a task.
BLOCK = 4_096

#: (entries, width) integers for every part position.
Codebooks = list[np.ndarray]


def as_integers(vectors: DataFrame, embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, ints of the vectors kept."""
    x = F.col(embedding)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    held = F.transform(
        x, lambda v: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), v.cast("double") * SCALE))).cast("int")
    )
    kept = vectors.select("vec_id", F.col(label).alias("label"), F.when(whole, held).alias("ints"))
    return kept.where("ints is not null")


def first_codebooks(rows: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> tuple[int, Codebooks]:
    """The dimension, which the smallest id's vector settles, and the parts of the smallest ids, ascending."""
    smallest = rows.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints")
    first = smallest.limit(1).collect()
    if not first:
        return 0, []
    dimension = len(first[0]["ints"])
    taken = smallest.where(F.size("ints") == dimension).limit(entries).collect()
    return dimension, _cut(np.array([r["ints"] for r in taken], np.int64).reshape(len(taken), dimension), parts)


def _cut(rows: np.ndarray, parts: int) -> Codebooks:
    """The columns of ``rows`` in equal parts, filled up with zeros."""
    width = -(-rows.shape[1] // parts)
    filled = np.zeros((len(rows), width * parts), np.int64)
    filled[:, : rows.shape[1]] = rows
    return [filled[:, p * width : (p + 1) * width] for p in range(parts)]


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, (rows, entries)."""
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * rows.shape[1] < 2**53:
        a, b = rows.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(rows), len(entries)), np.int64)
    for k in range(rows.shape[1]):
        step = rows[:, k, None] - entries[None, :, k]
        out += step * step
    return out


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lowest of equals, and its distance; all entries compared."""
    at, far = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for k in range(0, len(rows), BLOCK):
        gaps = distances(rows[k : k + BLOCK], entries)
        at[k : k + BLOCK] = best = gaps.argmin(1)
        far[k : k + BLOCK] = np.take_along_axis(gaps, best[:, None], 1)[:, 0]
    return at, far


def renearest(
    rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, far: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, from the assignment to entries of which the ``moved`` ones have changed since."""
    at, far = at.copy(), far.copy()
    again = moved[at]
    at[again], far[again] = nearest(rows[again], entries)
    active, still = np.flatnonzero(moved), np.flatnonzero(~again)
    if len(active) and len(still):
        near, gap = nearest(rows[still], entries[active])
        near = active[near]
        won = (gap < far[still]) | ((gap == far[still]) & (near < at[still]))
        at[still[won]], far[still[won]] = near[won], gap[won]
    return at, far


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = (np.arange(len(rows) + 1) * rows.shape[1]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind.value_type)).cast(kind)


def assigned(rows: DataFrame, books: Codebooks, moved: list[np.ndarray] | None = None) -> DataFrame:
    """``rows`` with ``codes`` and ``gaps`` by part; with ``moved`` it renews those that ``rows`` has."""
    codes, gaps = StructField("codes", ArrayType(IntegerType())), StructField("gaps", ArrayType(LongType()))
    fields = StructType([*(rows.schema[c] for c in ("vec_id", "label", "ints")), codes, gaps])
    arrow = to_arrow_schema(fields)
    parts = len(books)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = _cut(_matrix(batch.column(2)), parts)
            if moved is None:
                found = [nearest(part, book) for part, book in zip(cut, books, strict=True)]
            else:
                codes, gaps = _matrix(batch.column(3)), _matrix(batch.column(4))
                found = [
                    renearest(part, book, changed, codes[:, p], gaps[:, p])
                    for p, (part, book, changed) in enumerate(zip(cut, books, moved, strict=True))
                ]
            made = (np.stack(x, 1) for x in zip(*found, strict=True))
            columns = [_lists(x, kind) for x, kind in zip(made, arrow.types[3:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], schema=arrow)

    given = ["vec_id", "label", "ints", *(["codes", "gaps"] if moved else [])]
    return rows.select(*given).mapInArrow(apply, fields)


def entry_means(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The floored mean of each entry's parts; entries without parts stay."""
    parts, width = len(books), books[0].shape[1]
    kinds = "part int, entry int, place int, n long, total decimal(38,0)"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per entry and place that a task has seen; place -1 counts an entry of no components."""
        counts = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros(book.shape, np.int64) for book in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _matrix(batch.column(1))
            for p, part in enumerate(_cut(_matrix(batch.column(0)), parts)):
                counts[p] += np.bincount(codes[:, p], minlength=len(books[p]))
                order = np.argsort(codes[:, p], kind="stable")
                firsts = np.flatnonzero(np.diff(codes[order, p], prepend=-1))
                if width:
                    totals[p][codes[order[firsts], p]] += np.add.reduceat(part[order], firsts)
        for p in range(parts):
            used = np.flatnonzero(counts[p])
            entry, place = np.repeat(used, width), np.tile(np.arange(width), len(used))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(entry), p, np.int32)),
                    pa.array(entry.astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(counts[p][entry]),
                    pa.array(totals[p][entry, place]).cast(pa.decimal128(38, 0)),
                ],
                names=["part", "entry", "place", "n", "total"],
            )

    sums = rows.select("ints", "codes").mapInArrow(summed, kinds).groupBy("part", "entry", "place")
    found = sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    out = [book.copy() for book in books]
    for r in found:
        out[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def codebooks_sha256(books: Codebooks) -> str:
    """Of all components in decimals, by part, entry and place, joined by commas."""
    return sha256(",".join(str(x) for book in books for x in book.ravel()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    embedding: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of the vectors kept.

    ``code`` has two hex digits a part; ``error`` is the squared distance to the
    entries; ``label_error`` its sum over the rows of an equal label, at most the
    largest long.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits tells at most 256 entries apart")
    rows = stored(as_integers(vectors, embedding, label), "vectors")
    dimension, books = first_codebooks(rows, entries, parts)
    given, moved = rows.where(F.size("ints") == dimension), None
    for _ in range(rounds if books else 0):
        held = stored(assigned(given, books, moved), "vectors")
        release(rows)
        means = entry_means(held, books)
        moved = [(new != old).any(1) for new, old in zip(means, books, strict=True)]
        rows = given = held
        books = means
    coded = stored(assigned(given, books, moved) if books else _uncoded(given), "vectors")
    release(rows)
    code = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))))
    error = F.aggregate("gaps", F.lit(0).cast("long"), lambda a, b: a + b)
    told = coded.select("vec_id", "label", code.alias("code"), error.alias("error"))
    return _with_label_errors(told).withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))


def _uncoded(rows: DataFrame) -> DataFrame:
    """The columns of ``assigned`` where there is nothing to assign to, and so no row."""
    none = (F.lit(None).cast(f"array<{kind}>").alias(name) for name, kind in (("codes", "int"), ("gaps", "bigint")))
    return rows.limit(0).select("vec_id", "label", "ints", *none)


def _with_label_errors(told: DataFrame) -> DataFrame:
    """Adds the sum of ``error`` over equal labels, nulls together.

    The sums are counted. Few are broadcast; more are joined by shuffle, each
    label's rows dealt to ``SALTS`` tasks so that a frequent one fills none.
    """
    largest = F.lit(2**63 - 1).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), largest).cast("long")
    sums = stored(told.groupBy("label").agg(total.alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    same, columns = F.col("label").eqNullSafe(F.col("of")), ("vec_id", "label", "code", "error", "label_error")
    if sums.count() <= BROADCAST_KEYS:
        return told.join(F.broadcast(sums), same).select(*columns)
    dealt = told.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    copies = sums.withColumn("of_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return dealt.join(copies, same & (F.col("salt") == F.col("of_salt"))).select(*columns)
