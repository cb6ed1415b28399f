"""N-gram Jaccard join by vertical partitioning; one class id per document.

A document is the set of its distinct word 5-grams, as 64-bit hashes. Two
documents link when the Jaccard similarity is at least ``PERCENT`` / 100; the
result is the connected components of all links.

1. Documents with equal sets become one class before anything is compared.
2. The global order of grams runs from rare to frequent. What is frequent is
   found by counts within tasks; that list is bounded and broadcast. Any order
   gives the same links, a good one gives fewer candidates.
3. Vertical partitions. Candidates need only the first fragment of each set.
   Its postings are shuffled by gram; those of a frequent gram are dealt out
   further. Linked sets have a first common gram, and too few others before it,
   or grams that nobody else has there, to miss the overlap their sizes ask for.
4. A gram's classes are first compared with one center, the class with the
   fewest rare grams of its own, not with each other. After the links so found are closed
   into components, only pairs of different components are candidates, so a
   group of copies costs its size and not its square, and no link that joins
   components is lost. Postings whose place leaves no room for a set of any size
   that the gram has are left out before, and the rest meets within bands of
   sizes, so a gram that many different texts share costs its size too.
5. To verify, the sets are cut into fragments of a gram order that all share, that
   of the hashes, so that fragments are of like size. Overlaps of a pair are
   counted fragment by fragment and summed: first in FIRST_FRAGMENTS, whose
   missing grams rule out most pairs that are not linked, then in the rest.

Texts are read where they lie in each pass; only ids, first fragments and the
sets of candidates cross the network.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased.
Defined cases: fewer words than a gram make one gram of them all; null, empty
or blank texts have an empty set, link with nothing (each other neither) and
are their own component; a repeated row gets its class's answer each time; a
null ``doc_id`` has its class's answer, which is null where no other id is in
it; an empty table gives an empty result; further columns are not touched.
Two different grams share a hash with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import BROADCAST_KEYS, by_row, counted_small, release, stored, text_or_empty, without

GRAM, PERCENT = 5, 75
#: Fragments of the gram order in which overlaps are counted.
FRAGMENTS = 8
#: Of these, the ones counted first for all pairs, and those in which grams of a single class are looked for first.
FIRST_FRAGMENTS, FIRST_ALONE = 2, 3
#: Grams counted together within a task, and the counts that make a gram frequent:
#: LEAST_FREQUENT at least, and enough that MOST_FREQUENT grams reach it at most.
CHUNK, LEAST_FREQUENT, MOST_FREQUENT = 4_000_000, 32, 1 << 20
#: Tasks among which the postings of one frequent gram are dealt.
DEALT = 64
#: Ids up to this many (4 MB, with the text's hash in them 50) are broadcast to find their texts; more are joined by shuffle.
BROADCAST_IDS = 500_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


class _Hasher:
    """Word hashes of a whole batch at once: polynomial sums over per-byte random numbers."""

    def __init__(self) -> None:
        letters = np.arange(256)
        letters[65:91] += 32
        self.blank = np.zeros(256, bool)
        self.blank[[32, 9, 10, 11, 12, 13]] = True
        self.number = _mixed((letters.astype(np.uint64) + np.uint64(1)) * _MIX[0])
        base, one = 0x5851F42D4C957F2D, 1
        self.powers, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self._base, self._inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        assert (base * int(self._inverse)) % (1 << 64) == one

    def _grow(self, size: int) -> None:
        while len(self.powers) < size:  # doubling: p[n:2n] = p[:n] * base**n
            n = len(self.powers)
            step = np.uint64(pow(int(self._base), n, 1 << 64))
            back = np.uint64(pow(int(self._inverse), n, 1 << 64))
            self.powers = np.concatenate([self.powers, self.powers * step])
            self.inverse = np.concatenate([self.inverse, self.inverse * back])

    def sets(self, data: np.ndarray) -> np.ndarray:
        """The sorted distinct gram hashes of one text, given as bytes."""
        blank = self.blank[data]
        edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(starts):
            return np.empty(0, np.uint64)
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.number[data] * self.powers[: len(data)], out=sums[1:])
        words = _mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        width = min(GRAM, len(words))
        grams = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            grams = _mixed(grams * _MIX[0] + words[k : len(words) - width + 1 + k])
        return np.unique(grams)


def _gram_sets(batch: pa.RecordBatch, column: int, hasher: _Hasher) -> Iterator[np.ndarray]:
    """The set of each text of a batch, straight from its Arrow buffers."""
    texts = batch.column(column)
    if not len(texts):
        return
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield hasher.sets(data[start:end])


def _signature(grams: np.ndarray) -> int:
    """64 bits that stand for a set; with its size they name its class."""
    return int(_mixed(_mixed(grams * _MIX[2]).sum(keepdims=True) + np.uint64(len(grams))).view(np.int64)[0])


def _scanned(docs: DataFrame) -> DataFrame:
    """Per document (id, set, n), and per chunk of a task the grams seen twice or more (gram, times)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = _Hasher(), [], 0

        def repeated() -> pa.RecordBatch:
            grams, times = np.unique(np.concatenate(held), return_counts=True)
            more = times > 1
            count = int(more.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(count, id_type), pa.array(grams[more].view(np.int64)), pa.array(times[more]), pa.array([True] * count, pa.bool_())],
                names=names,
            )

        names, id_type = ["doc_id", "hash", "n", "is_gram"], pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            hashes, sizes = [], []
            for grams in _gram_sets(batch, 1, hasher):
                hashes.append(_signature(grams))
                sizes.append(len(grams))
                held.append(grams)
                size += len(grams)
                if size >= CHUNK:
                    yield repeated()
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes, pa.int64()), pa.array(sizes, pa.int64()), pa.array([False] * len(sizes), pa.bool_())],
                names=names,
            )
        if size:
            yield repeated()

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, hash long, n long, is_gram boolean")


def _frequent(scanned: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent grams, ascending, and the powers of two of their counts.

    Counts add up to ``total`` at most, so MOST_FREQUENT grams are found at most.
    """
    least = max(LEAST_FREQUENT, -(-total // MOST_FREQUENT))
    counts = scanned.where("is_gram").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    found = counts.select("hash", F.floor(F.log2("n")).cast("byte").alias("level")).toArrow()
    grams = found.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], found.column(1).to_numpy().astype(np.int8)[order]


def _least_overlap(n: Column, m: Column) -> Column:
    """The smallest overlap of linked sets of ``n`` and ``m`` grams: 100 o >= 75 (n + m - o)."""
    return F.ceil((PERCENT * (n + m)) / F.lit(100 + PERCENT))


def _postings(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """First fragments: (gram, dealt, set, at), the rarest grams of each set in their order.

    A set of n grams links with none of fewer than 0.75 n, so any linked set has
    one of the first ``_reach(n)``. ``dealt`` is -1, or spreads a frequent gram.
    A task names a class once.
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (listed, power), seen = _Hasher(), known.value, set()
        for batch in batches:
            grams, hot, sets, reaches = [], [], [], []
            for own in _gram_sets(batch, 0, hasher):
                n, name = len(own), _signature(own)
                if not n or name in seen:
                    continue
                seen.add(name)
                level = np.zeros(n, np.int8)
                if len(listed):
                    found = np.minimum(np.searchsorted(listed, own), len(listed) - 1)
                    level = np.where(listed[found] == own, power[found], np.int8(0))
                reach = n - (PERCENT * n + 99) // 100 + 1
                chosen = np.argsort(level, kind="stable")[:reach]
                grams.append(own[chosen])
                hot.append(level[chosen] > 0)
                sets.append(name)
                reaches.append(reach)
            if not sets:
                continue
            which = np.repeat(np.array(sets, np.int64), reaches)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(grams).view(np.int64)),
                    pa.array(np.where(np.concatenate(hot), which % DEALT, -1).astype(np.int8)),
                    pa.array(which),
                    pa.array(np.concatenate([np.arange(r, dtype=np.int32) for r in reaches])),
                ],
                names=["gram", "dealt", "set", "at"],
            )

    return docs.select(text_or_empty().alias("text")).mapInArrow(first, "gram long, dealt byte, set long, at int")


def _shared(postings: DataFrame, classes: DataFrame) -> DataFrame:
    """Postings of grams that more than one class has, and of all frequent grams; one row per gram and class."""

    def company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A stream sorted by gram and set: a row stays when a neighbour has its gram.
        last, joined = None, False
        for batch in batches:
            rows = pa.concat_batches([last, batch]) if last is not None else batch
            gram, name = rows.column(0).to_numpy(), rows.column(2).to_numpy()
            if not len(gram):
                continue
            fresh = np.ones(len(gram), bool)
            fresh[1:] = (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])
            rows = rows.filter(pa.array(fresh))
            gram, hot = rows.column(0).to_numpy(), rows.column(1).to_numpy() >= 0
            same = gram[1:] == gram[:-1]
            keep = hot.copy()
            keep[0] |= joined
            keep[1:] |= same
            joined = bool(keep[-1])
            keep[:-1] |= same
            yield rows.slice(0, len(gram) - 1).filter(pa.array(keep[:-1]))
            last = rows.slice(len(gram) - 1)
        if last is not None and joined:
            yield last

    dealt = postings.repartition("gram", "dealt").sortWithinPartitions("gram", "set")
    kept = stored(dealt.mapInArrow(company, postings.schema).select("gram", "set", "at", (F.col("dealt") >= 0).alias("frequent")), "postings")
    # Grams of a first fragment that no other class has in its own first fragment; see _may_link.
    counts = (F.count("*").alias("common"), F.count_if("frequent").alias("often"))
    own = kept.groupBy("set").agg(*counts).join(classes.select("set", "n"), "set")
    lone, rare = ((_reach(F.col("n")) - F.col(c)).cast("int") for c in ("common", "often"))
    own = stored(own.select("set", F.col("n").cast("int").alias("n"), lone.alias("lone"), rare.alias("rare")), "own")
    shared = stored(kept.drop("frequent").join(counted_small(own), "set"), "postings")
    release(kept, own)
    return shared


def _band(n: Column) -> Column:
    """Sets of one band differ in size by less than the similarity asks for; linked ones are in the same or the next."""
    return F.floor(F.log(n) / F.log(F.lit(100 / PERCENT))).cast("int")


def _sizes() -> Column:
    """Of a group of postings: bits of the sizes of their sets, four to a doubling."""
    return F.bit_or(_shifted(1, _size_bit(F.col("n"))))


def _shifted(bits: int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(bits).cast("long"), by)


def _size_bit(n: Column) -> Column:
    return F.least(F.floor(4 * F.log2(n)), F.lit(61)).cast("int")


def _fits_some(sizes: str) -> Column:
    """Whether a posting's ``at`` leaves room for a partner of some size among ``sizes``.

    """
    least, most = _partner_sizes()
    above, below = _shifted(2, _size_bit(F.greatest(most, F.lit(1)))) - 1, _shifted(1, _size_bit(least)) - 1
    return (least <= most) & (F.col(sizes).bitwiseAND(above) > F.col(sizes).bitwiseAND(below))


def _partner_sizes() -> tuple[Column, Column]:
    """The least and the most grams of a posting's partner: m >= 0.75 n, and n - at >= 3 (n + m) / 7 bounds m from above."""
    n = F.col("n")
    return F.ceil(PERCENT * n / F.lit(100)), F.floor((100 + PERCENT) * (n - F.col("at")) / F.lit(PERCENT)) - n


def _reach(n: Column) -> Column:
    """How many grams the first fragment has: the smallest partner has ceil(0.75 n), all of them common."""
    return n - F.ceil(PERCENT * n / F.lit(100)) + 1


def _may_link(a: str, b: str) -> Column:
    """Whether the least overlap fits, if this gram is the first that both sets have.

    The grams before it are missing from the overlap. A lone one is too, unless
    the partner has it behind its own first fragment. Then that fragment ends
    first: all it has in common is in the other's fragment and not lone, and the
    rest of the overlap is behind it. So with lone grams the overlap is at most
    the larger of n - lone and (reach - lone) + (n - reach of the partner).
    """
    least = _least_overlap(F.col(f"{a}.n"), F.col(f"{b}.n"))

    def room(s: str, t: str) -> Column:
        n, m = F.col(f"{s}.n"), F.col(f"{t}.n")
        most = F.greatest(n, _reach(n) - _reach(m) + m)
        return (n - F.col(f"{s}.at") >= least) & (most - F.col(f"{s}.lone") >= least)

    return room(a, b) & room(b, a)


def _pairs(joined: DataFrame) -> DataFrame:
    """Distinct (a, b, n_a, n_b), a < b."""
    swap = F.col("x.set") > F.col("y.set")
    both = [F.when(swap, F.col(f"{q}.{c}")).otherwise(F.col(f"{p}.{c}")) for c in ("set", "n") for p, q in (("x", "y"), ("y", "x"))]
    return joined.select(*(c.alias(name) for c, name in zip(both, ("a", "b", "n_a", "n_b"), strict=True))).distinct()


def _star_pairs(shared: DataFrame) -> DataFrame:
    """Each class with the center of each of its grams: the class with the fewest rare grams, then lone ones.

    In a group of altered copies that is the text they were made from.
    """
    center = F.min(F.struct("rare", "lone", "set", "n", "at")).alias("c")
    banded = shared.withColumn("band", _band(F.col("n")))
    centers = banded.groupBy("gram", "band").agg(center).select("gram", "band", "c.*")
    joined = banded.alias("x").join(centers.alias("y"), ["gram", "band"])
    return _pairs(joined.where((F.col("x.set") != F.col("y.set")) & _may_link("x", "y")))


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings of grams that several components have, with their component and the gram's largest one.

    Only of classes with a possible partner in another component.
    """
    label = F.coalesce(F.col("label"), F.col("set")).alias("label")
    tagged = shared.join(counted_small(labels.withColumnRenamed("node", "set")), "set", "left").select("gram", "set", "n", "lone", "at", label)
    mixed = stored(_mixed_grams(tagged), "open")
    other = (F.col("x.label") != F.col("y.label")) & _may_link("x", "y")
    partnered = stored(_met(mixed, mixed, other, "left_semi").select("set").distinct(), "partnered")
    open_ = stored(mixed.join(counted_small(partnered), "set", "left_semi"), "open")
    release(mixed, partnered)
    return open_


def _mixed_grams(tagged: DataFrame) -> DataFrame:
    """Postings of grams that several components have, with the largest one, if some set of the gram is of a size that fits."""
    held = tagged.groupBy("gram", "label").agg(F.count("*").alias("many"), _sizes().alias("sizes"))
    mixed = held.groupBy("gram").agg(F.max_by("label", "many").alias("main"), F.count("*").alias("kinds"), F.bit_or("sizes").alias("sizes"))
    found = tagged.join(mixed.where("kinds > 1").drop("kinds"), "gram")
    return found.where(_fits_some("sizes")).drop("sizes")


def _met(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Postings ``x`` and ``y`` of one gram whose sets may be linked by their sizes, and by ``condition``.

    Joined on gram and band of sizes: a set meets the bands of the sizes that its
    place in the gram's order leaves room for, three at most. ``condition`` has to
    imply :func:`_may_link`.
    """
    low, high = _partner_sizes()
    x = left.withColumn("band", _band(F.col("n")))
    y = right.where(low <= high).withColumn("band", F.explode(F.sequence(_band(low), _band(high))))
    same = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.band") == F.col("y.band"))
    return x.alias("x").join(y.alias("y"), same & condition, how)


def _remaining_pairs(open_: DataFrame, cut: DataFrame) -> DataFrame:
    """Pairs of different components that share a gram; the largest component of a gram is not paired with itself.

    ``cut`` has the whole sets of all classes in question. Grams that only one
    of these has are missing from every overlap still to be looked at, wherever
    in the set they stand.
    """
    some = stored(_alone(cut.where(F.col("fragment") < FIRST_ALONE)), "alone")
    # Of these fragments alone; what is still in question is looked for in the others.
    left = stored(_without_alone(open_, some).select("set").distinct(), "left")
    rest = cut.where(F.col("fragment") >= FIRST_ALONE).join(counted_small(left), "set", "left_semi")
    both = some.join(counted_small(left), "set", "left_semi").unionByName(_alone(rest))
    alone = stored(both.groupBy("set").agg(F.sum("alone").cast("int").alias("alone")), "alone")
    counted = _without_alone(open_.join(counted_small(left), "set", "left_semi"), alone).drop("main")
    counted = stored(_mixed_grams(counted), "open")
    release(some, left)
    # Each pair once a gram: the main component's classes only stand on the right.
    apart = (F.col("x.label") != F.col("y.label")) & (
        (F.col("y.label") == F.col("y.main")) | (F.col("x.set") < F.col("y.set"))
    )
    pairs = stored(_pairs(_met(counted.where("label != main"), counted, apart & _may_link("x", "y"))), "pairs")
    release(counted, alone)
    return pairs


def _alone(cut: DataFrame) -> DataFrame:
    """Per class the number of its grams in ``cut`` that no other class has there."""
    grams = cut.select("set", F.explode("grams").alias("gram")).groupBy("gram")
    single = grams.agg(F.count("*").alias("many"), F.min("set").alias("set")).where("many = 1")
    return single.groupBy("set").agg(F.count("*").cast("int").alias("alone"))


def _without_alone(open_: DataFrame, alone: DataFrame) -> DataFrame:
    """Postings whose set can still be linked, with the grams it has alone missing for certain, as those before the gram are."""
    counted = open_.join(counted_small(alone), "set", "left")
    counted = counted.withColumn("at", F.greatest("at", F.coalesce("alone", F.lit(0)))).drop("alone")
    # With the smallest partner allowed a quarter may be missing.
    return counted.where(100 * F.col("at") <= (100 - PERCENT) * F.col("n"))


def _fragments_of(docs: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """(set, fragment, grams) of the classes ``wanted``, each from one of its documents."""
    spark = docs.sparkSession
    needed = stored(wanted.distinct().join(classes.select("set", "doc_id"), "set"), "needed")
    few = needed.count() <= BROADCAST_IDS
    ids = needed.select("doc_id").where("doc_id is not null").distinct()
    ids = F.broadcast(ids) if few else ids
    # Classes without an id can only be found by their sets.
    docs = docs.select("doc_id", "text")
    docs = docs.join(ids, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
    names = None
    if few:  # 4 MB at most
        names = spark.sparkContext.broadcast(np.sort(needed.select("set").toArrow().column(0).to_numpy().astype(np.int64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = _Hasher(), set()
        listed = names.value if names is not None else None
        for batch in batches:
            sets, numbers, parts = [], [], []
            for own in _gram_sets(batch, 0, hasher):
                name = _signature(own)
                if not len(own) or name in seen:
                    continue
                if listed is not None:
                    at = int(np.searchsorted(listed, name))
                    if at == len(listed) or listed[at] != name:
                        continue
                seen.add(name)
                edges = np.searchsorted(own, np.arange(1, FRAGMENTS).astype(np.uint64) << np.uint64(64 - FRAGMENTS.bit_length() + 1))
                for k, part in enumerate(np.split(own, edges)):
                    if len(part):
                        sets.append(name)
                        numbers.append(k)
                        parts.append(part.view(np.int64))
            if sets:
                ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets, pa.int64()), pa.array(numbers, pa.int8()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))],
                    names=["set", "fragment", "grams"],
                )

    cutting = docs.select(text_or_empty().alias("text")).mapInArrow(cut, "set long, fragment byte, grams array<long>")
    if few:
        cut = stored(cutting, "fragments")
        # A class is cut in several tasks only by repeated ids or rows without one; else no set has to move.
        if not cut.groupBy("set", "fragment").count().where("count > 1").isEmpty():
            repeated, cut = cut, stored(cut.dropDuplicates(["set", "fragment"]), "fragments")
            release(repeated)
    else:
        cutting = cutting.join(needed.select("set"), "set", "left_semi")
        cut = stored(cutting.dropDuplicates(["set", "fragment"]), "fragments")
    release(needed)
    return cut


def _links(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """The pairs whose overlap, summed over the fragments ``cut``, is large enough: (a, b)."""
    first = _overlaps(pairs, cut.where(F.col("fragment") < FIRST_FRAGMENTS))
    # What one of a pair has alone in these fragments is missing from the whole overlap.
    most = F.least(F.col("n_a") - F.col("only_a"), F.col("n_b") - F.col("only_b"))
    left = stored(first.where(most >= _least_overlap(F.col("n_a"), F.col("n_b"))).drop("only_a", "only_b"), "left")
    rest = _overlaps(left.drop("overlap"), cut.where(F.col("fragment") >= FIRST_FRAGMENTS)).drop("only_a", "only_b")
    counted = left.unionByName(rest).groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    links = stored(counted.where(100 * F.col("overlap") >= PERCENT * union).select("a", "b"), "links")
    release(left)
    return links


def _overlaps(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """The pairs with their overlap in the fragments ``cut``, and the grams that only one of them has in fragments of both."""
    left = cut.select(F.col("set").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    right = cut.select(F.col("set").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    # One array of each pair has to move to the other; the pairs go to both where they are few.
    known = pairs
    if pairs.count() <= BROADCAST_KEYS:
        known = F.broadcast(pairs)
        right = right.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi")
    met = known.join(left, "a").join(right, ["b", "fragment"])
    part = F.size(F.array_intersect("grams_a", "grams_b"))
    only = [(F.size(f"grams_{c}") - part).alias(f"only_{c}") for c in ("a", "b")]
    # Pairs without a fragment in common have no overlap there.
    none = pairs.select("a", "b", "n_a", "n_b", *(F.lit(0).alias(c) for c in ("overlap", "only_a", "only_b")))
    counted = none.unionByName(met.select("a", "b", "n_a", "n_b", part.alias("overlap"), *only)).groupBy("a", "b", "n_a", "n_b")
    return counted.agg(*(F.sum(c).alias(c) for c in ("overlap", "only_a", "only_b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); the label is the component's smallest node.

    Alternating large and small stars: every round hangs nodes on smaller
    neighbours, in time that grows with the logarithm of the longest path.
    Neighbours are reduced to their minimum before they meet, so no node's
    neighbourhood is gathered.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges"
    )
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        former, current = current, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        release(former)
        before, mark = mark, _mark(current)
        if mark == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    labels = stored(current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots), "labels")
    release(current)
    return labels


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
    return row["n"], row["h"] or 0


def join(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, the smallest ``doc_id`` its links reach."""
    scanned = stored(_scanned(docs), "sets")
    rows = scanned.where("not is_gram").select("doc_id", F.col("hash").alias("set"), "n")
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    classes = stored(rows.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "classes")
    shared = _shared(_postings(docs, _frequent(scanned, total)), classes)
    star = stored(_star_pairs(shared), "pairs")
    ends = star.select(F.col("a").alias("set")).unionByName(star.select(F.col("b").alias("set")))
    cut = _fragments_of(docs, ends, classes)
    links = _links(star, cut)
    release(cut)
    labels = components(links)
    release(links)
    open_ = _open(shared, labels)
    release(shared)
    cut = _fragments_of(docs, open_.select("set"), classes)
    found = _remaining_pairs(open_, cut)
    rest = stored(found.join(star, ["a", "b"], "left_anti"), "pairs")
    release(open_, found, star)
    more = _links(rest, cut)
    release(cut, rest)
    hung = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    last = components(hung.unionByName(more))
    release(labels, more)
    named = classes.drop("n").join(last.withColumnRenamed("node", "set"), "set", "left").select(
        "set", "doc_id", F.coalesce("label", "set").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = stored(named.join(smallest, "label").select("set", "component_id"), "found")
    release(last, classes)
    return rows.join(found, "set", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest id, of equal ids one text; null ids come last.

    Rows equal in id and text stay or go together.
    """
    return without(docs, join(by_row(docs)).where("doc_id <> component_id"))
