"""Repair of conversation structure: the cheapest edits, and the audit string that names them.

Roles of a repaired conversation follow ``(system? (user assistant)+)?``. Row by row
a dynamic program keeps, for each of four states (nothing yet, after a system,
user or assistant turn), the cheapest edits that lead there, and of equally cheap
ones those whose initials are least in ASCII: Delete, Insert, Keep, Rerole.

Persistent audit: the edits of a state are a node of a tree, which shares its
prefix with all edits that begin alike. A node has its ancestors at the powers of
two above it and the rolling hash of its whole prefix. Equally cheap audits are
compared by a binary-lifting search of their longest common prefix; what the
hashes call equal is verified letter by letter up to the next pair that is known
to be equal, so that no collision decides, and verified pairs are remembered.
Equally cheap audits of one state cannot be prefixes of each other: both have
used the same rows, and every further insert costs.

Rows reach the program sorted by Spark, as a stream: one shuffle by conversation,
after which a task holds one row at a time, whatever the length of a
conversation. Per state it carries the running digest of the repaired text, so no
text waits for the end of its conversation. The nodes behind the last common
ancestor of all states that can still win are written out as text and forgotten,
so the tree holds the undecided end only. Rows said before are found by an
aggregate over (conversation, role, digest of the text), not by a set in memory.
A digest over a whole conversation demands that one task reads it in order.

Defined cases: a null id, turn, role or text is one space where it is text, null
ids are one conversation, and null turns come first; rows of one turn are
ordered by role and text; an empty role has the initial of a blank, so it is
never kept; a conversation all of whose rows went has zeros, an empty audit and
the digest of nothing; an empty table gives an empty result; further columns are
not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wickline.llm.common import BROADCAST_KEYS, stored

#: Costs of the edits; keeping is free, and a truncated row that stays costs one.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Nodes after which the decided prefix is written out.
SETTLE = 4_096

_MODULUS, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E6F1 % ((1 << 61) - 1)
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state after a turn of a role's initial, by the state before it.
_AFTER = {"s": {_START: _SYSTEM}, "u": dict.fromkeys((_START, _SYSTEM, _ASSISTANT), _USER), "a": {_USER: _ASSISTANT}}
_NAMED = {"u": "user", "a": "assistant"}


class Audits:
    """Strings that share prefixes, as nodes of a tree; node 0 is the empty string."""

    def __init__(self, modulus: int = _MODULUS) -> None:
        self.modulus = modulus
        self.up: list[tuple[int, ...]] = [()]  # ancestors 1, 2, 4, ... above
        self.depth, self.letter, self.hash = [0], [""], [0]
        self._same: dict[int, int] = {}  # nodes verified to be equal, towards a representative

    def add(self, node: int, letter: str) -> int:
        up, k = [node], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(tuple(up))
        self.depth.append(self.depth[node] + 1)
        self.letter.append(letter)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % self.modulus)
        return len(self.up) - 1

    def _root(self, node: int) -> int:
        while (above := self._same.get(node)) is not None:
            if (over := self._same.get(above)) is not None:
                self._same[node] = over
            node = above
        return node

    def ancestor(self, node: int, depth: int) -> int:
        while (gap := self.depth[node] - depth) > 0:
            node = self.up[node][gap.bit_length() - 1]
        return node

    def _verified(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth are the same string, whatever their hashes say."""
        walked = []
        while (a := self._root(a)) != (b := self._root(b)):
            if self.letter[a] != self.letter[b]:
                return False
            walked.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        for x, y in walked:
            x, y = self._root(x), self._root(y)
            if x != y:
                self._same[max(x, y)] = min(x, y)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether string ``a`` is less than string ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self._root(x) == self._root(y) or (self.hash[x] == self.hash[y] and self._verified(x, y)):
            return self.depth[a] < self.depth[b]
        # Up to the highest ancestors that differ; prefixes above them have equal hashes.
        k = len(self.up[x]) - 1
        while k >= 0:
            if k < len(self.up[x]) and (p := self.up[x][k]) != (q := self.up[y][k]) and self.hash[p] != self.hash[q]:
                x, y = p, q
            k -= 1
        if self.letter[x] == self.letter[y] or not self._verified(self.up[x][0], self.up[y][0]):
            return self._less_by_letters(a, b, depth)  # two different prefixes share a hash
        return self.letter[x] < self.letter[y]

    def _less_by_letters(self, a: int, b: int, depth: int) -> bool:
        x, y, first = self.ancestor(a, depth), self.ancestor(b, depth), None
        while x != y:
            if self.letter[x] != self.letter[y]:
                first = self.letter[x] < self.letter[y]
            x, y = self.up[x][0], self.up[y][0]
        return self.depth[a] < self.depth[b] if first is None else first

    def text(self, node: int, above: int = 0) -> str:
        """The letters of ``node`` below its ancestor ``above``."""
        letters = []
        while node != above:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def common(self, nodes: list[int]) -> int:
        """The lowest common ancestor of some nodes."""
        first = nodes[0]
        for other in nodes[1:]:
            depth = min(self.depth[first], self.depth[other])
            first, other = self.ancestor(first, depth), self.ancestor(other, depth)
            for k in range(len(self.up[first]) - 1, -1, -1):
                if k < len(self.up[first]) and self.up[first][k] != self.up[other][k]:
                    first, other = self.up[first][k], self.up[other][k]
            if first != other:
                first = self.up[first][0]
        return first


class _Best(NamedTuple):
    """The best edits that lead to a state: cost, audit, and the digest of the turns written so far."""

    cost: int
    node: int
    digest: object
    begun: bool


class Repair:
    """The dynamic program over the rows of one conversation, in order."""

    def __init__(self, modulus: int = _MODULUS, settle: int = SETTLE) -> None:
        self._modulus, self._settle = modulus, settle
        self._audits, self._decided = Audits(modulus), []
        self._best: dict[int, _Best] = {_START: _Best(0, 0, sha256(), False)}
        self._insert(self._best)

    def _offer(self, to: dict[int, _Best], state: int, before: _Best, cost: int, letter: str, turn: str | None) -> None:
        """Put the edit into ``to`` if it is the best there: the cheapest, and of these the least."""
        held, cost = to.get(state), before.cost + cost
        if held is not None and held.cost < cost:
            return
        node = self._audits.add(before.node, letter)
        if held is not None and held.cost == cost and not self._audits.less(node, held.node):
            return
        digest, begun = before.digest, before.begun
        if turn is not None:
            digest = digest.copy()
            digest.update((f"\n{turn}" if begun else turn).encode())
            begun = True
        to[state] = _Best(cost, node, digest, begun)

    def _insert(self, best: dict[int, _Best]) -> None:
        """Empty turns anywhere: from every state to the next, until nothing gets cheaper."""
        for _ in range(2):  # two inserts lead back to a state, at a price
            for state, before in list(best.items()):
                for initial, role in _NAMED.items():
                    if (after := _AFTER[initial].get(state)) is not None:
                        self._offer(best, after, before, INSERT, "I", f"{role}:")

    def row(self, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        best: dict[int, _Best] = {}
        initial = role[:1]
        for state, before in self._best.items():
            self._offer(best, state, before, DELETE, "D", None)
            if blank or duplicate:
                continue
            if (after := _AFTER.get(initial, {}).get(state)) is not None:
                self._offer(best, after, before, truncated * TRUNCATED, "K", f"{role}:{text}")
            for other, name in _NAMED.items():
                if (after := _AFTER[other].get(state)) is not None:
                    self._offer(best, after, before, REROLE + truncated * TRUNCATED, "R", f"{name}:{text}")
        self._insert(best)
        self._best = self._pruned(best)
        if len(self._audits.depth) > self._settle:
            self._write_out()

    @staticmethod
    def _pruned(best: dict[int, _Best]) -> dict[int, _Best]:
        """Without the states that can only lose.

        What follows a system turn can follow an assistant's as well. What follows
        the start can too, but for a system turn, which is deleted instead.
        """
        done = best[_ASSISTANT].cost if _ASSISTANT in best else None
        slack = {_SYSTEM: 0, _START: DELETE}
        return {s: b for s, b in best.items() if done is None or s not in slack or done + slack[s] >= b.cost}

    def _write_out(self) -> None:
        """Keep the tree below the common prefix of all states, and the prefix as text."""
        old, nodes = self._audits, [b.node for b in self._best.values()]
        above = old.common(nodes)
        self._decided.append(old.text(above))
        self._audits = fresh = Audits(self._modulus)
        moved = {above: 0}
        for node in nodes:
            path = []
            while node not in moved:
                path.append(node)
                node = old.up[node][0]
            for child in reversed(path):
                moved[child] = fresh.add(moved[old.up[child][0]], old.letter[child])
        self._best = {s: b._replace(node=moved[b.node]) for s, b in self._best.items()}
        # An undecided end that does not shrink is looked at half as often.
        self._settle = max(self._settle, 2 * len(fresh.depth))

    def end(self) -> tuple[int, str, str]:
        """cost, audit and digest of the best whole conversation."""
        ends = [self._best[s] for s in (_START, _ASSISTANT) if s in self._best]
        best = min(ends, key=lambda b: b.cost)
        for other in ends:
            if other.cost == best.cost and self._audits.less(other.node, best.node):
                best = other
        return best.cost, "".join(self._decided) + self._audits.text(best.node), best.digest.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """The rows by crc32(``conv_id:turn``) % 20: dropped, emptied, cut, repeated, given to the user, or as they are.

    conv_id, turn, role, text, ``gone``: a dropped row stays as a mark of its conversation.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        "conv_id",
        "turn",
        spaced("role").alias("role"),
        spaced("text").alias("text"),
        (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("fault"),
    )
    text = (
        F.when(F.col("fault").isin(0, 1), "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"), times.alias("times"))
    return rows.select("conv_id", "turn", "role", "text", "gone", F.explode("times").alias("again")).drop("again")


def repair(conversations: DataFrame, gone: str | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` holds conv_id, turn, role, text; the column named by ``gone``
    marks rows that only name their conversation.
    """
    key = ["conv_id", "role", "digest"]
    rows = conversations.select(
        "conv_id",
        "turn",
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
        (F.col(gone) if gone else F.lit(False)).alias("gone"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # Texts that a role says more than once in a conversation, and the first turn it does so in.
    turns = (F.count("*").alias("times"), F.min(F.struct(F.col("turn").isNotNull().alias("told"), "turn")).alias("first"))
    said = rows.where("not gone").groupBy(*key).agg(*turns).where("times > 1")
    said = stored(said.select(*(F.col(c).alias(f"of_{c}") for c in key), F.col("first.turn").alias("first")), "said")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv_id"))
    for c in key[1:]:
        same &= F.col(c) == F.col(f"of_{c}")
    few = said.count() <= BROADCAST_KEYS
    later = F.col("of_role").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    rows = rows.join(F.broadcast(said) if few else said, same, "left").select("conv_id", "turn", "role", "text", "gone", later.alias("later"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    fields = StructType(
        [
            conversations.schema["conv_id"],
            *(StructField(name, LongType()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
            StructField("audit", StringType()),
            StructField("repaired_sha256", StringType()),
        ]
    )
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_repaired(fields), fields)


class _Conversation:
    """The running counts and repair of the conversation that a task reads."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.repair = conv_id, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def row(self, turn: int | None, role: str, text: str, later: bool) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.turns == 0 else self.first, turn, self.turns + 1
        if self.before is not None:
            self.illegal += (self.before[1][:1] + role[:1]) not in ("su", "ua", "au")
        said = text.rstrip(" \t\n\v\f\r")
        blank = not said
        # Equal rows of one turn are neighbours; the first of them is the first one said.
        duplicate = not blank and (later or self.before == (turn, role, text))
        truncated = not blank and not duplicate and said[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.before = (turn, role, text)
        self.repair.row(role, text, blank, duplicate, truncated)

    def end(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.end()


def _repaired(fields: StructType):
    arrow = to_arrow_schema(fields)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []

        def told() -> pa.RecordBatch:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*done, strict=True), arrow.types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for conv_id, turn, role, text, gone, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.end())
                    current = _Conversation(conv_id)
                if not gone:
                    current.row(turn, role, text, later)
            if done:
                yield told()
                done = []
        if current is not None:
            done.append(current.end())
            yield told()

    return apply
