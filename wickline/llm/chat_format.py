"""Chat formatting by prefix-target expansion, DataFrame functions only.

Each assistant turn becomes one example: all turns before it are context and
only its own reply is trainable. A turn is written as

    <s>[INST] role [/INST]text</s>

Inside roles and texts every control string gets a ``~`` behind its first
character, one more where it already has some, so that a control string in the
output is always a mark of the template and ``unescape`` restores the input.

Examples of one conversation share a prefix, so each row of ``examples`` holds
of its text what the example before it does not have: the turns added since, the
target last. Where its text and its target end in the formatted conversation are
running sums over the sorted turns, in one shuffle by conversation. ``expand``
spells the texts out, one row per example, and ``read_back`` reads each of them:
that takes time in proportion to the texts, which grow with the square of a
conversation's turns; each is made, read and dropped where it is made, and is
neither shuffled nor sorted. ``digest`` finds the same by ``read_added``, from what
the examples add alone, in proportion to the conversation. All hold a conversation
as one row, as any digest over a whole conversation demands.

Defined cases: null text or role is empty, null turns come first, equal turns
are ordered by role and text; a null conversation id is a conversation; turns
behind the last assistant turn, or a conversation without one, make one example
without a target; an empty table gives an empty result; further columns are not
touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\[(~*)(/?INST\])", r"[~$1$2"), r"<(~*)(/?s>)", r"<~$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\[~(~*)(/?INST\])", r"[$1$2"), r"<~(~*)(/?s>)", r"<$1$2")


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, n_turns, start, added, n_chars, loss_start, loss_end, whole.

    An example's text has ``n_chars`` code points: those before ``start`` are the
    text of the example before it, the others are ``added``. The code points from
    ``loss_start`` to ``loss_end`` (exclusive) are trainable: the target's, or none.
    The last example of a conversation, marked ``whole``, holds all its turns.
    """
    said = conversations.select(
        "conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    )
    head, body = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE)), escape(F.col("text"))
    target = F.col("role") == "assistant"
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = said.select(
        "conv_id",
        "role",
        "text",
        (F.row_number().over(order) - 1).alias("at"),
        F.coalesce(F.sum(F.length(F.concat(head, body, F.lit(CLOSE)))).over(before), F.lit(0)).alias("start"),
        # A turn is added by the first example that has it: turns behind as many targets are added together.
        F.count_if(target).over(before).alias("targets"),
        F.lead(F.lit(True)).over(order).isNull().alias("last"),
    )
    end = F.col("start") + F.length(head) + F.length(body)
    turns = placed.select(
        "conv_id",
        "targets",
        F.struct("at", F.concat(head, body, F.lit(CLOSE)).alias("piece")).alias("turn"),
        "at",
        "start",
        F.when(target, F.col("start") + F.length(head)).otherwise(end).alias("loss_start"),
        end.alias("loss_end"),
        "last",
    )
    grown = turns.groupBy("conv_id", "targets").agg(
        F.max("at").alias("example"),
        F.min("start").alias("start"),
        F.array_join(F.sort_array(F.collect_list("turn"))["piece"], "").alias("added"),
        # Of the last turn, as places grow with the turns.
        F.max("loss_start").alias("loss_start"),
        F.max("loss_end").alias("loss_end"),
        F.max("last").alias("whole"),
    )
    return grown.select(
        "conv_id",
        "example",
        (F.col("example") + 1).alias("n_turns"),
        "start",
        "added",
        (F.col("loss_end") + len(CLOSE)).alias("n_chars"),
        "loss_start",
        "loss_end",
        "whole",
    )


def expand(conversations: DataFrame) -> DataFrame:
    """The examples with their texts: conv_id, example, n_turns, text, loss_start, loss_end, whole.

    ``text`` is the prefix of turns with the target last.
    """
    row = F.struct("example", "n_turns", "added", "n_chars", "loss_start", "loss_end", "whole")
    gathered = examples(conversations).groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    each = gathered.select(
        "conv_id",
        F.array_join("rows.added", "").alias("all_text"),
        F.inline(F.transform("rows", lambda r: r.dropFields("added"))),
    )
    text = F.substring(F.col("all_text"), F.lit(1), F.col("n_chars").cast("int"))
    return each.select("conv_id", "example", "n_turns", text.alias("text"), "loss_start", "loss_end", "whole")


def read_back(texts: DataFrame) -> DataFrame:
    """Per conversation, read from the ``text`` of every example of :func:`expand`: its turns and the trained text."""
    trained = F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    read = texts.select(
        "conv_id",
        "example",
        unescape(trained).alias("loss"),
        F.length("text").alias("n_chars"),
        F.when(F.col("whole"), F.col("text")).alias("whole_text"),
        # Not deterministic to the optimizer, which therefore leaves the texts out of what is aggregated.
        F.spark_partition_id().alias("task"),
    )
    gathered = read.groupBy("conv_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("example", "loss")))["loss"], "").alias("loss_text"),
        F.sum("n_chars").cast("long").alias("formatted_chars"),
        F.array_join(F.collect_list("whole_text"), "").alias("all_text"),
        F.max("task").alias("task"),
    )
    return _parsed(gathered)


def read_added(examples: DataFrame) -> DataFrame:
    """What :func:`read_back` finds, from what the rows of :func:`examples` add."""
    trained = F.substring(
        F.col("added"), (F.col("loss_start") - F.col("start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")
    )
    gathered = examples.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("example", "added", unescape(trained).alias("loss")))).alias("said"),
        F.sum("n_chars").cast("long").alias("formatted_chars"),
    )
    return _parsed(
        gathered.select(
            "conv_id",
            F.array_join("said.loss", "").alias("loss_text"),
            "formatted_chars",
            F.array_join("said.added", "").alias("all_text"),
        )
    )


def _parsed(gathered: DataFrame) -> DataFrame:
    """The turns of ``all_text``, the formatted conversation, beside what else was found."""
    parts = F.split("all_text", CLOSE, -1)
    parsed = gathered.select("conv_id", F.slice(parts, F.lit(1), F.size(parts) - 1).alias("turns"), "loss_text", "formatted_chars")
    said = F.transform(
        "turns",
        lambda t: F.concat(
            unescape(F.substring(F.substring_index(t, MIDDLE, 1), F.lit(len(OPEN) + 1), F.length(t))),
            F.lit("\n"),
            unescape(F.substring(t, F.length(F.substring_index(t, MIDDLE, 1)) + len(MIDDLE) + 1, F.length(t))),
            F.lit("\n"),
        ),
    )
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(said, "").alias("turns_text"), "loss_text", "formatted_chars"
    )


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of what :func:`read_added` finds, per conversation."""
    return _digests(read_added(examples(conversations)))


def digest_texts(conversations: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of what :func:`read_back` finds in the spelled out examples, per conversation."""
    return _digests(read_back(expand(conversations)))


def _digests(found: DataFrame) -> DataFrame:
    return found.select(
        "conv_id",
        "n_turns",
        F.sha2("turns_text", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )
