"""Language of a text by a bidirectional gated recurrent network over its bytes.

Two recurrent layers, one along the bytes and one against them, give every byte
position log odds over the languages, which are trained against the language of
the document; a document's probabilities are the mean of its positions'. The
network is trained here, in numpy, by backpropagation through time.

A text is read whole, as UTF-8, in windows of ``WINDOW`` bytes that each begin
with a blank state, so that a task holds some windows at a time whatever the
length of a text, and many windows take one step of the network together.

Training takes about ``MOST_ROWS`` windows of ``TRAINED`` bytes, spread evenly
over the ``MOST_LANGS`` most frequent languages, at places drawn from the row's
id, and several of a row where rows are few: the bounds are parameters, and
nothing else reaches the driver. Prediction covers every row.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as
is every text where no language was learned; rows with a null id, text or
language are not learned from; equal training windows of a language count once;
equal probabilities go to the language that comes first in the alphabet;
repeated rows are predicted each; an empty table gives an empty result; further
columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from wickline.llm.common import text_or_empty

UNKNOWN = "und"
#: Bounds of what is learned from.
MOST_ROWS, MOST_LANGS, TRAINED = 4_000, 64, 128
#: Windows of one row at most.
OF_A_ROW = 16
#: Width of each direction's state, and bytes read before the state is blank again.
HIDDEN, WINDOW = 16, 256
#: Training: passes over the rows and steps at least, rows in a step, step width, largest gradient norm.
PASSES, STEPS, ROWS, STEP, CLIP = 6, 150, 128, 0.02, 1.0
#: Floats that the states of one block of windows may take.
BLOCK_FLOATS = 8_000_000

Weights = dict[str, np.ndarray]


@dataclass
class Model:
    """The languages in alphabetical order and the network's weights; none: nothing learned."""

    langs: tuple[str, ...] = ()
    weights: Weights | None = None


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


# The network. Arrays are (step, direction, row, ...); direction 1 runs against the bytes.


def blank_weights(langs: int, hidden: int = HIDDEN, seed: int = 11) -> Weights:
    """``read``: what a byte adds to the update, reset and candidate gates; ``back``: what the state adds."""
    rng = np.random.default_rng(seed)
    wide = 1 / np.sqrt(hidden)
    return {
        "read": rng.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32),
        "back": rng.uniform(-wide, wide, (2, hidden, 3 * hidden)).astype(np.float32),
        "lean": np.zeros((2, 1, hidden), np.float32),
        "out": rng.uniform(-wide, wide, (2, hidden, langs)).astype(np.float32),
        "base": np.zeros(langs, np.float32),
    }


def both_ways(bytes_: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(rows, steps) bytes as (steps, 2, rows): each row as it is, and its own bytes reversed."""
    steps = bytes_.shape[1]
    turned = np.take_along_axis(bytes_, np.clip(lengths[:, None] - 1 - np.arange(steps), 0, None), 1)
    return np.stack([bytes_.T, turned.T], 1)


def run_network(w: Weights, given: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """The states after every step, (2, steps, rows, hidden); with ``keep`` also the gates of every step.

    The update and reset gates lie in an axis of their own and are computed as
    logistic(x) = (1 + tanh(x / 2)) / 2, with the halves taken into the weights.
    """
    hidden = w["lean"].shape[-1]
    steps, _, rows = given.shape
    kinds = w["read"].dtype
    read = w["read"].reshape(512, 3, hidden)
    gates_read = np.ascontiguousarray(read[:, :2].swapaxes(0, 1)) / 2
    gates_back = np.ascontiguousarray(np.moveaxis(w["back"].reshape(2, hidden, 3, hidden)[:, :, :2], 2, 0)) / 2
    new_read, new_back = np.ascontiguousarray(read[:, 2]), np.ascontiguousarray(w["back"][..., 2 * hidden :])
    places = given + np.array([0, 256], np.int64)[None, :, None]
    states = np.empty((2, steps, rows, hidden), kinds)
    state, kept = np.zeros((2, rows, hidden), kinds), []
    for t in range(steps):
        gates = np.matmul(state, gates_back)
        for gate, table in zip(gates, gates_read, strict=True):
            gate += np.take(table, places[t], axis=0)
        np.tanh(gates, out=gates)
        gates += 1
        gates /= 2
        update, reset = gates
        held = np.matmul(state, new_back)
        held += w["lean"]
        new = reset * held
        new += np.take(new_read, places[t], axis=0)
        np.tanh(new, out=new)
        if keep:
            kept.append((update, reset, held, new))
        # update * state + (1 - update) * new
        state = state - new
        state *= update
        state += new
        states[:, t] = state
    return states, kept


def _aligned(backward: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(langs, steps, rows) of the reversed rows, put at the places of the bytes."""
    steps = backward.shape[1]
    if (lengths == steps).all():
        return backward[:, ::-1]
    places = np.clip(lengths[None, :] - 1 - np.arange(steps)[:, None], 0, None)
    return np.take_along_axis(backward, places[None], 1)


def position_probabilities(w: Weights, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(langs, steps, rows): each byte's probabilities; those behind a row's end mean nothing."""
    _, steps, rows, hidden = states.shape
    one, other = (
        (out.T @ way.reshape(-1, hidden).T).reshape(-1, steps, rows) for out, way in zip(w["out"], states, strict=True)
    )
    one += _aligned(other, lengths)
    one += w["base"][:, None, None]
    one -= one.max(0)
    np.exp(one, out=one)
    one /= one.sum(0)
    return one


def loss_and_slopes(w: Weights, bytes_: np.ndarray, lengths: np.ndarray, lang: np.ndarray) -> tuple[float, Weights]:
    """Mean cross-entropy over all positions, and its gradient by backpropagation through time."""
    given = both_ways(bytes_, lengths)
    steps, _, rows = given.shape
    hidden = w["lean"].shape[-1]
    states, kept = run_network(w, given, keep=True)
    odds = position_probabilities(w, states, lengths)
    real = (np.arange(steps)[:, None] < lengths[None, :]).astype(odds.dtype)
    right = np.take_along_axis(odds, np.broadcast_to(lang, (1, steps, rows)), 0)[0]
    total = real.sum()
    loss = float(-(np.log(np.maximum(right, 1e-30)) * real).sum() / total)
    odds -= np.eye(len(odds), dtype=odds.dtype)[:, lang][:, None]
    odds *= real / total
    # The place of a byte in the reversed row is its mirror, so the same map leads back.
    sent = np.stack([odds, _aligned(odds, lengths) * real], 1)
    slopes = {name: np.zeros_like(value) for name, value in w.items()}
    slopes["base"] = odds.sum((1, 2))
    slopes["out"] = np.einsum("dtrh,kdtr->dhk", states, sent, optimize=True)
    into = np.einsum("kdtr,dhk->tdrh", sent, w["out"], optimize=True)
    read = np.empty((steps, 2, rows, 3 * hidden), odds.dtype)
    pull = np.zeros((2, rows, hidden), odds.dtype)
    back_t = np.swapaxes(w["back"], 1, 2)
    for t in range(steps - 1, -1, -1):
        update, reset, held, new = kept[t]
        before = states[:, t - 1] if t else np.zeros_like(pull)
        pull = pull + into[t]
        d_new = pull * (1 - update) * (1 - new * new)
        d_held = d_new * reset
        step = read[t]
        step[..., :hidden] = pull * (before - new) * update * (1 - update)
        step[..., hidden : 2 * hidden] = d_new * held * reset * (1 - reset)
        step[..., 2 * hidden :] = d_new
        through = np.concatenate([step[..., : 2 * hidden], d_held], -1)
        slopes["back"] += np.matmul(np.swapaxes(before, 1, 2), through)
        slopes["lean"] += d_held.sum(1, keepdims=True)
        pull = pull * update + np.matmul(through, back_t)
    for d in range(2):
        flat = given[:, d].ravel()
        order = np.argsort(flat, kind="stable")
        firsts = np.flatnonzero(np.diff(flat[order], prepend=-1))
        slopes["read"][d, flat[order][firsts]] = np.add.reduceat(read[:, d].reshape(-1, 3 * hidden)[order], firsts)
    return loss, slopes


def train(bytes_: np.ndarray, lengths: np.ndarray, lang: np.ndarray, langs: int, passes: int = PASSES) -> Weights:
    """Adam over mixed rows; the same rows in the same order give the same weights."""
    w = blank_weights(langs)
    rng = np.random.default_rng(7)
    first, second = ({name: np.zeros_like(v) for name, v in w.items()} for _ in range(2))
    a_pass = -(-len(lang) // ROWS)
    passes = max(passes, -(-STEPS // a_pass))
    done, steps = 0, passes * a_pass
    for _ in range(passes):
        order = rng.permutation(len(lang))
        for at in range(0, len(order), ROWS):
            rows = order[at : at + ROWS]
            slopes = loss_and_slopes(w, bytes_[rows], lengths[rows], lang[rows])[1]
            norm = np.sqrt(sum(float((s * s).sum()) for s in slopes.values()))
            done += 1
            width = STEP * min(1.0, 2 * (1 - (done - 1) / steps))  # level, then down to 0
            for name, slope in slopes.items():
                slope = slope * min(1.0, CLIP / (norm + 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.99 * second[name] + 0.01 * slope * slope
                w[name] = w[name] - (
                    width * (first[name] / (1 - 0.9**done)) / (np.sqrt(second[name] / (1 - 0.99**done)) + 1e-8)
                ).astype(np.float32)
    return w


# Learning from a table and predicting one.


def training_windows(
    docs: DataFrame, most_rows: int = MOST_ROWS, most_langs: int = MOST_LANGS, trained: int = TRAINED
) -> DataFrame:
    """lang, window of the rows to learn from: about ``most_rows`` windows of at most ``trained`` bytes."""
    known = docs.select("doc_id", "lang", "text").where("doc_id is not null and lang is not null and text is not null")
    known = known.where(~held_out())
    sizes = {
        r["lang"]: r["n"]
        for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs).collect()
    }
    if not sizes:
        return known.selectExpr("lang", "cast(text as binary) as window").limit(0)
    each = most_rows / len(sizes)
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, each / n) * 1_000_000))))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000))
    taken = known.where(drawn < F.coalesce(F.try_element_at(share, F.col("lang")), F.lit(0)))
    whole = F.encode("text", "utf-8")
    places = F.greatest(F.lit(1), F.length(whole) - trained + 1)
    windows = F.transform(
        F.sequence(F.lit(1), F.lit(int(max(1, min(OF_A_ROW, most_rows // sum(sizes.values())))))),
        lambda k: F.substring(whole, (F.pmod(F.xxhash64("doc_id", k), places) + 1).cast("int"), F.lit(trained)),
    )
    return taken.select("lang", F.explode(windows).alias("window")).where(F.length("window") > 0).distinct()


def fit(docs: DataFrame, most_rows: int = MOST_ROWS, most_langs: int = MOST_LANGS) -> Model:
    """A network from texts and their languages; about ``most_rows`` short windows reach the driver."""
    rows = training_windows(docs, most_rows, most_langs).orderBy("lang", "window").toArrow()
    langs = tuple(sorted(set(rows.column("lang").to_pylist())))
    if not langs:
        return Model()
    windows = rows.column("window").to_pylist()
    number = {lang: k for k, lang in enumerate(langs)}
    lang = np.array([number[x] for x in rows.column("lang").to_pylist()])
    lengths = np.array([len(x) for x in windows])
    bytes_ = np.zeros((len(windows), lengths.max()), np.int64)
    for row, window in zip(bytes_, windows, strict=True):
        row[: len(window)] = np.frombuffer(bytes(window), np.uint8)
    return Model(langs, train(bytes_, lengths, lang, len(langs)))


def probabilities(model: Model, texts: list[bytes], window: int = WINDOW) -> np.ndarray:
    """(texts, langs): the mean of the probabilities of all byte positions of each text, which is not empty."""
    langs = len(model.langs)
    sums = np.zeros((len(texts), langs))
    owners, starts = [], []
    for k, text in enumerate(texts):
        first = np.arange(0, len(text), window)
        starts.append(first)
        owners.append(np.full(len(first), k))
    owners, starts = np.concatenate(owners), np.concatenate(starts)
    sizes = np.array([len(t) for t in texts])
    lengths = np.minimum(window, sizes[owners] - starts)
    # Windows of like length share a block; most are full.
    order = np.argsort(lengths, kind="stable")
    width = max(1, BLOCK_FLOATS // (window * 2 * max(HIDDEN, langs)))
    for at in range(0, len(order), width):
        block = order[at : at + width]
        long = lengths[block]
        bytes_ = np.zeros((len(block), long.max()), np.int64)
        for row, k, start, n in zip(bytes_, owners[block], starts[block], long, strict=True):
            row[:n] = np.frombuffer(texts[k], np.uint8, n, start)
        states, _ = run_network(model.weights, both_ways(bytes_, long))
        odds = position_probabilities(model.weights, states, long)
        odds *= np.arange(odds.shape[1])[:, None] < long[None, :]
        np.add.at(sums, owners[block], odds.sum(1, dtype=np.float64).T)
    return sums / sizes[:, None]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row: the likeliest language and its probability."""
    schema = StructType([docs.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            told = [k for k, text in enumerate(texts) if model.langs and any(map(str.isalpha, text))]
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if told:
                odds = probabilities(model, [texts[k].encode() for k in told])
                for k, best, row in zip(told, odds.argmax(1), odds, strict=True):
                    langs[k], scores[k] = model.langs[best], min(1.0, row[best])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names
            )

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(apply, schema)
