"""Toxicity by multiple-instance learning: sentences score, documents are their noisy-or.

Only documents are labelled. Each sentence has a logistic score from the words
in it and the beginnings of its longer words; a document is toxic when at least
one sentence is, so its score is 1 - prod(1 - sentence score). Training descends
the log loss of that noisy-or on document labels, which moves the weight to the
sentences that explain a label; those sentences are what ``sentences`` reports.

Training takes about ``MOST_DOCS`` labelled documents, drawn by hashed id, with
whole texts; features are counted over these in Spark, and the ``MOST_FEATURES``
that tell the classes apart best are kept. A document reaches the driver as the
numbers of its features, two bytes each; where those of all would pass
``MOST_HITS``, fewer documents are drawn, and one that holds a sixteenth of that
by itself is not learned from. All three bounds are parameters. Descent then runs
over blocks of ``BLOCK`` hits. Scoring covers every document. Labels, language,
source and ids are never part of a score.

Defined cases: null text is empty, and a text without a word scores 0 as no
sentence can offend; null labels or ids are not learned from; several labels of
an id count as their largest, and of several texts of an id the least in order of
bytes is learned from; repeated rows are scored each; without both classes to
learn from every score is 0; an empty table gives an empty result; further
columns are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import per_text, release, stored, text_or_empty

#: Bounds of what is learned from and kept.
MOST_DOCS, MOST_FEATURES, LEAST_DOCS = 20_000, 8_192, 4
MOST_HITS, BLOCK = 32_000_000, 1_000_000
#: Letters of a word's beginning that are features of their own.
STARTS = (3, 4, 5, 6, 7, 8)
#: Training: passes of full-batch descent, step, and weight penalty.
PASSES, STEP, PENALTY = 150, 0.15, 1e-4

_SENTENCE, _WORD = re.compile(r"[.!?\n\r]+"), re.compile(r"[^\W_]+")


@dataclass
class Model:
    """Weights by feature, and the score of a sentence without any as log odds."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -30.0


def _features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}-" for k in STARTS if len(word) > k)]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS) -> DataFrame:
    """doc_id, toxic, text of the labelled documents to learn from: one row an id, about ``most_docs`` at most."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(~held_out())
    )
    total = known.count()
    if total > most_docs:
        share = F.lit(int(most_docs / total * 1_000_000))
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share)
    # The bounded label table goes to the documents, not their texts to it.
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    found = texts.join(F.broadcast(known) if total <= 50 * most_docs else known, "doc_id")
    return found.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))


def _sentence_words(text: str) -> list[list[str]]:
    return [words for s in _SENTENCE.split(text.lower()) if (words := _WORD.findall(s))]


def _choose(rows: DataFrame, most_features: int) -> tuple[dict[str, int], dict[int, int]]:
    """The features kept, numbered, and the documents of each class."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                words = set(_WORD.findall(text.lower()))
                for feature in {f for w in words for f in _features(w)}:
                    seen.setdefault(feature, [0, 0])[toxic] += 1
            yield pd.DataFrame(
                {"feature": list(seen), "clean": [v[0] for v in seen.values()], "toxic": [v[1] for v in seen.values()]}
            )

    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return {}, sizes
    counts = (
        rows.mapInPandas(counted, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= LEAST_DOCS)
    )
    # Log-likelihood gain of the feature's class rates over the common rate.
    n0, n1 = F.lit(float(sizes[0])), F.lit(float(sizes[1]))
    share = n1 / (n0 + n1)
    seen = F.col("clean") + F.col("toxic")
    rate = F.col("toxic") / seen
    gain = F.coalesce(F.col("toxic") * F.log(rate / share), F.lit(0.0)) + F.coalesce(
        F.col("clean") * F.log((1 - rate) / (1 - share)), F.lit(0.0)
    )
    best = counts.select("feature", gain.alias("gain")).orderBy(F.desc("gain"), "feature").limit(most_features)
    return {r["feature"]: k for k, r in enumerate(best.collect())}, sizes


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_docs: int = MOST_DOCS,
    most_features: int = MOST_FEATURES,
    most_hits: int = MOST_HITS,
) -> Model:
    """A model from document labels; what reaches the driver is bounded by the parameters."""
    if most_features > 1 << 16:
        raise ValueError("a feature's number has two bytes")
    rows = stored(training_rows(docs, labels, most_docs), "toxic-train")
    index, sizes = _choose(rows, most_features)
    if not index:
        release(rows)
        return Model()
    hits = stored(_numbered(rows, index), "toxic-hits")
    release(rows)
    bags = _gathered(hits, most_hits)
    release(hits)
    return _descend(bags, list(index))


def _numbered(rows: DataFrame, index: dict[str, int]) -> DataFrame:
    """Per document: toxic, ``blank`` sentences without a feature, and of the others ``sizes`` (int32) and ``hits`` (uint16)."""
    fields = "doc_id " + rows.schema["doc_id"].dataType.simpleString() + ", toxic int, blank int, sizes binary, hits binary"

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blanks, sizes, hits = [], [], []
            for text in batch.column(2).to_pylist():
                found, blank = [], 0
                for words in _sentence_words(text):
                    own = sorted({index[f] for w in words for f in _features(w) if f in index})
                    if own:
                        found.append(own)
                    else:
                        blank += 1
                blanks.append(blank)
                sizes.append(np.array([len(own) for own in found], np.int32).tobytes())
                hits.append(np.array([k for own in found for k in own], np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(blanks, pa.int32()), pa.array(sizes, pa.binary()), pa.array(hits, pa.binary())],
                names=["doc_id", "toxic", "blank", "sizes", "hits"],
            )

    return rows.select("doc_id", "toxic", "text").mapInArrow(numbered, fields)


@dataclass
class Bags:
    """Documents as bags of sentences: labels, sentences without features, and all others end to end."""

    label: np.ndarray
    blank: np.ndarray
    #: Of each sentence its document and number of hits, and the hits of all.
    owner: np.ndarray
    sizes: np.ndarray
    hits: np.ndarray


def _gathered(hits: DataFrame, most_hits: int) -> Bags:
    """The bags on the driver, flat: 2 bytes a hit and 12 a sentence."""
    long = F.length("hits") / 2
    fits = hits.where(long * 16 <= most_hits)
    total = fits.agg(F.sum(long)).first()[0] or 0
    if total > most_hits:
        drawn = F.pmod(F.xxhash64("doc_id", F.lit("hits")), F.lit(1_000_000))
        fits = fits.where(drawn < int(most_hits / total * 1_000_000))
    taken = fits.orderBy(F.xxhash64("doc_id"), "doc_id").select("toxic", "blank", "sizes", "hits").toArrow()
    sizes = [np.frombuffer(x.as_buffer(), np.int32) for x in taken.column("sizes")]
    numbers = [np.frombuffer(x.as_buffer(), np.uint16) for x in taken.column("hits")]
    return Bags(
        label=taken.column("toxic").to_numpy().astype(float),
        blank=taken.column("blank").to_numpy().astype(float),
        owner=np.repeat(np.arange(len(sizes)), [len(x) for x in sizes]),
        sizes=np.concatenate([*sizes, np.empty(0, np.int32)]),
        hits=np.concatenate([*numbers, np.empty(0, np.uint16)]),
    )


def _blocks(bags: Bags) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(sentences, their hits, the first hit of each sentence within these), about ``BLOCK`` hits at a time."""
    ends = np.cumsum(bags.sizes, dtype=np.int64)
    first = start = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, start + BLOCK, "right")))
        sizes = bags.sizes[first:last]
        yield slice(first, last), slice(start, int(ends[last - 1])), np.cumsum(sizes) - sizes
        first, start = last, int(ends[last - 1])


def loss_and_slopes(bags: Bags, weights: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
    """Mean log loss of the noisy-or, and its slopes by weight and bias; no penalty."""
    odds = np.empty(len(bags.sizes))
    for sentences, hits, starts in _blocks(bags):
        odds[sentences] = bias + np.add.reduceat(weights[bags.hits[hits]], starts)
    # -log(1 - sigmoid(x)) is softplus(x): the noisy-or adds them up over a document.
    none = np.bincount(bags.owner, np.logaddexp(0, odds), len(bags.label)) + bags.blank * np.logaddexp(0, bias)
    none = np.maximum(none, 1e-12)
    loss = np.where(bags.label == 1, -np.log(-np.expm1(-none)), none).mean()
    # d loss / d none: toxic rows want it large, clean rows want it 0.
    slope = np.where(bags.label == 1, -1 / np.expm1(np.minimum(none, 50)), 1.0) / len(bags.label)
    pull = slope[bags.owner] / (1 + np.exp(-odds))
    slant = np.zeros(len(weights))
    for sentences, hits, _ in _blocks(bags):
        slant += np.bincount(bags.hits[hits], np.repeat(pull[sentences], bags.sizes[sentences]), len(weights))
    return float(loss), slant, float(pull.sum() + (slope * bags.blank).sum() / (1 + np.exp(-bias)))


def _descend(bags: Bags, features: list[str]) -> Model:
    """Full-batch Adam on the noisy-or log loss. Sentences without features share the bias's score."""
    weights, bias = np.zeros(len(features)), -6.0
    first, second = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, PASSES + 1):
        _, slant, tilt = loss_and_slopes(bags, weights, bias)
        slant = np.append(slant + PENALTY * weights, tilt)
        first, second = 0.9 * first + 0.1 * slant, 0.999 * second + 0.001 * slant * slant
        move = STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], min(-1.0, bias - move[-1])
    return Model({f: float(w) for f, w in zip(features, weights, strict=True) if abs(w) > 1e-6}, float(bias))


def _known_features(model: Model) -> Callable[[str], tuple[str, ...]]:
    """The features of a word that have a weight, remembered."""
    weights, known = model.weights, {}

    def of(word: str) -> tuple[str, ...]:
        found = known.get(word)
        if found is None:
            found = tuple(f for f in _features(word) if f in weights)
            if len(known) < 500_000:
                known[word] = found
        return found

    return of


def _softplus(x: float) -> float:
    return float(np.logaddexp(0, x))


def _scorer(model: Model) -> Callable[[str], tuple[float, int, list[tuple[str, float]]]]:
    """A function of a text: its score, its sentences, and those with features and their log odds."""
    of, weights, base = _known_features(model), model.weights, _softplus(model.bias)

    def scored(text: str) -> tuple[float, int, list[tuple[str, float]]]:
        none, count, spans = 0.0, 0, []
        for part in _SENTENCE.split(text):
            words = set(_WORD.findall(part.lower()))
            if words:
                count += 1
                hits = {f for w in words for f in of(w)}
                if hits:
                    odds = model.bias + sum(weights[f] for f in hits)
                    none += _softplus(odds)
                    spans.append((part, odds))
                else:
                    none += base
        return float(-np.expm1(-none)), count, spans

    return scored


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, score, predicted, n_sentences, and the ``offending`` sentences.

    ``offending`` holds (start, end, score) in code points of every sentence that
    scores 0.5 or more by itself, or the highest one where only their union does.
    """

    def make() -> Callable[[str], tuple]:
        scorer = _scorer(model)

        def scored(text: str) -> tuple:
            total, count, spans = scorer(text)
            return total, int(total >= 0.5), count, _located(text, spans, total)

        return scored

    fields = "score double, predicted int, n_sentences int, offending array<struct<start:int,end:int,score:double>>"
    return per_text(docs, ["doc_id"], make, fields)


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, as they are."""
    place = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            yield batch.filter(pa.array([scorer(text or "")[0] < 0.5 for text in texts], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def _located(text: str, spans: list[tuple[str, float]], total: float) -> list[dict]:
    """The places of the sentences that offend, searched in order."""
    if total < 0.5 or not spans:
        return []
    high = max(odds for _, odds in spans)
    found, at = [], 0
    for part, odds in spans:
        at = text.index(part, at)
        if odds >= 0 or odds == high:
            lead = len(part) - len(part.lstrip())
            found.append({"start": at + lead, "end": at + len(part.rstrip()), "score": float(1 / (1 + np.exp(-odds)))})
        at += len(part)
    return found
