"""Language identification: gradients, held-out accuracy, whole texts, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import AWKWARD, CLASHING, SF_DIR
from wickline.llm import language_id
from wickline.llm.common import table
from wickline.llm.queries import op11_language_id


def slow_probabilities(w, text):
    """One byte at a time, scalar gates, straight from the formulas."""
    hidden = w["lean"].shape[-1]
    logistic = lambda x: 1 / (1 + np.exp(-x))
    odds = np.zeros((len(text), len(w["base"])))
    for way, places in enumerate((range(len(text)), range(len(text) - 1, -1, -1))):
        state = np.zeros(hidden)
        for t in places:
            read, back = w["read"][way, text[t]], state @ w["back"][way]
            update = logistic(read[:hidden] + back[:hidden])
            reset = logistic(read[hidden : 2 * hidden] + back[hidden : 2 * hidden])
            new = np.tanh(read[2 * hidden :] + reset * (back[2 * hidden :] + w["lean"][way, 0]))
            state = update * state + (1 - update) * new
            odds[t] += state @ w["out"][way]
    odds = np.exp(odds + w["base"])
    return odds / odds.sum(1, keepdims=True)


def test_network_matches_the_formulas_byte_by_byte():
    rng = np.random.default_rng(2)
    model = language_id.Model(("a", "b", "c"), language_id.blank_weights(3))
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (1, 2, 31, 32, 33, 64, 100, 7)]
    want = []
    for text in texts:
        parts = [slow_probabilities(model.weights, text[k : k + 32]) for k in range(0, len(text), 32)]
        want.append(np.concatenate(parts).mean(0))
    assert np.allclose(language_id.probabilities(model, texts, window=32), want, atol=1e-5)


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in language_id.blank_weights(3, 4).items()}
    bytes_, lengths, lang = rng.integers(0, 256, (5, 7)), np.array([7, 3, 1, 5, 7]), np.array([0, 1, 2, 0, 1])
    slopes = language_id.loss_and_slopes(w, bytes_, lengths, lang)[1]
    for name, value in w.items():
        for _ in range(15):
            place = tuple(rng.integers(0, n) for n in value.shape)
            if name == "read":
                place = (place[0], int(bytes_[rng.integers(5), 0]), place[2])
            kept, sides = value[place], []
            for step in (1e-5, -1e-5):
                value[place] = kept + step
                sides.append(language_id.loss_and_slopes(w, bytes_, lengths, lang)[0])
            value[place] = kept
            assert abs((sides[0] - sides[1]) / 2e-5 - slopes[name][place]) < 1e-8


def test_held_out_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    told = op11_language_id(spark, SF_DIR)
    assert told.columns == ["doc_id", "held_out", "lang_pred", "score"] and told.count() == docs.count()
    right = told.where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95
    assert told.where("score < 0 or score > 1 or score is null").count() == 0


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(k, "the cat and the dog of this house", "en") for k in range(60)]
    rows += [(100 + k, "der hund und die katze nicht das haus", "de") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    varied = docs.withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string")))
    return language_id.fit(varied)


def test_awkward_rows(spark, learned):
    rows = [(i, t, "en") for i, t in [*AWKWARD, (50, "123 !?"), (51, "²³"), (52, "é")]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'x' as {name}")
    told = language_id.predict(docs, learned).collect()
    assert len(told) == len(rows)
    for (_, text, _), row in zip(rows, told, strict=True):
        blank = not text or not any(map(str.isalpha, text))
        assert (row["lang_pred"] == "und") == blank and (row["score"] == 0.0) == blank


def test_the_end_of_a_long_text_counts(learned):
    english, german = b"the cat and the dog of this house ", b"der hund und die katze nicht das haus "
    odds = language_id.probabilities(learned, [english * 3000, german * 3000, english * 1000 + german * 2000])
    assert learned.langs == ("de", "en") and odds[0][1] > 0.6 and odds[1][0] > 0.6
    bytes_ = np.array([len(english), 2 * len(german)])
    assert np.allclose(odds[2], bytes_ @ odds[:2] / bytes_.sum(), atol=0.01)


def test_what_is_learned_from(spark, learned):
    schema = "doc_id long, text string, lang string"
    assert language_id.fit(spark.createDataFrame([], schema)) == language_id.Model()
    rows = [(None, "a", "en"), (1, None, "en"), (2, "a", None), (3, "", "en")]
    assert language_id.fit(spark.createDataFrame(rows, schema)) == language_id.Model()
    told = language_id.predict(spark.createDataFrame([(1, "a", "en")], schema), language_id.Model()).first()
    assert (told["lang_pred"], told["score"]) == ("und", 0.0)
    many = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 10 = 0, 'xx', 'yy') as lang")
    taken = language_id.training_windows(many, most_rows=400).groupBy("lang").count().collect()
    assert {r["lang"] for r in taken} == {"xx", "yy"} and all(120 <= r["count"] <= 280 for r in taken)
    one = many.withColumn("doc_id", F.lit(1).cast("long")).withColumn("text", F.lit("same"))
    assert language_id.training_windows(one, most_rows=10**6).count() == 2
