import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark import AccumulatorParam
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.fixtures import AWKWARD, docs_frame, prose
from wickline.llm import decontaminate, packing, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(1)
    bits = ["Hello", " world", "'ll", "é", "日本", " ", "  ", "\n\n", "\t", "123", "!?", "<|endoftext|>", "\u00a0", "🙂", "\x00", "ſ"]
    ids = packing.token_ids(PATH)
    for _ in range(400):
        text = "".join(rng.choices(bits, k=rng.randint(0, 20)))
        assert ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def checked(spark, tokenizer, rows, capacity):
    df = docs_frame(spark, rows).repartition(4)
    found = packing.pack_documents(df, PATH, capacity, with_ids=True)
    pieces = found.collect()
    whole = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows]
    assert sum(p.length for p in pieces) == sum(map(len, whole))
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        assert p.start == (0 if p.piece == 0 else p.start) and p.length == capacity or p.piece == 0
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    joined = {}
    for p in sorted(pieces, key=lambda p: p.start):
        joined.setdefault(p.doc_id, []).extend(p.ids)
    for (i, _), ids in zip(rows, whole):
        if [j for j, _ in rows].count(i) == 1:
            assert joined[i] == ids
    assert packing.sequences(found).count() == len(bins)
    return len(bins), -(-sum(map(len, whole)) // capacity)


def test_pieces_and_places(spark, tokenizer):
    rng = random.Random(2)
    rows = [(100 + k, prose(rng, rng.randint(0, 90))) for k in range(150)] + [(400 + k, None) for k in range(60)] + AWKWARD
    used, least = checked(spark, tokenizer, rows, 256)
    assert used <= least + 1


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "a" + " \t\n" * 400_000 + "b", "x" + " " * 700_000])
def test_long_runs_of_white_space_have_the_tokenizers_ids(tokenizer, text):
    assert packing.token_ids(PATH)(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_of_nothing(spark):
    assert packing.pack_documents(docs_frame(spark, []), PATH).collect() == []


def test_fullest_combination_is_the_best():
    import itertools

    rng = random.Random(3)
    for _ in range(200):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        counts = {n: lengths.count(n) for n in lengths}
        chosen = packing._fullest(dict(counts), 40)
        assert all(chosen.count(n) <= counts[n] for n in chosen) and max(lengths) in chosen
        rest = sorted(lengths)[:-1]
        best = max(sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k) if sum(c) + max(lengths) <= 40)
        assert sum(chosen) == max(lengths) + best


def test_combinations_hold_the_histogram():
    rng = random.Random(4)
    histogram = {n: rng.randint(1, 5000) for n in rng.sample(range(1, 2048), 900)} | {2048: 77}
    bins = packing.combinations(dict(histogram))
    held = {}
    for times, lengths in bins:
        assert sum(lengths) <= 2048
        for n in lengths:
            held[n] = held.get(n, 0) + times
    assert held == histogram
    total = sum(n * k for n, k in histogram.items())
    apart = sum(k for n, k in histogram.items() if n > 1024)  # no two of these share a bin
    assert sum(t for t, _ in bins) <= 1.01 * max(total / 2048, apart) + 2


def contaminated(rows, items, coverage=0.6):
    """Every alignment of every item with every row; an item's tokens found on alignments with a seed."""
    import re

    def tokens(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    out = {}
    for d, t in rows:
        w = tokens(t)
        for i, text in items:
            x = tokens(text)
            if not x:
                continue
            hit = set(range(len(x))) if w == x and len(x) < 5 else set()
            for start in range(-len(x), len(w)):
                same = {j for j in range(len(x)) if 0 <= start + j < len(w) and w[start + j] == x[j]}
                if any(all(k + p in same for p, b in enumerate(m) if b == "1") and 0 <= start + k and start + k + len(m) <= len(w) and k + len(m) <= len(x) for m in decontaminate.MASKS for k in range(len(x))):
                    hit |= same
            if len(hit) >= (coverage if len(x) >= 9 else 1) * len(x):
                out[d, i] = max(len(hit), out.get((d, i), 0))
    return out


@pytest.mark.parametrize("block", [2000, 3])
def test_decontamination_is_brute_force(spark, block):
    rng = random.Random(6)
    items = [(k, prose(rng, rng.randint(10, 40), 400)) for k in range(8)] + [(8, None), (9, "too short"), (10, ""), (11, "one")]
    items += [(20 + n, prose(rng, n, 400)) for n in range(3, 10)] + [(11, "another text of this id, of six")]
    rows = []
    for k in range(90):
        words = prose(rng, rng.randint(0, 80), 400).split()
        if k % 3 == 0:
            own = rng.choice([t for _, t in items if t]).split()
            own = [w if rng.random() > 0.15 * (k % 2) else "zz" for w in own]
            if k % 2:
                own.insert(len(own) // 2, "extra")
            words[10:10] = [w.upper() + "!!" for w in own]
        rows.append((k, "  ".join(words)))
    rows += [(71, None), (72, ""), (73, items[0][1]), (73, items[0][1]), (74, "Too short."), (75, "too short, not"), (76, "ONE")]
    rows += [(80 + n, f"so it is said {t} and so on") for n, (_, t) in enumerate(items[-8:])]
    half = items[0][1].split()
    rows += [(r, " ".join(part)) for r in (200, None) for part in (half[: len(half) // 2], half[len(half) // 2 :])]
    rows += [(None, items[1][1]), (None, f"x {items[2][1]} y")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'q' as h", "1 as number", "0 as row")
    found = decontaminate.matches(docs_frame(spark, rows), benchmark, block_items=block).collect()
    want = contaminated(rows, items)
    assert {(r.doc_id, r.item_id): r.matched for r in found} == want and len(found) == len(want)
    assert (200, 0) not in want and (None, 1) in want and (74, 9) in want and (75, 9) not in want
    assert any(20 <= i < 28 for _, i in want)


def test_a_long_item_is_broadcast_once_not_at_each_seed(spark):
    words = [f"w{k}" for k in range(6000)]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[::-1]))], "item_id long, text string")
    rows = [(1, " ".join(["x", *words, "y"])), (2, " ".join(words[:3000])), (3, " ".join(words[:2000] + ["z"] + words[2000:5000]))]
    found = decontaminate.matches(docs_frame(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.matched, r.first_token) for r in found} == {(1, 1, 6000, 1), (3, 1, 5000, 0)}


def test_blocks_hold_few_tokens_and_find_the_same(spark):
    rng = random.Random(8)
    items = [(k, prose(rng, 30, 400)) for k in range(6)]
    rows = [(k, f"as {items[k % 6][1]} is said") for k in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole, parts = (sorted(decontaminate.matches(docs_frame(spark, rows), benchmark, block_tokens=n).collect()) for n in (10**6, 50))
    assert whole == parts and {(r.doc_id, r.item_id) for r in parts} == {(k, k % 6) for k in range(12)}


def test_the_pipelines_stage_takes_a_long_item(spark, tmp_path):
    words = [f"w{k}" for k in range(6000)]
    spark.createDataFrame([(1, " ".join(words))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_frame(spark, [(1, " ".join(["x", *words])), (2, " ".join(words[:3000])), (3, None)])
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {2, 3}


def test_rows_are_cleaned_by_what_they_hold_not_by_id(spark):
    item = prose(random.Random(3), 20)
    rows = [(None, f"a {item} b"), (None, "clean"), (None, None), (5, item), (5, "clean too"), (6, "as clean"), (6, "as clean")]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_frame(spark, rows)
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    left = sorted((str(r.doc_id), str(r.text)) for r in kept.collect())
    assert left == [("5", "clean too"), ("6", "as clean"), ("6", "as clean"), ("None", "None"), ("None", "clean")]


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame([(1, prose(random.Random(1), 20))], "item_id long, text string")
    assert decontaminate.matches(docs_frame(spark, []), items).collect() == []
    assert decontaminate.matches(docs_frame(spark, AWKWARD), items.where("false")).collect() == []


def labelled(rng, n):
    rows, labels = [], []
    for k in range(n):
        sentences = [prose(rng, rng.randint(3, 9), 300).capitalize() for _ in range(rng.randint(1, 25))]
        toxic = k % 4 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += f" you {rng.choice(['grumbler', 'nastyfoo', 'nastybar'])}"
        rows.append((k, ". ".join(sentences) + "."))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = labelled(random.Random(8), 700)
    table = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    return toxicity.fit(docs_frame(spark, rows), table), rows, dict(labels)


def test_toxicity_on_held_out_documents(spark, model):
    fitted, rows, labels = model
    found = toxicity.score(docs_frame(spark, rows), fitted).collect()
    out = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(out) > 100
    assert sum(r.predicted == labels[r.doc_id] for r in out) / len(out) > 0.97
    texts = dict(rows)
    for r in out:
        if labels[r.doc_id] and r.predicted:
            assert any("grumbler" in texts[r.doc_id][s.start : s.end] or "nasty" in texts[r.doc_id][s.start : s.end] for s in r.offending)


def test_noisy_or_and_its_slopes_by_plain_loops():
    rng = np.random.default_rng(4)
    docs = [[sorted(set(rng.integers(0, 6, rng.integers(1, 4)).tolist())) for _ in range(rng.integers(0, 5))] for _ in range(9)]
    label, blank = rng.integers(0, 2, 9), rng.integers(0, 3, 9)
    sentences = [(d, hits) for d, found in enumerate(docs) for hits in found]
    bags = toxicity.Bags(
        label.astype(float),
        blank.astype(float),
        np.array([d for d, _ in sentences]),
        np.array([len(hits) for _, hits in sentences], np.int32),
        np.array([k for _, hits in sentences for k in hits], np.uint16),
    )

    def loss(weights, bias):
        total = 0.0
        for found, toxic, n in zip(docs, label, blank, strict=True):
            clean = 1.0
            for hits in [*found, *[[]] * n]:
                clean *= 1 - 1 / (1 + math.exp(-(bias + sum(weights[k] for k in hits))))
            chance = max(1 - clean, 1e-12)
            total -= math.log(chance) if toxic else math.log(1 - chance)
        return total / len(docs)

    weights, bias = rng.normal(0, 1, 6), -1.5
    got, slant, tilt = toxicity.loss_and_slopes(bags, weights, bias)
    assert abs(got - loss(weights, bias)) < 1e-6
    for k in range(6):
        step = np.eye(6)[k] * 1e-6
        assert abs((loss(weights + step, bias) - loss(weights - step, bias)) / 2e-6 - slant[k]) < 1e-6
    assert abs((loss(weights, bias + 1e-6) - loss(weights, bias - 1e-6)) / 2e-6 - tilt) < 1e-6


def test_blocks_of_hits_do_not_change_the_slopes(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 9, 300).astype(np.int32)
    bags = toxicity.Bags(rng.integers(0, 2, 40).astype(float), np.ones(40), np.sort(rng.integers(0, 40, 300)), sizes, rng.integers(0, 50, sizes.sum()).astype(np.uint16))
    weights = rng.normal(0, 1, 50)
    whole = toxicity.loss_and_slopes(bags, weights, -2.0)
    monkeypatch.setattr(toxicity, "BLOCK", 5)
    small = toxicity.loss_and_slopes(bags, weights, -2.0)
    assert whole[0] == pytest.approx(small[0]) and np.allclose(whole[1], small[1]) and whole[2] == pytest.approx(small[2])


def test_what_training_takes_is_bounded(spark, model):
    rows = model[1][:200]
    labels = spark.createDataFrame([(i, int(k % 4 == 0)) for k, (i, _) in enumerate(rows)], "doc_id long, toxic int")
    docs = docs_frame(spark, rows)
    again = docs.union(docs).union(docs_frame(spark, [(rows[0][0], f"other {k}") for k in range(50)]))
    taken = toxicity.training_rows(again, labels)
    assert taken.count() == taken.select("doc_id").distinct().count() == toxicity.training_rows(docs, labels).count()
    index = {w: k for k, w in enumerate(sorted({w for _, t in rows for w in t.lower().split()}))}
    hits = toxicity._numbered(toxicity.training_rows(docs, labels), index)
    whole = toxicity._gathered(hits, 10**9)
    part = toxicity._gathered(hits, len(whole.hits) // 2)
    assert 0 < len(part.hits) < 0.8 * len(whole.hits) and len(part.hits) == part.sizes.sum()


def test_toxicity_of_awkward_rows(spark, model):
    fitted, _, _ = model
    found = toxicity.score(docs_frame(spark, AWKWARD), fitted).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    assert all(r.score == 0 for r in found if r.doc_id in (1, 2, 3))
    assert toxicity.score(docs_frame(spark, []), fitted).collect() == []
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs_frame(spark, AWKWARD), none).weights == {}


def test_pipeline_of_nothing(spark, tmp_path):
    docs_frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_labels_of_held_out_documents_are_not_read(spark):
    rows, labels = labelled(random.Random(9), 200)
    taken = toxicity.training_rows(docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in taken.collect())


def test_pipeline_on_planted_cases(spark, tmp_path):
    rng = random.Random(10)
    rows, labels = labelled(rng, 400)
    item = prose(rng, 30, 400)
    copy, near = prose(rng, 80), prose(rng, 80).split()
    rows += [(1000 + k, copy) for k in range(30)]
    rows += [(2000 + k, " ".join([*near, *["tail"] * k])) for k in range(4)]
    rows += [(3000, f"{prose(rng, 20)} {item} {prose(rng, 20)}"), (None, "no id at all"), (4000, None), (4001, "")]
    rows += [(None, " ".join([*near, "tail", "end"])), (None, f"{prose(rng, 20)} {item}"), (5000, "clean text of this id"), (5000, f"{item} too")]
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("doc_id", "1 as quality", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and kept[name] <= before and None in kept[name]
    toxic = {i for i, y in labels if y}
    assert len(toxic & kept["toxicity"]) < 0.1 * len(toxic) and len(kept["toxicity"] - toxic) >= len(rows) - len(toxic) - 33 - 8
    assert {i for i in kept["exact_dedup"] if i and 1000 <= i < 2000} == {1029}
    assert {i for i in kept["jaccard_join"] if i and 2000 <= i < 3000} == {2000}
    assert {4000, 4001} & kept["jaccard_join"] == {4001}
    assert 3000 in kept["jaccard_join"] and 3000 not in kept["decontaminate"]
    assert kept["jaccard_join"] - kept["decontaminate"] == {3000}
    assert {r.text for r in docs.where("doc_id is null or doc_id = 5000").collect()} == {"no id at all", "clean text of this id"}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in packed} == kept["decontaminate"]


class Largest(AccumulatorParam):
    def zero(self, value):
        return value

    def addInPlace(self, one, other):
        return max(one, other)


def test_stages_take_texts_in_batches_of_bounded_size(spark, tmp_path, monkeypatch):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(limit)
    rng = random.Random(14)
    rows, labels = labelled(rng, 400)
    rows += [(9000 + k, prose(rng, 1500)) for k in range(2000)]
    docs_frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("doc_id", "1 as quality", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(rng, 30, 400))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kind, longest = type(docs), max(len(t or "") for _, t in rows)
    assert sum(len(t or "") for _, t in rows) > 2 * corpus_pipeline.BATCH_BYTES
    plain = kind.mapInArrow
    try:
        for name, stage in (s for s in corpus_pipeline.STAGES if s[0] in ("toxicity", "jaccard_join", "packing")):
            largest = spark.sparkContext.accumulator(0, Largest())

            def noted(self, function, schema, *args, largest=largest, **kwargs):
                def seen(batches):
                    for batch in batches:
                        if "text" in batch.schema.names:
                            largest.add(batch.nbytes)
                        yield batch

                return plain(self, lambda batches: function(seen(batches)), schema, *args, **kwargs)

            spark.conf.set(limit, "67108864")
            monkeypatch.setattr(kind, "mapInArrow", noted)
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
            monkeypatch.undo()
            assert 0 < largest.value <= corpus_pipeline.BATCH_BYTES + 2 * longest, name
    finally:
        spark.conf.set(limit, given)
