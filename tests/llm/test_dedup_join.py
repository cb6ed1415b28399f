import collections
import hashlib
import random
import time

import pytest

from tests.llm.fixtures import AWKWARD, CLASHING, docs_frame, prose
from wickline.llm import exact_dedup, jaccard_join


def copies(rng):
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    rows = [(i, rng.choice(texts)) for i in range(150)]
    rows += [(1000 + i, "the hot text of a third of all rows") for i in range(100)]
    rng.shuffle(rows)
    return rows + AWKWARD


@pytest.mark.parametrize("support", [0.001, 0.1, 0.9])
def test_exact_dedup_is_grouping(spark, support):
    rows = copies(random.Random(7))
    found = exact_dedup.resolve(docs_frame(spark, rows).repartition(5), support).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(found) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_text[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert collections.Counter(r.text_sha256 for r in found if r.kept) == collections.Counter(list(by_text))


def test_exact_dedup_keeps_whole_rows(spark):
    rows = copies(random.Random(3))
    df = docs_frame(spark, rows)
    kept = exact_dedup.keep(df)
    assert kept.columns == df.columns and set(CLASHING) <= set(kept.columns)
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in rows})


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.resolve(docs_frame(spark, [])).collect() == []
    assert exact_dedup.keep(docs_frame(spark, [])).collect() == []


def grams(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Components of all pairs, by text first, as ids of one text are linked."""
    sets = [(i, grams(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[find(a)] = find(b)
    members = collections.defaultdict(list)
    for k in range(len(sets)):
        members[find(k)].append(sets[k][0])
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [j for j in members[find(k)] if j is not None]
        out.append((i, len(s), (min(ids) if ids else None) if s else i))
    return sorted(out, key=repr)


def near_copies(rng, chance):
    rows = []
    for k in range(12):
        words = prose(rng, rng.randint(20, 120)).split()
        for _ in range(rng.randint(1, 14)):
            own = [w if rng.random() > chance else f"x{rng.randint(0, 99999)}" for w in words]
            cut = rng.randint(0, len(own) // 4)
            rows.append((len(rows), " ".join(own[cut:])))
    passage = prose(rng, 50)
    rows += [(500 + k, f"{prose(rng, rng.randint(5, 200))} {passage} {prose(rng, 20)}") for k in range(60)]
    rows += [(700 + k, passage.upper() if k % 2 else passage) for k in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, chance", [(1, 0.01), (2, 0.03), (3, 0.05)])
def test_jaccard_join_is_all_pairs(spark, monkeypatch, seed, chance):
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 8)
    rows = near_copies(random.Random(seed), chance) + AWKWARD
    found = jaccard_join.join(docs_frame(spark, rows).repartition(6)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute(rows)


def test_jaccard_join_without_broadcast_of_ids(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    rows = near_copies(random.Random(4), 0.02)
    found = jaccard_join.join(docs_frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute(rows)


def test_jaccard_join_at_the_threshold(spark):
    base = [f"t{k}" for k in range(39)]  # 35 shingles
    for swapped, linked in ((1, True), (2, False)):  # 30 of 40 and 25 of 45 shingles common
        other = list(base)
        for k in range(swapped):
            other[10 + 7 * k] = "z"
        found = jaccard_join.join(docs_frame(spark, [(1, " ".join(base)), (2, " ".join(other))])).collect()
        assert {r.component_id for r in found} == ({1} if linked else {1, 2})


def test_jaccard_join_of_lone_pairs_inside_each_other(spark):
    rng, rows = random.Random(12), []
    for k in range(300):  # nobody but the two has their words; the order of grams differs with each pair
        n = rng.randint(20, 120)
        words = [f"p{k}w{j}" for j in range(int(n * rng.uniform(1.2, 1.333)) + 4)]
        cut = rng.randint(0, len(words) - n - 4)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[cut : cut + n + 4]))]
    found = jaccard_join.join(docs_frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute(rows)


def watched(monkeypatch):
    """Label, plan and rows of each table that the join stores."""
    made, real = [], jaccard_join.stored

    def stored(df, label):
        table = real(df, label)
        made.append((label, df._jdf.queryExecution().executedPlan().toString(), table.count()))
        return table

    monkeypatch.setattr(jaccard_join, "stored", stored)
    return made


def test_pairs_that_differ_in_the_first_fragments_are_not_met_in_the_others(spark, monkeypatch):
    rng, rows, sets = random.Random(31), [], {}
    for name in range(40):  # pairs of 2k and 2k + 1; every fourth is alike, some lack fragments
        if name % 2:
            share = 0.95 if name % 8 == 1 else rng.uniform(0, 0.9)
            sets[name] = {g if rng.random() < share else g + 500_000 for g in sets[name - 1]}
        else:
            sets[name] = {8_000_000 * rng.choice([0, 1, 5] if name % 6 else range(8)) + rng.randint(0, 400_000) for _ in range(rng.randint(4, 90))}
        parts = collections.defaultdict(list)
        for g in sorted(sets[name]):
            parts[g // 8_000_000].append(g)
        rows += [(name, k, part) for k, part in parts.items()]
    cut = spark.createDataFrame(rows, "set long, fragment byte, grams array<long>")
    pairs = [(a, b, len(sets[a]), len(sets[b])) for a in range(40) for b in (a + 1, a + 2) if b < 40]
    made = watched(monkeypatch)
    found = jaccard_join._links(spark.createDataFrame(pairs, "a long, b long, n_a long, n_b long"), cut)
    linked = {(a, b) for a, b, _, _ in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert {tuple(r) for r in found.collect()} == linked and linked
    left = [n for label, _, n in made if label == "left"]
    assert len(left) == 1 and len(linked) <= left[0] < len(pairs)


def test_jaccard_join_of_repeated_rows_and_rows_without_ids(spark, monkeypatch):
    rng, rows = random.Random(32), []
    for k in range(40):
        words = [f"r{k}w{j}" for j in range(rng.randint(4, 90))]
        near = [*words[:-1], "z"] if k % 2 else [*words, "z", "y"]
        rows += [(2 * k, " ".join(words))] * rng.randint(1, 4) + [(rng.choice([2 * k + 1, None]), " ".join(near))] * rng.randint(1, 4)
    once = sorted({i: (i, t) for i, t in rows if i is not None}.values())
    for given, moved in ((rows, True), (once, False)):
        made = watched(monkeypatch)
        found = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(docs_frame(spark, given).repartition(6)).collect()}
        assert found == set(brute(given))
        # Only what is cut in several tasks is moved to be there once.
        plans = [plan for label, plan, _ in made if label == "fragments"]
        assert any("Exchange hashpartitioning(set" in plan for plan in plans) == moved
        monkeypatch.undo()


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.join(docs_frame(spark, [])).collect() == []


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100 + k, 100) for k in range(1, 30)] + [(7, 7)]
    found = dict(map(tuple, jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)}


def test_texts_that_share_a_passage_and_are_not_alike_cost_their_number(spark):
    rng = random.Random(21)
    shared = " ".join(f"s{k}" for k in range(40))

    def seconds(many):
        rows = [(k, f"{shared} " + " ".join(f"o{k}x{j}{rng.random()}" for j in range(7))) for k in range(many)]
        docs = docs_frame(spark, rows, clash=False).repartition(4).cache()
        docs.count()
        began = time.time()
        assert jaccard_join.join(docs).where("doc_id <> component_id").count() == 0
        return time.time() - began

    seconds(500)
    small = seconds(6_000)
    assert seconds(24_000) < 3 * small + 10
