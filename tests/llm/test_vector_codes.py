"""Vector codes against full scans in plain loops."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from tests.llm.fixtures import CLASHING, SF_DIR
from wickline.llm import vector_codes
from wickline.llm.common import table
from wickline.llm.queries import op12_vector_codes


def brute(rows, entries=256, parts=4, rounds=4):
    """rows: (vec_id, embedding, label). Sorted (vec_id, label, code, error, label_error), and the books' digest."""
    kept = [
        (i, tuple(math.floor(x * 1024) for x in v), label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], sha256(b"").hexdigest()
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    cut = [[(*v, *[0] * (width * parts))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def scan():
        return [[min((sum((x - y) ** 2 for x, y in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        near = scan()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, n in zip(cut, near, strict=True) if n[p][1] == k]
                if own:
                    books[p][k] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    errors, out = {}, []
    for (i, _, label), n in zip(kept, scan(), strict=True):
        error = sum(d for d, _ in n)
        errors[label] = errors.get(label, 0) + error
        out.append((i, label, "".join(f"{k:02x}" for _, k in n), error))
    digest = sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    order = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    return sorted(((*r, errors[r[1]]) for r in out), key=order), digest


SCHEMA = "vec_id long, embedding array<double>, label int"


def found(df, **more):
    got = vector_codes.compress(df, **more).collect()
    order = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    rows = sorted(((r["vec_id"], r["label"], r["code"], r["error"], r["label_error"]) for r in got), key=order)
    return rows, {r["codebooks_sha256"] for r in got}


@pytest.mark.parametrize("entries", [256, 7])
def test_matches_full_scans(spark, entries):
    rng = random.Random(entries)
    rows = [(k, [rng.choice([-0.01, 0.0, 0.002, rng.gauss(0, 0.01)]) for _ in range(8)], rng.choice([None, 1, 2])) for k in range(400)]
    rows += [(k, [0.005] * 8, 3) for k in range(400, 500)] + [(7, [1.0] * 8, 1), (7, [-1.0] * 8, 1), (7, [1.0] * 8, 1)]
    rows += [(None, [0.5] * 8, None), (900, None, 1), (901, [0.1] * 7 + [None], 1), (902, [math.nan] * 8, 1), (903, [math.inf] + [0.0] * 7, 1)]
    rows += [(904, [0.1] * 7, 1), (905, [], 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in (*CLASHING, "codes", "gaps", "ints", "code", "error", "salt"):
        if name != "label":
            df = df.selectExpr("*", f"'x' as {name}")
    want, digest = brute(rows, entries)
    assert found(df, entries=entries) == (want, {digest})


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0]], [[1.0, 2.0, 3.0]], [[1.0] * 5] * 3])
def test_small_tables_and_odd_lengths(spark, vectors):
    rows = [(k, v, 1) for k, v in enumerate(vectors)]
    want, digest = brute(rows)
    assert found(spark.createDataFrame(rows, SCHEMA)) == (want, {digest} if want else set())


def test_large_components_stay_exact_or_are_held(spark):
    rows = [(k, [(k % 5) * 30_000.0 + 1, 3e3 * k, -9e4, 0.0], 1) for k in range(40)]
    want, digest = brute(rows, entries=6)
    assert found(spark.createDataFrame(rows, SCHEMA), entries=6) == (want, {digest})
    held, _ = found(spark.createDataFrame([(1, [1e300, -1e300, 0.0, 0.0], 1), (2, [0.0] * 4, 1)], SCHEMA), entries=1, rounds=0)
    assert held[1][3] == 2 * vector_codes.LARGEST**2


def test_active_entries_give_what_full_scans_give():
    rng = np.random.default_rng(3)
    for _ in range(200):
        rows, book = rng.integers(-3, 4, (50, 2)), rng.integers(-3, 4, (9, 2))
        at, far = vector_codes.nearest(rows, book)
        moved = rng.random(9) < rng.random()
        book = np.where(moved[:, None], rng.integers(-3, 4, (9, 2)), book)
        again = vector_codes.renearest(rows, book, moved, at, far)
        assert all((x == y).all() for x, y in zip(again, vector_codes.nearest(rows, book), strict=True))


def test_many_labels_are_salted(spark, monkeypatch):
    df = table(spark, SF_DIR, "embeddings").limit(150)
    want = found(df)
    monkeypatch.setattr(vector_codes, "BROADCAST_KEYS", 0)
    assert found(df) == want


def test_registered_query(spark):
    given = table(spark, SF_DIR, "embeddings").select("vec_id", "embedding", "label").collect()
    want, digest = brute([(r[0], r[1], r[2]) for r in given])
    got = op12_vector_codes(spark, SF_DIR).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == [(i, c, e, t) for i, _, c, e, t in want]
    assert {r["codebooks_sha256"] for r in got} == {digest}
