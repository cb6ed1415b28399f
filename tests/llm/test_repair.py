"""Conversation repair against a program that compares whole audit strings, and the audit tree by itself."""

import random
import re
import zlib
from hashlib import sha256

import pytest

from tests.llm.fixtures import CLASHING
from wickline.llm.conversation_repair import Audits, Repair, damage, repair

BLANKS = " \t\n\v\f\r"


def damaged(rows):
    """(conv_id, turn, role, text) after damage, and the ids of all conversations."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        said = text.strip(BLANKS)
        kind = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append(kind)
    return found


def cheapest(rows, kinds):
    """Least (cost, audit, turns) over all edits, by states that hold whole strings."""
    pattern = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def put(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit, turns) in list(best.items()):
                for x, name in names.items():
                    if (state, x) in pattern:
                        put(best, pattern[state, x], (cost + 2, audit + "I", [*turns, f"{name}:"]))
        return best

    best = inserted({"": (0, "", [])})
    for (_, _, role, text), kind in zip(rows, kinds, strict=True):
        after = {}
        for state, (cost, audit, turns) in best.items():
            put(after, state, (cost + 3, audit + "D", turns))
            if kind in ("blank", "duplicate"):
                continue
            more = kind == "truncated"
            if (state, role[:1]) in pattern:
                put(after, pattern[state, role[:1]], (cost + more, audit + "K", [*turns, f"{role}:{text}"]))
            for x, name in names.items():
                if (state, x) in pattern:
                    put(after, pattern[state, x], (cost + 2 + more, audit + "R", [*turns, f"{name}:{text}"]))
        best = inserted(after)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            (r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
        )
        kinds = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:], strict=False)]
        cost, audit, said = cheapest(own, kinds)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            sha256("\n".join(said).encode()).hexdigest(),
        )
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def found(spark, rows, clash=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in clash:
        df = df.selectExpr("*", f"'x' as {name}")
    got = repair(damage(df), gone="gone").collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got}


def random_rows(rng, conversations, longest):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", None, "unknown", "agent"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            text = rng.choice(["a.", "b!", "c", "d? ", " \t", None, "", "é.\n", f"t{rng.randrange(5)}."])
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, rng.choice([turn, turn, turn, turn, None, turn + 7]), role, text))
    return rows


def test_matches_the_program_over_whole_strings(spark):
    rng = random.Random(5)
    rows = random_rows(rng, 250, 14) + [(None, None, None, None), (None, 1, "user", "x."), (None, 2, "assistant", "y.")]
    rows += [(9000, t, r, "hi.") for t, r in ((1, "user"), (1, "user"), (1, "assistant"), (-5, "assistant"))]
    gone = next(c for c in range(10_000, 20_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "x."))
    got, want = found(spark, rows, (*CLASHING, "gone", "later", "fault")), expected(rows)
    assert got == want
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())


def test_empty_table(spark):
    assert found(spark, []) == {}


@pytest.mark.parametrize(("modulus", "settle"), [((1 << 61) - 1, 1 << 30), (1, 1 << 30), (3, 1 << 30), ((1 << 61) - 1, 4), (2, 16)])
def test_neither_colliding_hashes_nor_forgotten_prefixes_change_an_audit(modulus, settle):
    rng = random.Random(modulus % 1000 + settle % 1000)
    for _ in range(150):
        rows = [(0, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", " "])) for t in range(rng.randrange(0, 40))]
        kinds = [rng.choice(["", "", "", "truncated", "blank"]) for _ in rows]
        program = Repair(modulus, settle)
        for (_, _, role, text), kind in zip(rows, kinds, strict=True):
            program.row(role, text, kind == "blank", False, kind == "truncated")
        cost, audit, turns = cheapest(rows, kinds)
        assert program.end() == (cost, audit, sha256("\n".join(turns).encode()).hexdigest())


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 1, 2, 5])
def test_audits_compare_as_strings(modulus):
    rng, tree = random.Random(1), Audits(modulus)
    texts = [""]
    for _ in range(400):
        node = rng.randrange(len(texts)) if rng.random() < 0.5 else len(texts) - 1
        letter = rng.choice("DK")
        texts.append(texts[node] + letter)
        assert tree.add(node, letter) == len(texts) - 1
    for _ in range(4000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert tree.less(a, b) == (texts[a] < texts[b])
        assert tree.text(a) == texts[a]
        some = [a, b, rng.randrange(len(texts))]
        above = tree.common(some)
        assert all(tree.ancestor(n, tree.depth[above]) == above for n in some)


def test_a_long_conversation_keeps_a_small_tree():
    program = Repair()
    rng = random.Random(3)
    for k in range(60_000):
        program.row(rng.choice(["user", "assistant"]), f"text {k}.", False, False, k % 7 == 0)
        assert len(program._audits.depth) <= 3 * 4_096
    cost, audit, _ = program.end()
    assert cost > 0 and len(audit) >= 60_000
