import hashlib
import math
import random
import time

import pytest

from tests import oracle_check
from wickline.llm import chat_format, oracles, queries, url_filter

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, head string, said string"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    differs = oracle_check.compare(spark, oracle_check.connect(SF), name, queries.queries()[name], oracles.ORACLES[name], SF)
    assert differs == ""


def conversations():
    rng = random.Random(5)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<", "[", "~", "<~s>", "[~~/INST]", "ok", " ", "\n", "é", "INST]", "/s>", "</", "s>", "$1", "\\"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            text = "".join(rng.choices(bits, k=rng.randint(0, 12))) or None
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", None, "</s>"]), text, "x", "y"))
    rows += [(None, 0, "user", "q", "", ""), (None, 1, "assistant", "a", "", ""), (77, None, "user", "null turn", "", ""), (77, 3, "assistant", "b", "", ""), (77, 3, "assistant", "b", "", "")]
    rows += [(78, k, "assistant" if k % 2 else "user", "long " * 50, "", "") for k in range(300)]
    return rows


def test_chat_round_trip(spark):
    rows = conversations()
    found = {r.conv_id: r for r in chat_format.digest(spark.createDataFrame(rows, TURNS)).collect()}
    by_conv = {}
    for conv, turn, role, text, _, _ in rows:
        by_conv.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = found[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_examples_are_prefixes_with_one_target(spark):
    rows = [(1, 0, "user", "q1", "", ""), (1, 1, "assistant", "a1", "", ""), (1, 2, "user", "q2", "", ""), (1, 3, "assistant", "a2", "", ""), (1, 4, "user", "q3", "", "")]
    found = chat_format.expand(spark.createDataFrame(rows, TURNS)).orderBy("example").collect()
    assert [r.text[r.loss_start : r.loss_end] for r in found] == ["a1", "a2", ""]
    assert all(b.text.startswith(a.text) for a, b in zip(found, found[1:]))
    assert found[0].text == "<s>[INST] user [/INST]q1</s><s>[INST] assistant [/INST]a1</s>"
    assert [r.whole for r in found] == [False, False, True]


def test_the_digest_is_read_from_the_examples(spark, monkeypatch):
    df = spark.createDataFrame(conversations(), TURNS).cache()
    spelled = {(r.conv_id, r.example): r for r in chat_format.expand(df).collect()}
    made = sorted(chat_format.examples(df).collect(), key=lambda r: (str(r.conv_id), r.example))
    assert set(spelled) == {(r.conv_id, r.example) for r in made} and len(made) == len(spelled)
    before = {}
    for r in made:  # a text is the text of the example before, and what is added
        whole = spelled[r.conv_id, r.example]
        before[r.conv_id] = before.get(r.conv_id, "") + r.added
        assert whole.text == before[r.conv_id] and r.n_chars == len(whole.text) and r.start == len(whole.text) - len(r.added)
        assert (r.n_turns, r.loss_start, r.loss_end, r.whole) == (whole.n_turns, whole.loss_start, whole.loss_end, whole.whole)
    chars = {r.conv_id: r.formatted_chars for r in chat_format.digest(df).collect()}
    assert chars == {c: sum(r.n_chars for r in made if r.conv_id == c) for c in chars}
    real = chat_format.examples
    monkeypatch.setattr(chat_format, "examples", lambda rows: real(rows).where("example <> 1 or conv_id <> 78"))
    less = {r.conv_id: r for r in chat_format.digest(df).collect()}
    gone = next(r for r in made if (r.conv_id, r.example) == (78, 1))
    assert (less[78].n_turns, less[78].loss_chars) == (298, 149 * len("long " * 50))
    assert less[78].formatted_chars == chars[78] - gone.n_chars


def test_every_text_is_spelled_out_and_read(spark, monkeypatch):
    df = spark.createDataFrame(conversations(), TURNS).cache()
    assert sorted(map(str, chat_format.digest_texts(df).collect())) == sorted(map(str, chat_format.digest(df).collect()))
    found = {r.conv_id: r for r in queries.op2_chat_format(spark, SF).collect()}
    real, told = chat_format.expand, {}
    for r in real(spark.read.parquet(f"{SF}/conversations.parquet")).collect():
        told.setdefault(r.conv_id, []).append(r)
    assert all(found[c].formatted_chars == sum(len(r.text) for r in rows) for c, rows in told.items())
    longer = "text", chat_format.F.concat("text", chat_format.F.lit("x"))
    monkeypatch.setattr(chat_format, "expand", lambda rows: real(rows).withColumn(*longer))
    for r in queries.op2_chat_format(spark, SF).collect():
        assert r.formatted_chars == found[r.conv_id].formatted_chars + len(told.get(r.conv_id, [0]))
        assert (r.n_turns, r.loss_sha256) == (found[r.conv_id].n_turns, found[r.conv_id].loss_sha256)


def test_a_long_conversation_takes_linear_time(spark):
    texts = [f"turn {k} <s> of many words é" for k in range(60_000)]
    rows = [(1, k, "assistant" if k % 2 else "user", text, "", "") for k, text in enumerate(texts)]
    df = spark.createDataFrame(rows, TURNS).cache()
    df.count()
    began = time.time()
    found = chat_format.digest(df).first()
    assert time.time() - began < 40
    loss = "".join(texts[1::2])
    assert (found.n_turns, found.loss_chars) == (60_000, len(loss))
    assert found.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_of_nothing(spark):
    assert chat_format.digest(spark.createDataFrame([], TURNS)).collect() == []


PAGES = "page_id long, url string, html string, host string, alpha double, prior string"


def test_hosts_paths_and_rules(spark):
    urls = [
        "https://WWW.Example.com/en/x?y#z", "http://example.com", "http://example.com/en/", "ftp://a.net/es/1", "//a.net/es/",
        None, "x://y://z/p", "http://notexample.com/en/", "http://h?q", "http://com/", "https://É.com/A/B", "http://a.net/fr",
    ]
    pages = spark.createDataFrame([(k, u, "", "", 0.0, "") for k, u in enumerate(urls)], PAGES)
    none = spark.createDataFrame([], "page_id long, good int")
    found = {r.page_id: r for r in url_filter.judge(pages, none, queries.URL_RULES).collect()}
    got = [(found[k].host, found[k].path, found[k].rule) for k in range(len(urls))]
    assert got == [
        ("www.example.com", "/en/x", "www.example.com/en/"), ("example.com", "", None), ("example.com", "/en/", "example.com/en/"),
        ("a.net", "/es/1", "net/es/"), ("", "", None), ("", "", None), ("y:", "//z/p", None), ("notexample.com", "/en/", "com/"), ("h", "", None),
        ("com", "/", "com/"), ("É.com", "/A/B", "com/"), ("a.net", "/fr", None),
    ]
    assert [found[k].verdict for k in (0, 2, 3, 9)] == ["allow", "block", "block", "allow"]


def test_reputation_shrinks_and_blocks(spark):
    rows, good, k = [], [], 0
    for host, n, bad in (("a.farm.org", 40, 38), ("b.farm.org", 3, 3), ("fine.org", 60, 3), ("new.farm.org", 0, 0), ("x.fresh.net", 0, 0), ("one.org", 1, 1)):
        for j in range(max(n, 1)):
            rows.append((k, f"http://{host}/{j}", "", "", 0.0, ""))
            good += [(k, int(j >= bad))] if n else []
            k += 1
    good += [(0, None), (None, 1)]
    found = url_filter.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame(good, "page_id long, good int"), ()).collect()
    rate = {r.host: r.rate for r in found}
    verdict = {r.host: r.verdict for r in found}
    assert verdict["a.farm.org"] == verdict["b.farm.org"] == verdict["new.farm.org"] == "block" and verdict["fine.org"] == "allow"
    assert rate["a.farm.org"] < rate["one.org"] < rate["fine.org"]
    assert all(0 < r.rate < 1 and r.bound < r.rate and math.isfinite(r.bound) for r in found)


def test_urls_of_nothing(spark):
    none = spark.createDataFrame([], "page_id long, good int")
    assert url_filter.judge(spark.createDataFrame([], PAGES), none, queries.URL_RULES).collect() == []
