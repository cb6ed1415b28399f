import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from wickline.operators import funding, universe
from wickline.sources import archives, listing, pages, tables

KLINE_LINE = "1741586400000,8.5,9.75,7.25,8.75,3.5,1741586459999,30.1,13,1.5,12.0,0"
KLINE_HEADER = (
    "open_time,open,high,low,close,volume,close_time,quote_volume,count,"
    "taker_buy_volume,taker_buy_quote_volume,ignore"
)


def packed(text, names=("rows.csv",)):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name in names:
            archive.writestr(name, text)
    return buffer.getvalue()


def extracted(spark, contents, is_funding=False, checksums=None):
    zips = spark.createDataFrame(list(contents.items()), "path string, content binary")
    texts = {p: f"{hashlib.sha256(c).hexdigest()}  {p}\n" for p, c in contents.items()}
    texts.update(checksums or {})
    sums = spark.createDataFrame(
        [(p, t) for p, t in texts.items() if t is not None], "path string, checksum_text string"
    )
    rows = archives.extract(zips, is_funding)
    outcomes = archives.archive_outcomes(rows, sums)
    return archives.good_rows(rows, outcomes), outcomes


def outcome(outcomes):
    return {r["path"]: (r["row_count"], r["error_code"], r["error_message"]) for r in outcomes.collect()}


@pytest.mark.parametrize("text", [KLINE_LINE, f"{KLINE_HEADER}\n{KLINE_LINE}\n"])
def test_kline_archive_with_and_without_header(spark, text):
    df, outcomes = extracted(spark, {"a": packed(text)})
    (row,) = archives.kline_rows(df).collect()
    assert tuple(row)[3:] == (8.5, 9.75, 7.25, 8.75, 3.5, 13)
    assert outcome(outcomes) == {"a": (1, None, None)}


def test_wrong_checksum_gives_no_rows(spark):
    good = packed(KLINE_LINE)
    upper = hashlib.sha256(good).hexdigest().upper()
    df, outcomes = extracted(
        spark,
        {"a": good, "b": good, "c": good, "d": good},
        checksums={"a": "0" * 64 + "  a", "b": "short", "c": None, "d": upper},
    )
    assert archives.kline_rows(df).count() == 0
    found = outcome(outcomes)
    assert found["a"][1] == "checksum_mismatch" and found["a"][2].startswith("expected 000")
    assert found["b"] == (None, None, "invalid checksum payload")
    assert found["c"] == (None, None, "no checksum landed")
    # The comparison is case-sensitive.
    assert found["d"][1] == "checksum_mismatch"


def test_archives_are_taken_whole_or_not_at_all(spark):
    lines = [KLINE_LINE] * 5000
    bad = [*lines, KLINE_LINE.replace("7.25", "low")]
    contents = {
        "good": packed("\n".join(lines)),
        "bad": packed("\n".join(bad)),
        "two": packed(KLINE_LINE, ("a.csv", "b.csv")),
        "none": packed(KLINE_LINE, ("a.txt",)),
        "broken": b"no zip",
        "whole": packed(KLINE_LINE.replace(",13,", ",1.3e1,")),
    }
    df, outcomes = extracted(spark, contents)
    found = outcome(outcomes)
    assert found["good"] == (5000, None, None) and found["whole"] == (1, None, None)
    assert "exactly one CSV" in found["two"][2] and "exactly one CSV" in found["none"][2]
    assert found["bad"][2] and found["broken"][2]
    counts = {r[0]: r[1] for r in archives.kline_rows(df).groupBy("path").count().collect()}
    assert counts == {"good": 5000, "whole": 1}


def test_archives_are_streamed(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(archives, "BLOCK_BYTES", 1000)

    def run(text):
        kinds = {"path": pa.string(), "checksum": pa.string(), "content": pa.binary()}
        values = ("a", "c", packed(text))
        columns = [pa.array([v], t) for v, t in zip(values, kinds.values())]
        batch = pa.RecordBatch.from_arrays(columns, names=list(kinds))
        found = list(archives._extractor(False)(iter([batch])))
        out = pa.Table.from_batches(found).to_pylist()
        return len(found), [r for r in out if r["source_row"] is not None], out[-1]

    count, rows, last = run("\n".join([KLINE_LINE] * 300))
    assert count > 10 and [r["source_row"] for r in rows] == list(range(300)) and last["row_count"] == 300
    _, rows, last = run("\n".join([KLINE_LINE] * 300 + [KLINE_LINE.replace("7.25", "x")]))
    assert last["row_count"] is None and last["error_message"]  # good_rows drops what came before


def test_funding_archive(spark):
    text = (
        "calc_time,funding_interval_hours,last_funding_rate\n"
        "1741564800000,8,-0.00021\n1741593600007,8,0.00034\n"
    )
    rows = archives.funding_rows(extracted(spark, {"a": packed(text)}, True)[0]).orderBy("source_row")
    found = rows.select(F.unix_millis("funding_time"), "funding_rate", "mark_price").collect()
    assert [tuple(r) for r in found] == [
        (1741564800000, -0.00021, None), (1741593600007, 0.00034, None),
    ]


def page(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")


PREMIUM = [1741586400000, "-0.0021", "0.0013", "-0.0034", "0.0005", "0", 1741586459999, "0", 31, "0", "0", "0"]


def test_premium_page(spark):
    parsed = pages.parse_premium_pages(page(spark, json.dumps([PREMIUM]), "[]"))
    (row,) = pages.premium_rows(parsed, ["n"]).collect()
    assert tuple(row)[3:] == (-0.0021, 0.0013, -0.0034, 0.0005, 0.0, 31)
    assert [tuple(r) for r in pages.page_outcomes(parsed, ["n"]).orderBy("n").collect()] == [(0, 1, None), (1, 0, None)]


def changed(position, value):
    return json.dumps([PREMIUM, [*PREMIUM[:position], value, *PREMIUM[position + 1 :]]])


def test_one_bad_premium_row_rejects_its_page(spark):
    bad = [
        changed(8, True), changed(8, None), changed(1, "x"), changed(1, [1]), changed(2, {}), changed(0, "1.5"),
        changed(1, False), json.dumps([PREMIUM[:8]]), '[{"a":1}]', "[1]", "{}", "null", "nonsense", "",
    ]
    parsed = pages.parse_premium_pages(page(spark, *bad))
    assert pages.premium_rows(parsed, ["n"]).count() == 0
    assert parsed.where(F.col("error").isNull()).count() == 0
    fine = [changed(8, "12"), changed(8, 12.9), changed(0, 1741586400000.0), changed(1, 1), changed(1, " 1.5 ")]
    parsed = pages.parse_premium_pages(page(spark, *fine))
    assert parsed.where(F.col("error").isNotNull()).count() == 0
    assert pages.premium_rows(parsed, ["n"]).count() == 2 * len(fine)


def test_funding_page(spark):
    good = (
        '[{"fundingTime":4000,"fundingRate":"0.00050","markPrice":"33.5"},'
        '{"fundingTime":5000,"fundingRate":"0.00070","markPrice":null},{"fundingTime":3,"fundingRate":1}]'
    )
    item = '[{"fundingTime":1000,"fundingRate":"0.1","markPrice":"1"},%s]'
    bad = [
        item % '{"fundingTime":"1000","fundingRate":"0.1"}', item % '{"fundingTime":1.5,"fundingRate":"0.1"}',
        item % '{"fundingTime":true,"fundingRate":"0.1"}', item % '{"fundingTime":1,"fundingRate":true}',
        item % '{"fundingTime":1,"fundingRate":"0.1","markPrice":true}', item % '{"fundingTime":1}', item % "7", "{}",
    ]
    parsed = pages.parse_funding_pages(page(spark, good, *bad))
    rows = pages.funding_rows(parsed, ["n"]).orderBy("position").collect()
    assert [tuple(r)[2:] for r in rows] == [(4000, 0.0005, 33.5), (5000, 0.0007, None), (3, 1.0, None)]


def test_overlapping_pages_last_wins(spark):
    items = spark.createDataFrame(
        [("X", 1, 0, 1000, 0.1, 1.0), ("X", 1, 1, 2000, 0.2, 2.0), ("X", 2, 0, 2000, 0.3, None),
         ("X", 2, 1, 3000, 0.4, 4.0), ("X", 2, 2, 3000, 0.5, 5.0), ("X", 2, 3, 9000, 0.9, 9.0)],
        "symbol string, page_no bigint, position bigint, funding_millis bigint, funding_rate double, mark_price double",
    )
    merged = funding.merge_pages(items, 1000, 3000).orderBy("funding_time")
    found = merged.select(F.unix_millis("funding_time"), "funding_rate", "mark_price").collect()
    assert [tuple(r) for r in found] == [(1000, 0.1, 1.0), (2000, 0.3, None), (3000, 0.5, 5.0)]


def test_tickers_skip_bad_items_and_zero_fill(spark):
    text = json.dumps(
        [{"symbol": "BTCUSDT", "quoteVolume": "5.5"}, {"symbol": "ETHUSDT", "quoteVolume": 2}, 1, None, [],
         {"symbol": 3, "quoteVolume": "1"}, {"symbol": "AUSDT"}, {"symbol": "BUSDT", "quoteVolume": True},
         {"symbol": "CUSDT", "quoteVolume": "abc"}, {"symbol": "DBUSD", "quoteVolume": 1}]
    )
    tickers = pages.ticker_rows(page(spark, text))
    assert [tuple(r) for r in universe.quote_liquidity(tickers).collect()] == [("USDT", 2, 7.5), ("USDC", 0, 0.0)]
    with pytest.raises(Exception, match="must be a JSON array"):
        pages.ticker_rows(page(spark, "{}")).collect()


def xml(prefixes, namespace=' xmlns="http://s3.amazonaws.com/doc/2006-03-01/"'):
    body = "".join(f"<CommonPrefixes><Prefix>{p}</Prefix></CommonPrefixes>" for p in prefixes)
    return f'<?xml version="1.0" encoding="UTF-8"?><ListBucketResult{namespace}>{body}</ListBucketResult>'


def test_listing_and_universe(spark):
    names = ["BTCUSDT", "DELISTEDUSDT", "BTCUSDC", "ETHBUSD", "%CE%A9USDT"]
    listed = spark.createDataFrame(
        [("klines", xml([f"a/klines/{n}/" for n in names] + [""])), ("premiumIndexKlines", xml(["p/BTCUSDT/", "p/ONLYUSDT/"], ""))],
        "dataset string, text string",
    )
    symbols = pages.listed_symbols(pages.listed_prefixes(listed, keep=["dataset"]), ["dataset"])
    for quotes, expected in [
        (("USDT",), ["BTCUSDT", "DELISTEDUSDT"]),
        (("USDT", "USDC"), ["BTCUSDT", "BTCUSDC", "DELISTEDUSDT"]),
    ]:
        found = universe.ordered_universe(universe.build_universe(symbols, quotes), quotes).collect()
        assert [r["symbol"] for r in found] == expected
    flags = {r["symbol"]: r["datasets"] for r in found}
    assert flags["BTCUSDT"] == {"klines": True, "premium_index_klines": True}
    assert flags["DELISTEDUSDT"] == {"klines": True, "premium_index_klines": False}


def test_universe_documents(spark):
    text = json.dumps(
        {"quote_asset": "USDC", "symbols": ["AUSDC", {"symbol": "B", "quote_asset": "X", "storage_key": "b",
         "datasets": {"klines": 1, "premiumIndexKlines": True}}, {"symbol": "C", "datasets": None, "quote_asset": None}]}
    )
    rows = universe.universe_from_json(spark.createDataFrame([(text,)], "value string")).orderBy("position").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("AUSDC", "USDC", "AUSDC", {"klines": True, "premium_index_klines": False}),
        ("B", "X", "b", {"klines": False, "premium_index_klines": True}),
        ("C", "USDC", "C", {"klines": True, "premium_index_klines": False}),
    ]
    for bad in ('{"symbols": {}}', '{"symbols": [1]}', '{"symbols": [{}]}', '{"symbols": [{"symbol": "A", "quote_asset": 1}]}'):
        with pytest.raises(Exception, match="symbol universe"):
            universe.universe_from_json(spark.createDataFrame([(bad,)], "value string")).collect()


def store(spark, folder, name, rows, schema):
    import pandas as pd

    folder.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(rows, columns=schema).to_parquet(folder / name, index=False)


def test_stored_archives_of_mixed_types(spark, tmp_path):
    klines = tmp_path / "klines"
    base = ["open_time", "open", "high", "low", "close", "volume"]
    key = "1000%EC%99%9CUSDT"
    store(spark, klines / key, f"{key}_klines_1m_2023-11-14.parquet",
          [(1700000000000, "1", "2", "0.5", "1.5", "10", "4")], [*base, "number_of_trades"])
    store(spark, klines / "1000왜USDT", "1000왜USDT_klines_1m_2023-11-15.parquet",
          [(1700006400000, 1.0, 2.0, 0.5, 1.5, 10.0, 3)], [*base, "trade_count"])
    store(spark, klines / "BTCUSDT", "BTCUSDT_klines_5m_2023-11.parquet", [(1700006400000, 1.0, 2.0, 0.5, 1.5, 10.0)], base)
    store(spark, tmp_path / "fundingRate" / "BTCUSDT", "BTCUSDT_fundingRate_2024-01.parquet",
          [(1704067200000, "0.0001"), (1704096000000, "-0.0002")], ["fundingTime", "fundingRate"])
    store(spark, tmp_path / "premiumIndexKlines" / "BTCUSDT", "BTCUSDT_premiumIndexKlines_1m_2024-01.parquet",
          [(1704067200000, 1.0, 1.0, 1.0, 1.0, 1.0)], base)

    found = listing.find_raw_archives(spark, str(tmp_path)).collect()
    assert [r["dataset"] for r in found] == ["fundingRate", "klines", "klines", "klines", "premiumIndexKlines"]
    assert [r["path"] for r in found] == sorted(r["path"] for r in found)
    assert listing.find_raw_archives(spark, str(tmp_path), interval="1m").count() == 3
    assert listing.find_raw_archives(spark, str(tmp_path), "funding_rate", "btcusdt").count() == 1
    assert [r[0] for r in listing.local_symbols(spark, str(tmp_path)).collect()] == ["1000왜USDT", "BTCUSDT"]
    assert listing.find_raw_archives(spark, str(tmp_path / "nowhere")).count() == 0

    rows = tables.read_stored_klines(spark, str(tmp_path), "klines", "1000왜usdt").orderBy("open_time").collect()
    assert [(r["symbol"], r["period"], r["open"], r["trade_count"]) for r in rows] == [
        ("1000왜USDT", "2023-11-14", 1.0, 4), ("1000왜USDT", "2023-11-15", 1.0, 3),
    ]
    events = tables.read_stored_funding(spark, str(tmp_path)).select("symbol", "funding_time", "funding_rate")
    assert [tuple(r) for r in funding.funding_events(events, 1704067200, 1704067200).collect()] == [
        ("BTCUSDT", 1704067200, 0.0001),
    ]
    assert tables.read_stored_klines(spark, str(tmp_path), "klines", "NONE").count() == 0


def test_funding_without_known_columns(spark):
    df = spark.createDataFrame([("X", 1)], "symbol string, other bigint")
    assert funding.funding_events(df).count() == 0
    legacy = spark.createDataFrame(
        [("X", 1704067200000, "0.0001"), ("X", 1704096000, "-0.0002"), ("X", 7, "x"), ("X", None, "1")],
        "symbol string, time bigint, fundingRate string",
    )
    assert [tuple(r) for r in funding.funding_events(legacy).orderBy("timestamp").collect()] == [
        ("X", 1704067200, 0.0001), ("X", 1704096000, -0.0002),
    ]


def test_strict_normalisation(spark):
    df = spark.createDataFrame([(1741586400000, "8.5", "1", "1", "1", "3.25", "13")],
                               "open_time bigint, open string, high string, low string, close string, volume string, trade_count string")
    row = tables.normalise_strict(df).first()
    assert (row["open"], row["volume"], row["trade_count"]) == (8.5, 3.25, 13)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.normalise_strict(df.withColumn("low", F.lit("x"))).collect()
