import datetime as dt
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from wickline.functions import errors, keys, numbers, times

NAMES = ["BTCUSDT", "btcusdt", " ethusdt\t", "1000왜USDT", "/absusdt", "%3D", "A=B", "007", "a b", "Ω+*", "x_y-z", "é%25"]
BAD = ["", "  ", ".", "..", "a.b", "a~b"]


def column(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", function(F.col("v"))).orderBy("i").collect()]


def test_symbol_keys_equal_percent_encoding(spark):
    found = column(spark, NAMES, keys.symbol_key)
    assert found == [quote(n.strip().upper(), safe="_%=-") for n in NAMES]
    assert found == [keys.require_symbol(n) for n in NAMES]
    assert found[3:5] == ["1000%EC%99%9CUSDT", "%2FABSUSDT"]


def test_bad_symbol_keys(spark):
    assert column(spark, BAD, lambda c: keys.symbol_key(c, strict=False)) == [None] * len(BAD)
    for name in BAD:
        with pytest.raises(ValueError):
            keys.require_symbol(name)
    with pytest.raises(Exception, match="invalid symbol"):
        column(spark, ["a.b"], keys.symbol_key)


def test_storage_keys_keep_case(spark):
    names = [*NAMES, "a.b~c"]
    assert column(spark, names, keys.storage_key) == [quote(n, safe="-_=") for n in names]
    assert column(spark, ["", ".", ".."], lambda c: keys.storage_key(c, strict=False)) == [None] * 3


def test_both_spellings_of_a_symbol_meet(spark):
    assert column(spark, ["1000왜usdt", "1000%EC%99%9CUSDT"], keys.canonical_symbol) == ["1000왜USDT"] * 2
    assert keys.partition_symbol("1000%EC%99%9Cusdt") == "1000왜USDT"


def test_symbol_from_prefix(spark):
    prefixes = ["a/b/BTCUSDT/", "a/%CE%A9USDT", "A+B//"]
    assert column(spark, prefixes, keys.symbol_from_prefix) == ["BTCUSDT", "ΩUSDT", "A+B"]


def test_intervals(spark):
    assert [keys.interval_millis(i) for i in ("1m", "15m", "2h", "3d")] == [
        60_000, 900_000, 7_200_000, 259_200_000,
    ]
    for bad in ("1w", "1M"):
        assert keys.require_interval(bad) == bad
        with pytest.raises(ValueError, match="unsupported interval"):
            keys.interval_millis(bad)
    for bad in ("../../escape", "1m/", "", "m1", "1m\n"):
        with pytest.raises(ValueError, match="invalid interval"):
            keys.require_interval(bad)
    found = column(spark, ["5m", "1h", "1d", "1w", "1M", "x"], keys.interval_millis_column)
    assert found == [300_000, 3_600_000, 86_400_000, None, None, None]


def test_dataset_names(spark):
    names = ["klines", "premiumIndexKlines", "premium_index_klines", "fundingRate", "funding_rate"]
    expected = ["klines", "premiumIndexKlines", "premiumIndexKlines", "fundingRate", "fundingRate"]
    assert column(spark, names, keys.dataset_name) == expected
    assert [keys.require_dataset(n) for n in names] == expected
    with pytest.raises(Exception, match="invalid dataset"):
        column(spark, ["trades"], keys.dataset_name)
    with pytest.raises(ValueError):
        keys.require_dataset("trades")


def test_quote_assets_by_configured_order(spark):
    names = ["BTCUSDT", "ETHBUSD", "XUSDC", "USDT"]
    assert column(spark, names, lambda c: keys.quote_asset(c, ("USDT", "USDC"))) == ["USDT", None, "USDC", "USDT"]
    assert column(spark, ["BTCUSDT"], lambda c: keys.quote_asset(c, ("T", "USDT"))) == ["T"]


def test_archive_keys(spark):
    df = spark.createDataFrame(
        [
            (0, "klines", "btcusdt", "1m", "2026-06-01"),
            (1, "premiumIndexKlines", "BTCUSDT", "1m", "2026-06"),
            (2, "fundingRate", "BTCUSDT", None, "2026-05"),
        ],
        "i int, d string, s string, n string, p string",
    ).orderBy("i")
    parts = [F.col(c) for c in "dsnp"]
    urls = [r[0] for r in df.select(keys.archive_url("https://host/", keys.archive_key(*parts))).collect()]
    assert urls == [
        "https://host/data/futures/um/daily/klines/BTCUSDT/1m/BTCUSDT-1m-2026-06-01.zip",
        "https://host/data/futures/um/monthly/premiumIndexKlines/BTCUSDT/1m/BTCUSDT-1m-2026-06.zip",
        "https://host/data/futures/um/monthly/fundingRate/BTCUSDT/BTCUSDT-fundingRate-2026-05.zip",
    ]
    files = [r[0] for r in df.select(keys.raw_file_key(*parts)).collect()]
    assert files == [
        "klines/BTCUSDT/BTCUSDT_klines_1m_2026-06-01.parquet",
        "premiumIndexKlines/BTCUSDT/BTCUSDT_premiumIndexKlines_1m_2026-06.parquet",
        "fundingRate/BTCUSDT/BTCUSDT_fundingRate_2026-05.parquet",
    ]


TEXTS = {
    "1": (1.0, 1), "1.5": (1.5, 2), "2.5": (2.5, 3), "-1.5": (-1.5, -2), " 7 ": (7.0, 7), "1_000": (1000.0, 1000),
    "1__0": (None, None), "_1": (None, None), "1_": (None, None), "1.5d": (None, None), "1f": (None, None),
    "inf": (float("inf"), None), "1e3": (1000.0, 1000), "": (None, None), "abc": (None, None), "+5": (5.0, 5),
    ".5": (0.5, 1), "5.": (5.0, 5), "1e": (None, None), "9223372036854775807": (9.223372036854776e18, 2**63 - 1),
    "9223372036854775808": (9.223372036854776e18, None), "1_0.5_0": (10.5, 11), "0x10": (None, None),
}


def test_tolerant_numbers(spark):
    assert column(spark, list(TEXTS), numbers.text_to_double) == [v[0] for v in TEXTS.values()]
    assert column(spark, list(TEXTS), numbers.text_to_long) == [v[1] for v in TEXTS.values()]
    (nan,) = column(spark, ["NaN"], numbers.text_to_double)
    assert nan != nan


def test_epoch_millis_by_stored_type(spark):
    texts = {
        "2024-01-01 00:00:01": 1704067201000, "2024-01-01": 1704067200000, "1700000000000": 1700000000000,
        "17000": 17000, "2024": 2024, "2024-01-01T00:00:01+02:00": 1704060001000, "x": None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in df.orderBy("i").select(times.epoch_millis(df, "t")).collect()]
    assert found == list(texts.values())
    stamps = spark.sql("SELECT timestamp_micros(m) t FROM VALUES (1500), (1499), (-1500), (-1499) AS v(m)")
    assert [r[0] for r in stamps.select(times.epoch_millis(stamps, "t")).collect()] == [2, 1, -2, -1]
    # A number is milliseconds, never seconds.
    longs = spark.sql("SELECT 1700000000000 AS t")
    assert longs.select(times.epoch_millis(longs, "t")).first()[0] == 1700000000000


def test_epochs_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_seconds(1704067200) AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(times.epoch_seconds(df, "t"), times.epoch_millis(df, "t")).first() == (
            1704067200, 1704067200000,
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_units_buckets_and_periods(spark):
    df = spark.createDataFrame([(10_000_000_000,), (10_000_000_001,), (1704067200999,), (-5,)], "v bigint")
    assert [r[0] for r in df.select(times.seconds_from_any_unit(F.col("v"))).collect()] == [
        10_000_000_000, 10_000_000, 1704067200, -5,
    ]
    df = spark.createDataFrame([(-61,), (-60,), (0,), (59,), (60,)], "v bigint")
    assert [r[0] for r in df.select(times.bucket_start(F.col("v"), 60)).collect()] == [-120, -60, 0, 0, 60]
    with pytest.raises(ValueError):
        times.bucket_start(F.col("v"), 0)
    periods = ["2024-02", "2023-02", "2024-12", "2024-06-15", "garbage"]
    assert column(spark, periods, times.period_end_day) == [
        "2024-02-29", "2023-02-28", "2024-12-31", "2024-06-15", None,
    ]
    day = spark.createDataFrame([(dt.date(2026, 6, 15),)], "d date")
    bounds = day.select(times.day_start_millis(F.col("d")), times.day_end_millis(F.col("d"))).first()
    assert bounds == (1781481600000, 1781567999999)


def test_file_names(spark):
    names = [
        "BTCUSDT_klines_1m_2026-06.parquet", "BTCUSDT_premiumIndexKlines_1m_2026-06-15.parquet",
        "A_B_fundingRate_2026-05.parquet", "BTCUSDT_fundingRate_2026-05-01.parquet", "x.parquet",
    ]
    df = spark.createDataFrame([(i, n) for i, n in enumerate([*names, "A_klines_2026-06.parquet"])], "i int, v string")
    parsed = df.select("i", times.file_name_parts(F.col("v")).alias("parts")).orderBy("i")
    found = parsed.select(*[times.part(n) for n in ("dataset", "symbol", "interval", "period")]).collect()
    assert [tuple(r) if r[0] else None for r in found] == [
        ("klines", "BTCUSDT", "1m", "2026-06"), ("premiumIndexKlines", "BTCUSDT", "1m", "2026-06-15"),
        ("fundingRate", "A_B", None, "2026-05"), ("fundingRate", "BTCUSDT", None, "2026-05-01"), None, None,
    ]
    assert [r[1] for r in found][-2:] == [None, None]


def test_missing_errors(spark):
    messages = ["HTTP 404 Not Found", "404", "not found", "400 Bad Request", "Invalid symbol.", "code -1121", "boom", None]
    assert column(spark, messages, errors.is_missing_archive) == [True] + [False] * 7
    assert column(spark, messages, errors.is_missing_rest) == [
        True, False, False, True, True, True, False, False,
    ]


def test_both_forms_of_a_canonical_symbol_agree(spark):
    names = ["100%usdt", "A%zzUSDT", "B%3DUSDT", "C%", "D%FF%FEX", "1000왜usdt", "E%2", "%41B", "x%25y", "é%C3%A9"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = [r[0] for r in df.select(keys.canonical_symbol(F.col("name"))).collect()]
    assert found == [keys.partition_symbol(n) for n in names] and None not in found
    assert found[:4] == ["100%USDT", "A%ZZUSDT", "B=USDT", "C%"]
