import datetime as dt

import pytest
from pyspark.sql import functions as F

from wickline.operators import candles, gaps

BARS = [
    ("AAAUSDT", "2025-03-10 06:00:00", "50", "58", "47", "52", "3", 5),
    ("AAAUSDT", "2025-03-10 06:01:00", "52", "61", "51", "60", "4", 6),
    ("AAAUSDT", "2025-03-10 06:20:00", "60", "63", "55", "57", "5", 7),
    ("AAAUSDT", "2025-03-10 07:30:00", "57", "70", "56", "66", "6", 8),
]
COLUMNS = "symbol string, t string, open string, high string, low string, close string, volume string, trade_count bigint"


@pytest.fixture
def bars(spark):
    return spark.createDataFrame(BARS, COLUMNS).withColumn("open_time", F.col("t").cast("timestamp"))


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns[:2])).collect()]


def test_resample_golden(bars):
    assert rows(candles.resample(bars, 900)) == [
        ("AAAUSDT", 1741586400, 50.0, 61.0, 47.0, 60.0, 7.0),
        ("AAAUSDT", 1741587300, 60.0, 63.0, 55.0, 57.0, 5.0),
        ("AAAUSDT", 1741591800, 57.0, 70.0, 56.0, 66.0, 6.0),
    ]


def test_gap_counts_golden(bars):
    found = rows(gaps.find_gaps(bars, 60), "missing_start_ts")
    assert [r[3] for r in found] == [18, 69]
    assert found[0][1:] == (1741586520, 1741587540, 18, 1741586460, 1741587600)


def test_intrabar_golden_window_includes_both_ends(bars):
    found = candles.intrabar(bars, 10_800, 1741586460, 1741587600)
    assert [(r["bucket"], r["timestamp"]) for r in found.orderBy("timestamp").collect()] == [
        (1741586400, 1741586460),
        (1741586400, 1741587600),
    ]


def test_nested_intrabar_is_ordered_and_one_row_a_bucket(spark):
    data = [("A", s, float(s), 1.0, 1.0, 1.0, None) for s in (90_000, 0, 60)]
    df = spark.createDataFrame(
        data, "symbol string, s bigint, open double, high double, low double, close double, volume double"
    ).withColumn("open_time", F.timestamp_seconds("s"))
    nested = candles.nest_intrabar(candles.intrabar(df, 604_800)).collect()
    # A missing volume does not drop a bar.
    assert [[b["timestamp"] for b in r["bars"]] for r in nested] == [[0, 60, 90_000]]
    assert {r["bucket"] for r in nested} == {0}


def test_sixty_seconds_is_no_aggregation(spark, bars):
    twice = bars.unionAll(bars)
    assert candles.timeframe(twice, 60).count() == 8
    assert candles.timeframe(twice, 900).count() == 3


def test_one_hour_compaction_golden(spark):
    df = spark.createDataFrame(
        [
            ("X", 1741588200000, "8", "9", "6.5", "7", "1", "4"),
            ("X", 1741588260000, "7", "9.5", "7", "8.25", "2.5", "9"),
        ],
        "symbol string, open_time bigint, open string, high string, low string, close string, volume string, trade_count string",
    )
    (row,) = candles.compact(df, "1h").collect()
    assert tuple(row)[2:] == (8.0, 9.5, 6.5, 8.25, 3.5, 13)
    assert row["open_time"] == dt.datetime(2025, 3, 10, 6, 0)


def test_trade_count_names_mix_and_default(spark):
    base = "symbol string, open_time bigint, open double, high double, low double, close double, volume double"
    first = spark.createDataFrame([("X", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 2)], base + ", number_of_trades bigint")
    second = spark.createDataFrame([("X", 60000, 1.0, 1.0, 1.0, 1.0, 1.0, 3)], base + ", trade_count bigint")
    both = first.unionByName(second, allowMissingColumns=True)
    assert candles.compact(both, "1h").first()["trade_count"] == 5
    assert candles.compact(first.drop("number_of_trades"), "1h").first()["trade_count"] == 0


@pytest.mark.parametrize("interval", ["1w", "1M", "../escape", "m", "1x"])
def test_unsupported_interval(bars, interval):
    with pytest.raises(ValueError):
        candles.compact(bars, interval)


@pytest.mark.parametrize("tie_bits", [None, 10])
def test_ties_take_the_lowest_key_for_open_and_close(spark, tie_bits):
    data = [("X", 0, 5.0, 7), ("X", 0, 4.0, 3), ("X", 1, 8.0, 9), ("X", 1, 6.0, 2), ("X", -61, 1.0, 1)]
    df = spark.createDataFrame(data, "symbol string, s bigint, p double, k bigint").select(
        "symbol", "k", F.timestamp_seconds("s").alias("open_time"),
        *[F.col("p").alias(n) for n in ("open", "high", "low", "close", "volume")],
    )
    found = rows(candles.resample(df, 60, tie_key="k", tie_bits=tie_bits))
    assert found == [
        ("X", -120, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("X", 0, 4.0, 8.0, 4.0, 6.0, 23.0),
    ]


def test_huge_tie_keys(spark):
    top = 2**63 - 1
    data = [("X", 0, 1.0, top), ("X", 0, 2.0, top - 1), ("X", 9, 3.0, top), ("X", 9, 4.0, top - 1)]
    df = spark.createDataFrame(data, "symbol string, s bigint, p double, k bigint").select(
        "symbol", "k", F.timestamp_seconds("s").alias("open_time"),
        *[F.col("p").alias(n) for n in ("open", "high", "low", "close", "volume")],
    )
    (row,) = candles.resample(df, 604_800, tie_key="k").collect()
    assert (row["open"], row["close"]) == (2.0, 4.0)


def test_half_seconds_round_to_even_and_nan_passes(spark):
    df = spark.sql(
        "SELECT 'X' AS symbol, timestamp_micros(m) AS open_time, double('nan') AS open, 1d AS high, "
        "1d AS low, 1d AS close, IF(m = 2500000, NULL, 1d) AS volume FROM VALUES "
        "(500000), (1500000), (2500000), (-1500000) AS t(m)"
    )
    found = candles.candle_rows(df).orderBy("timestamp").collect()
    assert [r["timestamp"] for r in found] == [-2, 0, 2]
    assert all(r["open"] != r["open"] for r in found)


def test_window_bounds_are_exact_and_reach_the_scan(spark, tmp_path):
    df = spark.sql(
        "SELECT 'X' AS symbol, timestamp_micros(m) AS open_time, 1d AS open, 1d AS high, 1d AS low, "
        "1d AS close, 1d AS volume FROM VALUES (9400000), (9500000), (9600000), (20500000), (20500001) AS t(m)"
    )
    df.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    window = candles.candle_rows(stored, 10, 20)
    # 9.5 rounds to 10, 20.5 to 20.
    assert [r["timestamp"] for r in window.orderBy("timestamp").collect()] == [10, 10, 20]
    plan = window._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(open_time" in plan and "LessThan(open_time" in plan


@pytest.mark.parametrize("unique", [False, True])
def test_gaps_across_days_and_fractional_counts(spark, unique):
    seconds = [0, 90, 300, 86_399, 86_400, 400_000, 400_000 + 86_400 * 3]
    repeated = seconds if unique else seconds * 3
    df = spark.createDataFrame([("X", s) for s in repeated] + [("Y", 5)], "symbol string, s bigint")
    df = df.withColumn("open_time", F.timestamp_seconds("s"))
    found = rows(gaps.find_gaps(df, 60, times_unique=unique), "missing_start_ts")
    brute = [
        ("X", a + 60, b - 60, round((b - a) / 60 - 1), a, b)
        for a, b in zip(seconds, seconds[1:])
        if b - a > 60
    ]
    assert found == brute
    assert [r[3] for r in found][:2] == [0, 2]


def test_gap_ledger_first_wins(spark):
    key = ("klines", "BTCUSDT", "1m", 1741586520, 1741586580)
    schema = (
        "dataset string, symbol string, interval string, missing_start_ts bigint, missing_end_ts bigint, "
        "missing_count bigint, observed_before_ts bigint, observed_after_ts bigint, reason string"
    )
    old = spark.createDataFrame([(*key, 2, 1741586460, 1741586640, "first")], schema)
    new = spark.createDataFrame(
        [
            (*key, 7, 1, 2, "timestamp_gap"),
            ("klines", "BTCUSDT", "1m", 5, 6, 9, 1, 2, "timestamp_gap"),
            ("klines", "BTCUSDT", "1m", 5, 6, 2, 1, 2, "timestamp_gap"),
        ],
        schema,
    )
    merged = gaps.merge_gaps(old, new).orderBy("missing_start_ts").collect()
    assert [(r["missing_start_ts"], r["missing_count"], r["reason"]) for r in merged] == [
        (5, 2, "timestamp_gap"),
        (1741586520, 2, "first"),
    ]
