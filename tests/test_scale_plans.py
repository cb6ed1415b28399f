"""Physical plans and results that must hold when one key owns much of the data."""

import pytest
from pyspark.sql import functions as F

from wickline.operators import candles, coverage, funding, gaps, status, universe
from wickline.plans import adapters, compaction
from wickline.schemas import RAW_KLINE
from wickline.sources import archives, pages, tables
from wickline.sources.tables import Layout

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, part):
    return text.count(part)


@pytest.mark.parametrize("tie_bits", [None, 30])
def test_resampling_pre_aggregates_by_hash(spark, tie_bits):
    lines = adapters.line_candles(spark, SF_DIR)
    plan = plan_of(candles.resample(lines, 86_400, tie_key="source_key", tie_bits=tie_bits))
    final = plan.split("Initial Plan")[0]
    assert "SortAggregate" not in plan and "partial_min_by" in final
    assert count(final, "Exchange hashpartitioning") == 1


def test_page_merge_pre_aggregates_by_hash(spark):
    items = spark.range(1000).select(
        F.lit("X").alias("symbol"), F.col("id").alias("page_no"), F.col("id").alias("position"),
        F.lit(1).cast("bigint").alias("funding_millis"), F.rand().alias("funding_rate"), F.rand().alias("mark_price"),
    )
    plan = plan_of(funding.merge_pages(items))
    assert "SortAggregate" not in plan and "partial_max_by" in plan and "Window" not in plan


def test_gap_windows_never_span_a_symbol(spark):
    plan = plan_of(gaps.find_gaps(adapters.line_candles(spark, SF_DIR), 86_400))
    final = plan.split("Initial Plan")[0]
    # The window over rows is cut by day, the one over a symbol sees the edges of its days.
    windows = [line for line in final.splitlines() if "Window [" in line]
    assert len(windows) == 2 and "day" in windows[1].split("windowspecdefinition")[1]
    assert "Filter ((isnull(before" in final.split(windows[0])[1].split(windows[1])[0]


def test_targets_are_planned_without_a_join_or_shuffle(spark):
    import datetime as dt

    symbols = spark.range(10).select(F.col("id").cast("string").alias("symbol"))
    targets = coverage.refresh_targets(symbols, ("klines", "fundingRate"), dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    plan = plan_of(targets)
    assert "Join" not in plan and "Exchange" not in plan and "Cartesian" not in plan


def test_universe_and_liquidity_need_no_join(spark):
    listed = spark.createDataFrame([("klines", "AUSDT")], "dataset string, symbol string")
    tickers = spark.createDataFrame([("AUSDT", 1.0)], "symbol string, quote_volume double")
    for df in (universe.build_universe(listed), universe.quote_liquidity(tickers)):
        assert "Join" not in plan_of(df)


def test_archive_bytes_are_never_joined_or_shuffled(spark):
    zips, checksums = adapters.archives(spark, SF_DIR)
    stored = spark.createDataFrame([("a", b"x")], zips.schema)
    extracted = archives.extract(stored)
    outcomes = archives.archive_outcomes(extracted, checksums)
    for df in (outcomes, archives.good_rows(extracted, outcomes)):
        plan = plan_of(df)
        for line in plan.splitlines():
            assert not ("content" in line and ("Join" in line or "Exchange" in line)), line


def test_gaps_take_one_scan_and_two_exchanges(spark):
    df = adapters.event_candles(spark, SF_DIR)
    found = gaps.find_gaps(df, 60)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert count(final, "FileScan") == 1 and "SortAggregate" not in final
    direct = spark.read.parquet(f"{SF_DIR}/events.parquet").select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("open_time")
    )
    final = plan_of(gaps.find_gaps(direct, 60)).split("Initial Plan")[0]
    assert count(final, "Exchange hashpartitioning") == 2 and count(final, "FileScan") == 1


def test_grouped_rollups_do_not_sort(spark):
    schema = "dataset string, interval string, symbol string, latest_complete_utc_day string, source_count bigint"
    seen = spark.createDataFrame([("klines", "1m", "A", "2026-06-01", 1)], schema)
    outcomes = spark.createDataFrame(
        [("k", "c", 1, None, None)], "k string, checksum string, row_count bigint, error_code string, error_message string"
    )
    for df in (status.freshness(seen), coverage.one_outcome(outcomes, ["k"])):
        assert "SortAggregate" not in plan_of(df)


def skewed(spark, rows=60_000):
    """One symbol holds nine tenths of the rows, one of its minutes a third."""
    hot = F.col("id") % 10 != 0
    minute = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(rows).select(
        F.timestamp_seconds(F.lit(1780272000) + F.when(hot, minute).otherwise(F.col("id")) * 60).alias("open_time"),
        *[(F.col("id") % 97).cast("double").alias(n) for n in ("open", "high", "low", "close", "volume")],
        F.lit(1).cast("bigint").alias("trade_count"), F.col("id").alias("source_row"), F.lit("klines").alias("dataset"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("symbol"),
        F.lit("1m").alias("interval"), F.lit("2026-06").alias("period"),
    ).select(*RAW_KLINE.names)


@pytest.mark.parametrize("dedupe", [None, "latest_period"])
def test_skewed_compaction_matches_pandas(spark, dedupe):
    raw = skewed(spark)
    got = compaction.compacted_rows(raw, "1h", dedupe)
    found = {
        (r["symbol"], r["t"]): (r["open"], r["high"], r["low"], r["close"], r["volume"], r["trade_count"])
        for r in got.withColumn("t", F.unix_seconds("open_time")).collect()
    }
    pdf = raw.withColumn("t", F.unix_seconds("open_time")).toPandas().sort_values("source_row")
    if dedupe:
        pdf = pdf.drop_duplicates(["symbol", "t"], keep="last")
    pdf["b"] = pdf["t"] // 3600 * 3600
    first = pdf.sort_values(["t", "source_row"]).groupby(["symbol", "b"])["open"].first()
    last = pdf.sort_values(["t", "source_row"], ascending=[True, False]).groupby(["symbol", "b"])["close"].last()
    rest = pdf.groupby(["symbol", "b"]).agg(high=("high", "max"), low=("low", "min"), volume=("volume", "sum"), n=("trade_count", "sum"))
    expected = {
        k: (first[k], r.high, r.low, last[k], r.volume, r.n) for k, r in zip(rest.index, rest.itertuples(index=False))
    }
    assert found == expected


def test_skewed_gaps_match_brute_force(spark):
    raw = skewed(spark, 20_000)
    found = {tuple(r) for r in gaps.find_gaps(raw, 60).select("symbol", "observed_before_ts", "observed_after_ts").collect()}
    pdf = raw.withColumn("t", F.unix_seconds("open_time")).toPandas()
    expected = set()
    for symbol, group in pdf.groupby("symbol"):
        seconds = sorted(set(int(t) for t in group["t"]))
        expected |= {(symbol, a, b) for a, b in zip(seconds, seconds[1:]) if b - a > 60}
    assert found == expected


@pytest.mark.parametrize("dedupe", [None, "latest_period"])
def test_compaction_shuffles_twice_and_writes_clustered(spark, tmp_path, dedupe):
    layout = Layout(str(tmp_path))
    tables.write_raw_candles(skewed(spark, 1000), layout)
    raw = tables.read_raw_candles(spark, layout, "klines").where("interval = '1m'")
    rows = compaction.compacted_rows(raw, "1h", dedupe)
    plan = plan_of(rows).split("Initial Plan")[0]
    assert count(plan, "Exchange hashpartitioning") == 2 and "SortAggregate" not in plan
    assert "partial_max_by" in plan
    parts = rows.withColumn("part", F.spark_partition_id()).select("symbol", "year", "part").distinct()
    assert parts.count() == parts.select("symbol", "year").distinct().count()


def test_pages_are_parsed_once(spark):
    parsed = pages.parse_premium_pages(adapters.premium_pages(spark, SF_DIR))
    plan = plan_of(pages.premium_rows(parsed, ["symbol"])).split("Initial Plan")[0]
    assert count(plan, "parseJson") == 1
