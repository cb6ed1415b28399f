import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wickline.operators import coverage, status
from wickline.schemas import FAILURE, SOURCE
from wickline.sources import ledgers
from wickline.sources.tables import Layout

D = dt.date


@pytest.fixture
def symbols(spark):
    return spark.createDataFrame([("BTCUSDT",)], "symbol string")


def plan(df):
    return sorted((r["dataset"], r["route"], r["period"], r["target_date"]) for r in df.collect())


def test_daily_and_monthly_targets(symbols):
    daily = coverage.archive_targets(symbols, ("klines", "fundingRate"), D(2026, 5, 31), D(2026, 6, 1))
    assert plan(daily) == [("klines", "archive", d, d) for d in ("2026-05-31", "2026-06-01")]
    monthly = coverage.archive_targets(symbols, ("klines",), D(2026, 6, 1), D(2026, 6, 30), "1m", "monthly")
    assert plan(monthly) == [("klines", "archive", "2026-06", "2026-06-01")]
    across = coverage.archive_targets(symbols, ("klines",), D(2025, 12, 31), D(2026, 1, 1), "1m", "monthly")
    assert [r[2] for r in plan(across)] == ["2025-12", "2026-01"]
    assert coverage.archive_targets(symbols, ("klines",), D(2026, 6, 2), D(2026, 6, 1)).count() == 0
    with pytest.raises(ValueError):
        coverage.archive_targets(symbols, ("klines",), D(2026, 6, 1), D(2026, 6, 2), "1m", "weekly")


@pytest.mark.parametrize(
    ("start", "end", "granularity", "archive", "rest"),
    [
        (D(2026, 5, 1), D(2026, 5, 31), "monthly", 1, 0),
        (D(2026, 5, 30), D(2026, 6, 2), "monthly", 0, 4),
        (D(2026, 4, 30), D(2026, 6, 1), "monthly", 1, 2),
        (D(2026, 5, 1), D(2026, 5, 31), "daily", 0, 31),
    ],
)
def test_funding_calendar(symbols, start, end, granularity, archive, rest):
    routes = Counter(r["route"] for r in coverage.funding_targets(symbols, start, end, granularity).collect())
    assert (routes["archive"], routes["rest"]) == (archive, rest)


OUTCOME = "checksum string, row_count bigint, error_code string, error_message string"


def resolve(spark, dataset, archive, fallback, period="2026-06-01"):
    targets = spark.createDataFrame(
        [(dataset, "X", "1m", period, period if len(period) > 7 else period + "-01", "archive", "url", "out")],
        "dataset string, symbol string, interval string, period string, target_date string, route string, "
        "source_url string, output_path string",
    )
    archives = spark.createDataFrame(
        [(dataset, "X", "1m", period, *archive)] if archive else [],
        "dataset string, symbol string, interval string, period string, " + OUTCOME,
    )
    fallbacks = spark.createDataFrame(
        [("X", "1m", day, "page", *o) for day, o in fallback.items()],
        "symbol string, interval string, day string, output_path string, " + OUTCOME,
    )
    rows = coverage.resolve_archives(targets, archives, fallbacks, "pages").orderBy("target_date").collect()
    return [(r["kind"], r["target_date"], r["source_url"], r["row_count"], r["error_code"]) for r in rows]


GOOD = ("abc", 7, None, None)
MISSING = (None, None, None, "HTTP 404 Not Found")
NOT_FOUND = (None, None, "archive_not_found", "gone")
MISMATCH = (None, None, "checksum_mismatch", "expected a got b")
RAISED = (None, None, None, "broken pipe")
EMPTY_PAGE = (None, 0, None, None)
BAD_PAGE = (None, None, None, "timed out")
DAY = "2026-06-01"


@pytest.mark.parametrize(
    ("dataset", "archive", "fallback", "expected"),
    [
        ("klines", GOOD, None, ("source", DAY, "url", 7, None)),
        ("klines", MISSING, None, None),
        ("klines", NOT_FOUND, None, None),
        ("klines", None, None, None),
        ("klines", MISMATCH, GOOD, ("failure", DAY, "url", None, "checksum_mismatch")),
        ("klines", RAISED, None, ("failure", DAY, "", None, "archive_exception")),
        ("premiumIndexKlines", MISMATCH, EMPTY_PAGE, ("source", DAY, "pages", 0, None)),
        ("premiumIndexKlines", RAISED, BAD_PAGE, ("failure", DAY, "pages", None, "premium_fallback_exception")),
        ("premiumIndexKlines", RAISED, MISSING, None),
        ("premiumIndexKlines", RAISED, None, ("failure", DAY, "", None, "archive_exception")),
        ("premiumIndexKlines", GOOD, BAD_PAGE, ("source", DAY, "url", 7, None)),
        ("premiumIndexKlines", MISSING, EMPTY_PAGE, None),
    ],
)
def test_archive_outcomes(spark, dataset, archive, fallback, expected):
    found = resolve(spark, dataset, archive, {DAY: fallback} if fallback else {})
    assert found == ([expected] if expected else [])


def test_monthly_premium_falls_back_to_every_day(spark):
    days = {f"2026-06-{d:02d}": EMPTY_PAGE for d in range(1, 29)}
    found = resolve(spark, "premiumIndexKlines", RAISED, {**days, "2026-06-29": BAD_PAGE}, "2026-06")
    assert Counter(r[4] for r in found) == {
        None: 28, "premium_fallback_exception": 1, "archive_exception": 1,
    }
    assert resolve(spark, "premiumIndexKlines", RAISED, {}, "2026-06") == [
        ("failure", "2026-06-01", "", None, "archive_exception")
    ]


def test_funding_outcomes(spark):
    names = ["OK", "MISSING", "FAILED", "ABSENT"]
    symbols = spark.createDataFrame([(n,) for n in names], "symbol string")
    targets = coverage.funding_targets(symbols, D(2026, 4, 30), D(2026, 5, 31), "monthly")
    targets = targets.withColumn("source_url", F.lit("url")).withColumn("output_path", F.lit("out"))
    archives = spark.createDataFrame(
        [("OK", "2026-05", *GOOD), ("MISSING", "2026-05", *MISSING), ("FAILED", "2026-05", *MISMATCH)],
        "symbol string, period string, " + OUTCOME,
    )
    pages = spark.createDataFrame(
        [(n, "2026-04-30", "page", *EMPTY_PAGE) for n in names]
        + [(n, "2026-05-01", "page", *EMPTY_PAGE) for n in names]
        + [("FAILED", "2026-05-02", "page", *BAD_PAGE), ("FAILED", "2026-05-03", "page", None, None, None, "-1121")],
        "symbol string, day string, output_path string, " + OUTCOME,
    )
    rows = coverage.resolve_funding(targets, archives, pages, "rest").collect()
    found = sorted((r["symbol"], r["target_date"], r["kind"], r["error_code"]) for r in rows)
    day = [(n, "2026-04-30", "source", None) for n in names]
    assert found == sorted(
        [*day, ("OK", "2026-05", "source", None), ("FAILED", "2026-05-01", "source", None),
         ("FAILED", "2026-05-02", "failure", "funding_rest_exception")],
        key=lambda r: tuple(map(str, r)),
    )


def source(dataset, symbol, interval, day, rows=2):
    return (dataset, symbol, interval, day, "url", "out", None, rows)


def failure(message="m", code="checksum_mismatch"):
    return ("klines", "X", "1m", "2026-06-11", "url", 1, code, message, True)


def test_missing_targets_and_counts(spark, symbols):
    targets = coverage.refresh_targets(symbols, ("klines", "fundingRate"), D(2026, 6, 1), D(2026, 6, 2))
    done = spark.createDataFrame(
        [source("klines", "BTCUSDT", "1m", "2026-06-01"), source("fundingRate", "BTCUSDT", None, "2026-06-02")], SOURCE
    )
    assert plan(coverage.missing_targets(targets, done)) == [
        ("fundingRate", "rest", "2026-06-01", "2026-06-01"), ("klines", "archive", "2026-06-02", "2026-06-02"),
    ]
    rows = spark.createDataFrame([("BTCUSDT", "2026-06-01")] * 3, "symbol string, period string")
    counted = coverage.with_row_counts(targets.where("dataset = 'klines'"), rows, ["symbol", "period"])
    assert [r["row_count"] for r in counted.orderBy("period").collect()] == [3, 0]


def test_one_outcome_prefers_success(spark):
    df = spark.createDataFrame([("a", *RAISED), ("a", *GOOD), ("b", *RAISED), ("b", *MISMATCH)], "k string, " + OUTCOME)
    found = {r["k"]: (r["row_count"], r["error_message"]) for r in coverage.one_outcome(df, ["k"]).collect()}
    assert found["a"] == (7, None) and found["b"][0] is None


def test_freshness_and_manifests(spark):
    files = spark.createDataFrame(
        [("A_premiumIndexKlines_1m_2026-06.parquet",), ("B_premiumIndexKlines_1m_2026-05-03.parquet",),
         ("A_fundingRate_2026-05-01.parquet",), ("A_fundingRate_2026-05.parquet",), ("junk",)], "name string")
    manifests = spark.createDataFrame(
        [("BTCUSDT", "1m", "x/BTCUSDT_klines_1m_2026-06.parquet", 2), ("ETHUSDT", "1m", None, None)],
        "symbol string, interval string, last_source string, source_files bigint",
    )
    seen = status.file_observations(files).unionByName(status.manifest_observations(manifests))
    assert [tuple(r) for r in status.ordered_freshness(status.freshness(seen)).collect()] == [
        ("fundingRate", None, 1, "2026-05-31", 2),
        ("klines", "1m", 2, "2026-06-30", 3),
        ("premiumIndexKlines", "1m", 2, "2026-06-30", 2),
    ]


def test_run_rollup(spark):
    schema = "kind string, error_message string, n int"
    rows = [("source", None, 0), ("failure", "late", 2), ("failure", "early", 1), ("source", None, 3)]
    run = status.run_rollup(spark.createDataFrame(rows, schema), [F.col("n")]).first()
    assert tuple(run) == ("failed", 4, 2, 2, "early")
    clean = status.run_rollup(spark.createDataFrame(rows[:1], schema), [F.col("n")]).first()
    assert tuple(clean) == ("succeeded", 1, 1, 0, None)
    empty = status.run_rollup(spark.createDataFrame([], schema), [F.col("n")]).first()
    assert tuple(empty) == ("succeeded", 0, 0, 0, None)


def test_ledgers(spark, tmp_path):
    layout = Layout(str(tmp_path))
    missing = ledgers.read_status(spark, layout).first()
    assert (missing["status"], missing["last_run"], missing["source_count"], missing["freshness"]) == ("missing", None, 0, [])
    assert ledgers.read_failures(spark, layout).count() == 0
    failures = spark.createDataFrame([failure()], FAILURE)
    sources = spark.createDataFrame([source("premiumIndexKlines", "X", "1m", "2026-06")], SOURCE)
    rolled = status.status_rollup(failures, sources)
    document = rolled.select(
        "*", F.lit(None).cast(
            "struct<id:string,mode:string,status:string,started_at:string,finished_at:string,symbol_count:bigint,"
            "item_count:bigint,success_count:bigint,failure_count:bigint,last_error:string>"
        ).alias("last_run"),
    )
    fresh = status.nested_freshness(status.published_freshness(sources)).first()["freshness"]
    assert [tuple(r) for r in fresh] == [("premiumIndexKlines", "1m", 1, "2026-06-30")]
    document = document.withColumn("freshness", F.array(F.struct(
        F.lit("klines").alias("dataset"), F.lit("1m").alias("interval"), F.lit(1).cast("bigint").alias("symbol_count"),
        F.lit("2026-06-11").alias("latest_complete_utc_day"))))
    ledgers.publish(layout, document, failures, sources)
    ledgers.append_failures(spark.createDataFrame([failure("again", "not_found")], FAILURE), layout)
    ledgers.append_sources(spark.createDataFrame([source("fundingRate", "X", None, "2026-05", 0)], SOURCE), layout)
    assert sorted(r["error_code"] for r in ledgers.read_failures(spark, layout).collect()) == ["checksum_mismatch", "not_found"]
    assert sorted(r["row_count"] for r in ledgers.read_sources(spark, layout).collect()) == [0, 2]
    stored = ledgers.read_status(spark, layout).first()
    assert (stored["status"], stored["failed_item_count"], stored["source_count"]) == ("degraded", 1, 1)
    lines = spark.read.text(layout.version(spark).folders("sources")).collect()
    assert all(line[0].startswith('{"checksum":null,"dataset":') for line in lines)


@pytest.mark.parametrize("line", ['{"dataset":1}', "[]", '{"dataset":"d"', "null"])
def test_broken_ledger_lines_are_errors(spark, tmp_path, line):
    layout = Layout(str(tmp_path))
    with layout.changing(spark) as inside:
        inside.commit.write_ledger(spark.createDataFrame([(line,)], "value string"), "failures")
    with pytest.raises(Exception, match="ledger field|MALFORMED"):
        ledgers.read_failures(spark, layout).collect()


def test_gap_ledger_drops_mistyped_records_and_appends_once(spark, tmp_path):
    layout = Layout(str(tmp_path))
    good = (
        '{"dataset":"klines","interval":"1m","missing_count":1,"missing_end_ts":1700000060,"missing_start_ts":1700000000,'
        '"observed_after_ts":1700000120,"observed_before_ts":1699999940,"reason":"timestamp_gap","symbol":"BTCUSDT"}'
    )
    lines = [good.replace("BTCUSDT", "A").replace(':1,', ':"1",'), good.replace(':1,', ":true,"), "[1]", good]
    with layout.changing(spark) as inside:
        inside.commit.write_ledger(spark.createDataFrame([(x,) for x in lines], "value string"), "gaps")
    assert ledgers.read_gaps(spark, layout).count() == 1
    found = ledgers.read_gaps(spark, layout).withColumn("reason", F.lit("other"))
    more = found.unionByName(found.withColumn("symbol", F.lit("ETHUSDT")))
    for _ in range(2):
        ledgers.record_gaps(more, layout)
    rows = ledgers.read_gaps(spark, layout).collect()
    assert [(r["symbol"], r["reason"]) for r in rows] == [("BTCUSDT", "timestamp_gap"), ("ETHUSDT", "other")]


def test_universe_ledger(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert ledgers.read_universe(spark, layout).count() == 0
    ledgers.publish_symbols(spark.createDataFrame([("B",), ("A",)], "symbol string"), layout)
    rows = ledgers.read_universe(spark, layout).orderBy("symbol").collect()
    assert [(r["symbol"], r["quote_asset"], r["datasets"]["klines"]) for r in rows] == [("A", "USDT", True), ("B", "USDT", True)]
