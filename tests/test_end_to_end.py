"""Landed files to query results, through every table."""

import datetime as dt
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wickline.plans import api, compaction, reports
from wickline.plans.ingest import Request, ingest_landed
from wickline.sources import ledgers, tables
from wickline.sources.tables import Layout
from wickline.streaming import incremental

D = dt.date
DAY = 86_400
START = 1780272000  # 2026-06-01


def kline_csv(day_start, minutes, price=100.0):
    return "\n".join(
        f"{(day_start + 60 * m) * 1000},{price},{price + 2},{price - 1},{price + 1},10,0,0,3,0,0,0" for m in minutes
    )


def land(root, key, text=None, error=None, checksum=None):
    path = root / "data/futures/um" / key
    path.parent.mkdir(parents=True, exist_ok=True)
    if error is not None:
        path.with_name(path.name + ".ERROR").write_text(error)
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("rows.csv", text)
    path.write_bytes(buffer.getvalue())
    digest = checksum or hashlib.sha256(buffer.getvalue()).hexdigest()
    path.with_name(path.name + ".CHECKSUM").write_text(f"{digest}  {path.name}\n")


def land_page(root, where, payload):
    path = root / "pages" / where
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload))


def premium_row(second, price="-0.1"):
    return [second * 1000, price, "0.2", "-0.3", price, "0", 0, "0", 12, "0", "0", "0"]


def daily(dataset, symbol, day):
    return f"daily/{dataset}/{symbol}/1m/{symbol}-1m-{day}.zip"


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("market")
    landed, root = base / "landed", str(base / "store")
    # Klines: complete, gapped, wrong checksum, missing, and one nobody asked for.
    land(landed, daily("klines", "BTCUSDT", "2026-06-01"), kline_csv(START, range(10)))
    land(landed, daily("klines", "BTCUSDT", "2026-06-02"), kline_csv(START + DAY, [0, 1, 5]))
    land(landed, daily("klines", "%2FABUSDT", "2026-06-01"), kline_csv(START, range(3), 7.0))
    land(landed, daily("klines", "%2FABUSDT", "2026-06-02"), kline_csv(START, [0]), checksum="0" * 64)
    land(landed, daily("klines", "OTHERUSDT", "2026-06-01"), kline_csv(START, range(4)))
    land(landed, daily("klines", "GONEUSDT", "2026-06-01"), error="HTTP 404 Not Found")
    land(landed, daily("klines", "GONEUSDT", "2026-06-02"), error="connection reset")
    # Premium index: archive, and archives that failed with good, empty, bad or no pages.
    land(landed, daily("premiumIndexKlines", "BTCUSDT", "2026-06-01"), kline_csv(START, range(2), -5.0))
    land(landed, daily("premiumIndexKlines", "BTCUSDT", "2026-06-02"), "x,y", checksum="0" * 64)
    land_page(landed, "premiumIndexKlines/BTCUSDT/1m/2026-06-02/0.json", [premium_row(START + DAY), premium_row(START + DAY + 60)])
    land(landed, daily("premiumIndexKlines", "%2FABUSDT", "2026-06-01"), error="boom")
    land_page(landed, "premiumIndexKlines/%2FABUSDT/1m/2026-06-01/0.json", [])
    land(landed, daily("premiumIndexKlines", "%2FABUSDT", "2026-06-02"), error="boom")
    land_page(landed, "premiumIndexKlines/%2FABUSDT/1m/2026-06-02/0.json", [premium_row(START + DAY), [1]])
    land(landed, daily("premiumIndexKlines", "GONEUSDT", "2026-06-01"), error="boom")
    # Funding by page: overlapping pages, a bad page, an empty day, an error.
    item = {"fundingTime": START * 1000, "fundingRate": "0.0001", "markPrice": "5"}
    late = {"fundingTime": (START + 8) * 1000, "fundingRate": "0.0002", "markPrice": None}
    outside = {"fundingTime": (START + DAY) * 1000, "fundingRate": "9", "markPrice": None}
    land_page(landed, "fundingRate/BTCUSDT/2026-06-01/0.json", [item, late])
    land_page(landed, "fundingRate/BTCUSDT/2026-06-01/1.json", [{**late, "fundingRate": "0.0003"}, outside])
    land_page(landed, "fundingRate/BTCUSDT/2026-06-02/0.json", [])
    land_page(landed, "fundingRate/%2FABUSDT/2026-06-01/0.json", [item])
    land_page(landed, "fundingRate/%2FABUSDT/2026-06-01/1.json", "{}")
    land_page(landed, "fundingRate/GONEUSDT/2026-06-01/0.json.ERROR", "400 Bad Request: Invalid symbol")
    request = Request(["BTCUSDT", "/abusdt", "GONEUSDT"], D(2026, 6, 1), D(2026, 6, 2), base_url="https://host")
    run = ingest_landed(spark, root, str(landed), request).first()
    return root, landed, run, request


def test_run_and_ledgers(spark, refreshed):
    root, _, run, _ = refreshed
    layout = Layout(root)
    sources = {(r["dataset"], r["symbol"], r["target_date"]): r for r in ledgers.read_sources(spark, layout).collect()}
    assert {k: r["row_count"] for k, r in sources.items()} == {
        ("klines", "BTCUSDT", "2026-06-01"): 10,
        ("klines", "BTCUSDT", "2026-06-02"): 3,
        ("klines", "/ABUSDT", "2026-06-01"): 3,
        ("premiumIndexKlines", "BTCUSDT", "2026-06-01"): 2,
        ("premiumIndexKlines", "BTCUSDT", "2026-06-02"): 2,
        ("premiumIndexKlines", "/ABUSDT", "2026-06-01"): 0,
        ("fundingRate", "BTCUSDT", "2026-06-01"): 2,
        ("fundingRate", "BTCUSDT", "2026-06-02"): 0,
    }
    failures = {(r["dataset"], r["symbol"], r["target_date"]): r["error_code"] for r in ledgers.read_failures(spark, layout).collect()}
    assert failures == {
        ("klines", "/ABUSDT", "2026-06-02"): "checksum_mismatch",
        ("klines", "GONEUSDT", "2026-06-02"): "archive_exception",
        ("premiumIndexKlines", "/ABUSDT", "2026-06-02"): "premium_fallback_exception",
        ("premiumIndexKlines", "GONEUSDT", "2026-06-01"): "archive_exception",
        ("fundingRate", "/ABUSDT", "2026-06-01"): "funding_rest_exception",
    }
    assert (run["status"], run["success_count"], run["failure_count"], run["symbol_count"]) == ("failed", 8, 5, 3)
    # First in the order asked for: the second symbol's klines.
    assert run["last_error"].startswith("expected 000")
    url = sources[("klines", "/ABUSDT", "2026-06-01")]["source_url"]
    assert url == "https://host/data/futures/um/daily/klines/%2FABUSDT/1m/%2FABUSDT-1m-2026-06-01.zip"


def test_status_reports(spark, refreshed):
    root, _, run, _ = refreshed
    document = reports.status(spark, root).first()
    assert (document["status"], document["failed_item_count"], document["source_count"]) == ("degraded", 5, 8)
    assert document["last_run"]["id"] == run["id"]
    assert [tuple(r) for r in document["freshness"]] == [
        ("fundingRate", None, 1, "2026-06-02"), ("klines", "1m", 2, "2026-06-02"), ("premiumIndexKlines", "1m", 2, "2026-06-02"),
    ]
    assert tuple(reports.validate(spark, root).first()) == (True, "degraded", 5)
    assert tuple(reports.plan(spark, root).first()) == (2, "degraded")
    assert [r[0] for r in reports.local_symbols(spark, root).collect()] == ["/ABUSDT", "BTCUSDT"]
    assert [tuple(r) for r in reports.scan_local_status(spark, root).collect()] == [
        ("fundingRate", None, 1, "2026-06-01", 1),
        ("klines", "1m", 2, "2026-06-02", 2),
        ("premiumIndexKlines", "1m", 1, "2026-06-02", 2),
    ]


def test_status_before_any_run(spark, tmp_path):
    root = str(tmp_path)
    assert tuple(reports.validate(spark, root).first()) == (False, "missing", 0)
    assert tuple(reports.plan(spark, root).first()) == (0, "missing")
    assert reports.scan_local_status(spark, root).count() == 0
    assert api.load_klines(spark, root, "BTCUSDT").count() == 0
    assert api.load_funding_rates(spark, root, "BTCUSDT").count() == 0
    assert api.available_klines(spark, root).count() == 0


def test_reads(spark, refreshed):
    root = refreshed[0]
    bars = api.load_klines(spark, root, "btcusdt", "1m", START + 60, START + 120).collect()
    assert [tuple(r) for r in bars] == [
        ("BTCUSDT", START + 60, 100.0, 102.0, 99.0, 101.0, 10.0),
        ("BTCUSDT", START + 120, 100.0, 102.0, 99.0, 101.0, 10.0),
    ]
    assert api.load_klines(spark, root, "OTHERUSDT").count() == 0
    assert [r["symbol"] for r in api.available_klines(spark, root).collect()] == ["/ABUSDT", "BTCUSDT"]
    assert api.available_klines(spark, root, "/abusdt", "1m").count() == 1
    frames = api.load_resampled_klines(spark, root, ["BTCUSDT"], 300).collect()
    assert [(r["timestamp"] - START, r["volume"]) for r in frames] == [(0, 50.0), (300, 50.0), (DAY, 20.0), (DAY + 300, 10.0)]
    assert api.load_resampled_klines(spark, root, ["BTCUSDT"], 60).count() == 13
    nested = api.load_intrabar_buckets(spark, root, "BTCUSDT", 300, nested=True).collect()
    assert [len(r["bars"]) for r in nested] == [5, 5, 2, 1]
    events = api.load_funding_rates(spark, root, "BTCUSDT").collect()
    assert [tuple(r) for r in events] == [("BTCUSDT", START, 0.0001), ("BTCUSDT", START + 8, 0.0003)]
    premium = api.load_premium_index_klines(spark, root, "BTCUSDT", "1m", START + DAY).collect()
    assert [(r["timestamp"], r["open"]) for r in premium] == [(START + DAY, -0.1), (START + DAY + 60, -0.1)]
    with pytest.raises(ValueError):
        api.load_klines(spark, root, "a.b")


def test_reads_prune_directories(spark, refreshed):
    df = api.load_klines(spark, refreshed[0], "BTCUSDT", "1m", START, START + 60)
    plan = df._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    partition = scan.split("PartitionFilters:")[1].split("]")[0]
    assert "symbol" in partition and "interval" in partition and "year" in partition
    assert "trade_count" not in scan.split("ReadSchema:")[1]


def test_gaps_are_recorded_once(spark, refreshed):
    root = refreshed[0]
    for _ in range(2):
        api.load_klines(spark, root, "BTCUSDT", record_gaps=True)
    rows = ledgers.read_gaps(spark, Layout(root)).collect()
    assert [(r["missing_start_ts"] - START, r["missing_end_ts"] - START, r["missing_count"]) for r in rows] == [
        (600, DAY - 60, 1430), (DAY + 120, DAY + 240, 3),
    ]


def compacted(spark, root):
    rows = tables.read_compacted(spark, Layout(root)).orderBy("symbol", "open_time").collect()
    return [(r["symbol"], int(r["open_time"].timestamp()) , r["open"], r["volume"], r["trade_count"]) for r in rows]


def test_refresh_is_repeatable_and_keeps_history(spark, refreshed):
    root, landed, _, request = refreshed
    before = compacted(spark, root)
    later = Request(["BTCUSDT"], D(2026, 6, 3), D(2026, 6, 3), ["klines"], base_url="https://host")
    land(landed, daily("klines", "BTCUSDT", "2026-06-03"), kline_csv(START + 2 * DAY, [0]))
    ingest_landed(spark, root, str(landed), later)
    after = compacted(spark, root)
    assert len(after) == len(before) + 1 and set(before) < set(after)
    ingest_landed(spark, root, str(landed), later)
    assert compacted(spark, root) == after


def test_overlapping_periods_count_once_unless_asked(spark, tmp_path):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    rows = spark.createDataFrame(
        [("2026-06-01", 0, 1.0), ("2026-06", 0, 2.0), ("2026-06", 1, 3.0)], "period string, source_row bigint, p double"
    ).select(
        F.timestamp_seconds(F.lit(START)).alias("open_time"), *[F.col("p").alias(n) for n in ("open", "high", "low", "close", "volume")],
        F.lit(1).cast("bigint").alias("trade_count"), "source_row", F.lit("klines").alias("dataset"),
        F.lit("X").alias("symbol"), F.lit("1m").alias("interval"), "period",
    )
    tables.write_raw_candles(rows, layout)
    compaction.compact_klines(spark, root)
    assert [r[2:] for r in compacted(spark, root)] == [(3.0, 3.0, 1)]
    compaction.compact_klines(spark, root, ["x"], dedupe=None)
    assert [r[2:] for r in compacted(spark, root)] == [(1.0, 6.0, 3)]
    with pytest.raises(ValueError, match="unsupported interval"):
        compaction.compact_klines(spark, root, interval="1w")
    with pytest.raises(ValueError, match="dedupe"):
        compaction.compact_klines(spark, root, dedupe="first")


def test_one_symbol_year_is_one_sorted_file(spark, tmp_path):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    rows = spark.range(200_000).select(
        F.timestamp_seconds(F.lit(START) + F.col("id") * 600).alias("open_time"),
        *[F.col("id").cast("double").alias(n) for n in ("open", "high", "low", "close", "volume")],
        F.lit(1).cast("bigint").alias("trade_count"), F.col("id").alias("source_row"), F.lit("klines").alias("dataset"),
        F.lit("HOT").alias("symbol"), F.lit("1m").alias("interval"), F.lit("2026-06").alias("period"),
    )
    tables.write_raw_candles(rows, layout)
    compaction.compact_klines(spark, root)
    stored = tables.read_compacted(spark, layout)
    files = stored.groupBy("year").agg(F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("n")).collect()
    assert len(files) == 5 and all(r["files"] == 1 for r in files) and sum(r["n"] for r in files) == 200_000
    previous = F.lag("open_time").over(Window.partitionBy("year").orderBy("place"))
    placed = stored.select("year", "open_time", F.col("_metadata.row_index").alias("place"))
    assert placed.withColumn("p", previous).where("p >= open_time").count() == 0


def test_monthly_archives(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "store")
    land(landed, "monthly/klines/BTCUSDT/1m/BTCUSDT-1m-2026-06.zip", kline_csv(START, range(5)))
    text = "calc_time,funding_interval_hours,last_funding_rate\n1780272000000,8,-0.1\n"
    land(landed, "monthly/fundingRate/BTCUSDT/BTCUSDT-fundingRate-2026-06.zip", text)
    symbols = spark.createDataFrame([("btcusdt",)], "symbol string")
    request = Request(symbols, D(2026, 6, 1), D(2026, 6, 30), ["klines", "funding_rate"], granularity="monthly")
    run = ingest_landed(spark, root, str(landed), request).first()
    assert (run["status"], run["success_count"], run["failure_count"], run["last_error"]) == ("succeeded", 2, 0, None)
    assert api.load_klines(spark, root).count() == 5
    assert api.load_funding_rates(spark, root).first()["funding_rate"] == -0.1


def test_universe_and_liquidity_reports(spark, tmp_path):
    for dataset, names in (("klines", ["BTCUSDT", "OLDUSDT"]), ("premiumIndexKlines", ["BTCUSDT"])):
        folder = tmp_path / "listings" / dataset
        folder.mkdir(parents=True)
        body = "".join(f"<CommonPrefixes><Prefix>a/{n}/</Prefix></CommonPrefixes>" for n in names)
        (folder / "0.xml").write_text(f"<ListBucketResult>{body}</ListBucketResult>")
    (tmp_path / "tickers").mkdir()
    (tmp_path / "tickers/0.json").write_text('[{"symbol":"BTCUSDT","quoteVolume":"2.5"}]')
    root = str(tmp_path / "store")
    reports.publish_universe(spark, root, str(tmp_path))
    rows = ledgers.read_universe(spark, Layout(root)).collect()
    assert [(r["symbol"], r["datasets"]["premium_index_klines"]) for r in rows] == [("BTCUSDT", True), ("OLDUSDT", False)]
    assert [tuple(r) for r in reports.quote_liquidity(spark, str(tmp_path)).collect()] == [("USDT", 1, 2.5), ("USDC", 0, 0.0)]


def test_stored_status_and_import(spark, tmp_path):
    import pandas as pd

    folder = tmp_path / "optimized/klines/symbol=BTCUSDT/interval=1m"
    folder.mkdir(parents=True)
    pd.DataFrame({"a": [1]}).to_parquet(folder / "candles.parquet")
    (folder / "candles.manifest.json").write_text('{"last_source": "BTCUSDT_klines_1m_2026-06.parquet", "source_files": 2}')
    raw = tmp_path / "raw/klines/BTCUSDT"
    raw.mkdir(parents=True)
    frame = pd.DataFrame({"open_time": [START * 1000], **{n: ["1.5"] for n in ("open", "high", "low", "close", "volume")}})
    frame.to_parquet(raw / "BTCUSDT_klines_1m_2026-06-01.parquet")
    (tmp_path / "raw/fundingRate/BTCUSDT").mkdir(parents=True)
    pd.DataFrame({"time": [START], "fundingRate": ["0.5"]}).to_parquet(tmp_path / "raw/fundingRate/BTCUSDT/BTCUSDT_fundingRate_2026-06.parquet")
    found = reports.scan_stored_status(spark, str(tmp_path / "raw"), str(tmp_path / "optimized")).collect()
    assert [tuple(r) for r in found] == [("fundingRate", None, 1, "2026-06-30", 1), ("klines", "1m", 1, "2026-06-30", 2)]
    root = str(tmp_path / "store")
    compaction.import_stored_klines(spark, root, str(tmp_path / "raw"))
    compaction.import_stored_funding(spark, root, str(tmp_path / "raw"))
    compaction.compact_klines(spark, root)
    assert [tuple(r)[1:3] for r in api.load_klines(spark, root, "BTCUSDT").collect()] == [(START, 1.5)]
    assert [tuple(r) for r in api.load_funding_rates(spark, root).collect()] == [("BTCUSDT", START, 0.5)]


def raw_rows(spark, seconds, period):
    return spark.createDataFrame([(s,) for s in seconds], "s bigint").select(
        F.timestamp_seconds("s").alias("open_time"), *[F.col("s").cast("double").alias(n) for n in ("open", "high", "low", "close", "volume")],
        F.lit(1).cast("bigint").alias("trade_count"), F.col("s").alias("source_row"), F.lit("klines").alias("dataset"),
        F.lit("X").alias("symbol"), F.lit("1m").alias("interval"), F.lit(period).alias("period"),
    )


def test_incremental_compaction(spark, tmp_path):
    root, layout = str(tmp_path / "store"), Layout(str(tmp_path / "store"))
    checkpoint = str(tmp_path / "checkpoint")
    tables.write_raw_candles(raw_rows(spark, [START, START + 60], "2026-06-01"), layout)
    assert incremental.compact_new_rows(spark, root, checkpoint).awaitTermination(120)
    assert len(compacted(spark, root)) == 2
    tables.write_raw_candles(raw_rows(spark, [START + DAY], "2026-06-02"), layout)
    assert incremental.compact_new_rows(spark, root, checkpoint).awaitTermination(120)
    assert [r[1] - START for r in compacted(spark, root)] == [0, 60, DAY]


def test_incremental_resampling_equals_batch(spark, tmp_path):
    root, layout = str(tmp_path / "store"), Layout(str(tmp_path / "store"))

    def land_rows(seconds, period, price=None):
        rows = raw_rows(spark, [int(s) for s in seconds], period)
        if price is not None:  # fractions of a second, or no price at all
            rows = rows.withColumn("open_time", F.expr("open_time + INTERVAL '0.7' SECOND"))
            rows = rows.withColumn("close", F.lit(price).cast("double"))
        tables.write_raw_candles(rows, layout)

    def run():
        assert incremental.resample_new_rows(spark, root, str(tmp_path / "c"), 900).awaitTermination(180)

    land_rows([START + DAY + 60 * m for m in range(40)], "2026-06-02")
    run()
    # Late days, repeated times, a row without a price, and rows at the end of a bucket's last second.
    land_rows([START + 60 * m for m in range(0, 90, 7)] + [START + 420], "2026-06-01")
    land_rows([START + 899, START + 1799], "2026-05-31", 5.0)
    land_rows([START + 2 * DAY], "2026-06-03", None)
    tables.write_raw_candles(raw_rows(spark, [START + 3 * DAY], "2026-06-04").withColumn("close", F.lit(None).cast("double")), layout)
    run()
    columns = ["symbol", "timestamp", "open", "high", "low", "close", "volume"]
    stored = tables.read_resampled(spark, layout, 900).select(*columns).orderBy("timestamp").collect()
    batch = api.load_resampled_klines(spark, root, None, 900).select(*columns).collect()
    assert len(stored) > 5 and [tuple(r) for r in stored] == [tuple(r) for r in batch]


def test_a_period_replaced_by_nothing_vanishes(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "store")
    header = "open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore"
    for symbol in ("ONEUSDT", "TWOUSDT"):
        land(landed, daily("klines", symbol, "2026-06-01"), kline_csv(START, range(5)))
    land(landed, daily("klines", "TWOUSDT", "2026-06-02"), kline_csv(START + DAY, range(3)))
    request = Request(["ONEUSDT", "TWOUSDT"], D(2026, 6, 1), D(2026, 6, 2), datasets=["klines"])
    assert ingest_landed(spark, root, str(landed), request).first()["success_count"] == 3
    assert api.load_klines(spark, root).count() == 13
    for symbol in ("ONEUSDT", "TWOUSDT"):
        land(landed, daily("klines", symbol, "2026-06-01"), header + "\n")
    assert ingest_landed(spark, root, str(landed), request).first()["success_count"] == 3
    layout = Layout(root)
    assert tables.read_raw_candles(spark, layout, "klines").count() == 3
    # The only year of one symbol is gone, the other keeps the rest of its year.
    assert {r["symbol"] for r in api.load_klines(spark, root).collect()} == {"TWOUSDT"}
    assert [r["symbol"] for r in api.available_klines(spark, root).collect()] == ["TWOUSDT"]
    assert [r["symbol_count"] for r in reports.scan_local_status(spark, root).collect()] == [1]
    assert api.find_kline_gaps(spark, root).count() == 0


def test_a_refresh_opens_what_it_was_asked_for_and_leaves_no_scratch(spark, tmp_path):
    from wickline.plans import ingest
    from wickline.session import Scratch
    from wickline.sources import archives

    landed, root = tmp_path / "landed", str(tmp_path / "store")
    for symbol in ("AUSDT", "BUSDT", "CUSDT", "100%USDT"):
        for day in range(1, 6):
            land(landed, daily("klines", symbol.replace("/", "%2F"), f"2026-06-0{day}"), kline_csv(START + (day - 1) * DAY, [0]))
            land(landed, daily("premiumIndexKlines", symbol, f"2026-06-0{day}"), error="boom")
            land_page(landed, f"premiumIndexKlines/{symbol}/1m/2026-06-0{day}/0.json", [premium_row(START)])
    names = [("BUSDT", "BUSDT")]
    folder = ingest._archives_of(str(landed), "klines", ["daily"], names, "1m")
    period = ingest._archive_period(F.col("_metadata.file_name"))
    named = ingest._between(period, D(2026, 6, 2), D(2026, 6, 3))
    zips = archives.read_zips(spark, folder, named=named)
    assert zips.count() == 2
    zips.select(F.length("content")).collect()
    plan = zips._jdf.queryExecution()
    scan = plan.executedPlan().collectLeaves().apply(0)
    scan.execute().count()
    assert scan.metrics().apply("numFiles").value() == 2
    request = Request(["busdt", "100%USDT"], D(2026, 6, 2), D(2026, 6, 3), datasets=["klines", "premiumIndexKlines"])
    run = ingest_landed(spark, root, str(landed), request).first()
    assert run["status"] == "succeeded"
    # A stray percent sign is part of the symbol.
    assert {r["symbol"] for r in api.load_klines(spark, root).collect()} == {"BUSDT", "100%USDT"}
    assert api.load_klines(spark, root, "100%usdt").count() == 2
    assert api.load_premium_index_klines(spark, root, "BUSDT", "1m").count() == 2
    base = spark.conf.get("spark.checkpoint.dir")
    import glob

    assert glob.glob(f"{base}/wickline-*") == [] and not (tmp_path / "store/scratch").exists()
    with Scratch(spark, root) as scratch:
        assert scratch.folder.startswith(base)


def test_gaps_and_events_come_in_order(spark, tmp_path):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    tables.write_raw_candles(raw_rows(spark, [START, START + 600, START + 60], "2026-06-01"), layout)
    compaction.compact_klines(spark, root)
    assert [r["missing_start_ts"] for r in api.find_kline_gaps(spark, root).collect()] == [START + 120]
    rows = [(START, float(k), k) for k in (3, 1, 2, 0)]
    events = spark.createDataFrame(rows, "s bigint, funding_rate double, source_row bigint").select(
        F.timestamp_seconds("s").alias("funding_time"), "funding_rate", F.lit(None).cast("double").alias("mark_price"),
        "source_row", F.lit("X").alias("symbol"), F.lit("2026-06-01").alias("period"),
    )
    compaction.store_raw_funding(events.repartition(3), layout)
    assert [r["funding_rate"] for r in api.load_funding_rates(spark, root).collect()] == [0.0, 1.0, 2.0, 3.0]


NEW_YEAR = 1767225600  # 2026-01-01


def test_rows_outside_their_period_are_found(spark, tmp_path):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    # A December minute in a January archive, and regular rows of both years.
    compaction.store_raw_candles(raw_rows(spark, [NEW_YEAR - 60, NEW_YEAR], "2026-01-01"), layout)
    compaction.store_raw_candles(raw_rows(spark, [NEW_YEAR - 120], "2025-12-31"), layout)
    assert ledgers.stray_periods(spark, layout, "klines") == ["2026-01-01"]
    for year in ("2025", "2026"):
        touched = spark.createDataFrame([("X", "1m", year)], "symbol string, interval string, year string")
        compaction.compact_klines(spark, root, touched=touched)
    assert [r[1] - NEW_YEAR for r in compacted(spark, root)] == [-120, -60, 0]
    premium = raw_rows(spark, [NEW_YEAR - 60, NEW_YEAR], "2026-01-01").withColumn("dataset", F.lit("premiumIndexKlines"))
    compaction.store_raw_candles(premium, layout)
    window = api.load_premium_index_klines(spark, root, "X", "1m", NEW_YEAR - 60, NEW_YEAR - 60)
    assert [r["timestamp"] for r in window.collect()] == [NEW_YEAR - 60]


def test_windows_open_only_their_periods(spark, tmp_path):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    for day in range(3):
        period = (dt.date(2026, 6, 1) + dt.timedelta(days=day)).isoformat()
        rows = raw_rows(spark, [START + day * DAY], period).withColumn("dataset", F.lit("premiumIndexKlines"))
        compaction.store_raw_candles(rows, layout)
        events = rows.select(
            F.col("open_time").alias("funding_time"), F.col("open").alias("funding_rate"),
            F.lit(None).cast("double").alias("mark_price"), "source_row", "symbol", "period",
        )
        compaction.store_raw_funding(events, layout)
    window = (START + DAY, START + DAY + 10)
    for df in (
        api.load_premium_index_klines(spark, root, "X", "1m", *window),
        api.load_funding_rates(spark, root, "X", *window),
    ):
        assert [r["timestamp"] for r in df.collect()] == [START + DAY]
        files = df.select(F.lit(1)).inputFiles()
        plan = df._jdf.queryExecution().toString()
        scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
        assert files and "period" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_buckets_across_the_year_end(spark, tmp_path):
    root, layout = str(tmp_path), Layout(str(tmp_path))
    # Buckets of seven days start on Thursdays; one runs from 2025-12-25 to the end of the year, the next from 2026-01-01.
    days = [NEW_YEAR - 2 * DAY, NEW_YEAR + DAY, NEW_YEAR + 5 * DAY]
    for second in days:
        period = dt.datetime.fromtimestamp(second, dt.UTC).date().isoformat()
        compaction.store_raw_candles(raw_rows(spark, [second], period).withColumn("interval", F.lit("5d")), layout)
    rows = tables.read_raw_candles(spark, layout, "klines")
    compaction.compact_klines(spark, root, interval="5d", touched=compaction.touched_years(rows))
    width = 5 * DAY
    assert [r[1] for r in compacted(spark, root)] == sorted({s // width * width for s in days})


def test_import_of_compacted_files(spark, tmp_path):
    import pandas as pd

    prices = {"open": ["100"], "high": ["110"], "low": ["99"], "close": ["105"], "volume": ["10"]}
    for key, trades in (("1000%EC%99%9CUSDT", {"trade_count": [7]}), ("007", {})):
        folder = tmp_path / f"optimized/klines/symbol={key}/interval=1m"
        folder.mkdir(parents=True)
        frame = pd.DataFrame({"open_time": [pd.Timestamp(START, unit="s", tz="UTC")], **prices, **trades})
        frame.to_parquet(folder / "candles.parquet", coerce_timestamps="us")
    root = str(tmp_path / "store")
    compaction.import_stored_compacted(spark, root, str(tmp_path / "optimized"))
    assert compacted(spark, root) == [("007", START, 100.0, 10.0, 0), ("1000왜USDT", START, 100.0, 10.0, 7)]
    assert api.load_klines(spark, root, "1000%ec%99%9cusdt").count() == 1
