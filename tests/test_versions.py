"""Changes of a store are seen all at once or not at all."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_end_to_end import START, daily, kline_csv, land, land_page
from wickline.constants import ARCHIVE_COLUMNS
from wickline.plans import api, compaction, reports
from wickline.plans.ingest import Request, ingest_landed
from wickline.sources import ledgers, tables, versions
from wickline.sources.tables import Layout

DAY = 86_400
HEADER = ",".join("count" if name == "trade_count" else name for name in ARCHIVE_COLUMNS)
DAYS = (dt.date(2026, 6, 1), dt.date(2026, 6, 2))


def rows_of(spark, seconds, period, price=1.0, symbol="BTCUSDT"):
    values = [(s * 1000, price, k) for k, s in enumerate(seconds)]
    return spark.createDataFrame(values, "ms long, p double, source_row long").select(
        F.timestamp_millis("ms").alias("open_time"),
        *(F.col("p").alias(c) for c in ("open", "high", "low", "close", "volume")),
        F.lit(1).cast("long").alias("trade_count"),
        "source_row",
        F.lit("klines").alias("dataset"),
        F.lit(symbol).alias("symbol"),
        F.lit("1m").alias("interval"),
        F.lit(period).alias("period"),
    )


def seen(spark, root):
    """Everything that readers see of a store."""
    layout = Layout(root)
    frames = [
        tables.read_raw_candles(spark, layout, "klines"),
        tables.read_raw_candles(spark, layout, "premiumIndexKlines"),
        tables.read_raw_funding(spark, layout),
        tables.read_compacted(spark, layout),
        ledgers.read_failures(spark, layout),
        ledgers.read_sources(spark, layout),
        reports.status(spark, root),
        api.available_klines(spark, root),
    ]
    return [sorted(map(str, f.collect())) for f in frames]


@pytest.fixture
def store(spark, tmp_path):
    landed, root = tmp_path / "first", str(tmp_path / "store")
    for day, start in (("2026-06-01", START), ("2026-06-02", START + DAY)):
        land(landed, daily("klines", "BTCUSDT", day), kline_csv(start, range(4)))
        land(landed, daily("premiumIndexKlines", "BTCUSDT", day), kline_csv(start, range(2)))
    request = Request(["BTCUSDT"], *DAYS, base_url="https://host")
    ingest_landed(spark, root, str(landed), request)
    again = tmp_path / "second"
    land(again, daily("klines", "BTCUSDT", "2026-06-01"), kline_csv(START, range(6), 9.0))
    land(again, daily("klines", "BTCUSDT", "2026-06-02"), HEADER + "\n")
    land(again, daily("premiumIndexKlines", "BTCUSDT", "2026-06-01"), error="boom")
    land_page(again, "premiumIndexKlines/BTCUSDT/1m/2026-06-01/0.json", [])
    land_page(again, "fundingRate/BTCUSDT/2026-06-01/0.json", [{"fundingTime": START * 1000, "fundingRate": "0.1", "markPrice": "5"}])
    return root, str(again), request


STEPS = [
    (compaction, "store_raw_candles"),
    (tables, "remove_raw"),
    (compaction, "store_raw_funding"),
    (compaction, "compact_klines"),
    (ledgers, "publish"),
    (versions, "create_file"),
]


def test_a_refresh_that_fails_after_any_step_leaves_the_old_state(spark, store, monkeypatch):
    root, landed, request = store
    before = seen(spark, root)
    for module, name in STEPS:
        step = getattr(module, name)

        def failing(*args, _step=step, _name=name, **options):
            if _name == "create_file" and not str(args[1]).endswith(".json"):
                return _step(*args, **options)
            if _name != "create_file":
                _step(*args, **options)
            raise OSError(f"lost after {_name}")

        with monkeypatch.context() as patch:
            patch.setattr(module, name, failing)
            with pytest.raises(OSError, match="lost after"):
                ingest_landed(spark, root, landed, request)
        assert versions.latest(spark, root).number == 1
    assert seen(spark, root) == before
    ingest_landed(spark, root, landed, request)
    after = seen(spark, root)
    assert versions.latest(spark, root).number == 2
    assert len(after[0]) == 6 and len(after[3]) == 6 and len(after[2]) == 1  # the second day was replaced by nothing
    assert after != before
    versions.vacuum(spark, root, kept_hours=0)
    assert seen(spark, root) == after
    version = versions.latest(spark, root)
    assert not any(t.stale for t in version.tables.values())


def test_readers_keep_what_they_began_with_and_changes_see_themselves(spark, tmp_path):
    layout = Layout(str(tmp_path))
    tables.write_raw_candles(rows_of(spark, [START], "2026-06-01"), layout)
    old = tables.read_raw_candles(spark, layout, "klines")
    with layout.changing(spark) as inside:
        tables.write_raw_candles(rows_of(spark, [START, START + 60], "2026-06-01", 2.0), inside)
        tables.write_raw_candles(rows_of(spark, [START + DAY], "2026-06-02"), inside)
        assert tables.read_raw_candles(spark, inside, "klines").count() == 3
        assert tables.read_raw_candles(spark, layout, "klines").count() == 1
    assert tables.read_raw_candles(spark, layout, "klines").count() == 3
    assert [r["open"] for r in old.collect()] == [1.0]
    assert tables.partitions(spark, layout, versions.RAW_CANDLES).count() == 2


def test_only_one_of_two_jobs_can_follow_a_version(spark, tmp_path):
    layout = Layout(str(tmp_path))
    with pytest.raises(versions.Conflict), layout.changing(spark) as inside:
        tables.write_raw_candles(rows_of(spark, [START], "2026-06-01"), inside)
        tables.write_raw_candles(rows_of(spark, [START + DAY], "2026-06-02"), layout)
    rows = tables.read_raw_candles(spark, layout, "klines").collect()
    assert [r["period"] for r in rows] == ["2026-06-02"]


@pytest.mark.parametrize("named", [10_000, 0])
def test_replaced_partitions_are_not_read(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(versions, "NAMED_PARTITIONS", named)
    layout = Layout(str(tmp_path))
    both = rows_of(spark, [START], "2026-06-01").unionByName(rows_of(spark, [START], "2026-06-01", symbol="1000왜USDT"))
    tables.write_raw_candles(both.unionByName(rows_of(spark, [START + DAY], "2026-06-02")), layout)
    tables.write_raw_candles(rows_of(spark, [START], "2026-06-01", 5.0, "1000왜USDT"), layout)
    tables.remove_raw(rows_of(spark, [START], "2026-06-02").select("symbol", "interval", "period"), layout, "klines")
    rows = tables.read_raw_candles(spark, layout, "klines")
    assert sorted((r["symbol"], r["open"]) for r in rows.collect()) == [("1000왜USDT", 5.0), ("BTCUSDT", 1.0)]
    if named:  # told to the scan: no file of a replaced partition is opened
        assert len(rows.inputFiles()) <= 4
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "Join" not in plan


def test_ledgers_that_grow_are_merged(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for k in range(versions.MOST_RUNS + 3):
        with layout.changing(spark) as inside:
            inside.commit.write_ledger(spark.createDataFrame([(str(k),)], "value string"), "notes", keep=True)
    version = layout.version(spark)
    assert len(version.folders("notes")) <= versions.MOST_RUNS + 1
    lines = spark.read.text(version.folders("notes")).collect()
    assert sorted(int(r[0]) for r in lines) == list(range(versions.MOST_RUNS + 3))


def test_streams_wait_for_open_refreshes(spark, tmp_path):
    root = str(tmp_path)
    assert versions.unsettled(spark, root, versions.RAW_CANDLES, ["x"]) == []
    with Layout(root).changing(spark) as inside:
        tables.write_raw_candles(rows_of(spark, [START], "2026-06-01"), inside)
        batch = inside.commit.version.table(versions.RAW_CANDLES).batches[0]
        assert versions.unsettled(spark, root, versions.RAW_CANDLES, [batch]) == [batch]
    assert versions.unsettled(spark, root, versions.RAW_CANDLES, [batch]) == []
