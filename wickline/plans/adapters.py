"""Market-data views of the driver tables.

The driver tables hold no candles. These adapters read them as such: events and
line items as candles, orders as funding events, and events again as pages,
archives, listings, tickers and fetch outcomes. Pages and archives are cut by
``event_id`` ranges, so none holds more than ``PAGE_ROWS`` rows at any scale.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.constants import ARCHIVE_COLUMNS, ARCHIVE_KEY_ROOT, KLINES, PREMIUM
from wickline.functions import keys
from wickline.functions.times import timestamp_millis

PAGE_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _symbol() -> Column:
    return F.concat(F.upper("event_type"), F.lit("USDT"))


def event_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as candles, ``source_key`` unique."""
    return table(spark, sf_dir, "events").select(
        _symbol().alias("symbol"),
        F.col("ts").alias("open_time"),
        F.col("value").alias("open"),
        (F.col("value") + 1).alias("high"),
        (F.col("value") - 1).alias("low"),
        (F.col("value") + 0.5).alias("close"),
        F.col("value").alias("volume"),
        F.pmod("event_id", F.lit(7)).alias("trade_count"),
        F.col("event_id").alias("source_key"),
    )


def text_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed raw candles: integer-millisecond times and text prices."""
    candles = event_candles(spark, sf_dir)
    return candles.select(
        "symbol",
        timestamp_millis(F.col("open_time")).alias("open_time"),
        *[F.col(n).cast("string").alias(n) for n in ("open", "high", "low", "close", "volume")],
        F.when(F.col("trade_count") > 2, F.col("trade_count").cast("string")).alias("trade_count"),
        F.col("trade_count").alias("number_of_trades"),
        "source_key",
    )


def line_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as candles of their supplier: many rows per time, ``source_key`` decides."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey", F.lit("USDT")).alias("symbol"),
        F.col("l_shipdate").alias("open_time"),
        *[F.col("l_extendedprice").alias(n) for n in ("open", "high", "low", "close")],
        F.col("l_quantity").alias("volume"),
        F.col("l_linenumber").cast("bigint").alias("trade_count"),
        (F.col("l_orderkey") * 1_000_000 + F.col("l_partkey")).alias("source_key"),
    )


def order_funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as funding events of one of fifty symbols."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.pmod("o_custkey", F.lit(50)), F.lit("USDT")).alias("symbol"),
        F.col("o_orderdate").alias("funding_time"),
        (F.col("o_totalprice") / 1e9).alias("funding_rate"),
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
    )


def _pages(rows: DataFrame, keys: list[str], line: Column, separator: str = ",") -> DataFrame:
    """Lines of each (keys, page of event ids), in order, as one text."""
    page = F.floor(F.col("event_id") / PAGE_ROWS).alias("page_no")
    lines = F.array_sort(F.collect_list(F.struct("event_id", line.alias("line"))))
    return rows.groupBy(*keys, page).agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), separator).alias("text")
    )


def _quoted(column: Column) -> Column:
    return F.concat(F.lit('"'), column.cast("string"), F.lit('"'))


def premium_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as premium-index pages; errors of value below 1 have a boolean trade count."""
    events = table(spark, sf_dir, "events").withColumn("symbol", _symbol())
    price = F.col("value") - 50
    spoilt = (F.col("event_type") == "error") & (F.col("value") < 1)
    cells = F.concat_ws(
        ",",
        timestamp_millis(F.col("ts")).cast("string"),
        _quoted(price),
        _quoted(price + 1),
        _quoted(price - 1),
        (price + 0.5).cast("string"),
        _quoted(F.lit(0)),
        F.lit("0"),
        _quoted(F.lit(0)),
        F.when(spoilt, F.lit("true")).otherwise(F.pmod("event_id", F.lit(7)).cast("string")),
        _quoted(F.lit(0)),
    )
    pages = _pages(events, ["symbol"], F.concat(F.lit("["), cells, F.lit("]")))
    return pages.withColumn("text", F.concat(F.lit("["), "text", F.lit("]")))


def funding_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as funding pages; clicks have no mark price, low-valued views a text as time."""
    events = table(spark, sf_dir, "events").withColumn("symbol", _symbol())
    millis = timestamp_millis(F.col("ts"))
    spoilt = (F.col("event_type") == "view") & (F.col("value") < 1)
    item = F.concat(
        F.lit('{"fundingTime":'),
        F.when(spoilt, _quoted(millis)).otherwise(millis.cast("string")),
        F.lit(',"fundingRate":'),
        _quoted(F.col("value")),
        F.lit(',"markPrice":'),
        F.when(F.col("event_type") == "click", F.lit("null")).otherwise(
            (F.col("value") + 1).cast("string")
        ),
        F.lit("}"),
    )
    pages = _pages(events, ["symbol"], item)
    return pages.withColumn("text", F.concat(F.lit("["), "text", F.lit("]")))


def ticker_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticker pages: errors lack a volume, views are no objects, clicks are in BUSD."""
    events = table(spark, sf_dir, "events")
    symbol = F.concat(
        F.upper("event_type"), F.when(F.col("event_type") == "click", "BUSD").otherwise("USDT")
    )
    item = (
        F.when(F.col("event_type") == "view", F.col("value").cast("string"))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"symbol":'), _quoted(symbol), F.lit("}")))
        .otherwise(
            F.concat(
                F.lit('{"symbol":'),
                _quoted(symbol),
                F.lit(',"quoteVolume":'),
                F.when(F.col("event_type") == "signup", F.col("value").cast("string")).otherwise(
                    _quoted(F.col("value"))
                ),
                F.lit("}"),
            )
        )
    )
    return _pages(events, [], item).withColumn("text", F.concat(F.lit("["), "text", F.lit("]")))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as listing pages of two datasets, one symbol per user and event type.

    Purchases are in USDC, signups in BUSD, errors have a non-ASCII symbol, and
    events of value 10 and more are also listed as premium index.
    """
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    quote = F.when(kind == "purchase", "USDC").when(kind == "signup", "BUSD").otherwise("USDT")
    lead = F.when(kind == "error", "%CE%A9").otherwise("")
    symbol = F.concat(lead, F.upper("event_type"), F.col("user_id").cast("string"), quote)
    datasets = F.when(
        F.col("value") >= 10, F.array(F.lit(KLINES), F.lit(PREMIUM))
    ).otherwise(F.array(F.lit(KLINES)))
    rows = events.select("event_id", symbol.alias("symbol"), F.explode(datasets).alias("dataset"))
    prefix = F.concat_ws(
        "/", F.lit(ARCHIVE_KEY_ROOT), F.lit("monthly"), F.col("dataset"), F.col("symbol"), F.lit("")
    )
    element = F.concat(
        F.lit("<CommonPrefixes><Prefix>"), prefix, F.lit("</Prefix></CommonPrefixes>")
    )
    head = '<ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/">'
    return _pages(rows, ["dataset"], element, "").withColumn(
        "text", F.concat(F.lit(head), "text", F.lit("</ListBucketResult>"))
    )


@F.pandas_udf(T.BinaryType())
def _zipped(texts: pd.Series) -> pd.Series:
    def pack(text: str) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(zipfile.ZipInfo("rows.csv"), text)
        return buffer.getvalue()

    return texts.map(pack)


def _event_lines(events: DataFrame, spoilt: Column) -> Column:
    """An archive line of each event; the low price of spoilt ones is no number."""
    price = F.col("value")
    zero = F.lit("0")
    return F.concat_ws(
        ",",
        timestamp_millis(F.col("ts")).cast("string"),
        price.cast("string"),
        (price + 1).cast("string"),
        F.when(spoilt, F.lit("low")).otherwise((price - 1).cast("string")),
        (price + 0.5).cast("string"),
        price.cast("string"),
        zero,
        zero,
        F.pmod("event_id", F.lit(7)).cast("string"),
        zero,
        zero,
        zero,
    )


def _spoilt() -> Column:
    return (F.col("event_type") == "error") & (F.col("value") < 1)


def archives(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as zip archives and their checksum texts; the checksums of signups are wrong.

    Archives of views have a header line; those of errors with a value below 1
    hold a cell that is no number.
    """
    events = table(spark, sf_dir, "events").withColumn("symbol", _symbol())
    line = _event_lines(events, _spoilt())
    header = ",".join("count" if name == "trade_count" else name for name in ARCHIVE_COLUMNS)
    texts = _pages(events, ["symbol"], line, "\n").select(
        F.concat_ws("/", "symbol", F.concat("page_no", F.lit(".zip"))).alias("path"),
        F.concat(
            F.when(F.col("symbol") == "VIEWUSDT", F.lit(header + "\n")).otherwise(""),
            "text",
            F.lit("\n"),
        ).alias("csv"),
    )
    zips = texts.select("path", _zipped("csv").alias("content"))
    return zips, _checksums(zips, F.col("path").startswith("SIGNUP"))


def _checksums(zips: DataFrame, wrong: Column) -> DataFrame:
    digest = F.when(wrong, F.repeat(F.lit("0"), F.lit(64))).otherwise(F.sha2("content", 256))
    return zips.select("path", F.concat_ws("  ", digest, "path").alias("checksum_text"))


def daily_archives(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """Events as landed files of daily candle archives: ``path`` and ``content``, checksums among them.

    Checksums of signups are wrong. With ``again`` as they land a second time:
    even days only, ten dearer, with right checksums, and clicks of days that
    end in 0 as archives without a line.
    """
    events = table(spark, sf_dir, "events").withColumn("symbol", _symbol())
    events = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    line = _event_lines(events, _spoilt())
    if again:
        number = F.dayofmonth("ts")
        events = events.where(number % 2 == 0).withColumn("value", F.col("value") + 10)
        # Its own value decides whether a cell is spoilt, as it did before.
        line = _event_lines(events, (F.col("event_type") == "error") & (F.col("value") < 11))
        line = F.when((F.col("event_type") == "click") & (number % 10 == 0), F.lit(None)).otherwise(line)
    lines = events.groupBy("symbol", "day").agg(F.sort_array(F.collect_list(F.struct("event_id", line.alias("line")))).alias("lines"))
    key = keys.archive_key(F.lit(KLINES), F.col("symbol"), F.lit("1m"), F.col("day"))
    text = F.array_join(F.transform("lines.line", lambda written: F.concat(written, F.lit("\n"))), "")
    header = ",".join("count" if name == "trade_count" else name for name in ARCHIVE_COLUMNS)
    zips = lines.select(key.alias("path"), F.concat(F.lit(header + "\n"), text).alias("csv")).select("path", _zipped("csv").alias("content"))
    wrong = F.lit(False) if again else F.col("path").contains("/SIGNUP")
    checksums = _checksums(zips, wrong)
    return zips.unionByName(
        checksums.select(F.concat("path", F.lit(".CHECKSUM")).alias("path"), F.encode("checksum_text", "utf-8").alias("content"))
    )


def mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stored candle files, one a symbol and day, of varying columns: ``path`` and ``content``.

    Clicks have times and numbers; views texts throughout; errors whole
    milliseconds and their trade count under its other name; purchases neither
    trade count nor, as their closing price, anything but a boolean.
    """
    events = table(spark, sf_dir, "events").withColumn("symbol", _symbol())
    events = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    rows = events.select("symbol", "day", "event_id", "event_type", "value", timestamp_millis(F.col("ts")).alias("ms"))

    def stored(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("event_id")
        kind, symbol, day = pdf["event_type"].iat[0], pdf["symbol"].iat[0], pdf["day"].iat[0]
        made = pd.DataFrame({"open_time": pdf["ms"], "open": pdf["value"], "high": pdf["value"] + 1, "low": pdf["value"] - 1})
        made = made.assign(close=pdf["value"] + 0.5, volume=pdf["value"], trade_count=pdf["event_id"] % 7)
        if kind == "click":
            made["open_time"] = pd.to_datetime(made["open_time"], unit="ms", utc=True)
        elif kind == "view":
            made = made.astype(str)
        elif kind == "error":
            made = made.rename(columns={"trade_count": "number_of_trades"})
        elif kind == "purchase":
            made = made.drop(columns="trade_count").assign(close=True)
        buffer = io.BytesIO()
        made.to_parquet(buffer, index=False)
        path = f"{KLINES}/{symbol}/{symbol}_{KLINES}_1m_{day}.parquet"
        return pd.DataFrame({"path": [path], "content": [buffer.getvalue()]})

    return rows.groupBy("symbol", "day").applyInPandas(stored, "path string, content binary")


def land(landed: DataFrame, folder: str) -> None:
    """Write files (``path``, ``content``) below a folder, each by the task that has it."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                uri = f"{folder.rstrip('/')}/{path}"
                if uri.startswith("file:"):
                    uri = "/" + uri.removeprefix("file:").lstrip("/")
                remote = "://" in uri
                system, place = pafs.FileSystem.from_uri(uri) if remote else (pafs.LocalFileSystem(), uri)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                with system.open_output_stream(place) as stream:
                    stream.write(content)
            yield pd.DataFrame({"files": [len(batch)]})

    landed.mapInPandas(write, "files long").agg(F.sum("files")).collect()


def fetch_outcomes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every event as a refresh target with an archive outcome and a page outcome.

    An outcome without a count and without an error is one where nothing landed.
    """
    events = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    symbol = F.concat(F.lit("U"), "event_id", F.lit("USDT"))
    premium = F.col("event_type").isin("click", "view", "purchase")
    key = [
        F.when(premium, PREMIUM).otherwise(KLINES).alias("dataset"),
        symbol.alias("symbol"),
        F.lit("1m").alias("interval"),
        day.alias("period"),
    ]
    targets = events.select(
        *key,
        day.alias("target_date"),
        F.lit("archive").alias("route"),
        F.concat(F.lit("archive/"), symbol).alias("source_url"),
        F.concat(F.lit("raw/"), symbol).alias("output_path"),
    )
    turn = F.pmod("event_id", F.lit(5))
    text = F.lit(None).cast("string")
    archive_outcomes = events.select(
        *key,
        F.when(turn == 0, "abc").alias("checksum"),
        F.when(turn == 0, F.col("user_id")).alias("row_count"),
        F.when(turn == 2, "checksum_mismatch").alias("error_code"),
        F.when(turn == 1, "HTTP 404 Not Found")
        .when(turn == 2, "expected a got b")
        .when(turn == 3, "broken pipe")
        .alias("error_message"),
    )
    turn = F.pmod("event_id", F.lit(4))
    page_outcomes = events.select(
        symbol.alias("symbol"),
        F.lit("1m").alias("interval"),
        day.alias("day"),
        F.concat(F.lit("pages/"), symbol).alias("output_path"),
        text.alias("checksum"),
        F.when(turn == 0, F.lit(0).cast("bigint")).alias("row_count"),
        text.alias("error_code"),
        F.when(turn == 1, "404: page Not Found").when(turn == 2, "timed out").alias("error_message"),
    )
    return targets, archive_outcomes, page_outcomes


def overlapping_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw candles of daily archives, and again, dearer, of monthly ones.

    Purchases come in daily archives only.
    """
    candles = event_candles(spark, sf_dir)
    millis = F.timestamp_millis(timestamp_millis(F.col("open_time")))
    copies = F.when(F.col("symbol") == "PURCHASEUSDT", F.array(F.lit(0))).otherwise(
        F.array(F.lit(0), F.lit(1))
    )
    rows = candles.select("*", F.explode(copies).alias("monthly"))
    month, day = F.date_format("open_time", "yyyy-MM"), F.date_format("open_time", "yyyy-MM-dd")
    return rows.select(
        millis.alias("open_time"),
        *[(F.col(n) + F.col("monthly")).alias(n) for n in ("open", "high", "low", "close")],
        "volume",
        F.col("trade_count"),
        F.col("source_key").alias("source_row"),
        F.lit(KLINES).alias("dataset"),
        "symbol",
        F.lit("1m").alias("interval"),
        F.when(F.col("monthly") == 1, month).otherwise(day).alias("period"),
    )


def gap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of a gap ledger; views have a text count, errors a boolean one."""
    count = (
        F.when(F.col("event_type") == "view", _quoted(F.col("user_id")))
        .when(F.col("event_type") == "error", F.lit("true"))
        .otherwise(F.col("user_id").cast("string"))
    )
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    line = F.format_string(
        '{"dataset":"klines","symbol":"%s","interval":"1m","missing_start_ts":%d,'
        '"missing_end_ts":%d,"missing_count":%s,"observed_before_ts":%d,'
        '"observed_after_ts":%d,"reason":"timestamp_gap"}',
        _symbol(),
        second,
        second + 60,
        count,
        second - 60,
        second + 120,
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of a source ledger; only open orders have a checksum and an interval."""
    is_open = F.col("o_orderstatus") == "O"
    line = F.format_string(
        '{"checksum":%s,"dataset":"klines","interval":%s,"output_path":"out/%d",'
        '"row_count":%d,"source_url":"url","symbol":"C%d","target_date":"%s"}',
        F.when(is_open, F.lit('"abc"')).otherwise("null"),
        F.when(is_open, F.lit('"1m"')).otherwise("null"),
        "o_orderkey",
        "o_orderkey",
        "o_custkey",
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    return table(spark, sf_dir, "orders").select(line.alias("value"))


def universe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as universe documents of up to ``PAGE_ROWS`` entries of varying form."""
    customers = table(spark, sf_dir, "customer")
    name = F.concat(F.lit("C"), "c_custkey", F.lit("USDT"))
    segment = F.col("c_mktsegment")
    entry = (
        F.when(segment == "BUILDING", _quoted(name))
        .when(segment == "MACHINERY", F.format_string('{"symbol":"%s","datasets":{"klines":true,"premiumIndexKlines":true}}', name))
        .when(segment == "HOUSEHOLD", F.format_string('{"symbol":"%s","quote_asset":null,"datasets":{"klines":1}}', name))
        .otherwise(F.format_string('{"symbol":"%s","quote_asset":"USDT","storage_key":"k%d"}', name, "c_nationkey"))
    )
    rows = customers.select(F.col("c_custkey").alias("event_id"), entry.alias("entry"))
    return _pages(rows, [], F.col("entry")).select(
        F.concat(F.lit('{"quote_asset":"USDC","symbols":['), "text", F.lit("]}")).alias("value")
    )


def stored_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as paths of stored archives, with plain and encoded directory names."""
    symbol = F.concat(F.upper("event_type"), "user_id", F.lit("왜USDT"))
    key = F.replace(symbol, F.lit("왜"), F.lit("%EC%99%9C"))
    named = F.when(F.col("value") >= 10, key).otherwise(symbol)
    day = F.date_format("ts", "yyyy-MM-dd")
    name = F.concat(named, F.lit("_klines_1m_"), day, F.lit(".parquet"))
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.lit("file:/data/klines"), named, name).alias("path")
    )


def funding_archives(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as funding archives and their checksum texts."""
    orders = order_funding(spark, sf_dir).withColumn("event_id", F.col("o_orderkey"))
    line = F.concat_ws(
        ",",
        timestamp_millis(F.col("funding_time")).cast("string"),
        F.lit("8"),
        F.col("o_totalprice").cast("string"),
    )
    texts = _pages(orders, ["symbol"], line, "\n").select(
        F.concat_ws("/", "symbol", F.concat("page_no", F.lit(".zip"))).alias("path"),
        F.concat(F.lit("calc_time,funding_interval_hours,last_funding_rate\n"), "text").alias("csv"),
    )
    zips = texts.select("path", _zipped("csv").alias("content"))
    return zips, zips.select("path", F.sha2("content", 256).alias("checksum_text"))
