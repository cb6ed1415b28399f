"""Landed API pages (JSON) and archive listing pages (XML), one text per row.

The page parsers take any DataFrame with a text column and keep its other
columns. A page of candles or funding events is accepted or rejected whole: a
single bad item turns it into a failure and none of its items are returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.constants import PREMIUM_CELLS
from wickline.functions import keys as key_functions
from wickline.functions import once, variants
from wickline.sources import listing


def read_texts(
    spark: SparkSession, path: str, glob: str, named: Column | None = None
) -> DataFrame:
    """One row per landed text file below ``path``: ``path``, ``text``. None when there is none."""
    files = listing.files(spark, path, glob, content=True, named=named)
    return files.select("path", F.decode("content", "UTF-8").alias("text"))


def _parsed(pages: DataFrame, text: str, convert, complete) -> DataFrame:
    """Pages with their converted ``items`` and the page's ``error`` (NULL when good)."""
    found = variants.items(F.try_parse_json(F.col(text)))
    converted = once.with_value(pages, "items", F.transform(found, convert), drop=text)
    bad = F.exists("items", lambda entry: ~complete(entry))
    error = F.when(F.col("items").isNull(), F.lit("page is not a JSON array")).when(
        bad, F.concat(F.lit("invalid item at position "), F.array_position(
            F.transform("items", lambda entry: ~complete(entry)), True
        ) - 1)
    )
    return converted.withColumn("error", error)


def _explode(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Items of the good pages with their position in the page."""
    good = parsed.where(F.col("error").isNull())
    return good.select(*keep, F.posexplode("items").alias("position", "item")).select(
        *keep, F.col("position").cast("bigint").alias("position"), "item.*"
    )


def page_outcomes(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Per page: how many rows it gave, or the error that rejected it."""
    rows = F.when(F.col("error").isNull(), F.size("items").cast("bigint"))
    return parsed.select(*keep, rows.alias("row_count"), "error")


def parse_premium_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    """Premium-index pages: arrays of rows with at least nine cells.

    Adds ``items`` (one struct of candle values per row) and ``error``.
    """

    def convert(row: Column) -> Column:
        cells = []
        for name, position in PREMIUM_CELLS.items():
            whole = name in ("open_time", "trade_count")
            read = variants.whole_number_of if whole else variants.number_of
            value = read(row, f"$[{position}]")
            cells.append(value.alias("open_millis" if name == "open_time" else name))
        return F.struct(*cells)

    def complete(entry: Column) -> Column:
        fields = ["open_millis", *[n for n in PREMIUM_CELLS if n != "open_time"]]
        present = F.lit(True)
        for name in fields:
            present = present & entry[name].isNotNull()
        return present

    return _parsed(pages, text, convert, complete)


def premium_rows(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Candles of the good premium-index pages: ``keep``, ``position``, KLINE columns."""
    rows = _explode(parsed, keep)
    return rows.select(
        *keep,
        "position",
        F.timestamp_millis("open_millis").alias("open_time"),
        *[name for name in PREMIUM_CELLS if name != "open_time"],
    )


def parse_funding_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    """Funding pages: arrays of objects with an integer time, a rate and maybe a mark price.

    Adds ``items`` and ``error``.
    """

    def convert(entry: Column) -> Column:
        mark = variants.item(entry, "$.markPrice")
        return F.struct(
            variants.integer_of(variants.item(entry, "$.fundingTime")).alias("funding_millis"),
            variants.number_of(entry, "$.fundingRate").alias("funding_rate"),
            variants.number_of(entry, "$.markPrice").alias("mark_price"),
            variants.is_null(mark).alias("no_mark"),
        )

    def complete(entry: Column) -> Column:
        mark_fine = entry["no_mark"] | entry["mark_price"].isNotNull()
        return (
            entry["funding_millis"].isNotNull() & entry["funding_rate"].isNotNull() & mark_fine
        )

    return _parsed(pages, text, convert, complete)


def funding_rows(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Events of the good funding pages, ready for ``merge_pages``."""
    return _explode(parsed, keep).drop("no_mark")


def ticker_rows(pages: DataFrame, text: str = "text") -> DataFrame:
    """Tickers (symbol, quote_volume) of ticker pages; unusable items are skipped.

    A page that is no JSON array is an error.
    """
    found = variants.items(F.try_parse_json(F.col(text)))
    message = F.lit("ticker response must be a JSON array")
    checked = F.coalesce(found, F.raise_error(message).cast("array<variant>"))
    entries = pages.select(F.explode(checked).alias("entry"))
    entry = F.col("entry")
    return entries.select(
        variants.text_of(variants.item(entry, "$.symbol")).alias("symbol"),
        variants.number_of(entry, "$.quoteVolume").alias("quote_volume"),
    ).where(F.col("symbol").isNotNull() & F.col("quote_volume").isNotNull())


def listed_prefixes(pages: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Common prefixes of listing pages, with or without an XML namespace; empty ones dropped."""
    prefixes = F.xpath(F.col(text), F.lit("//CommonPrefixes/Prefix/text()"))
    return pages.select(*keep, F.explode(prefixes).alias("prefix")).where(F.col("prefix") != "")


def prefix_symbols(prefixes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The symbol each listing prefix names."""
    symbol = key_functions.symbol_from_prefix(F.col("prefix"))
    return prefixes.select(*keep, symbol.alias("symbol"))


def listed_symbols(prefixes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Symbols named by listing prefixes, each once per ``keep``."""
    return prefix_symbols(prefixes, keep).distinct()
