"""Tradable-symbol universe and quote liquidity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.constants import DEFAULT_LIQUIDITY_QUOTES, DEFAULT_QUOTES, KLINES, UNIVERSE_FLAGS
from wickline.functions import keys, once, variants


def build_universe(listed: DataFrame, quotes: tuple[str, ...] = DEFAULT_QUOTES) -> DataFrame:
    """Universe from listed (dataset, symbol) pairs.

    Symbols with candles are canonical, also delisted ones; of these the ASCII
    ones with a configured quote asset are kept. ``datasets`` tells which
    archives exist. One aggregation gives all flags, without a join.
    """
    has = {
        flag: F.bool_or(F.col("dataset") == dataset) for flag, dataset in UNIVERSE_FLAGS.items()
    }
    symbols = listed.where(
        F.col("symbol").rlike(r"^[\x00-\x7F]*$")
        & keys.quote_asset(F.col("symbol"), quotes).isNotNull()
    )
    flagged = symbols.groupBy("symbol").agg(*[c.alias(name) for name, c in has.items()])
    flags = F.create_map(*[x for name in has for x in (F.lit(name), F.col(name))])
    return flagged.where(F.col(KLINES)).select(
        "symbol",
        keys.quote_asset(F.col("symbol"), quotes).alias("quote_asset"),
        keys.storage_key(F.col("symbol")).alias("storage_key"),
        flags.alias("datasets"),
    )


def ordered_universe(universe: DataFrame, quotes: tuple[str, ...] = DEFAULT_QUOTES) -> DataFrame:
    """Universe by base asset, rank of the quote asset, symbol."""
    return universe.orderBy(*keys.symbol_order(F.col("symbol"), quotes))


def simple_universe(symbols: DataFrame, quote: str = DEFAULT_QUOTES[0]) -> DataFrame:
    """Universe of a plain symbol list: candles assumed present, premium index not."""
    return symbols.select(
        "symbol",
        F.lit(quote).alias("quote_asset"),
        keys.storage_key(F.col("symbol")).alias("storage_key"),
        F.create_map(
            F.lit("klines"), F.lit(True), F.lit("premium_index_klines"), F.lit(False)
        ).alias("datasets"),
    )


def universe_from_json(documents: DataFrame, text: str = "value") -> DataFrame:
    """Universe rows of stored documents, full or plain, with their defaults.

    A plain symbol counts as having candles and no premium index. In an object
    a flag holds only if it is a real boolean, and premium has two spellings.
    """
    documents = once.with_value(documents, "document", F.parse_json(F.col(text)), drop=text)
    document = F.col("document")
    symbols = variants.items(variants.item(document, "$.symbols"))
    default_quote = F.coalesce(
        variants.text_of(variants.item(document, "$.quote_asset")), F.lit(DEFAULT_QUOTES[0])
    )
    checked = F.when(symbols.isNotNull(), symbols).otherwise(
        F.raise_error(F.lit("symbol universe field symbols must be a list")).cast("array<variant>")
    )
    entries = documents.select(default_quote.alias("quote"), F.posexplode(checked)).select(
        "quote", F.col("pos").alias("position"), F.col("col").alias("entry")
    )
    entry = F.col("entry")
    plain = variants.text_of(entry)
    flags = variants.item(entry, "$.datasets")
    is_object = variants.kind_of(flags).startswith("OBJECT")

    def flag(*names: str) -> Column:
        found = [variants.boolean_of(variants.item(flags, f"$.{name}")) for name in names]
        return F.coalesce(F.array_contains(F.array(*found), True), F.lit(False))

    def field(name: str, default: Column) -> Column:
        value = variants.item(entry, f"$.{name}")
        wrong = ~variants.is_null(value) & variants.text_of(value).isNull()
        message = F.lit(f"symbol universe field {name} must be a string or null")
        given = F.when(wrong, F.raise_error(message).cast("string")).otherwise(
            variants.text_of(value)
        )
        return F.coalesce(F.nullif(given, F.lit("")), default)

    no_symbol = F.raise_error(F.lit("symbol universe symbols must be strings or objects"))
    named = F.coalesce(plain, variants.text_of(variants.item(entry, "$.symbol")))
    known = F.coalesce(is_object, F.lit(False))
    datasets = F.create_map(
        F.lit("klines"),
        F.when(known, flag("klines")).otherwise(F.lit(True)),
        F.lit("premium_index_klines"),
        F.when(known, flag("premium_index_klines", "premiumIndexKlines")).otherwise(F.lit(False)),
    )
    rows = entries.withColumn("symbol", F.coalesce(named, no_symbol.cast("string")))
    return rows.select(
        "position",
        "symbol",
        field("quote_asset", F.col("quote")).alias("quote_asset"),
        field("storage_key", keys.storage_key(F.col("symbol"))).alias("storage_key"),
        datasets.alias("datasets"),
    )


def quote_liquidity(
    tickers: DataFrame, quotes: tuple[str, ...] = DEFAULT_LIQUIDITY_QUOTES
) -> DataFrame:
    """Symbols and summed quote volume per quote asset, in the configured order.

    Takes (symbol, quote_volume). One conditional aggregate per configured asset
    gives every asset its row, zeros included, without a join.
    """
    matched = tickers.select(
        keys.quote_asset(F.col("symbol"), quotes).alias("quote"), F.col("quote_volume")
    )
    totals = matched.agg(
        *[F.count_if(F.col("quote") == q).alias(f"n{i}") for i, q in enumerate(quotes)],
        *[
            F.sum(F.when(F.col("quote") == q, F.col("quote_volume"))).alias(f"v{i}")
            for i, q in enumerate(quotes)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(q).alias("quote_asset"),
                F.col(f"n{i}").alias("symbol_count"),
                F.coalesce(F.col(f"v{i}"), F.lit(0.0)).alias("aggregate_quote_volume"),
            )
            for i, q in enumerate(quotes)
        ]
    )
    return totals.select(F.inline(rows))
