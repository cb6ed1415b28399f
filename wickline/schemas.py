"""Row schemas of the stored tables."""

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


KLINE = _struct(
    open_time=T.TimestampType(), open=_D, high=_D, low=_D, close=_D, volume=_D, trade_count=_L
)
FUNDING = _struct(funding_time=T.TimestampType(), funding_rate=_D, mark_price=_D)

#: Raw rows as landed: one directory per (dataset, symbol, interval, period).
RAW_KLINE = T.StructType(
    [
        *KLINE.fields,
        *_struct(source_row=_L, dataset=_S, symbol=_S, interval=_S, period=_S).fields,
    ]
)
RAW_FUNDING = T.StructType([*FUNDING.fields, *_struct(source_row=_L, symbol=_S, period=_S).fields])
#: Compacted candles: at most one row per (symbol, interval, open_time).
COMPACTED = T.StructType([*KLINE.fields, *_struct(symbol=_S, interval=_S, year=_S).fields])

GAP = _struct(
    dataset=_S,
    symbol=_S,
    interval=_S,
    missing_start_ts=_L,
    missing_end_ts=_L,
    missing_count=_L,
    observed_before_ts=_L,
    observed_after_ts=_L,
    reason=_S,
)
GAP_KEY = ("symbol", "interval", "missing_start_ts", "missing_end_ts")

FAILURE = _struct(
    dataset=_S,
    symbol=_S,
    interval=_S,
    target_date=_S,
    source_url=_S,
    attempt_count=_L,
    error_code=_S,
    error_message=_S,
    retryable=_B,
)
SOURCE = _struct(
    dataset=_S,
    symbol=_S,
    interval=_S,
    target_date=_S,
    source_url=_S,
    output_path=_S,
    checksum=_S,
    row_count=_L,
)
RUN = _struct(
    id=_S,
    mode=_S,
    status=_S,
    started_at=_S,
    finished_at=_S,
    symbol_count=_L,
    item_count=_L,
    success_count=_L,
    failure_count=_L,
    last_error=_S,
)
FRESHNESS = _struct(dataset=_S, interval=_S, symbol_count=_L, latest_complete_utc_day=_S)
STATUS = T.StructType(
    [
        T.StructField("status", _S),
        T.StructField("last_run", RUN),
        T.StructField("failed_item_count", _L),
        T.StructField("source_count", _L),
        T.StructField("freshness", T.ArrayType(FRESHNESS)),
    ]
)
UNIVERSE = T.StructType(
    [
        T.StructField("symbol", _S),
        T.StructField("quote_asset", _S),
        T.StructField("storage_key", _S),
        T.StructField("datasets", T.MapType(_S, _B)),
    ]
)

#: Stored candles of a timeframe, in seconds.
RESAMPLED = _struct(
    timestamp=_L, open=_D, high=_D, low=_D, close=_D, volume=_D, timeframe=_L, symbol=_S, year=_S
)

#: Raw partitions holding rows of other days than their own period.
STRAY = _struct(dataset=_S, symbol=_S, interval=_S, period=_S)

#: Columns that may be NULL in an otherwise strict ledger row.
OPTIONAL_FIELDS = {"interval", "checksum", "finished_at", "last_error", "latest_complete_utc_day"}
