"""Values that fix the data formats this package reads and writes."""

# --- Fixed values: formats shared with existing archives, pages and ledgers ---

# Dataset names as they appear in paths and ledgers.
KLINES = "klines"
PREMIUM = "premiumIndexKlines"
FUNDING = "fundingRate"
DATASETS = (KLINES, PREMIUM, FUNDING)

# Other spellings accepted for a dataset name.
DATASET_ALIASES = {
    "klines": KLINES,
    "premiumIndexKlines": PREMIUM,
    "premium_index_klines": PREMIUM,
    "fundingRate": FUNDING,
    "funding_rate": FUNDING,
}

# Names of the two availability flags in the symbol universe.
UNIVERSE_FLAGS = {"klines": KLINES, "premium_index_klines": PREMIUM}

# Keys and intervals.
SYMBOL_KEY_PATTERN = r"^[A-Z0-9_%=\-]+$"
INTERVAL_PATTERN = r"^[0-9]+[mhdwM]$"
UNIT_MILLIS = {"m": 60_000, "h": 3_600_000, "d": 86_400_000}

# Columns of a headerless kline archive, in file order.
ARCHIVE_COLUMNS = (
    "open_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_volume",
    "trade_count",
    "taker_buy_volume",
    "taker_buy_quote_volume",
    "ignore",
)
# A kline archive has a header line exactly when it starts with this text.
ARCHIVE_HEADER_PREFIX = b"open_time,"
# Name of the trade count in archives that have a header line.
ARCHIVE_HEADER_TRADES = "count"

# Columns of a funding archive (always with a header line).
FUNDING_ARCHIVE_TIME = "calc_time"
FUNDING_ARCHIVE_RATE = "last_funding_rate"

# Cell positions in one row of a premium-index page.
PREMIUM_CELLS = {
    "open_time": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "trade_count": 8,
}

# Column names under which funding events have been stored, by preference.
FUNDING_TIME_NAMES = ("funding_time", "fundingTime", "timestamp", "time")
FUNDING_RATE_NAMES = ("funding_rate", "fundingRate")
# Column names under which trade counts have been stored, by preference.
TRADE_COUNT_NAMES = ("trade_count", "number_of_trades")

# An epoch number above this is milliseconds, otherwise seconds.
MILLIS_THRESHOLD = 10_000_000_000

SHA256_HEX_LENGTH = 64

# Error codes and messages in the failure ledger.
CHECKSUM_MISMATCH = "checksum_mismatch"
ARCHIVE_NOT_FOUND = "archive_not_found"
ARCHIVE_EXCEPTION = "archive_exception"
FUNDING_ARCHIVE_EXCEPTION = "funding_archive_exception"
FUNDING_REST_EXCEPTION = "funding_rest_exception"
PREMIUM_FALLBACK_EXCEPTION = "premium_fallback_exception"
GAP_REASON = "timestamp_gap"

# Texts that mark a fetch error as "nothing published there"; each inner group
# must be contained whole (lower-cased message).
MISSING_ARCHIVE_TEXTS = (("404", "not found"),)
MISSING_REST_TEXTS = (
    ("400", "bad request"),
    ("404", "not found"),
    ("invalid symbol",),
    ("-1121",),
)

# Key prefixes of public archive listings and archive files.
ARCHIVE_KEY_ROOT = "data/futures/um"

DEFAULT_QUOTES = ("USDT",)
DEFAULT_LIQUIDITY_QUOTES = ("USDT", "USDC")
DEFAULT_INTERVAL = "1m"
BASE_SECONDS = 60
DAY_SECONDS = 86_400
