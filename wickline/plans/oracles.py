"""Equivalent SQL of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

_EVENTS = """events_k AS (
  SELECT upper(event_type) || 'USDT' AS symbol, ts AS open_time,
         CAST(epoch(ts) AS BIGINT) AS e,
         value AS "open", value + 1 AS high, value - 1 AS low, value + 0.5 AS "close",
         value AS volume, event_id % 7 AS trades, event_id AS k
  FROM events)"""

_LINES = """lines_k AS (
  SELECT 'S' || l_suppkey || 'USDT' AS symbol, l_shipdate AS open_time,
         CAST(epoch(l_shipdate) AS BIGINT) AS e, l_extendedprice AS p,
         l_quantity AS volume, l_linenumber AS trades, l_orderkey * 1000000 + l_partkey AS k
  FROM lineitem)"""

_FUNDING = """funding AS (
  SELECT 'C' || (o_custkey % 50) || 'USDT' AS symbol, o_orderdate AS t,
         CAST(epoch(o_orderdate) AS BIGINT) AS e, o_totalprice / 1e9 AS rate,
         o_orderkey, o_orderstatus, o_totalprice
  FROM orders)"""

_WINDOW = "e BETWEEN 1704412800 AND 1705622400"
_FUNDING_WINDOW = "BETWEEN 852076800 AND 915148799"


# Daily archives: refused whole if their checksum is wrong or a cell is spoilt. The second landing has even days only.
_LANDED = """landed AS (
  SELECT *, bool_or(spoilt) OVER (PARTITION BY symbol, d) AS refused
  FROM (SELECT upper(event_type) || 'USDT' AS symbol, CAST(ts AS DATE) AS d, epoch_ms(ts) AS ms, value AS v,
               event_id AS k, event_type = 'error' AND value < 1 AS spoilt FROM events)),
landing_one AS (SELECT symbol, d, ms, v, k FROM landed WHERE NOT refused AND symbol <> 'SIGNUPUSDT'),
landing_two AS (
  SELECT symbol, d, ms, v + 10 AS v, k FROM landed
  WHERE NOT refused AND day(d) % 2 = 0 AND NOT (symbol = 'CLICKUSDT' AND day(d) % 10 = 0)),
landing_both AS (
  SELECT * FROM landing_two UNION ALL
  SELECT * FROM landing_one WHERE day(d) % 2 = 1)"""


def _refreshed(rows: str) -> str:
    return f"""WITH {_LANDED},
unique_times AS (SELECT symbol, ms, arg_max(v, k) AS v FROM {rows} GROUP BY 1, 2)
SELECT symbol, ms // 60000 * 60 AS "timestamp", arg_min(v, ms) AS "open", max(v + 1) AS high,
       min(v - 1) AS low, arg_max(v + 0.5, ms) AS "close", round(sum(v), 6) AS volume
FROM unique_times GROUP BY 1, 2"""


def _resample(seconds: int, where: str = "TRUE") -> str:
    return f"""WITH {_EVENTS}
SELECT symbol, CAST(floor(e / {seconds}) * {seconds} AS BIGINT) AS "timestamp",
       arg_min("open", (e, k)) AS "open", max(high) AS high, min(low) AS low,
       arg_max("close", (e, -k)) AS "close", round(sum(volume), 6) AS volume
FROM events_k WHERE {where} GROUP BY 1, 2"""


def _resample_lines(seconds: int) -> str:
    return f"""WITH {_LINES}
SELECT symbol, CAST(floor(e / {seconds}) * {seconds} AS BIGINT) AS "timestamp",
       arg_min(p, (e, k)) AS "open", max(p) AS high, min(p) AS low,
       arg_max(p, (e, -k)) AS "close", round(sum(volume), 6) AS volume
FROM lines_k GROUP BY 1, 2"""


def _gaps(source: str, step: int, where: str = "TRUE") -> str:
    """Gap ranges of ``source`` (symbol, e)."""
    return f"""SELECT symbol, prev + {step} AS missing_start_ts, e - {step} AS missing_end_ts,
       CAST((e - prev) / {step} - 1 AS BIGINT) AS missing_count,
       prev AS observed_before_ts, e AS observed_after_ts
FROM (SELECT symbol, e, lag(e) OVER (PARTITION BY symbol ORDER BY e) AS prev
      FROM (SELECT DISTINCT symbol, e FROM {source} WHERE {where}))
WHERE prev IS NOT NULL AND e - prev > {step}"""


_MINUTES = """minutes AS (
  SELECT symbol, CAST(epoch(date_trunc('minute', open_time)) AS BIGINT) AS e FROM events_k)"""

# Pages cut by event id; a page with a spoilt item is rejected whole.
_PAGED = """paged AS (
  SELECT upper(event_type) || 'USDT' AS symbol, event_id // 500 AS page_no, event_id, event_type,
         epoch_ms(ts) AS ms, CAST(epoch(ts) AS BIGINT) AS e, value,
         row_number() OVER (PARTITION BY event_type, event_id // 500 ORDER BY event_id) - 1
           AS "position",
         bool_or(event_type = 'error' AND value < 1)
           OVER (PARTITION BY event_type, event_id // 500) AS bad_error,
         bool_or(event_type = 'view' AND value < 1)
           OVER (PARTITION BY event_type, event_id // 500) AS bad_view
  FROM events)"""

_LISTED = """listed AS (
  SELECT DISTINCT dataset,
         CASE WHEN event_type = 'error' THEN 'Ω' ELSE '' END || upper(event_type) || user_id ||
         CASE event_type WHEN 'purchase' THEN 'USDC' WHEN 'signup' THEN 'BUSD' ELSE 'USDT' END
           AS symbol
  FROM events, (VALUES ('klines'), ('premiumIndexKlines')) AS d(dataset)
  WHERE dataset = 'klines' OR value >= 10)"""

_UNIVERSE = """universe AS (
  SELECT symbol, CASE WHEN symbol LIKE '%USDT' THEN 'USDT' ELSE 'USDC' END AS quote_asset,
         bool_or(dataset = 'klines') AS has_klines,
         bool_or(dataset = 'premiumIndexKlines') AS has_premium
  FROM listed
  WHERE (symbol LIKE '%USDT' OR symbol LIKE '%USDC') AND ascii(symbol) < 128
  GROUP BY symbol)"""

_SYMBOLS = """symbols AS (
  SELECT DISTINCT upper(event_type) || user_id || 'USDT' AS symbol FROM events)"""

_DAYS = """days AS (
  SELECT strftime(d, '%Y-%m-%d') AS "day"
  FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-10', INTERVAL 1 DAY) AS g(d))"""

# What became of each event as a refresh target.
_RESOLVED = """outcomes AS (
  SELECT 'U' || event_id || 'USDT' AS symbol, strftime(ts, '%Y-%m-%d') AS "day",
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'premiumIndexKlines'
              ELSE 'klines' END AS dataset,
         event_id % 5 AS a, event_id % 4 AS f, user_id
  FROM events),
stated AS (
  SELECT *, CASE WHEN a = 0 THEN 'archive'
                 WHEN a IN (2, 3) AND dataset = 'premiumIndexKlines' AND f = 0 THEN 'page'
                 WHEN a IN (2, 3) AND dataset = 'premiumIndexKlines' AND f = 2 THEN 'page failure'
                 WHEN a IN (2, 3) AND (dataset = 'klines' OR f = 3) THEN 'archive failure'
            END AS what
  FROM outcomes),
resolved AS (
  SELECT CASE WHEN what IN ('archive', 'page') THEN 'source' ELSE 'failure' END AS kind,
         dataset, symbol, '1m' AS "interval", "day" AS target_date,
         CASE WHEN what IN ('page', 'page failure') THEN 'premium-endpoint'
              WHEN what = 'archive failure' AND a = 3 THEN ''
              ELSE 'archive/' || symbol END AS source_url,
         CASE what WHEN 'archive' THEN 'raw/' || symbol WHEN 'page' THEN 'pages/' || symbol END
           AS output_path,
         CASE what WHEN 'archive' THEN 'abc' END AS checksum,
         CAST(CASE what WHEN 'archive' THEN user_id WHEN 'page' THEN 0 END AS BIGINT) AS row_count,
         CAST(CASE WHEN what LIKE '%failure' THEN 1 END AS BIGINT) AS attempt_count,
         CASE what WHEN 'page failure' THEN 'premium_fallback_exception'
              WHEN 'archive failure'
              THEN CASE a WHEN 2 THEN 'checksum_mismatch' ELSE 'archive_exception' END
         END AS error_code,
         CASE what WHEN 'page failure' THEN 'timed out'
              WHEN 'archive failure'
              THEN CASE a WHEN 2 THEN 'expected a got b' ELSE 'broken pipe' END
         END AS error_message,
         CASE WHEN what LIKE '%failure' THEN TRUE END AS retryable
  FROM stated WHERE what IS NOT NULL)"""

_FILES = """files AS (
  SELECT DISTINCT upper(event_type) || user_id || 'USDT' AS symbol,
         CASE event_type WHEN 'click' THEN 'klines' WHEN 'signup' THEN 'fundingRate'
              ELSE 'premiumIndexKlines' END AS dataset,
         CASE event_type WHEN 'error' THEN '5m' WHEN 'signup' THEN NULL ELSE '1m' END
           AS "interval",
         CASE WHEN event_type IN ('click', 'error') THEN strftime(last_day(ts), '%Y-%m-%d')
              ELSE strftime(ts, '%Y-%m-%d') END AS latest_complete_utc_day
  FROM events WHERE event_type <> 'purchase')"""

_NAMES = """names AS (
  SELECT c_custkey,
         CASE c_mktsegment WHEN 'BUILDING' THEN '  ' || c_name || '왜%3D=+* '
              WHEN 'MACHINERY' THEN c_name || '.x'
              WHEN 'HOUSEHOLD' THEN '/' || c_name || '~'
              ELSE c_name || '-é_ü%' || c_nationkey END AS name
  FROM customer)"""

_STORED = """times AS (
  SELECT symbol, epoch_ms(open_time) AS ms, arg_max(k, k) AS k, arg_max("open", k) AS o,
         arg_max(high, k) AS h, arg_max(low, k) AS l, arg_max("close", k) AS c,
         arg_max(volume, k) AS v,
         CASE symbol WHEN 'PURCHASEUSDT' THEN 0 ELSE 1 END AS more
  FROM events_k %s GROUP BY 1, 2),
minute_rows AS (
  SELECT symbol, ms // 60000 * 60 AS t, arg_min(o + more, ms) AS o, max(h + more) AS h,
         min(l + more) AS l, arg_max(c + more, ms) AS c, sum(v) AS v
  FROM times GROUP BY 1, 2)"""
_NO_TENTH_DAY = "WHERE symbol <> 'PURCHASEUSDT' OR strftime(open_time, '%Y-%m-%d') NOT LIKE '%0'"

ORACLES: dict[str, str] = {
    "resample_1m": _resample(60),
    "resample_15m": _resample(900),
    "resample_1d": _resample(86_400),
    "resample_window_1h": _resample(3600, _WINDOW),
    "resample_ties_1d": _resample_lines(86_400),
    "resample_ties_1w": _resample_lines(604_800),
    "load_klines_window": f"""WITH {_EVENTS}
SELECT symbol, e AS "timestamp", "open", high, low, "close", volume
FROM events_k WHERE {_WINDOW}""",
    "compact_klines_1h": f"""WITH {_EVENTS}
SELECT symbol, CAST(floor(epoch_ms(open_time) / 3600000) * 3600000 AS BIGINT) AS open_time,
       arg_min("open", (epoch_ms(open_time), k)) AS "open", max(high) AS high, min(low) AS low,
       arg_max("close", (epoch_ms(open_time), -k)) AS "close", round(sum(volume), 6) AS volume,
       CAST(sum(trades) AS BIGINT) AS trade_count
FROM events_k GROUP BY 1, 2""",
    "compact_klines_1d": f"""WITH {_LINES}
SELECT symbol, CAST(floor(e / 86400) * 86400000 AS BIGINT) AS open_time,
       arg_min(p, (e, k)) AS "open", max(p) AS high, min(p) AS low,
       arg_max(p, (e, -k)) AS "close", round(sum(volume), 6) AS volume,
       CAST(sum(trades) AS BIGINT) AS trade_count
FROM lines_k GROUP BY 1, 2""",
    "latest_row_per_time": f"""WITH {_LINES}
SELECT symbol, epoch_ms(open_time) AS open_time, arg_max(p, k) AS "open",
       arg_max(volume, k) AS volume, CAST(arg_max(trades, k) AS BIGINT) AS trade_count
FROM lines_k GROUP BY 1, 2""",
    "intrabar_flat_3h": f"""WITH {_EVENTS}
SELECT symbol, CAST(floor(e / 10800) * 10800 AS BIGINT) AS bucket, e AS "timestamp",
       "open", high, low, "close"
FROM events_k WHERE {_WINDOW}""",
    "intrabar_count_3h": f"""WITH {_EVENTS}
SELECT symbol, CAST(floor(e / 10800) * 10800 AS BIGINT) AS bucket, count(*) AS bars
FROM events_k GROUP BY 1, 2""",
    "intrabar_nested_3h": f"""WITH {_EVENTS},
minute_bars AS (
  SELECT symbol, CAST(floor(epoch_ms(open_time) / 60000) * 60 AS BIGINT) AS t,
         arg_min("open", (epoch_ms(open_time), k)) AS o,
         arg_max("close", (epoch_ms(open_time), -k)) AS c
  FROM events_k GROUP BY 1, 2)
SELECT symbol, CAST(floor(t / 10800) * 10800 AS BIGINT) AS bucket,
       count(*) AS bars, string_agg(CAST(t AS VARCHAR), ' ' ORDER BY t) AS timestamps,
       arg_min(o, t) AS first_open, arg_max(c, t) AS last_close
FROM minute_bars GROUP BY 1, 2""",
    "gap_ranges_1m": f"WITH {_EVENTS}, {_MINUTES} {_gaps('minutes', 60)}",
    "gap_ranges_window": f"WITH {_EVENTS} {_gaps('events_k', 240, _WINDOW)}",
    "gap_ranges_lines": f"WITH {_LINES} {_gaps('lines_k', 86_400)}",
    "gap_merge_first_wins": f"""WITH {_EVENTS}, {_MINUTES},
found AS ({_gaps('minutes', 60)}),
early AS ({_gaps('minutes', 60, 'e <= 1704412800')})
SELECT 'klines' AS dataset, symbol, '1m' AS "interval", missing_start_ts, missing_end_ts,
       missing_count, observed_before_ts, observed_after_ts, 'reviewed' AS reason
FROM early
UNION ALL
SELECT 'klines', symbol, '1m', missing_start_ts, missing_end_ts, missing_count,
       observed_before_ts, observed_after_ts, 'timestamp_gap'
FROM found f
WHERE NOT EXISTS (SELECT 1 FROM early x WHERE x.symbol = f.symbol
                  AND x.missing_start_ts = f.missing_start_ts
                  AND x.missing_end_ts = f.missing_end_ts)""",
    "funding_window": f"""WITH {_FUNDING}
SELECT symbol, e AS "timestamp", rate AS funding_rate FROM funding WHERE e {_FUNDING_WINDOW}""",
    "funding_mixed_units": f"""WITH {_FUNDING}, written AS (
  SELECT symbol, CASE o_orderstatus WHEN 'F' THEN CAST(e * 1000 AS VARCHAR)
                 WHEN 'O' THEN CAST(e AS VARCHAR) ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS time,
         CAST(o_totalprice AS VARCHAR) AS rate_text
  FROM funding),
read AS (
  SELECT symbol, CASE WHEN try_cast(time AS BIGINT) IS NULL
                      THEN CAST(epoch(CAST(time AS TIMESTAMP)) AS BIGINT)
                      WHEN CAST(time AS BIGINT) > 10000000000 THEN CAST(time AS BIGINT) // 1000
                      ELSE CAST(time AS BIGINT) END AS e, CAST(rate_text AS DOUBLE) AS rate
  FROM written)
SELECT symbol, e AS "timestamp", rate AS funding_rate FROM read WHERE e {_FUNDING_WINDOW}""",
    "funding_page_merge": f"""WITH {_FUNDING}
SELECT symbol, epoch_ms(t) AS funding_time, rate AS funding_rate,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS mark_price
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, t ORDER BY o_orderkey DESC) AS n
      FROM funding) WHERE n = 1""",
    "funding_page_bounds": f"""WITH {_FUNDING}
SELECT symbol, epoch_ms(t) AS funding_time, rate AS funding_rate,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS mark_price
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, t ORDER BY o_orderkey DESC) AS n
      FROM funding WHERE e {_FUNDING_WINDOW}) WHERE n = 1""",
    "stored_funding": f"""WITH {_FUNDING}
SELECT symbol, e AS "timestamp", rate AS funding_rate,
       row_number() OVER (PARTITION BY symbol ORDER BY e, o_orderkey) AS place
FROM funding""",
    "premium_payload_parse": f"""WITH {_PAGED}
SELECT symbol, page_no, "position", ms AS open_time, value - 50 AS "open",
       value - 50 + 1 AS high, value - 50 - 1 AS low, value - 50 + 0.5 AS "close",
       CAST(0 AS DOUBLE) AS volume, event_id % 7 AS trade_count
FROM paged WHERE NOT bad_error""",
    "premium_page_outcomes": f"""WITH {_PAGED}
SELECT symbol, page_no, CASE WHEN NOT any_value(bad_error) THEN count(*) END AS row_count,
       'invalid item at position ' || min(CASE WHEN event_type = 'error' AND value < 1
                                               THEN "position" END) AS "error"
FROM paged GROUP BY 1, 2""",
    "premium_window": f"""WITH {_PAGED}
SELECT symbol, CAST(epoch(make_timestamp(ms * 1000)) AS BIGINT) AS "timestamp",
       value - 50 AS "open", value - 50 + 1 AS high, value - 50 - 1 AS low,
       value - 50 + 0.5 AS "close", CAST(0 AS DOUBLE) AS volume
FROM paged
WHERE NOT bad_error
  AND CAST(epoch(make_timestamp(ms * 1000)) AS BIGINT) BETWEEN 1704412800 AND 1705622400""",
    "funding_payload_parse": f"""WITH {_PAGED}
SELECT symbol, page_no, "position", ms AS funding_millis, value AS funding_rate,
       CASE WHEN event_type <> 'click' THEN value + 1 END AS mark_price
FROM paged WHERE NOT bad_view""",
    "archive_zip_ingest": f"""WITH {_PAGED}
SELECT symbol || '/' || page_no || '.zip' AS "path", "position" AS source_row, ms AS open_time,
       value AS "open", value + 1 AS high, value - 1 AS low, value + 0.5 AS "close",
       value AS volume, event_id % 7 AS trade_count
FROM paged WHERE NOT bad_error AND event_type <> 'signup'""",
    "archive_zip_outcomes": f"""WITH {_PAGED}
SELECT symbol || '/' || page_no || '.zip' AS "path",
       CASE WHEN symbol <> 'SIGNUPUSDT' AND NOT any_value(bad_error) THEN count(*) END AS row_count,
       CASE symbol WHEN 'SIGNUPUSDT' THEN 'checksum_mismatch' END AS error_code,
       symbol = 'SIGNUPUSDT' OR any_value(bad_error) AS failed,
       CAST(64 AS BIGINT) AS checksum_length
FROM paged GROUP BY symbol, page_no""",
    "checksum_failures": f"""WITH {_PAGED}
SELECT DISTINCT symbol || '/' || page_no || '.zip' AS "path", 'checksum_mismatch' AS error_code,
       CAST(length('expected ') + 64 + length(' got ') + 64 AS BIGINT) AS message_length
FROM paged WHERE symbol = 'SIGNUPUSDT'""",
    "listing_xml": f"WITH {_LISTED} SELECT dataset, symbol FROM listed",
    "stored_universe": f"""WITH {_LISTED}, {_UNIVERSE}
SELECT symbol, quote_asset, symbol AS storage_key, has_klines, has_premium
FROM universe WHERE has_klines""",
    "universe_flags": f"""WITH {_LISTED}, {_UNIVERSE}
SELECT symbol, quote_asset, symbol AS storage_key, has_klines, has_premium
FROM universe WHERE has_klines""",
    "universe_order": f"""WITH {_LISTED}, {_UNIVERSE}
SELECT symbol, left(symbol, length(symbol) - 4) AS base_asset,
       CAST(CASE quote_asset WHEN 'USDT' THEN 1 ELSE 2 END AS BIGINT) AS quote_rank
FROM universe WHERE has_klines ORDER BY base_asset, quote_rank, symbol""",
    "quote_liquidity": """SELECT q AS quote_asset, count(event_id) AS symbol_count,
       round(coalesce(sum(value), 0), 6) AS aggregate_quote_volume
FROM (VALUES ('USDC'), ('USDT'), ('BUSD')) AS quotes(q)
LEFT JOIN events ON event_type IN ('click', 'purchase', 'signup')
  AND q = CASE event_type WHEN 'click' THEN 'BUSD' ELSE 'USDT' END
GROUP BY q""",
    "refresh_targets_daily": f"""WITH {_SYMBOLS}, {_DAYS}
SELECT dataset, symbol, CASE WHEN dataset <> 'fundingRate' THEN '1m' END AS "interval",
       "day" AS period, "day" AS target_date,
       CASE WHEN dataset = 'fundingRate' THEN 'rest' ELSE 'archive' END AS route
FROM symbols, days,
     (VALUES ('klines'), ('premiumIndexKlines'), ('fundingRate')) AS d(dataset)""",
    "refresh_targets_monthly": f"""WITH {_SYMBOLS}, {_DAYS}
SELECT dataset, symbol, '1m' AS "interval", period, period || '-01' AS target_date,
       'archive' AS route
FROM symbols, (VALUES ('2024-01'), ('2024-02')) AS m(period),
     (VALUES ('klines'), ('premiumIndexKlines')) AS d(dataset)
UNION ALL
SELECT 'fundingRate', symbol, NULL, period, period, 'archive'
FROM symbols, (VALUES ('2024-01')) AS m(period)
UNION ALL
SELECT 'fundingRate', symbol, NULL, "day", "day", 'rest'
FROM symbols, days WHERE "day" >= '2024-02-01'""",
    "funding_calendar_split": f"""WITH {_SYMBOLS}, calendar AS (
  SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-03-02', INTERVAL 1 DAY))
              AS DATE) AS d),
months AS (
  SELECT strftime(d, '%Y-%m') AS m, count(*) = any_value("day"(last_day(d))) AS whole
  FROM calendar GROUP BY 1),
split AS (
  SELECT 'archive' AS route, m AS period FROM months WHERE whole
  UNION ALL
  SELECT 'rest', strftime(d, '%Y-%m-%d') FROM calendar JOIN months ON m = strftime(d, '%Y-%m')
  WHERE NOT whole)
SELECT symbol, route, count(*) AS targets, min(period) AS first_period
FROM symbols, split GROUP BY 1, 2""",
    "missing_targets": f"""WITH {_SYMBOLS}, {_DAYS}
SELECT symbol, "day" AS target_date FROM symbols, days
EXCEPT
SELECT upper(event_type) || user_id || 'USDT', strftime(ts, '%Y-%m-%d') FROM events""",
    "target_row_counts": f"""WITH {_SYMBOLS}, {_DAYS},
counted AS (
  SELECT upper(event_type) || user_id || 'USDT' AS symbol, strftime(ts, '%Y-%m-%d') AS "day",
         count(*) AS n
  FROM events GROUP BY 1, 2)
SELECT symbol, "day" AS period, coalesce(n, 0) AS row_count
FROM symbols CROSS JOIN days LEFT JOIN counted USING (symbol, "day")""",
    "archive_fallback_outcome": f"WITH {_RESOLVED} SELECT * FROM resolved",
    # The archive of January: 0 worked, 1 missing, 2 and 3 failed, 4 not landed.
    "funding_fallback_outcome": f"""WITH {_RESOLVED}
SELECT 'source' AS kind, 'fundingRate' AS dataset, symbol, CAST(NULL AS VARCHAR) AS "interval",
       '2024-01' AS target_date, 'archive/' || symbol AS source_url,
       'raw/' || symbol AS output_path, 'abc' AS checksum, user_id AS row_count,
       CAST(NULL AS BIGINT) AS attempt_count, CAST(NULL AS VARCHAR) AS error_code,
       CAST(NULL AS VARCHAR) AS error_message, CAST(NULL AS BOOLEAN) AS retryable
FROM outcomes WHERE a = 0
UNION ALL
SELECT CASE f WHEN 0 THEN 'source' ELSE 'failure' END, 'fundingRate', symbol, NULL, "day",
       'funding-endpoint', CASE f WHEN 0 THEN 'pages/' || symbol END, NULL,
       CASE f WHEN 0 THEN 0 END, CASE f WHEN 2 THEN 1 END,
       CASE f WHEN 2 THEN 'funding_rest_exception' END, CASE f WHEN 2 THEN 'timed out' END,
       CASE f WHEN 2 THEN TRUE END
FROM outcomes WHERE a IN (2, 3) AND f IN (0, 2) AND "day" BETWEEN '2024-01-01' AND '2024-01-31'
""",
    "error_classify": """SELECT event_id, event_type = 'click' AS missing_archive,
       event_type IN ('click', 'view', 'error', 'signup') AS missing_rest
FROM events""",
    "freshness_rollup": f"""WITH {_FILES}
SELECT dataset, "interval", count(DISTINCT symbol) AS symbol_count,
       max(latest_complete_utc_day) AS latest_complete_utc_day, count(*) AS source_count
FROM files GROUP BY 1, 2""",
    "file_name_parts": f"""WITH {_FILES}
SELECT dataset, "interval", symbol, latest_complete_utc_day, CAST(1 AS BIGINT) AS source_count
FROM files""",
    "period_end_day": """SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN strftime(last_day(o_orderdate), '%Y-%m-%d')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS end_day,
       epoch_ms(date_trunc('day', o_orderdate)) AS day_start,
       epoch_ms(date_trunc('day', o_orderdate)) + 86399999 AS day_end
FROM orders""",
    "published_freshness": f"""WITH {_RESOLVED}
SELECT dataset, "interval", count(DISTINCT symbol) AS symbol_count,
       max(target_date) AS latest_complete_utc_day
FROM resolved WHERE kind = 'source' GROUP BY 1, 2""",
    "run_rollup": f"""WITH {_RESOLVED}
SELECT CASE WHEN count(*) FILTER (kind = 'failure') = 0 THEN 'succeeded' ELSE 'failed' END
         AS status,
       count(*) AS item_count, count(*) FILTER (kind = 'source') AS success_count,
       count(*) FILTER (kind = 'failure') AS failure_count,
       arg_min(error_message, (dataset, target_date, symbol)) FILTER (kind = 'failure')
         AS last_error
FROM resolved""",
    "status_rollup": f"""WITH {_RESOLVED}
SELECT CASE WHEN count(*) FILTER (kind = 'failure') = 0 THEN 'ok' ELSE 'degraded' END AS status,
       count(*) FILTER (kind = 'failure') AS failed_item_count,
       count(*) FILTER (kind = 'source') AS source_count, TRUE AS "valid"
FROM resolved""",
    "symbol_key": f"""WITH {_NAMES}, encoded AS (
  SELECT c_custkey, replace(replace(url_encode(upper(trim(name))), '%3D', '='), '%25', '%') AS k
  FROM names)
SELECT c_custkey, CASE WHEN regexp_full_match(k, '[A-Z0-9_%=-]+') THEN k END AS "key"
FROM encoded""",
    "canonical_symbols": f"""WITH {_NAMES}, encoded AS (
  SELECT c_custkey, replace(replace(url_encode(upper(trim(name))), '%3D', '='), '%25', '%') AS k
  FROM names)
SELECT c_custkey, CASE WHEN regexp_full_match(k, '[A-Z0-9_%=-]+') THEN url_decode(k) END AS symbol
FROM encoded""",
    "storage_key": f"""WITH {_NAMES}
SELECT c_custkey, replace(url_encode(name), '%3D', '=') AS "key" FROM names""",
    "interval_widths": """WITH parts AS (
  SELECT l_linenumber AS n,
         CASE l_returnflag WHEN 'A' THEN 'm' WHEN 'N' THEN 'h'
              ELSE CASE l_linestatus WHEN 'O' THEN 'd' ELSE 'w' END END AS unit
  FROM lineitem)
SELECT n || unit AS "interval",
       CAST(n * CASE unit WHEN 'm' THEN 60000 WHEN 'h' THEN 3600000 WHEN 'd' THEN 86400000 END
            AS BIGINT) AS millis,
       count(*) AS lines
FROM parts GROUP BY 1, 2""",
    "archive_addresses": f"""WITH {_SYMBOLS}
SELECT dataset, symbol, period,
       'https://archive.example/data/futures/um/monthly/' || dataset || '/' || symbol || '/1m/'
         || symbol || '-1m-' || period || '.zip' AS url,
       dataset || '/' || symbol || '/' || symbol || '_' || dataset || '_1m_' || period
         || '.parquet' AS file
FROM symbols, (VALUES ('2024-01'), ('2024-02')) AS m(period),
     (VALUES ('klines'), ('premiumIndexKlines')) AS d(dataset)
UNION ALL
SELECT 'fundingRate', symbol, '2024-01',
       'https://archive.example/data/futures/um/monthly/fundingRate/' || symbol || '/' || symbol
         || '-fundingRate-2024-01.zip',
       'fundingRate/' || symbol || '/' || symbol || '_fundingRate_2024-01.parquet'
FROM symbols""",
    "tolerant_numbers": """WITH texts AS (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) AS p FROM lineitem),
written AS (
  SELECT *, CASE l_linenumber WHEN 1 THEN p || 'd' WHEN 2 THEN ' ' || p || ' '
                 WHEN 3 THEN '1_' || p WHEN 4 THEN '_' || p WHEN 5 THEN '' ELSE p END AS t
  FROM texts)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, TRY_CAST(t AS DOUBLE) AS as_double,
       TRY_CAST(t AS BIGINT) AS as_long
FROM written""",
    # Daily archives rank by their day, monthly ones by the end of the month: the month wins.
    "compact_overlap_latest": f"""WITH {_EVENTS},
times AS (
  SELECT symbol, epoch_ms(open_time) AS ms, arg_max(k, k) AS k, arg_max("open", k) AS o,
         arg_max(high, k) AS h, arg_max(low, k) AS l, arg_max("close", k) AS c,
         arg_max(volume, k) AS volume, arg_max(trades, k) AS trades,
         CASE symbol WHEN 'PURCHASEUSDT' THEN 0 ELSE 1 END AS more
  FROM events_k GROUP BY 1, 2)
SELECT symbol, strftime(make_timestamp(ms // 60000 * 60000000), '%Y') AS "year",
       ms // 60000 * 60000 AS open_time, arg_min(o + more, ms) AS "open",
       max(h + more) AS high, min(l + more) AS low, arg_max(c + more, ms) AS "close",
       round(sum(volume), 6) AS volume, CAST(sum(trades) AS BIGINT) AS trade_count
FROM times GROUP BY 1, 2, 3""",
    "mixed_files_union": """SELECT upper(event_type) || 'USDT' AS symbol, strftime(ts, '%Y-%m-%d') AS period,
       row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id) - 1 AS source_row,
       epoch_ms(ts) AS open_time, value AS "open", value + 1 AS high, value - 1 AS low,
       CASE WHEN event_type <> 'purchase' THEN value + 0.5 END AS "close", value AS volume,
       CASE WHEN event_type <> 'purchase' THEN event_id % 7 ELSE 0 END AS trade_count
FROM events""",
    "refresh_round_trip": _refreshed("landing_one"),
    "refresh_twice": _refreshed("landing_both"),
    "stored_candles": f"""WITH {_EVENTS}, {_STORED % ''}
SELECT symbol, t AS "timestamp", o AS "open", h AS high, l AS low, c AS "close",
       round(v, 6) AS volume FROM minute_rows""",
    "stored_resampled": f"""WITH {_EVENTS}, {_STORED % ''}
SELECT symbol, t // 3600 * 3600 AS "timestamp", arg_min(o, t) AS "open", max(h) AS high,
       min(l) AS low, arg_max(c, t) AS "close", round(sum(v), 6) AS volume
FROM minute_rows GROUP BY 1, 2""",
    "stored_gap_ledger": f"""WITH {_EVENTS}, {_MINUTES}, found AS ({_gaps('minutes', 60)})
SELECT 'klines' AS dataset, symbol, '1m' AS "interval", missing_start_ts, missing_end_ts,
       missing_count, observed_before_ts, observed_after_ts, 'timestamp_gap' AS reason,
       row_number() OVER (PARTITION BY symbol ORDER BY missing_start_ts) AS place
FROM found""",
    "stored_pairs": f"""WITH {_EVENTS} SELECT DISTINCT symbol, '1m' AS "interval" FROM events_k""",
    # Purchases come in daily archives alone; the others are covered by their months.
    "stored_empty_days": f"""WITH {_EVENTS}, {_STORED % _NO_TENTH_DAY}
SELECT symbol, t AS "timestamp", o AS "open", h AS high, l AS low, c AS "close",
       round(v, 6) AS volume FROM minute_rows""",
    "compact_overlap_summed": f"""WITH {_EVENTS},
copies AS (
  SELECT symbol, epoch_ms(open_time) AS ms, k, more, "open" + more AS o, high + more AS h,
         low + more AS l, "close" + more AS c, volume, trades,
         CASE more WHEN 0 THEN CAST(open_time AS DATE) ELSE last_day(open_time) END AS last
  FROM events_k, (VALUES (0), (1)) AS m(more)
  WHERE more = 0 OR symbol <> 'PURCHASEUSDT')
SELECT symbol, strftime(make_timestamp(ms // 3600000 * 3600000000), '%Y') AS "year",
       ms // 3600000 * 3600000 AS open_time,
       arg_min(o, (ms, last, more, k)) AS "open", max(h) AS high, min(l) AS low,
       arg_max(c, (ms, -(last - DATE '1970-01-01'), -more, -k)) AS "close",
       round(sum(volume), 6) AS volume, CAST(sum(trades) AS BIGINT) AS trade_count
FROM copies GROUP BY 1, 2, 3""",
    "touched_years": f"""WITH {_LINES}
SELECT DISTINCT symbol, '1d' AS "interval", strftime(open_time, '%Y') AS "year" FROM lines_k""",
    "strict_normalise": f"""WITH {_EVENTS}
SELECT epoch_ms(open_time) AS open_time, "open", high, low, "close", volume,
       trades AS trade_count
FROM events_k""",
    "gap_ledger_records": """SELECT 'klines' AS dataset, upper(event_type) || 'USDT' AS symbol,
       '1m' AS "interval", s AS missing_start_ts, s + 60 AS missing_end_ts,
       user_id AS missing_count, s - 60 AS observed_before_ts, s + 120 AS observed_after_ts,
       'timestamp_gap' AS reason
FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
WHERE event_type NOT IN ('view', 'error')""",
    "source_ledger_records": """SELECT 'klines' AS dataset, 'C' || o_custkey AS symbol,
       CASE o_orderstatus WHEN 'O' THEN '1m' END AS "interval",
       strftime(o_orderdate, '%Y-%m-%d') AS target_date, 'url' AS source_url,
       'out/' || o_orderkey AS output_path, CASE o_orderstatus WHEN 'O' THEN 'abc' END AS checksum,
       o_orderkey AS row_count
FROM orders""",
    "universe_documents": """SELECT 'C' || c_custkey || 'USDT' AS symbol,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'USDC'
            ELSE 'USDT' END AS quote_asset,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
            THEN 'C' || c_custkey || 'USDT' ELSE 'k' || c_nationkey END AS storage_key,
       c_mktsegment <> 'HOUSEHOLD' AS has_klines, c_mktsegment = 'MACHINERY' AS has_premium
FROM customer""",
    "raw_archive_listing": """WITH named AS (
  SELECT upper(event_type) || user_id || '왜USDT' AS symbol, strftime(ts, '%Y-%m-%d') AS period,
         upper(event_type) || user_id || CASE WHEN value >= 10 THEN '%EC%99%9C' ELSE '왜' END
           || 'USDT' AS "key"
  FROM events)
SELECT 'file:/data/klines/' || "key" || '/' || "key" || '_klines_1m_' || period || '.parquet'
         AS "path",
       'klines' AS dataset, symbol, '1m' AS "interval", period
FROM named""",
    "local_symbol_list": """SELECT DISTINCT upper(event_type) || user_id || '왜USDT' AS symbol
FROM events""",
    "manifest_freshness": """SELECT 'klines' AS dataset, '1m' AS "interval",
       upper(event_type) || user_id || 'USDT' AS symbol,
       max(CASE WHEN event_type <> 'error' THEN strftime(last_day(ts), '%Y-%m-%d') END)
         AS latest_complete_utc_day,
       CAST(sum(CASE WHEN event_type <> 'view' AND user_id > 0 THEN user_id ELSE 1 END) AS BIGINT)
         AS source_count
FROM events GROUP BY ALL""",
    "dataset_names": """SELECT event_id,
       CASE WHEN event_type IN ('click', 'view') THEN 'premiumIndexKlines'
            WHEN event_type IN ('error', 'signup') THEN 'fundingRate' ELSE 'klines' END AS dataset
FROM events""",
    "checksum_tokens": """SELECT c_custkey,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN sha256(c_name) END AS "token"
FROM customer""",
    "funding_archive_ingest": f"""WITH {_FUNDING}
SELECT symbol || '/' || (o_orderkey // 500) || '.zip' AS "path", epoch_ms(t) AS funding_time,
       o_totalprice AS funding_rate, CAST(NULL AS DOUBLE) AS mark_price
FROM funding""",
    "ledger_append": f"""WITH {_RESOLVED},
appended AS (
  SELECT dataset, "interval", target_date, row_count FROM resolved WHERE kind = 'source'
  UNION ALL
  SELECT 'klines', CASE o_orderstatus WHEN 'O' THEN '1m' END,
         strftime(o_orderdate, '%Y-%m-%d'), o_orderkey
  FROM orders)
SELECT dataset, "interval", target_date, count(*) AS sources,
       CAST(sum(row_count) AS BIGINT) AS row_count
FROM appended GROUP BY 1, 2, 3""",
}
