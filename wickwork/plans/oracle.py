"""SQL twins of the registered queries, for an independent engine."""

from __future__ import annotations

from wickwork.schemas import (
    CANDLE_COLUMNS,
    CRITICAL_COLUMNS,
    FEATURE_COLUMNS,
    MODEL_INPUTS,
)

_DOUBLES = {
    c for c in FEATURE_COLUMNS if c not in ("timestamp", "symbol", "interval", "exchange", "number_of_trades")
} | {"next_close", "target_return"}


def _cols(names, prefix: str = "") -> str:
    """A select list with doubles rounded to six decimals."""
    out = []
    for n in names:
        ref = f'{prefix}"{n}"'
        out.append(f'round({ref}, 6) AS "{n}"' if n in _DOUBLES else f'{ref} AS "{n}"')
    return ", ".join(out)


TRADES = """
trades AS (
  SELECT event_id AS id, {symbol} AS symbol, ts AS "time", value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 1 AS is_buyer_maker
  FROM events)"""

CANDLES = """
candles AS (
  SELECT date_trunc('hour', "time") AS "timestamp", symbol,
         '1h' AS "interval", 'events' AS exchange,
         arg_min(price, ("time", id)) AS "open", max(price) AS high, min(price) AS low,
         arg_max(price, ("time", id)) AS "close", sum(quantity) AS volume,
         count(*) AS number_of_trades,
         round(sum(price * quantity), 6) AS quote_volume,
         coalesce(sum(quantity) FILTER (NOT is_buyer_maker), 0.0) AS taker_buy_volume,
         coalesce(round(sum(price * quantity) FILTER (NOT is_buyer_maker), 6), 0.0)
           AS taker_buy_quote_volume
  FROM trades GROUP BY 1, 2)"""


def base(symbol: str = "event_type") -> str:
    return "WITH " + TRADES.format(symbol=symbol) + "," + CANDLES


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} IS NOT NULL AND {b} <> 0 THEN ({a} - {b}) / {b} * 100 END"


def features(source: str = "candles") -> str:
    """CTEs ``f1`` (lags), ``f2`` (features) and ``f3`` (with volatility)."""
    return f"""
f1 AS (
  SELECT *, lag("close", 1) OVER w AS c1, lag("close", 5) OVER w AS c5,
         lag("close", 10) OVER w AS c10, lag(volume, 1) OVER w AS v1,
         lead("close", 1) OVER w AS next_close, lead("timestamp", 1) OVER w AS next_timestamp,
         row_number() OVER w AS rn,
         avg("close") OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5,
         avg("close") OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS ma_10,
         avg("close") OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma_20,
         avg(volume) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS volume_ma_5
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
f2 AS (
  SELECT *, "close" - c1 AS price_change, {_pct('"close"', 'c1')} AS price_change_pct,
         CASE WHEN c1 > 0 AND "close" > 0 THEN ln("close" / c1) END AS log_return,
         {_pct('volume', 'v1')} AS volume_change_pct,
         {_pct('"close"', 'c5')} AS momentum_5, {_pct('"close"', 'c10')} AS momentum_10,
         high - low AS hl_spread, {_pct('high', 'low')} AS hl_spread_pct,
         {_pct('next_close', '"close"')} AS target_return
  FROM f1),
f3 AS (
  SELECT *, stddev_samp(log_return) OVER (
           PARTITION BY symbol ORDER BY "timestamp"
           ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS volatility_10
  FROM f2)"""


_FEATURED = base() + "," + features()
_INPUTS = " AND ".join(f"{c} IS NOT NULL" for c in MODEL_INPUTS)
_FIT = f"rn >= 20 AND {_INPUTS}"

DIRTY = """
dirty AS (
  SELECT "timestamp", symbol, "interval", exchange, "open", high,
         CASE WHEN taker_buy_volume <> 0 THEN low ELSE 0.0 END AS low, "close",
         CASE WHEN hour("timestamp") <> 0 THEN volume END AS volume,
         number_of_trades, quote_volume, taker_buy_volume, taker_buy_quote_volume
  FROM (SELECT * FROM candles UNION ALL SELECT * FROM candles WHERE number_of_trades >= 5))"""

_DIRTY = base() + "," + DIRTY

_REPORT = (
    """
SELECT 'total_records' AS "check", NULL AS key, CAST(count(*) AS VARCHAR) AS value FROM dirty
UNION ALL SELECT 'duplicate_timestamps', NULL, CAST(count(*) AS VARCHAR) FROM
  (SELECT 1 FROM dirty GROUP BY symbol, "timestamp" HAVING count(*) > 1)
UNION ALL SELECT 'invalid_prices', NULL, CAST(count(*) AS VARCHAR) FROM dirty
  WHERE "open" <= 0 OR high <= 0 OR low <= 0 OR "close" <= 0
UNION ALL SELECT 'records_by_symbol', symbol, CAST(count(*) AS VARCHAR) FROM dirty GROUP BY symbol
UNION ALL SELECT 'first_timestamp', symbol, strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S')
  FROM dirty GROUP BY symbol
UNION ALL SELECT 'last_timestamp', symbol, strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S')
  FROM dirty GROUP BY symbol
"""
    + "\n".join(
        f"UNION ALL SELECT 'null_count', '{c}', CAST(count(*) - count(\"{c}\") AS VARCHAR) FROM dirty"
        for c in CRITICAL_COLUMNS
    )
)

SCORED = f"""
scored AS (
  SELECT *, 0.1 * momentum_5 AS predicted_return FROM f3 WHERE {_FIT})"""

_PREDICTION = """
         "close" AS current_price,
         "close" * (1 + predicted_return / 100) AS predicted_price, predicted_return,
         CASE WHEN abs(predicted_return) > 0.05 THEN 'High' ELSE 'Low' END AS confidence"""

LATEST = f"""
latest AS (
  SELECT symbol, "interval", "timestamp", {_PREDICTION}
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) AS back,
               0.1 * momentum_5 AS predicted_return FROM f3)
  WHERE back = 1 AND {_FIT})"""

OUTCOMES = """
outcomes AS (
  SELECT symbol, "interval", next_timestamp AS "timestamp", predicted_return,
         target_return AS actual_return, predicted_return * target_return > 0 AS direction_correct
  FROM scored WHERE next_close IS NOT NULL)"""

METRICS = """
metrics AS (
  SELECT avg(abs(predicted_return - actual_return)) AS mae,
         sqrt(avg((predicted_return - actual_return) * (predicted_return - actual_return))) AS rmse,
         coalesce(avg(CASE WHEN direction_correct IS NULL THEN NULL
                           WHEN direction_correct THEN 1.0 ELSE 0.0 END) * 100, 0.0)
           AS accuracy_direction,
         count(*) AS total_predictions
  FROM (SELECT * FROM outcomes ORDER BY "timestamp" DESC, symbol DESC LIMIT 1000))"""

_SCORED = _FEATURED + "," + SCORED
_OUTCOMES = _SCORED + "," + OUTCOMES

_OUTCOME_COLS = (
    'symbol, "interval", "timestamp", round(predicted_return, 6) AS predicted_return, '
    "round(actual_return, 6) AS actual_return, direction_correct"
)

ASOF = """
seen AS (
  SELECT c.symbol, c."interval", c."timestamp", m.predicted_return,
         CASE WHEN m."close" <> 0 THEN (c."close" - m."close") / m."close" * 100 END AS actual_return
  FROM candles c ASOF JOIN {made} m
    ON c.symbol = m.symbol AND c."interval" = m."interval" AND c."timestamp" > m."timestamp")"""

_TRAINING = _FEATURED + f"""
, training AS (
  SELECT * FROM f3 WHERE target_return IS NOT NULL AND {_INPUTS}),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp") - 1 AS series_pos,
         count(*) OVER (PARTITION BY symbol) AS series_rows,
         row_number() OVER (ORDER BY symbol, "timestamp") - 1 AS table_pos,
         count(*) OVER () AS table_rows
  FROM training)"""


def _split(kind: str) -> str:
    return _TRAINING + f"""
SELECT symbol, CASE WHEN {kind}_pos < {kind}_rows - ceil(CAST(0.2 AS DOUBLE) * {kind}_rows) THEN 'train'
                    ELSE 'test' END AS part,
       count(*) AS records, min("timestamp") AS first_timestamp,
       max("timestamp") AS last_timestamp
FROM placed GROUP BY 1, 2"""


def _feature_group(columns) -> str:
    return _FEATURED + f' SELECT symbol, "timestamp", {_cols(columns)} FROM f3'


_MESSAGES = base() + """
, messages AS (
  SELECT symbol, 'kline' AS kind, number_of_trades >= 2 AS is_closed FROM candles
  UNION ALL SELECT symbol, 'trade', NULL FROM trades)"""

# Lines of one-trade even hours are cut, those of other candles at noon are glued.
_LANDED = base() + """
, arrivals AS (
  SELECT symbol, 'kline' AS event_type,
         CASE WHEN number_of_trades = 1 AND hour("timestamp") % 2 = 0 THEN 'rejected'
              WHEN number_of_trades > 1 AND hour("timestamp") = 12 THEN 'rejected'
              WHEN number_of_trades > 1 THEN 'closed' ELSE 'in_progress' END AS kind
  FROM candles
  UNION ALL SELECT symbol, 'trade', 'other' FROM trades),
read AS (
  SELECT kind, CASE WHEN kind <> 'rejected' THEN event_type END AS event_type,
         CASE WHEN kind <> 'rejected' THEN symbol END AS symbol FROM arrivals)"""

_CLOSED = "number_of_trades > 1 AND hour(\"timestamp\") <> 12"


def _without_close(instead: str) -> str:
    names = [c for c in CANDLE_COLUMNS if c not in ("exchange", "close")]
    close = f'round(CASE WHEN number_of_trades = 1 THEN {instead} ELSE "close" END, 6) AS "close"'
    return base() + f" SELECT {_cols(names)}, {close} FROM candles"


# Candles of one hour and of four, and their features by series.
_WIDE = CANDLES.replace("candles AS", "wide AS").replace(
    'date_trunc(\'hour\', "time") AS', 'date_trunc(\'day\', "time") + to_hours(CAST(hour("time") // 4 * 4 AS INTEGER)) AS'
).replace("'1h'", "'4h'")
_WIDTHS = base() + "," + _WIDE + """
, widths AS (SELECT * FROM candles UNION ALL SELECT * FROM wide)"""
_BY_INTERVAL = features("widths").replace("PARTITION BY symbol ", 'PARTITION BY symbol, "interval" ')

_EMA = """
walk AS (
  SELECT symbol, "timestamp", "close", row_number() OVER w AS n
  FROM candles WHERE "close" IS NOT NULL
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
line AS (
  SELECT symbol, "timestamp", n, "close" AS fast, "close" AS slow, CAST(0.0 AS DOUBLE) AS signal
  FROM walk WHERE n = 1
  UNION ALL
  SELECT w.symbol, w."timestamp", w.n,
         CAST(w."close" * 2 / 13.0 + l.fast * 11 / 13.0 AS DOUBLE),
         CAST(w."close" * 2 / 27.0 + l.slow * 25 / 27.0 AS DOUBLE),
         CAST(((w."close" * 2 / 13.0 + l.fast * 11 / 13.0)
               - (w."close" * 2 / 27.0 + l.slow * 25 / 27.0)) * 0.2 + l.signal * 0.8 AS DOUBLE)
  FROM line l JOIN walk w ON w.symbol = l.symbol AND w.n = l.n + 1)"""

_DAY = "WITH " + TRADES.format(symbol="event_type") + """
, day AS (
  SELECT symbol, arg_max(price, ("time", id)) AS price, arg_min(price, ("time", id)) AS o,
         max(price) AS high_24h, min(price) AS low_24h, sum(quantity) AS volume_24h,
         sum(price * quantity) AS quote_volume_24h, count(*) AS trade_count
  FROM trades WHERE "time" > (SELECT max("time") FROM trades) - INTERVAL 24 HOUR GROUP BY symbol)
SELECT symbol, round(price, 6) AS price, round(price - o, 6) AS price_change,
       round(CASE WHEN o <> 0 THEN (price - o) / o * 100 END, 6) AS price_change_percent,
       CASE WHEN price > o THEN 'up' WHEN price < o THEN 'down' ELSE 'flat' END AS direction,
       round(high_24h, 6) AS high_24h, round(low_24h, 6) AS low_24h,
       round(volume_24h, 6) AS volume_24h, round(quote_volume_24h, 6) AS quote_volume_24h,
       trade_count FROM day"""

_RETURNS = base() + """
, d AS (
  SELECT symbol, "timestamp", "close", "close" - lag("close") OVER w AS d,
         CASE WHEN lag("close") OVER w > 0 AND "close" > 0
              THEN ln("close" / lag("close") OVER w) END AS r
  FROM candles WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp"))"""

SQL: dict[str, str] = {
    # candles and ingest
    "candles_hourly": base() + f" SELECT {_cols(CANDLE_COLUMNS)} FROM candles",
    "candles_by_user": base("CAST(user_id AS VARCHAR)")
    + f" SELECT {_cols(CANDLE_COLUMNS)} FROM candles",
    "trades_normalized": "WITH " + TRADES.format(symbol="event_type")
    + ' SELECT id, symbol, "time", round(price, 6) AS price, '
    "round(quantity, 6) AS quantity, is_buyer_maker FROM trades",
    "subscription_streams": """
SELECT upper(event_type) AS symbol, stream, lower(event_type) || '@' || stream AS name
FROM (SELECT DISTINCT event_type FROM events), (VALUES ('kline_1m'), ('trade')) AS s(stream)""",
    "kline_roundtrip": base()
    + f" SELECT {_cols(CANDLE_COLUMNS)} FROM candles WHERE number_of_trades >= 2",
    "kline_history_roundtrip": base() + f" SELECT {_cols(CANDLE_COLUMNS)} FROM candles",
    "positional_klines": base() + f""" SELECT {_cols(CANDLE_COLUMNS)},
 "timestamp" + INTERVAL 3599 SECOND AS kline_close_time FROM candles""",
    "normalised_messages": _MESSAGES + """
SELECT kind AS event_type, symbol, 'events' AS exchange, count(*) AS messages,
       CAST(1704067200 AS DOUBLE) AS received_at
FROM messages GROUP BY kind, symbol""",
    "malformed_quarantine": base() + """
SELECT CASE WHEN number_of_trades = 1 THEN 'quarantined' ELSE 'parsed' END AS status,
       count(*) AS lines FROM candles GROUP BY 1""",
    "landed_lines": _LANDED + """
SELECT kind, event_type, symbol, count(*) AS records, count(event_type) AS messages,
       count(*) FILTER (event_type IS NULL) AS lines,
       CASE WHEN event_type IS NOT NULL THEN CAST(1704067200 AS DOUBLE) END AS received_at
FROM read GROUP BY kind, event_type, symbol""",
    "landed_candles": base()
    + f" SELECT {_cols([c for c in CANDLE_COLUMNS if c != 'exchange'])} FROM candles WHERE {_CLOSED}",
    "left_out_candles": base() + f"""
SELECT symbol, count(*) AS records FROM candles
WHERE {_CLOSED} AND "timestamp" >= TIMESTAMP '2024-01-15' GROUP BY symbol""",
    "kline_zero_defaults": _without_close("0.0"),
    "kline_null_defaults": _without_close("NULL"),
    "stream_counters": _MESSAGES + """
SELECT lower(symbol) || '@' || CASE WHEN kind = 'kline' THEN 'kline_1h' ELSE 'trade' END AS stream,
       count(*) AS messages, count(*) FILTER (kind = 'trade') AS trade_messages,
       count(*) FILTER (kind = 'kline') AS candle_messages,
       count(*) FILTER (kind = 'kline' AND NOT is_closed) AS in_progress_skipped,
       count(*) FILTER (kind = 'kline' AND is_closed) AS closed_sent
FROM messages GROUP BY 1""",
    "partition_columns": """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, count(*) AS records
FROM events GROUP BY 1, 2, 3, 4, 5""",
    "minute_batches": """
SELECT date_trunc('minute', ts) AS bucket, count(*) AS records,
       count(DISTINCT event_type) AS symbols FROM events GROUP BY 1""",
    "due_batches": """
SELECT date_trunc('minute', ts) AS bucket, count(*) AS records,
       count(DISTINCT event_type) AS symbols
FROM events GROUP BY 1
HAVING date_trunc('minute', (SELECT max(ts) FROM events)) - date_trunc('minute', ts)
       >= INTERVAL 90 SECOND""",
    "dedupe_latest": base() + f"""
, copies AS (
  SELECT *, CAST(number_of_trades AS DOUBLE) AS received_at FROM candles
  UNION ALL
  SELECT * REPLACE ("close" + 1 AS "close"), CAST(3.5 AS DOUBLE) FROM candles)
SELECT {_cols(CANDLE_COLUMNS)}, received_at FROM copies
QUALIFY row_number() OVER (PARTITION BY symbol, "interval", "timestamp"
                           ORDER BY received_at DESC) = 1""",
    "union_history_live": base() + """
SELECT symbol, count(*) AS records FROM (
  SELECT symbol FROM candles UNION ALL
  SELECT symbol FROM candles WHERE "timestamp" >= TIMESTAMP '2024-01-15') GROUP BY symbol""",
    # features
    "features_full": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "features_by_user": base("CAST(user_id AS VARCHAR)")
    + ","
    + features()
    + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "features_returns": _feature_group(["price_change", "price_change_pct", "log_return"]),
    "features_moving_avg": _feature_group(["ma_5", "ma_10", "ma_20"]),
    "features_volatility": _feature_group(["volatility_10"]),
    "features_volume": _feature_group(["volume_ma_5", "volume_change_pct"]),
    "features_momentum": _feature_group(["momentum_5", "momentum_10"]),
    "features_spread": _feature_group(["hl_spread", "hl_spread_pct"]),
    "serving_rows": _FEATURED + f"""
SELECT {_cols(FEATURE_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) AS back FROM f3)
WHERE back = 1 AND {_FIT}""",
    "training_rows": _TRAINING
    + f' SELECT {_cols(FEATURE_COLUMNS + ["next_timestamp", "next_close", "target_return"])} FROM training',
    "recent_50": base() + f"""
SELECT {_cols(CANDLE_COLUMNS)} FROM candles
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) <= 50""",
    "latest_candle": base() + f"""
SELECT {_cols(CANDLE_COLUMNS)} FROM candles
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) = 1""",
    "ordered_split_time": _split("series"),
    "ordered_split_table": _split("table"),
    "price_direction": _FEATURED + """
SELECT symbol, CASE WHEN price_change > 0 THEN 'up' WHEN price_change < 0 THEN 'down'
                    WHEN price_change = 0 THEN 'flat' END AS direction,
       count(*) AS records FROM f3 GROUP BY 1, 2""",
    # quality
    "quality_report": _DIRTY + _REPORT,
    "records_by_symbol": _DIRTY + " SELECT symbol, count(*) AS records FROM dirty GROUP BY symbol",
    "time_ranges": _DIRTY + """
SELECT symbol, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp
FROM dirty GROUP BY symbol""",
    "duplicate_keys": _DIRTY + """
SELECT symbol, "interval", "timestamp", count(*) AS copies FROM dirty GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "invalid_prices": _DIRTY + f"""
SELECT {_cols(CANDLE_COLUMNS)} FROM dirty
WHERE "open" <= 0 OR high <= 0 OR low <= 0 OR "close" <= 0""",
    "null_counts": _DIRTY
    + " SELECT "
    + ", ".join(f'count(*) - count("{c}") AS "{c}"' for c in CRITICAL_COLUMNS)
    + " FROM dirty",
    "distinct_symbols": _DIRTY + " SELECT DISTINCT symbol FROM dirty",
    # predictions and outcomes
    "predictions_latest": _FEATURED + "," + LATEST + """
SELECT symbol, "interval", "timestamp", round(current_price, 6) AS current_price,
       round(predicted_price, 6) AS predicted_price,
       round(predicted_return, 6) AS predicted_return, confidence FROM latest""",
    "prediction_outcomes": _OUTCOMES + f" SELECT {_OUTCOME_COLS} FROM outcomes",
    "asof_outcomes": _SCORED
    + ", made AS (SELECT * FROM scored WHERE momentum_5 > 0),"
    + ASOF.format(made="made")
    + """
SELECT symbol, "interval", "timestamp", round(predicted_return, 6) AS predicted_return,
       round(actual_return, 6) AS actual_return,
       predicted_return * actual_return > 0 AS direction_correct FROM seen""",
    "direction_accuracy": _OUTCOMES + "," + METRICS + """
SELECT round(mae, 6) AS mae, round(rmse, 6) AS rmse,
       round(accuracy_direction, 6) AS accuracy_direction, total_predictions FROM metrics""",
    "outcomes_by_interval": _WIDTHS + "," + _BY_INTERVAL + "," + SCORED
    + ", made AS (SELECT * FROM scored WHERE momentum_5 > 0),"
    + ASOF.format(made="made").replace("FROM candles c", "FROM widths c")
    + """
, done AS (SELECT *, predicted_return * actual_return > 0 AS hit FROM seen)
SELECT symbol, "interval", "timestamp", round(predicted_return, 6) AS predicted_return,
       round(actual_return, 6) AS actual_return, hit AS direction_correct,
       round(avg(CASE WHEN hit IS NULL THEN NULL WHEN hit THEN 1.0 ELSE 0.0 END) OVER w * 100, 6) AS accuracy,
       count(*) OVER w AS counted FROM done
WINDOW w AS (PARTITION BY symbol, "interval" ORDER BY "timestamp" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "indicators_by_interval": _WIDTHS + """
, d AS (
  SELECT symbol, "interval", "timestamp", "close", "close" - lag("close") OVER w AS d,
         CASE WHEN lag("close") OVER w > 0 AND "close" > 0
              THEN ln("close" / lag("close") OVER w) END AS r
  FROM widths WINDOW w AS (PARTITION BY symbol, "interval" ORDER BY "timestamp"))
SELECT symbol, "interval", "timestamp", round(CASE WHEN count(d) OVER w14 = 14 THEN
         CASE WHEN avg(greatest(-d, 0)) OVER w14 = 0 THEN 100.0
              ELSE 100 - 100 / (1 + avg(greatest(d, 0)) OVER w14 / avg(greatest(-d, 0)) OVER w14) END
       END, 6) AS rsi,
       round(CASE WHEN count("close") OVER w20 = 20
             THEN avg("close") OVER w20 + 2 * stddev_pop("close") OVER w20 END, 6) AS upper_band,
       round(CASE WHEN count(r) OVER w20 = 20
             THEN avg(r) OVER w20 / nullif(stddev_samp(r) OVER w20, 0) END, 6) AS sharpe
FROM d
WINDOW w14 AS (PARTITION BY symbol, "interval" ORDER BY "timestamp" ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
       w20 AS (PARTITION BY symbol, "interval" ORDER BY "timestamp" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "split_by_interval": _WIDTHS + """
, placed AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, "interval" ORDER BY "timestamp") - 1 AS pos,
         count(*) OVER (PARTITION BY symbol, "interval") AS n FROM widths)
SELECT symbol, "interval", CASE WHEN pos < n - ceil(CAST(0.2 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS part,
       count(*) AS records, min("timestamp") AS first_timestamp, CAST(0 AS BIGINT) AS copies
FROM placed GROUP BY 1, 2, 3""",
    "running_accuracy": _OUTCOMES + """
SELECT symbol, "timestamp",
       round(avg(CASE WHEN direction_correct IS NULL THEN NULL
                      WHEN direction_correct THEN 1.0 ELSE 0.0 END) OVER w * 100, 6) AS accuracy,
       count(*) OVER w AS counted FROM outcomes
WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""",
    "running_accuracy_overall": _OUTCOMES + """
SELECT symbol, "timestamp",
       round(avg(CASE WHEN direction_correct IS NULL THEN NULL
                      WHEN direction_correct THEN 1.0 ELSE 0.0 END) OVER w * 100, 6) AS accuracy,
       count(*) OVER w AS counted FROM outcomes
WINDOW w AS (ORDER BY "timestamp", symbol ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)""",
    "prediction_lookup": _OUTCOMES + "," + METRICS + "," + LATEST + """
, asked AS (
  SELECT DISTINCT upper(event_type) AS symbol FROM events
  UNION ALL SELECT DISTINCT upper(c_mktsegment) FROM customer)
SELECT a.symbol, CASE WHEN l.symbol IS NULL THEN 'waiting_for_data' END AS status,
       l."interval", l."timestamp", round(l.current_price, 6) AS current_price,
       round(l.predicted_price, 6) AS predicted_price,
       round(l.predicted_return, 6) AS predicted_return, l.confidence,
       CASE WHEN l.symbol IS NOT NULL THEN round(m.mae, 6) END AS mae,
       CASE WHEN l.symbol IS NOT NULL THEN round(m.rmse, 6) END AS rmse,
       CASE WHEN l.symbol IS NOT NULL THEN round(m.accuracy_direction, 6) END AS accuracy_direction,
       CASE WHEN l.symbol IS NOT NULL THEN m.total_predictions END AS total_predictions
FROM asked a LEFT JOIN latest l ON upper(l.symbol) = a.symbol CROSS JOIN metrics m""",
    "symbol_names": base("CAST(user_id AS VARCHAR)") + """
, newest AS (
  SELECT symbol, "timestamp", "close" FROM candles
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) = 1)
SELECT n.symbol, n."timestamp", round(n."close", 6) AS "close", c.c_name AS name,
       c.c_mktsegment AS icon
FROM newest n LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = n.symbol""",
    "naive_evaluation": _TRAINING + """
SELECT round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, count(e) AS test_rows
FROM (SELECT 0.1 * momentum_5 - target_return AS e FROM placed
      WHERE series_pos >= series_rows - ceil(CAST(0.2 AS DOUBLE) * series_rows))""",
    # market
    "buy_sell_ratio": "WITH " + TRADES.format(symbol="event_type") + """
SELECT symbol, count(*) FILTER (NOT is_buyer_maker) AS buys,
       count(*) FILTER (is_buyer_maker) AS sells,
       round(count(*) FILTER (NOT is_buyer_maker) * 100.0 / count(*), 6) AS buy_percent
FROM trades GROUP BY symbol""",
    "stats_24h": _DAY,
    "stats_24h_panes": _DAY,
    "recent_trades": "WITH " + TRADES.format(symbol="event_type") + """
SELECT id, symbol, "time", round(price, 6) AS price, round(quantity, 6) AS quantity,
       is_buyer_maker, CASE WHEN is_buyer_maker THEN 'SELL' ELSE 'BUY' END AS side
FROM trades ORDER BY "time" DESC, id DESC LIMIT 20""",
    "recent_trades_by_symbol": "WITH " + TRADES.format(symbol="event_type") + """
SELECT id, symbol, "time", round(price, 6) AS price, round(quantity, 6) AS quantity, is_buyer_maker
FROM trades
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "time" DESC, id DESC) <= 20""",
    "chart_series": base() + """
SELECT symbol, CAST(epoch("timestamp") AS BIGINT) AS "time", round("open", 6) AS "open",
       round(high, 6) AS high, round(low, 6) AS low, round("close", 6) AS "close" FROM candles""",
    # sinks and jobs
    "csv_by_symbol": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "csv_of_one_symbol": _FEATURED
    + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3 WHERE symbol = (SELECT min(symbol) FROM trades)",
    "collected_once": base() + " SELECT symbol, count(*) AS records FROM candles GROUP BY symbol",
    "late_candles_merged": base() + """
, corrected AS (
  SELECT * REPLACE (CASE WHEN number_of_trades >= 6 THEN "close" + 1 ELSE "close" END AS "close")
  FROM candles),""" + features("corrected") + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "stream_written": _SCORED + "," + ASOF.format(made="scored") + """
SELECT 'raw' AS "table", count(*) AS records FROM candles
UNION ALL SELECT 'clean', count(*) FROM f3
UNION ALL SELECT 'predictions', count(*) FROM scored
UNION ALL SELECT 'outcomes', count(*) FROM seen""",
    "stream_by_the_clock": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "parquet_by_time": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "csv_in_time_order": base()
    + " SELECT symbol, count(*) AS records, CAST(0 AS BIGINT) AS out_of_order FROM candles GROUP BY symbol",
    "rows_to_candles": base() + f"""
SELECT {_cols(CANDLE_COLUMNS)} FROM candles WHERE symbol = (SELECT min(symbol) FROM candles)
QUALIFY row_number() OVER (ORDER BY "timestamp" DESC) <= 50""",
    "forest_learns": _TRAINING + """
SELECT true AS beats_the_mean, count(*) AS test_rows
FROM placed WHERE series_pos >= series_rows - ceil(CAST(0.2 AS DOUBLE) * series_rows)""",
    "stream_replayed": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "stream_compacted": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "stream_after_history": _FEATURED
    + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3 WHERE \"timestamp\" >= TIMESTAMP '2024-01-15'",
    "lines_appended": base() + " SELECT symbol, 2 * count(*) AS records FROM candles GROUP BY symbol",
    "batch_job_report": _DIRTY + _REPORT,
    "stream_features": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "stream_features_restarted": _FEATURED + f" SELECT {_cols(FEATURE_COLUMNS)} FROM f3",
    "stream_outcomes": _SCORED
    + ","
    + ASOF.format(made="scored")
    + """
SELECT symbol, "interval", "timestamp", round(predicted_return, 6) AS predicted_return,
       round(actual_return, 6) AS actual_return,
       predicted_return * actual_return > 0 AS direction_correct FROM seen""",
    # indicators
    "indicator_rsi": _RETURNS + """
SELECT symbol, "timestamp", round(CASE WHEN count(d) OVER w = 14 THEN
         CASE WHEN avg(greatest(-d, 0)) OVER w = 0 THEN 100.0
              ELSE 100 - 100 / (1 + avg(greatest(d, 0)) OVER w / avg(greatest(-d, 0)) OVER w) END
       END, 6) AS rsi
FROM (SELECT symbol, "timestamp", d FROM d)
WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
    "indicator_bollinger": base() + """
SELECT symbol, "timestamp",
       round(CASE WHEN count("close") OVER w = 20 THEN avg("close") OVER w END, 6) AS middle_band,
       round(CASE WHEN count("close") OVER w = 20
             THEN avg("close") OVER w + 2 * stddev_pop("close") OVER w END, 6) AS upper_band,
       round(CASE WHEN count("close") OVER w = 20
             THEN avg("close") OVER w - 2 * stddev_pop("close") OVER w END, 6) AS lower_band
FROM candles
WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "indicator_anomalies": _RETURNS + """
, z AS (
  SELECT symbol, "timestamp", CASE WHEN count(r) OVER w = 20 THEN
           (r - avg(r) OVER w) / nullif(stddev_samp(r) OVER w, 0) END AS zscore
  FROM d
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
SELECT symbol, "timestamp", round(zscore, 6) AS zscore,
       coalesce(abs(zscore) > 3, false) AS is_anomaly FROM z""",
    "indicator_sharpe": _RETURNS + """
SELECT symbol, "timestamp", round(CASE WHEN count(r) OVER w = 20 THEN
         avg(r) OVER w / nullif(stddev_samp(r) OVER w, 0) END, 6) AS sharpe
FROM d
WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "indicator_sliding": "WITH " + TRADES.format(symbol="event_type") + """
, spread AS (
  SELECT symbol, price, quantity,
         date_trunc('hour', "time") - to_hours(CAST(back AS INTEGER)) AS window_start
  FROM trades, range(5) AS r(back))
SELECT symbol, window_start, window_start + INTERVAL 5 HOUR AS window_end,
       count(*) AS trade_count, round(avg(price), 6) AS avg_price,
       round(sum(quantity), 6) AS volume
FROM spread GROUP BY 1, 2""",
    "indicator_macd": base().replace("WITH ", "WITH RECURSIVE ", 1) + "," + _EMA + """
SELECT symbol, "timestamp", round(fast - slow, 6) AS macd, round(signal, 6) AS macd_signal,
       round(fast - slow - signal, 6) AS macd_histogram FROM line""",
}

