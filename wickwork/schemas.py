"""Fixed table schemas and the fixed values every part of the package shares."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
DEFAULT_SYMBOL = "UNKNOWN"
DEFAULT_INTERVAL = "1m"
DEFAULT_EXCHANGE = "binance"
KLINE = "kline"

WARMUP_ROWS = 20
RECENT_ROWS = 50
OUTCOME_HISTORY = 1000
CONFIDENCE_THRESHOLD = 0.05
HIGH = "High"
LOW = "Low"
WAITING = "waiting_for_data"

# Positions inside an exchange history array.
POSITIONAL_FIELDS = [
    "open_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_volume",
    "number_of_trades",
    "taker_buy_volume",
    "taker_buy_quote_volume",
    "ignore",
]

# Kline key -> (column, type) inside a message.
KLINE_FIELDS = {
    "t": ("open_ms", "bigint"),
    "T": ("close_ms", "bigint"),
    "s": ("kline_symbol", "string"),
    "i": ("interval", "string"),
    "o": ("open", "double"),
    "h": ("high", "double"),
    "l": ("low", "double"),
    "c": ("close", "double"),
    "v": ("volume", "double"),
    "n": ("number_of_trades", "bigint"),
    "q": ("quote_volume", "double"),
    "V": ("taker_buy_volume", "double"),
    "Q": ("taker_buy_quote_volume", "double"),
    "x": ("is_closed", "boolean"),
}

CANDLE_COLUMNS = [
    "timestamp",
    "symbol",
    "interval",
    "exchange",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "number_of_trades",
    "quote_volume",
    "taker_buy_volume",
    "taker_buy_quote_volume",
]

DERIVED_COLUMNS = [
    "price_change",
    "price_change_pct",
    "log_return",
    "ma_5",
    "ma_10",
    "ma_20",
    "volatility_10",
    "volume_ma_5",
    "volume_change_pct",
    "momentum_5",
    "momentum_10",
    "hl_spread",
    "hl_spread_pct",
]

FEATURE_COLUMNS = CANDLE_COLUMNS + DERIVED_COLUMNS

MODEL_INPUTS = [
    "price_change_pct",
    "log_return",
    "volatility_10",
    "volume_change_pct",
    "momentum_5",
    "momentum_10",
    "hl_spread_pct",
]
MODEL_LABEL = "target_return"

CRITICAL_COLUMNS = ["timestamp", "symbol", "open", "high", "low", "close", "volume"]
PRICE_COLUMNS = ["open", "high", "low", "close"]

TIME_LEVELS = {
    "year": "yyyy",
    "month": "MM",
    "day": "dd",
    "hour": "HH",
    "minute": "mm",
}
# ------------------------------------------------------------ end fixed values

_TYPES = {
    "timestamp": T.TimestampType(),
    "symbol": T.StringType(),
    "interval": T.StringType(),
    "exchange": T.StringType(),
    "number_of_trades": T.LongType(),
}


def _struct(names):
    return T.StructType(
        [T.StructField(n, _TYPES.get(n, T.DoubleType()), True) for n in names]
    )


CANDLE_SCHEMA = _struct(CANDLE_COLUMNS)
FEATURE_SCHEMA = _struct(FEATURE_COLUMNS)

# A normalised message. The payload stays JSON text: its keys differ only in
# case (t/T, v/V, q/Q, e/E), which a struct cannot hold safely.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("received_at", T.DoubleType()),
        T.StructField("client_timestamp", T.StringType()),
    ]
)

# What one pass over a raw line pulls out, for both enveloped and bare shapes.
LINE_SCHEMA = (
    "event_type string, symbol string, exchange string, stream string, "
    "e string, s string, k map<string,string>, "
    "data struct<e:string, s:string, symbol:string, k:map<string,string>>, "
    "received_at string, client_timestamp string"
)

# A message as it arrived: what it is, the message itself, when it came, and the
# whole line if it could not be read.
LANDED_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        *MESSAGE_SCHEMA.fields,
        T.StructField("arrival", T.TimestampType()),
        T.StructField("line", T.StringType()),
    ]
)

TRADE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("predicted_price", T.DoubleType()),
        T.StructField("predicted_return", T.DoubleType()),
        T.StructField("confidence", T.StringType()),
    ]
)
