"""Small candle tables for tests."""

import math
from datetime import datetime, timedelta, timezone

from wickwork.schemas import CANDLE_SCHEMA

START = datetime(2024, 1, 1, tzinfo=timezone.utc)

GOLDEN = {
    "event_type": "kline",
    "symbol": "ONETWO",
    "exchange": "binance",
    "data": {
        "e": "kline",
        "E": 1711929600000,
        "s": "ONETWO",
        "k": {
            "t": 1711929600000,
            "T": 1711929659999,
            "s": "ONETWO",
            "i": "1m",
            "o": "310.25",
            "c": "312.50",
            "h": "314.00",
            "l": "308.00",
            "v": "64.25",
            "n": 37,
            "q": "20010.5",
            "V": "31.5",
            "Q": "9800.75",
            "x": True,
        },
    },
    "received_at": 1711929661.5,
    "client_timestamp": "2024-04-01T00:01:01.500Z",
}


def candle(symbol="A", minute=0, close=10.0, **over):
    row = {
        "timestamp": None if minute is None else START + timedelta(minutes=minute),
        "symbol": symbol,
        "interval": "1m",
        "exchange": "test",
        "open": close,
        "high": None if close is None else close + 1,
        "low": None if close is None else close - 1,
        "close": close,
        "volume": 5.0,
        "number_of_trades": 3,
        "quote_volume": 50.0,
        "taker_buy_volume": 2.0,
        "taker_buy_quote_volume": 20.0,
    }
    row.update(over)
    return row


def table(spark, rows):
    names = CANDLE_SCHEMA.names
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CANDLE_SCHEMA)


def wave(symbol, minutes, base=100.0):
    return [
        candle(
            symbol,
            m,
            base + 10 * math.sin(m / 3) + (m % 7),
            volume=float(m % 5),
        )
        for m in minutes
    ]


def bag(df):
    """Rows as a sorted list, floats at nine digits."""

    def plain(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        return str(v)

    names = sorted(df.columns)
    return sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
