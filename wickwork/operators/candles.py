"""Candles from trades, and de-duplication of candles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.functions.columns import sequence_key
from wickwork.schemas import CANDLE_COLUMNS


def build_candles(
    trades: DataFrame, width: str = "1 minute", interval: str = "1m", exchange: str = "trades"
) -> DataFrame:
    """One candle per symbol and tumbling window; batch or stream.

    Every aggregate combines on the map side, so a symbol holding a third of
    all trades ships one row per window and task, not its trades.
    """
    order = sequence_key(F.col("time"), F.col("id"))
    value = F.col("price") * F.col("quantity")
    buy = ~F.col("is_buyer_maker")
    grouped = trades.groupBy("symbol", F.window("time", width).alias("w")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"),
        F.count(F.lit(1)).alias("number_of_trades"),
        F.round(F.sum(value), 6).alias("quote_volume"),
        F.coalesce(F.sum(F.when(buy, F.col("quantity"))), F.lit(0.0)).alias("taker_buy_volume"),
        F.coalesce(F.round(F.sum(F.when(buy, value)), 6), F.lit(0.0)).alias(
            "taker_buy_quote_volume"
        ),
    )
    return grouped.select(
        F.col("w.start").alias("timestamp"),
        "symbol",
        F.lit(interval).alias("interval"),
        F.lit(exchange).alias("exchange"),
        *[c for c in CANDLE_COLUMNS if c not in ("timestamp", "symbol", "interval", "exchange")],
    )


def latest_of(rows: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """One row per key: the one that arrived last; NULL arrival counts as 0.

    A map-side combined aggregate, so any number of copies of one key shrinks
    to one row per task before the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    # The payload follows the arrival in the sort key: equal arrivals then
    # resolve the same way on every run.
    rank = F.struct(F.coalesce(F.col(arrival), F.lit(0.0)).alias("at"), *rest)
    picked = rows.groupBy(*keys).agg(F.max(rank).alias("pick"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"pick.{c}") for c in rows.columns])


def dedupe_candles(candles: DataFrame, arrival: str = "received_at") -> DataFrame:
    """Keep the latest arrival of each ``(symbol, interval, timestamp)``."""
    return latest_of(candles, ["symbol", "interval", "timestamp"], arrival)
