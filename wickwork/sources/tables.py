"""Trades and candles from a table of timed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.operators.candles import build_candles


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def as_trades(rows: DataFrame, symbol: str = "event_type") -> DataFrame:
    """Event rows, static or streamed, as trades.

    The quantity is read from the JSON properties, in a step of its own so that
    it is parsed once per row.
    """
    amount = F.get_json_object("props", "$.k").try_cast("double")
    return rows.withColumn("quantity", amount).select(
        F.col("event_id").alias("id"),
        F.col(symbol).cast("string").alias("symbol"),
        F.col("ts").alias("time"),
        F.col("value").alias("price"),
        "quantity",
        (F.col("quantity") % 2 == 1).alias("is_buyer_maker"),
    )


def trades(spark: SparkSession, folder: str, symbol: str = "event_type") -> DataFrame:
    return as_trades(events(spark, folder), symbol)


def hourly_candles(spark: SparkSession, folder: str, symbol: str = "event_type") -> DataFrame:
    return build_candles(
        trades(spark, folder, symbol), "1 hour", interval="1h", exchange="events"
    )
