"""Trade and stream summaries a market screen shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.functions.columns import direction, pct_change, sequence_key
from wickwork.operators import series
from wickwork.schemas import KLINE


def recent_trades(trades: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` trades of all symbols, newest first."""
    side = F.when(F.col("is_buyer_maker"), F.lit("SELL")).otherwise(F.lit("BUY"))
    return trades.orderBy(F.desc("time"), F.desc("id")).limit(n).withColumn("side", side)


def recent_trades_by_symbol(trades: DataFrame, n: int = 20) -> DataFrame:
    return series.recent_rows(trades, ["symbol"], ["time", "id"], n)


def buy_sell(trades: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Buy and sell counts and the buy share; 50 where there is no trade."""
    buys = F.count_if(~F.col("is_buyer_maker"))
    sells = F.count_if(F.col("is_buyer_maker"))
    grouped = trades.groupBy(*(by or [])).agg(buys.alias("buys"), sells.alias("sells"))
    total = F.col("buys") + F.col("sells")
    share = F.when(total > 0, F.col("buys") / total * 100).otherwise(F.lit(50.0))
    return grouped.withColumn("buy_percent", share)


def day_stats(trades: DataFrame, span: str = "24 hours") -> DataFrame:
    """Per symbol over the span ending at the last trade of the table.

    The end is a scalar subquery: one aggregate over one column, whose value is
    then a filter on the scan.
    """
    clock = trades.agg(F.max("time").alias("clock")).scalar()
    inside = trades.where(F.col("time") > clock - F.expr(f"INTERVAL {span}"))
    return _day_columns(_merged(trade_panes(inside, None)))


def trade_panes(trades: DataFrame, width: str | None = "1 hour") -> DataFrame:
    """Partial results of each symbol and window, which any longer span combines: first
    and last price with the place of their trade, bounds, sums and the last time. With
    no ``width`` a symbol is one pane. Batch or stream.
    """
    order = sequence_key(F.col("time"), F.col("id"))
    by = ["symbol"] if width is None else ["symbol", F.window("time", width).alias("w")]
    panes = trades.groupBy(*by).agg(
        F.min(order).alias("first_at"),
        F.min_by("price", order).alias("first"),
        F.max(order).alias("last_at"),
        F.max_by("price", order).alias("last"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("quantity").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("quote_volume"),
        F.count(F.lit(1)).alias("trades"),
        F.max("time").alias("last_time"),
    )
    if width is None:
        return panes
    return panes.select("symbol", F.col("w.start").alias("pane"), F.col("w.end").alias("pane_end"), *PANE)


PANE = ["first_at", "first", "last_at", "last", "high", "low", "volume", "quote_volume", "trades", "last_time"]


def _merged(panes: DataFrame) -> DataFrame:
    """Panes of a symbol as one row."""
    return panes.groupBy("symbol").agg(
        F.max_by("last", "last_at").alias("price"),
        F.min_by("first", "first_at").alias("open_price"),
        F.max("high").alias("high_24h"),
        F.min("low").alias("low_24h"),
        F.sum("volume").alias("volume_24h"),
        F.sum("quote_volume").alias("quote_volume_24h"),
        F.sum("trades").alias("trade_count"),
    )


def day_stats_from_panes(panes: DataFrame, trades: DataFrame | None = None, span: str = "24 hours") -> DataFrame:
    """``day_stats`` from stored ``trade_panes``.

    Panes that lie inside the span are combined. The one it begins in is computed from
    ``trades``, of which no more than that pane is read; without ``trades`` the span
    begins with the first whole pane.
    """
    ends = panes.agg(F.max("last_time").alias("clock"))
    start = ends.select((F.col("clock") - F.expr(f"INTERVAL {span}")).alias("start"))
    whole = panes.where(F.col("pane") > start.scalar()).select("symbol", *PANE)
    if trades is not None:
        split = panes.where((F.col("pane") <= start.scalar()) & (F.col("pane_end") > start.scalar()))
        until = split.agg(F.max("pane_end").alias("until")).scalar()
        edge = trades.where((F.col("time") > start.scalar()) & (F.col("time") < until))
        whole = whole.unionByName(trade_panes(edge, None))
    return _day_columns(_merged(whole))


def _day_columns(grouped: DataFrame) -> DataFrame:
    change = F.col("price") - F.col("open_price")
    return grouped.select(
        "symbol",
        "price",
        change.alias("price_change"),
        pct_change(F.col("price"), F.col("open_price")).alias("price_change_percent"),
        direction(change).alias("direction"),
        "high_24h",
        "low_24h",
        "volume_24h",
        "quote_volume_24h",
        "trade_count",
    )


def stream_counters(fields: DataFrame) -> DataFrame:
    """Per stream: all messages, trades, candles, open ones skipped, closed ones kept.

    ``fields`` has ``stream``, ``kind`` and ``is_closed``.
    """
    is_kline = F.col("kind") == KLINE
    closed = F.coalesce("is_closed", F.lit(False))
    return fields.groupBy("stream").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("kind") == "trade").alias("trade_messages"),
        F.count_if(is_kline).alias("candle_messages"),
        F.count_if(is_kline & ~closed).alias("in_progress_skipped"),
        F.count_if(is_kline & closed).alias("closed_sent"),
    )


def chart_series(candles: DataFrame, ordered: bool = True) -> DataFrame:
    """Candles for a chart: epoch seconds and prices, ascending."""
    seconds = F.unix_seconds(F.col("timestamp").cast("timestamp"))
    points = candles.select(
        "symbol", seconds.alias("time"), "open", "high", "low", "close"
    )
    return points.orderBy("symbol", "time") if ordered else points


def with_names(rows: DataFrame, names: DataFrame, key: str = "symbol") -> DataFrame:
    """Adds symbol metadata; symbols without any keep NULLs."""
    return rows.join(names, key, "left")
