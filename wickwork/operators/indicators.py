"""Textbook indicators over row windows, cut into chunks like the features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickwork.functions.columns import log_return
from wickwork.operators import series
from wickwork.session import materialise

BY = series.SERIES_KEYS
ORDER = ["timestamp"]


def _windowed(candles: DataFrame, lookback: int, chunk: str, levels) -> DataFrame:
    rows = series.with_halo(candles, BY, ORDER, chunk, before=lookback)
    w = series.chunk_window(BY, ORDER)
    for level in levels:
        rows = rows.select("*", *[c.alias(n) for n, c in level(w).items()])
    return series.own_rows(rows)


def rsi(candles: DataFrame, n: int = 14, chunk: str = series.DEFAULT_CHUNK) -> DataFrame:
    """Relative strength from plain averages of the last ``n`` changes.

    NULL until ``n`` changes exist; 100 when nothing fell.
    """

    def change(w) -> dict[str, Column]:
        return {"_d": F.col("close") - F.lag("close", 1).over(w)}

    def strength(w) -> dict[str, Column]:
        span = w.rowsBetween(1 - n, 0)
        up = F.avg(F.greatest(F.col("_d"), F.lit(0.0))).over(span)
        down = F.avg(F.greatest(-F.col("_d"), F.lit(0.0))).over(span)
        value = F.when(down == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide(up, down)))
        return {"rsi": F.when(F.count("_d").over(span) == n, value)}

    return _windowed(candles, n, chunk, [change, strength]).drop("_d")


def bollinger(
    candles: DataFrame, n: int = 20, width: float = 2.0, chunk: str = series.DEFAULT_CHUNK
) -> DataFrame:
    """Moving average and population-deviation bands over ``n`` rows."""

    def bands(w) -> dict[str, Column]:
        span = w.rowsBetween(1 - n, 0)
        middle = F.avg("close").over(span)
        reach = F.lit(width) * F.stddev_pop("close").over(span)
        full = F.count("close").over(span) == n
        return {
            "middle_band": F.when(full, middle),
            "upper_band": F.when(full, middle + reach),
            "lower_band": F.when(full, middle - reach),
        }

    return _windowed(candles, n - 1, chunk, [bands])


def _returns(w) -> dict[str, Column]:
    return {"log_return": log_return(F.col("close"), F.lag("close", 1).over(w))}


def anomalies(
    candles: DataFrame, n: int = 20, threshold: float = 3.0, chunk: str = series.DEFAULT_CHUNK
) -> DataFrame:
    """Rows whose return is far from the ``n`` returns before it, by z-score."""

    def score(w) -> dict[str, Column]:
        span = w.rowsBetween(-n, -1)
        sd = F.stddev_samp("log_return").over(span)
        z = (F.col("log_return") - F.avg("log_return").over(span)) / F.nullif(sd, F.lit(0.0))
        return {"zscore": F.when(F.count("log_return").over(span) == n, z)}

    scored = _windowed(candles, n + 1, chunk, [_returns, score])
    return scored.withColumn(
        "is_anomaly", F.coalesce(F.abs("zscore") > threshold, F.lit(False))
    )


def sharpe(candles: DataFrame, n: int = 20, chunk: str = series.DEFAULT_CHUNK) -> DataFrame:
    """Mean over deviation of the last ``n`` returns; NULL until they exist."""

    def ratio(w) -> dict[str, Column]:
        span = w.rowsBetween(1 - n, 0)
        sd = F.nullif(F.stddev_samp("log_return").over(span), F.lit(0.0))
        value = F.avg("log_return").over(span) / sd
        return {"sharpe": F.when(F.count("log_return").over(span) == n, value)}

    return _windowed(candles, n, chunk, [_returns, ratio])


def sliding_stats(trades: DataFrame, width: str = "5 minutes", step: str = "1 minute") -> DataFrame:
    """Overlapping time windows per symbol; batch or stream."""
    grouped = trades.groupBy("symbol", F.window("time", width, step).alias("w")).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.avg("price").alias("avg_price"),
        F.sum("quantity").alias("volume"),
    )
    return grouped.select(
        "symbol",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "trade_count",
        "avg_price",
        "volume",
    )


def ema(
    rows: DataFrame, averages: dict[str, tuple[str, int]], chunk: str = series.DEFAULT_CHUNK
) -> DataFrame:
    """Exponential averages ``{output: (column, span)}``, started at the first row.

    The recursion ``y = a x + (1 - a) y_prev`` is a weighted running sum. A
    series is cut into blocks so long that the weight of everything before the
    previous block is below double precision (under e**-40); a block then needs
    only one number from the block before it. Rows are never gathered per
    symbol. The averaged columns must not be NULL.
    """
    if len({span for _, span in averages.values()}) > 1:
        # Blocks sized for a long span are too long for the powers of a short one.
        for out, one in averages.items():
            rows = ema(rows, {out: one}, chunk)
        return rows
    longest = max(span for _, span in averages.values())
    size = math.ceil(40 / -math.log(1 - 2 / (longest + 1)))
    placed = (
        series.series_index(rows, BY, ORDER, chunk)
        .withColumn("_b", F.floor(F.col("series_pos") / size))
        .withColumn("_i", F.col("series_pos") % size)
    )
    first = F.col("series_pos") == 0
    decay = {out: 1 - 2 / (span + 1) for out, (_, span) in averages.items()}

    def term(out: str) -> Column:
        q = decay[out]
        weight = F.when(first, F.lit(1.0)).otherwise(F.lit(1 - q))
        return weight * F.col(averages[out][0]) * F.pow(F.lit(q), -F.col("_i"))

    terms = placed.select("*", *[term(o).alias(f"_t_{o}") for o in averages])
    ends = terms.groupBy(*BY, "_b").agg(
        F.max("_i").alias("_last"), *[F.sum(f"_t_{o}").alias(f"_t_{o}") for o in averages]
    )
    carried = ends.select(
        *BY,
        (F.col("_b") + 1).alias("_b"),
        F.lit(-1).cast("bigint").alias("_i"),
        *[(F.col(f"_t_{o}") * F.pow(F.lit(decay[o]), "_last")).alias(f"_c_{o}") for o in averages],
    )
    both = terms.unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy(*BY, "_b").orderBy("_i")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)

    def value(out: str) -> Column:
        q = F.lit(decay[out])
        local = F.sum(f"_t_{out}").over(so_far) * F.pow(q, "_i")
        inherited = F.coalesce(F.first(f"_c_{out}").over(so_far), F.lit(0.0))
        return local + inherited * F.pow(q, F.col("_i") + 1)

    done = both.select(*rows.columns, "_i", *[value(o).alias(o) for o in averages])
    return done.where(F.col("_i") >= 0).drop("_i")


def macd(
    candles: DataFrame,
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    chunk: str = series.DEFAULT_CHUNK,
) -> DataFrame:
    """Difference of two exponential averages of the close, and its signal line.

    Numbering the rows reads them more than once, so both passes start from a
    written table. Rows without a close are returned without averages.
    """
    every = materialise(candles.select(*BY, *ORDER, "close"), "prices")
    lines = ema(every.where(F.col("close").isNotNull()), {"_fast": ("close", fast)}, chunk)
    lines = ema(materialise(lines, "macd-fast"), {"_slow": ("close", slow)}, chunk)
    lines = lines.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    done = ema(materialise(lines, "macd"), {"macd_signal": ("macd", signal)}, chunk)
    done = done.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    return done.unionByName(every.where(F.col("close").isNull()), allowMissingColumns=True)
