"""The feature code: one implementation for batch, serving and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.functions.columns import log_return, pct_change, spread
from wickwork.operators import series
from wickwork.schemas import (
    DERIVED_COLUMNS,
    FEATURE_COLUMNS,
    MODEL_INPUTS,
    MODEL_LABEL,
    RECENT_ROWS,
    WARMUP_ROWS,
)

BY = series.SERIES_KEYS
ORDER = ["timestamp"]
LOOKBACK = WARMUP_ROWS - 1


def derived_columns(w) -> dict[str, Column]:
    """Features that read the candle columns, over a row-ordered window ``w``."""
    close, volume, high, low = (F.col(c) for c in ("close", "volume", "high", "low"))

    def trailing(column: Column, rows: int) -> Column:
        return F.avg(column).over(w.rowsBetween(1 - rows, 0))

    def ago(column: Column, rows: int) -> Column:
        return F.lag(column, rows).over(w)

    return {
        "price_change": close - ago(close, 1),
        "price_change_pct": pct_change(close, ago(close, 1)),
        "log_return": log_return(close, ago(close, 1)),
        "ma_5": trailing(close, 5),
        "ma_10": trailing(close, 10),
        "ma_20": trailing(close, 20),
        "volume_ma_5": trailing(volume, 5),
        "volume_change_pct": pct_change(volume, ago(volume, 1)),
        "momentum_5": pct_change(close, ago(close, 5)),
        "momentum_10": pct_change(close, ago(close, 10)),
        "hl_spread": spread(high, low),
        "hl_spread_pct": pct_change(high, low),
    }


def next_return(w) -> dict[str, Column]:
    """The label: percent change from this close to the next one."""
    following = F.lead("close", 1).over(w)
    return {
        "next_timestamp": F.lead("timestamp", 1).over(w),
        "next_close": following,
        MODEL_LABEL: pct_change(following, F.col("close")),
    }


def _over(rows: DataFrame, w, label: bool, warm: bool) -> DataFrame:
    """Two window levels (volatility reads log_return), one sort and shuffle."""
    first = derived_columns(w)
    if label:
        first |= next_return(w)
    if warm:
        first["is_warm"] = F.lag(F.lit(True), LOOKBACK).over(w).isNotNull()
    level1 = rows.select("*", *[c.alias(n) for n, c in first.items()])
    volatility = F.stddev_samp("log_return").over(w.rowsBetween(-9, 0))
    return level1.withColumn("volatility_10", volatility)


def engineer_features(
    candles: DataFrame,
    chunk: str | None = series.DEFAULT_CHUNK,
    label: bool = False,
    warm: bool = False,
    stored: bool = False,
    keep: tuple[str, ...] = (),
    long_rows: int | None = None,
) -> DataFrame:
    """The 26 feature columns, optionally with the label and a warm-up flag.

    ``chunk`` is the calendar unit a series is cut into; choose it so that one
    unit of one symbol fits a task. ``None`` uses one window per symbol, which
    is right only for small batches. Set ``stored`` when ``candles`` is a plain
    table scan: the edge rows are then read as four columns instead of sharing
    the shuffle that built the candles. ``keep`` names further input columns
    to carry through. ``long_rows`` leaves shorter series uncut; set it where
    many symbols have few candles per chunk.
    """
    extra = (["next_timestamp", "next_close", MODEL_LABEL] if label else []) + (["is_warm"] if warm else [])
    if chunk is None:
        done = _over(candles, series.series_window(BY, ORDER), label, warm)
    else:
        haloed = series.with_halo(
            candles,
            BY,
            ORDER,
            chunk,
            before=LOOKBACK,
            after=1 if label else 0,
            needed=["close", "volume"] if stored else None,
            long_rows=long_rows,
        )
        done = series.own_rows(_over(haloed, series.chunk_window(BY, ORDER), label, warm))
    return done.select(*FEATURE_COLUMNS, *extra, *keep)


def base_columns(features: DataFrame) -> DataFrame:
    """Drop everything that is not one of the 26 columns, in order."""
    return features.select(*FEATURE_COLUMNS)


def recent_candles(candles: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    return series.recent_rows(candles, BY, ORDER, n)


def serving_features(candles: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    """The newest row per symbol, if it is fit to score.

    Needs 20 candles and no NULL among the model inputs. Only the last ``n``
    candles per symbol take part, as they are all the features look at.
    """
    recent = recent_candles(candles, n)
    features = engineer_features(recent, chunk=None, warm=True)
    newest = series.latest_row(features, BY, ORDER)
    return newest.where("is_warm").dropna(subset=MODEL_INPUTS).drop("is_warm")


def training_set(candles: DataFrame, chunk: str | None = series.DEFAULT_CHUNK) -> DataFrame:
    """Feature rows with a label; rows lacking either are dropped."""
    features = engineer_features(candles, chunk, label=True)
    return features.dropna(subset=[MODEL_LABEL]).dropna(subset=MODEL_INPUTS)


def labelled(features: DataFrame, chunk: str | None = series.DEFAULT_CHUNK) -> DataFrame:
    """Adds the label to a table that already holds features."""
    if chunk is None:
        done = features.select(
            "*", *[c.alias(n) for n, c in next_return(series.series_window(BY, ORDER)).items()]
        )
    else:
        haloed = series.with_halo(features, BY, ORDER, chunk, after=1, needed=["close"])
        w = series.chunk_window(BY, ORDER)
        done = series.own_rows(
            haloed.select("*", *[c.alias(n) for n, c in next_return(w).items()])
        )
    return done.dropna(subset=[MODEL_LABEL]).dropna(subset=MODEL_INPUTS)


__all__ = [
    "DERIVED_COLUMNS",
    "base_columns",
    "engineer_features",
    "labelled",
    "recent_candles",
    "serving_features",
    "training_set",
]
