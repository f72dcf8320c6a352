"""Writers for Parquet by time, CSV by symbol and appended JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.functions.columns import time_parts
from wickwork.operators.quality import records_by_symbol
from wickwork.schemas import FEATURE_COLUMNS, TIME_LEVELS
from wickwork.sources.messages import closed_messages, klines, message_lines, split_malformed

ALL_LEVELS = tuple(TIME_LEVELS)
ROWS_PER_FILE = 5_000_000
# The folder level of the CSV files by symbol.
SERIES = "series"


def write_by_time(
    rows: DataFrame,
    path: str,
    time: str = "timestamp",
    levels: tuple[str, ...] = ALL_LEVELS,
    replace: str = "table",
    first: tuple[str, ...] = (),
) -> None:
    """Snappy Parquet in ``year=/month=/day=/hour=/minute=`` folders.

    Rows are gathered per folder by a rebalance, not a range partitioning: it
    needs no sampling pass over the plan above, Spark splits a folder that is
    too large for one task and merges small ones. Minute folders suit a stream; for long history stop at ``day`` or ``hour``.

    ``replace="table"`` overwrites ``path``; ``replace="folders"`` overwrites
    only the time folders that ``rows`` has rows for; ``replace="nothing"``
    appends. Columns in ``first`` name folders above those of the time.
    """
    mode, scope = {
        "table": ("overwrite", "static"),
        "folders": ("overwrite", "dynamic"),
        "nothing": ("append", "static"),
    }[replace]
    parted = rows.select("*", *time_parts(F.col(time), levels))
    (
        parted.hint("rebalance", *[F.col(c) for c in (*first, *levels)])
        .write.mode(mode)
        .option("partitionOverwriteMode", scope)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*first, *levels)
        .parquet(path)
    )


def write_csv_by_symbol(features: DataFrame, path: str) -> DataFrame:
    """Feature CSV with a header, one folder per symbol, sorted by time.

    One write for all symbols. Rows are range-partitioned by symbol and time:
    a small symbol ends up in one file, a large one in several consecutive
    files instead of one task. All 26 columns stay inside the files. Returns
    the row count per symbol.
    """
    rows = features.select(*FEATURE_COLUMNS, F.col("symbol").alias(SERIES))
    (
        rows.repartitionByRange(SERIES, "timestamp")
        .sortWithinPartitions(SERIES, "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("header", True)
        .partitionBy(SERIES)
        .csv(path)
    )
    return records_by_symbol(features)


HISTORY, LIVE = "history", "live"


def write_history(lines: DataFrame, path: str) -> None:
    """Earlier lines (column ``value``) into the history folder of a collection.

    The stream has a folder of its own: readers of a folder that a stream writes
    see the stream's files only. Writing the history again replaces it.
    """
    lines.select("value").write.mode("overwrite").text(f"{path}/{HISTORY}")


def append_lines(lines: DataFrame, path: str) -> None:
    """Append JSON lines (column ``value``)."""
    lines.select("value").write.mode("append").text(path)


def collect_closed(
    lines: DataFrame, path: str, checkpoint: str, available_now: bool = False,
    within: str | None = None, history: DataFrame | None = None,
):
    """Stream closed kline messages into the live folder of a collection, one JSON line each.

    With ``within`` a candle (symbol, interval and start) is stored once: of copies that
    arrive up to so long apart the first is kept, and what is in ``history``, lines
    stored before, is left out. The clock is that of the arrival, so no candle is too
    late to be stored. Messages without a symbol, interval or start are no copies.
    """
    kept = closed_messages(lines)
    if within is not None:
        kept = _stored_once(kept, within, history)
    trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
    return (
        message_lines(kept)
        .writeStream.format("text")
        .option("path", f"{path}/{LIVE}")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def _stored_once(messages: DataFrame, within: str, history: DataFrame | None) -> DataFrame:
    start = F.get_json_object("data", "$.k.t").try_cast("bigint")
    interval = F.get_json_object("data", "$.k.i")
    symbol = F.coalesce(F.get_json_object("data", "$.k.s"), F.col("symbol"))
    whole = symbol.isNotNull() & interval.isNotNull() & start.isNotNull()
    own = {"_symbol": symbol, "_interval": interval, "_start": start, "_arrived": F.current_timestamp()}
    kept = messages.withColumns(own)
    kept = kept.withColumn("_single", F.when(~whole, F.uuid()))
    if history is not None:
        good, _ = split_malformed(history)
        known = klines(good).select(
            F.coalesce("kline_symbol", "root_symbol").alias("_symbol"), F.col("interval").alias("_interval"),
            F.col("open_ms").alias("_start"),
        )
        kept = kept.join(known.distinct(), ["_symbol", "_interval", "_start"], "left_anti")
    keys = ["_symbol", "_interval", "_start", "_single"]
    return kept.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(keys)
