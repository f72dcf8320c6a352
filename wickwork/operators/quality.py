"""Data quality: counts, NULLs, duplicate keys, time ranges, bad prices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.operators.series import keys_of
from wickwork.schemas import CRITICAL_COLUMNS, PRICE_COLUMNS

_STAMP = "yyyy-MM-dd HH:mm:ss"


def _bad_price() -> Column:
    """Any price at or below zero; a NULL price is not a bad price."""
    return reduce(lambda a, b: a | b, [F.col(c) <= 0 for c in PRICE_COLUMNS])


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def records_by_symbol(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("records"))


def distinct_symbols(rows: DataFrame) -> DataFrame:
    return rows.select("symbol").distinct()


def null_counts(rows: DataFrame) -> DataFrame:
    """One row, one column per critical column; one pass."""
    return rows.agg(*[_count(F.col(c).isNull()).alias(c) for c in CRITICAL_COLUMNS])


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """Each ``(symbol, interval, timestamp)`` seen more than once, with its copies."""
    grouped = rows.groupBy(*keys_of(rows), "timestamp").agg(F.count(F.lit(1)).alias("copies"))
    return grouped.where(F.col("copies") > 1)


def time_ranges(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol").agg(
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp")
    )


def invalid_prices(rows: DataFrame) -> DataFrame:
    return rows.where(_bad_price())


def rows_per_minute(rows: DataFrame, width: str = "1 minute") -> DataFrame:
    """Batch composition: rows and symbols per time bucket."""
    # Pre-grouped by symbol so that the distinct count needs no second expand.
    inner = rows.groupBy(F.window("timestamp", width)["start"].alias("bucket"), "symbol").agg(
        F.count(F.lit(1)).alias("n")
    )
    return inner.groupBy("bucket").agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("symbols")
    )


def due_batches(rows: DataFrame, clock: Column, age: str = "90 seconds") -> DataFrame:
    """Minute batches old enough to process at ``clock``.

    Both sides are whole minutes, so 90 seconds acts as two minutes.
    """
    now = F.date_trunc("minute", clock).cast("timestamp_ntz")
    return rows_per_minute(rows).where(
        F.col("bucket").cast("timestamp_ntz") + F.expr(f"INTERVAL {age}") <= now
    )


def quality_report(rows: DataFrame) -> DataFrame:
    """Every check as ``(check, key, value)`` in one pass over ``rows``.

    Three stacked aggregates, each combined on the map side: per key (which
    finds duplicates), per symbol, then a rollup of the per-symbol lines into
    the totals. Nothing is scanned twice.
    """
    nulls = {f"null_{c}": _count(F.col(c).isNull()) for c in CRITICAL_COLUMNS}
    per_key = rows.groupBy(*keys_of(rows), "timestamp").agg(
        F.count(F.lit(1)).alias("n"),
        _count(_bad_price()).alias("bad"),
        *[c.alias(n) for n, c in nulls.items()],
    )
    per_symbol = per_key.groupBy("symbol").agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        _count(F.col("n") > 1).alias("dup"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        *[F.sum(n).alias(n) for n in nulls],
    )
    both = per_symbol.rollup("symbol").agg(
        F.grouping("symbol").alias("is_total"),
        *[F.sum(c).alias(c) for c in ("n", "bad", "dup", *nulls)],
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )

    def line(check: str, key: Column, value: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"), key.alias("key"), value.cast("string").alias("value")
        )

    none = F.lit(None).cast("string")

    def total(column: str) -> Column:
        return F.coalesce(column, F.lit(0))

    totals = F.array(
        line("total_records", none, total("n")),
        line("duplicate_timestamps", none, total("dup")),
        line("invalid_prices", none, total("bad")),
        *[line("null_count", F.lit(c), total(f"null_{c}")) for c in CRITICAL_COLUMNS],
    )
    by_symbol = F.array(
        line("records_by_symbol", F.col("symbol"), F.col("n")),
        line("first_timestamp", F.col("symbol"), F.date_format("first", _STAMP)),
        line("last_timestamp", F.col("symbol"), F.date_format("last", _STAMP)),
    )
    lines = F.when(F.col("is_total") == 1, totals).otherwise(by_symbol)
    return both.select(F.inline(lines))
