from helpers import START, candle, table
from pyspark.sql import functions as F

from wickwork.operators import quality as q
from wickwork.operators.candles import build_candles, dedupe_candles


def dirty(spark):
    return table(
        spark,
        [
            candle("A", 0, 10.0),
            candle("A", 0, 11.0),
            candle("A", 0, 12.0),
            candle("A", 1, -1.0),
            candle("A", 2, 5.0, low=0.0),
            candle("A", 3, None),
            candle("B", None, 3.0),
            candle(None, 5, 3.0, volume=None),
        ],
    )


def lines(df):
    return {(r.check, r.key): r.value for r in df.collect()}


def test_report(spark):
    got = lines(q.quality_report(dirty(spark)))
    assert got[("total_records", None)] == "8"
    assert got[("duplicate_timestamps", None)] == "1"
    # minute 1 and 2; a NULL price is not a bad price
    assert got[("invalid_prices", None)] == "2"
    nulls = {k: v for (c, k), v in got.items() if c == "null_count"}
    assert nulls == {
        "timestamp": "1", "symbol": "1", "open": "1", "high": "1", "low": "1", "close": "1", "volume": "1",
    }
    counts = {k: v for (c, k), v in got.items() if c == "records_by_symbol"}
    assert counts == {"A": "6", "B": "1", None: "1"}
    assert got[("first_timestamp", "A")] == "2024-01-01 00:00:00"
    assert got[("last_timestamp", "A")] == "2024-01-01 00:03:00"
    assert got[("first_timestamp", "B")] is None


def test_report_agrees_with_single_checks(spark):
    rows = dirty(spark)
    assert q.duplicate_keys(rows).collect()[0].copies == 3
    assert q.invalid_prices(rows).count() == 2
    assert q.null_counts(rows).first().close == 1
    assert q.distinct_symbols(rows).count() == 3
    assert {r.symbol: r.records for r in q.records_by_symbol(rows).collect()} == {"A": 6, "B": 1, None: 1}
    ranges = {r.symbol: r for r in q.time_ranges(rows).collect()}
    assert ranges["B"].first_timestamp is None


def test_report_is_one_scan(spark, folder):
    from wickwork.plans.queries import timed

    rows = timed(spark, folder).select(
        "timestamp", "symbol", *[F.col("price").alias(c) for c in ("open", "high", "low", "close")],
        F.col("quantity").alias("volume"),
    )
    report = q.quality_report(rows)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1


def test_due_batches_need_two_whole_minutes(spark):
    rows = table(spark, [candle("A", m) for m in range(5)] + [candle("B", 1)])
    clock = F.lit(START.replace(minute=4, second=59)).cast("timestamp")
    due = sorted((r.bucket.minute, r.records, r.symbols) for r in q.due_batches(rows, clock).collect())
    assert due == [(0, 1, 1), (1, 2, 2), (2, 1, 1)]


def test_dedupe_keeps_the_last_arrival(spark):
    rows = table(spark, [candle("A", 0, 1.0), candle("A", 0, 2.0), candle("A", 0, 3.0), candle("A", 1, 4.0)])
    arrival = F.when(F.col("close") == 2, F.lit(9.0)).when(F.col("close") == 3, F.lit(8.0))
    got = dedupe_candles(rows.withColumn("received_at", arrival)).collect()
    assert sorted(r.close for r in got) == [2.0, 4.0]


def test_candles_from_trades(spark):
    trades = spark.createDataFrame(
        [
            (1, "A", "2024-01-01 00:00:05", 10.0, 2.0, False),
            (3, "A", "2024-01-01 00:00:50", 12.0, 1.0, True),
            (2, "A", "2024-01-01 00:00:50", 9.0, 1.0, False),
            (4, "A", "2024-01-01 00:01:00", 11.0, 1.0, True),
        ],
        "id long, symbol string, t string, price double, quantity double, is_buyer_maker boolean",
    ).withColumn("time", F.to_timestamp("t"))
    first, second = sorted(build_candles(trades).collect(), key=lambda r: r.timestamp)
    assert (first.open, first.high, first.low, first.close) == (10.0, 12.0, 9.0, 12.0)
    assert (first.volume, first.number_of_trades, first.quote_volume) == (4.0, 3, 41.0)
    assert (first.taker_buy_volume, first.taker_buy_quote_volume) == (3.0, 29.0)
    assert (second.taker_buy_volume, second.taker_buy_quote_volume) == (0.0, 0.0)
    plan = build_candles(trades)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min_by" in plan
