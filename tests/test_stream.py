import json
from datetime import timedelta

import pytest
from helpers import START, bag, candle, table, wave
from pyspark.sql import functions as F

from wickwork.operators import outcomes
from wickwork.operators.features import engineer_features
from wickwork.schemas import CANDLE_COLUMNS, FEATURE_COLUMNS
from wickwork.sources import messages as m
from wickwork.streaming.counters import Counters
from wickwork.streaming.live import LiveJob, kline_candles, trade_candles


def message(row, received=None, closed=True, event="kline"):
    start = int(row["timestamp"].timestamp() * 1000)
    k = {
        "t": start, "T": start + 59999, "s": row["symbol"], "i": "1m", "x": closed,
        "o": str(row["open"]), "h": str(row["high"]), "l": str(row["low"]), "c": str(row["close"]),
        "v": str(row["volume"]), "n": row["number_of_trades"], "q": str(row["quote_volume"]),
        "V": str(row["taker_buy_volume"]), "Q": str(row["taker_buy_quote_volume"]),
    }
    body = {"event_type": event, "symbol": row["symbol"], "exchange": "test", "data": {"e": event, "k": k}}
    if received is not None:
        body["received_at"] = received
    return json.dumps(body)


class Feed:
    """A folder that receives one file of messages at a time."""

    def __init__(self, folder):
        self.folder = folder
        folder.mkdir()
        self.n = 0

    def add(self, lines):
        target = self.folder / f"{self.n:04d}.json"
        target.write_text("\n".join(lines) + "\n")
        stamp = 1_700_000_000 + self.n
        import os

        os.utime(target, (stamp, stamp))
        self.n += 1


def run(spark, feed, job, flush=False):
    source = m.stream_lines(spark, str(feed.folder), max_files=1)
    still = m.read_lines(spark, str(feed.folder)) if flush else None
    return job.run(source, kline_candles, flush_from=still)


def job_at(spark, path, **options):
    options.setdefault("levels", ("year", "month", "day"))
    options.setdefault("chunk", None)
    return LiveJob(spark, str(path / "out"), str(path / "state"), **options)


def clean(spark, job):
    return spark.read.parquet(f"{job.out}/clean").select(*FEATURE_COLUMNS)


def minutes(rows, lo, hi):
    end = START + timedelta(minutes=hi)
    return [r for r in rows if START + timedelta(minutes=lo) <= r["timestamp"] < end]


@pytest.mark.parametrize("chunk", [None, "hour"])
def test_stream_equals_batch(spark, tmp_path, chunk):
    rows = wave("A", range(45)) + wave("B", range(0, 45, 2))
    feed = Feed(tmp_path / "in")
    for lo in range(0, 45, 9):
        feed.add([message(r) for r in minutes(rows, lo, lo + 9)])
    job = job_at(spark, tmp_path, chunk=chunk)
    run(spark, feed, job, flush=True)
    want = engineer_features(table(spark, rows), None)
    assert bag(clean(spark, job)) == bag(want)
    raw = spark.read.parquet(f"{job.out}/raw").select(*CANDLE_COLUMNS)
    assert bag(raw) == bag(table(spark, rows))
    # several batches carried the history on
    batches = spark.read.parquet(f"{job.out}/clean").select("batch").distinct().count()
    assert batches > 3


def test_stream_restarts_and_replaces_the_flushed_part(spark, tmp_path):
    rows = wave("A", range(40))
    feed = Feed(tmp_path / "in")
    feed.add([message(r) for r in rows[:20]])
    job = job_at(spark, tmp_path)
    run(spark, feed, job, flush=True)
    assert clean(spark, job).count() == 20
    feed.add([message(r) for r in rows[20:]])
    job = job_at(spark, tmp_path)
    run(spark, feed, job, flush=True)
    assert bag(clean(spark, job)) == bag(engineer_features(table(spark, rows), None))


def test_replayed_batch_gives_the_same_tables(spark, tmp_path):
    rows = table(spark, wave("A", range(30)))
    job = job_at(spark, tmp_path, score=outcomes.linear_score())
    job.process(rows.where("minute(timestamp) < 25"), 0)
    job.process(rows.where("minute(timestamp) >= 25"), 1)
    before = bag(clean(spark, job)), bag(spark.read.parquet(f"{job.out}/outcomes"))
    job.process(rows.where("minute(timestamp) >= 25"), 1)
    after = bag(clean(spark, job)), bag(spark.read.parquet(f"{job.out}/outcomes"))
    assert before == after
    assert before[0] == bag(engineer_features(rows, None))


def test_empty_batch_keeps_history(spark, tmp_path):
    rows = table(spark, wave("A", range(30)))
    job = job_at(spark, tmp_path)
    job.process(rows.where("minute(timestamp) < 25"), 0)
    job.process(rows.limit(0), 1)
    job.process(rows.limit(0), 2)
    job.process(rows.where("minute(timestamp) >= 25"), 3)
    assert bag(clean(spark, job)) == bag(engineer_features(rows, None))


def test_resends_open_and_late_candles(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(
        [
            message(candle("A", 0, 1.0), received=5.0),
            message(candle("A", 0, 2.0), received=9.0),
            message(candle("A", 0, 3.0)),
            message(candle("A", 1, 4.0), closed=False),
            message(candle("A", 2, 5.0), event="trade"),
            '{"broken":',
        ]
    )
    feed.add([message(candle("A", m, 10.0 + m)) for m in range(2, 12)])
    feed.add([message(candle("A", 12, 22.0))])
    # Spark compares late rows with the watermark of the batch before
    feed.add([message(candle("A", 1, 99.0)), message(candle("A", 13, 23.0))])
    counters = Counters()
    spark.streams.addListener(counters)
    try:
        job = job_at(spark, tmp_path)
        query = run(spark, feed, job)
        # the listener runs on its own thread
        for _ in range(100):
            if counters.totals["input_rows"] >= 19:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    got = {r.timestamp.minute: r.close for r in clean(spark, job).collect()}
    assert got[0] == 2.0
    assert 1 not in got
    assert max(got) == 11  # minutes 12 and 13 are still open
    assert counters.totals["dropped_late"] == 1
    assert counters.totals["in_progress_skipped"] == 1
    assert counters.totals["closed_sent"] == 16
    assert query.exception() is None


def test_a_minute_waits_for_its_delay(spark, tmp_path):
    """A minute is written once a candle two minutes later was seen."""
    feed = Feed(tmp_path / "in")
    feed.add([message(candle("A", m)) for m in range(2)])
    job = job_at(spark, tmp_path)
    run(spark, feed, job)
    assert spark.read.schema("timestamp timestamp").parquet(f"{job.out}/raw/batch=0").count() == 0
    feed.add([message(candle("A", 2))])
    run(spark, feed, job)
    assert [r.timestamp.minute for r in clean(spark, job).collect()] == [0]


def test_history_is_continued(spark, tmp_path):
    rows = wave("A", range(40))
    history = table(spark, rows[:30])
    feed = Feed(tmp_path / "in")
    feed.add([message(r) for r in rows[28:]])
    job = job_at(spark, tmp_path)
    job.seed(history)
    run(spark, feed, job, flush=True)
    want = engineer_features(table(spark, rows), None).where(F.minute("timestamp") >= 28)
    assert bag(clean(spark, job)) == bag(want)


def test_scores_and_outcomes_equal_batch(spark, tmp_path):
    rows = [{**r, "volume": r["volume"] + 1} for r in wave("A", range(50)) + wave("B", range(0, 50, 2))]
    feed = Feed(tmp_path / "in")
    for lo in range(0, 50, 10):
        feed.add([message(r) for r in minutes(rows, lo, lo + 10)])
    job = job_at(spark, tmp_path, score=outcomes.linear_score())
    run(spark, feed, job, flush=True)
    candles = table(spark, rows)
    fit = engineer_features(candles, None, warm=True).where("is_warm").dropna(subset=["momentum_10"])
    made = outcomes.predictions(fit, outcomes.linear_score())
    got = spark.read.parquet(f"{job.out}/predictions").select(*made.columns)
    assert bag(got) == bag(made)
    want = outcomes.asof_outcomes(candles, made)
    assert bag(spark.read.parquet(f"{job.out}/outcomes").select(*want.columns)) == bag(want)


def test_bounded_run(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add([message(candle("A", m)) for m in range(9)])
    job = job_at(spark, tmp_path)
    source = m.stream_lines(spark, str(feed.folder))
    query = job.run(source, kline_candles, timeout=25)
    assert not query.isActive
    assert clean(spark, job).count() == 7


def test_candles_from_a_trade_stream(spark, tmp_path):
    rows = spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("A")).otherwise(F.lit("B")).alias("symbol"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 5).alias("time"),
        (F.col("id") % 17 + 1.0).alias("price"),
        (F.col("id") % 5 + 1.0).alias("quantity"),
        (F.col("id") % 2 == 0).alias("is_buyer_maker"),
    )
    path = str(tmp_path / "in")
    rows.repartitionByRange(4, "time").write.parquet(path)
    job = job_at(spark, tmp_path, width="1 minute")
    source = spark.readStream.schema(rows.schema).parquet(path)
    job.run(source, trade_candles, flush_from=rows)
    want = engineer_features(trade_candles(rows), None)
    assert bag(clean(spark, job)) == bag(want)


def test_sliding_windows_on_a_stream(spark, tmp_path):
    from wickwork.operators.indicators import sliding_stats

    rows = spark.range(60).select(
        F.lit("A").alias("symbol"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 30).alias("time"),
        F.col("id").cast("double").alias("price"),
        F.lit(1.0).alias("quantity"),
    )
    path = str(tmp_path / "in")
    rows.coalesce(1).write.parquet(path)
    live = sliding_stats(
        spark.readStream.schema(rows.schema).parquet(path).withWatermark("time", "0 seconds")
    )
    query = (
        live.writeStream.format("memory").queryName("sliding").outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    closed = sliding_stats(rows).where(F.col("window_end") <= F.lit("2024-01-01 00:29:30").cast("timestamp"))
    assert bag(spark.table("sliding")) == bag(closed)


@pytest.mark.parametrize("batches", [1, 4])
def test_an_idle_rerun_changes_nothing(spark, tmp_path, batches):
    feed, rows = Feed(tmp_path / "in"), wave("A", range(40))
    for i in range(batches):
        part = rows[i * 40 // batches : (i + 1) * 40 // batches]
        feed.add([message(r) for r in part])
    expected = bag(engineer_features(table(spark, rows), None))
    for _ in range(2):
        job = job_at(spark, tmp_path)
        run(spark, feed, job, flush=True)
        assert bag(clean(spark, job)) == expected


def test_seeding_on_every_start_keeps_what_ran(spark, tmp_path):
    feed, rows = Feed(tmp_path / "in"), wave("A", range(90))
    history = table(spark, rows[:30])
    for i in range(30, 90, 15):
        feed.add([message(r) for r in rows[i : i + 15]])
        job = job_at(spark, tmp_path)
        job.seed(history)
        run(spark, feed, job, flush=True)
    every = engineer_features(table(spark, rows), None)
    expected = every.where(every.timestamp >= F.lit(rows[30]["timestamp"]))
    assert bag(clean(spark, job)) == bag(expected)
