"""Kept rows by bucket, stored counts, the clock, and candles collected once."""

import glob
import json
import os
from datetime import timedelta

import pytest
from helpers import START, bag, candle, table, wave
from pyspark.sql import functions as F
from test_stream import Feed, clean, job_at, message, run

from wickwork.operators import market, outcomes
from wickwork.operators.features import engineer_features
from wickwork.sinks import files as sinks
from wickwork.sources import files as sources
from wickwork.sources import messages as m
from wickwork.streaming.counters import _ahead
from wickwork.streaming.live import kline_candles

SYMBOLS = [f"S{i}" for i in range(40)]


def written_since(folder, stamp):
    found = glob.glob(f"{folder}/**/part-*.parquet", recursive=True)
    return [f for f in found if os.stat(f).st_mtime_ns > stamp]


def newest(folder):
    return max(os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/part-*.parquet", recursive=True))


def test_a_batch_of_one_symbol_writes_its_bucket_only(spark, tmp_path):
    job = job_at(spark, tmp_path, score=outcomes.linear_score())
    rows = [r for s in SYMBOLS for r in wave(s, range(30))]
    rows = [{**r, "volume": r["volume"] + 1} for r in rows]
    job.process(table(spark, rows), 0)
    for kept in ("tail", "latest"):
        buckets = glob.glob(f"{job.state}/{kept}/bucket=*")
        assert 15 < len(buckets) <= 40
        assert len(glob.glob(f"{job.state}/{kept}/**/part-*.parquet", recursive=True)) == len(buckets)
    stamps = {kept: newest(f"{job.state}/{kept}") for kept in ("tail", "latest")}
    job.process(table(spark, [candle("S7", 30, 5.0)]), 1)
    assert {kept: len(written_since(f"{job.state}/{kept}", at)) for kept, at in stamps.items()} == {"tail": 1, "latest": 1}
    # an idle trigger writes its progress and nothing else
    stamps = {kept: newest(f"{job.state}/{kept}") for kept in ("tail", "latest")}
    job.process(table(spark, rows).limit(0), 2)
    assert not any(written_since(f"{job.state}/{kept}", at) for kept, at in stamps.items())
    job.process(table(spark, [candle("S7", 31, 6.0), candle("S8", 30, 9.0)]), 3)
    every = rows + [candle("S7", 30, 5.0), candle("S7", 31, 6.0), candle("S8", 30, 9.0)]
    assert bag(clean(spark, job)) == bag(engineer_features(table(spark, every), None))


def test_a_replayed_batch_reads_what_its_first_run_read(spark, tmp_path):
    rows = [r for s in SYMBOLS[:5] for r in wave(s, range(40))]
    job = job_at(spark, tmp_path, buckets=2)
    parts = [table(spark, rows).where(f"minute(timestamp) between {lo} and {lo + 9}") for lo in (0, 10, 20, 30)]
    for i, part in enumerate(parts):
        job.process(part, i)
        if i % 2:
            job.process(part, i)
    assert bag(clean(spark, job)) == bag(engineer_features(table(spark, rows), None))


def test_loaded_history_counts_until_a_bucket_is_written(spark, tmp_path):
    rows = [r for s in SYMBOLS[:6] for r in wave(s, range(60))]
    job = job_at(spark, tmp_path, buckets=4)
    job.seed(table(spark, rows).where("minute(timestamp) < 30"))
    some = F.col("symbol").isin(SYMBOLS[:2])
    job.process(table(spark, rows).where("minute(timestamp) between 30 and 39").where(some), 0)
    job.process(table(spark, rows).where("minute(timestamp) between 30 and 59").where(~some), 1)
    job.process(table(spark, rows).where("minute(timestamp) >= 40").where(some), 2)
    want = engineer_features(table(spark, rows), None).where("minute(timestamp) >= 30")
    assert bag(clean(spark, job)) == bag(want)


def test_stored_counts_equal_the_tables(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    rows = [{**r, "volume": r["volume"] + 1} for r in wave("A", range(50))]
    for lo in range(0, 50, 10):
        feed.add([message(r) for r in rows[lo : lo + 10]])
        job = job_at(spark, tmp_path, score=outcomes.linear_score())
        run(spark, feed, job, flush=True)
        counts = {r.table: r.records for r in job.written().collect()}
        assert counts == {
            t: spark.read.schema("timestamp timestamp").parquet(f"{job.out}/{t}").count()
            for t in ("raw", "clean", "predictions", "outcomes")
        }
    assert counts["raw"] == 50
    assert job_at(spark, tmp_path / "none").written().count() == 0


def test_backlog_is_what_the_source_is_ahead():
    assert _ahead('{"logOffset": 7}', '{"logOffset": 4}') == 3
    assert _ahead('{"t": {"0": 10, "1": 5}}', '{"t": {"0": 7}}') == 8
    assert _ahead(None, '{"logOffset": 4}') == 0 == _ahead("12", "12") and _ahead("12", None) == 12
    assert _ahead("not json", "3") == 0


def test_a_quiet_stream_completes_by_the_clock(spark, tmp_path):
    feed, clock = Feed(tmp_path / "in"), Feed(tmp_path / "clock")
    feed.add([message(candle("A", i, 10.0 + i)) for i in range(3)])

    def tick(minute):
        clock.add([json.dumps({"timestamp": (START + timedelta(minutes=minute)).isoformat()})])

    def go():
        job = job_at(spark, tmp_path)
        beats = spark.readStream.schema("timestamp timestamp").json(str(clock.folder))
        lines = m.stream_lines(spark, str(feed.folder))
        job.run(lines, lambda rows: kline_candles(rows, "2 minutes", beats))
        return sorted(r.timestamp.minute for r in clean(spark, job).collect())

    tick(0)
    assert go() == [0]  # by the candle of minute 2
    tick(3)  # minutes 0 and 1 are two minutes old
    assert go() == [0, 1]
    tick(9)
    assert go() == [0, 1, 2]
    feed.add([message(candle("A", 10)), message(candle("A", 1, 99.0))])
    tick(20)
    assert go() == [0, 1, 2, 10]
    got = job_at(spark, tmp_path)
    assert [r.close for r in clean(spark, got).where("minute(timestamp) = 1").collect()] == [11.0]


def test_a_resent_candle_is_collected_once(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def line(start, symbol="A", closed="true"):
        return '{"e":"kline","s":"%s","k":{"t":%s,"s":"%s","i":"1m","x":%s}}' % (symbol, start, symbol, closed)

    def send(*lines):
        sinks.append_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), path)
        known = sources.read_collected(spark, out)
        sinks.collect_closed(
            m.stream_lines(spark, path), out, state, True, within="1 day", history=known
        ).awaitTermination(120)
        good, _ = m.split_malformed(sources.read_collected(spark, out))
        return sorted(((r.kline_symbol, r.open_ms) for r in m.klines(good).collect()), key=lambda x: (x[0], x[1] or -1))

    sinks.write_history(spark.createDataFrame([(line(60000),)], "value string"), out)
    assert send(line(60000), line(120000), line(120000), line(180000, closed="false")) == [("A", 60000), ("A", 120000)]
    # later, much earlier candles, another symbol, copies again
    got = send(line(120000), line(0), line(120000, "B"), line(0))
    assert got == [("A", 0), ("A", 60000), ("A", 120000), ("B", 120000)]
    # messages without a start are not copies of each other
    bare = '{"e":"kline","s":"A","k":{"s":"A","i":"1m","x":true}}'
    assert len(send(bare, bare)) == 6


def test_csv_of_some_symbols_reads_their_folders(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = engineer_features(table(spark, wave("A", range(30)) + wave("B", range(20)) + wave("1", range(10))), None)
    sinks.write_csv_by_symbol(rows, path)
    one = sources.read_feature_csv(spark, path, symbols=["1", "B"])
    assert bag(one) == bag(rows.where("symbol != 'A'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "series" in plan.split("PartitionFilters")[1].split("]")[0]
    names = spark.createDataFrame([("B",), ("none",)], "symbol string")
    some = sources.read_feature_csv(spark, path, symbols=names)
    assert bag(some) == bag(rows.where("symbol = 'B'"))
    # folders of other names, and flat files
    nested = str(tmp_path / "nested")
    rows.where("symbol = 'A'").coalesce(1).write.option("header", True).csv(f"{nested}/a")
    rows.where("symbol = 'B'").coalesce(1).write.option("header", True).csv(f"{nested}/b")
    assert bag(sources.read_feature_csv(spark, nested, symbols=["B"])) == bag(rows.where("symbol = 'B'"))
    assert bag(sources.read_feature_csv(spark, f"{nested}/a", symbols=names)) == []
    assert sources.read_feature_csv(spark, nested).count() == 50


@pytest.mark.parametrize("seconds", [0, 1, 1799, 3599])
def test_panes_give_the_day(spark, seconds):
    rows = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 5 == 0, F.lit("A")).otherwise(F.lit("B")).alias("symbol"),
        F.timestamp_seconds(F.lit(1704067200 + seconds) - F.col("id") * 13).alias("time"),
        ((F.col("id") * 7919) % 1000 + 1.0).alias("price"),
        (F.col("id") % 5 + 1.0).alias("quantity"),
        (F.col("id") % 2 == 0).alias("is_buyer_maker"),
    )
    panes = market.trade_panes(rows)
    assert bag(market.day_stats_from_panes(panes, rows)) == bag(market.day_stats(rows))
    whole = market.day_stats_from_panes(panes).agg(F.sum("trade_count")).first()[0]
    assert 0 < whole <= market.day_stats(rows).agg(F.sum("trade_count")).first()[0]
    assert market.day_stats_from_panes(panes.limit(0), rows.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_accuracy_over_all_symbols(spark, n):
    rows = spark.range(400).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.timestamp_seconds(F.floor(F.col("id") / 3) * 60).alias("timestamp"),
        F.lit(1.0).alias("predicted_return"),
        F.when(F.col("id") % 7 == 0, F.lit(-1.0)).otherwise(F.lit(2.0)).alias("actual_return"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 7 != 0).alias("direction_correct"),
    ).repartition(5)
    got = outcomes.running_accuracy_overall(rows, n).orderBy("timestamp", "symbol").collect()
    hits = [r.direction_correct for r in got]
    for i, r in enumerate(got):
        part = [h for h in hits[max(0, i - n + 1) : i + 1] if h is not None]
        assert r.counted == min(i + 1, n)
        assert r.accuracy == (pytest.approx(sum(part) / len(part) * 100) if part else None)


def test_a_global_order_is_cut_into_ranges(spark):
    """A third of the rows are alike and still fall into several ranges."""
    from wickwork.operators import series

    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("one"))
    done = series.ordered_totals(rows.repartition(6), [F.col("k")], {"n": F.lit(1).cast("bigint"), "sum": F.col("k")})
    got = sorted((r.n, r.k, r["sum"]) for r in done.collect())
    total = 0
    for place, (n, k, running) in enumerate(got):
        total += k
        assert (n, running) == (place + 1, total)
    assert [k for _, k, _ in got] == sorted(k for _, k, _ in got)


def test_compaction_swaps_batches_for_folders(spark, tmp_path):
    from wickwork.schemas import CANDLE_SCHEMA
    from wickwork.streaming.compact import CompactedTable

    rows = wave("A", range(0, 60)) + wave("B", range(0, 60))
    job = job_at(spark, tmp_path)
    raw = CompactedTable(job, "raw", CANDLE_SCHEMA, ("year", "month", "day", "hour"))
    assert raw.read().count() == 0 and raw.compact().number == -1

    def files(kind):
        return glob.glob(f"{job.out}/{kind}/**/part-*.parquet", recursive=True)

    for i in range(6):
        job.process(table(spark, rows).where(f"minute(timestamp) between {i * 10} and {i * 10 + 9}"), i)
        before, reader = bag(raw.read()), raw.read()
        if i in (2, 4):
            state = raw.compact()
            assert state.note == i
            assert bag(raw.read()) == before == bag(reader)
    assert bag(raw.read()) == bag(table(spark, rows))
    # batches of the record before the last are gone, those of the last still there
    assert sorted({f.split("batch=")[1].split("/")[0] for f in files("raw")}) == ["3", "4", "5"]
    # nothing new: nothing happens; the flushed part is read but not taken in
    again = raw.compact()
    assert again.note == 5 and raw.compact() == again
    job.process(table(spark, [candle("C", 70)]), -1, keep=False)
    assert raw.compact() == again and raw.read().count() == 121
