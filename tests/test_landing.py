import json

import pytest
from helpers import GOLDEN, bag
from pyspark.sql import functions as F

from wickwork.__main__ import main
from wickwork.sources import messages as m
from wickwork.sources.files import read_candles
from wickwork.streaming.landing import Landing
from wickwork.streaming.live import LiveJob, kline_candles


def kline(minute, closed=True, **over):
    k = {"t": 1704067200000 + minute * 60_000, "s": "A", "i": "1m", "o": "1", "c": "2", "h": "3", "l": "1", "v": "5", "x": closed}
    return json.dumps({"e": "kline", "s": "A", "k": {**k, **over}})


def put(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(path)


@pytest.fixture
def job(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1704067200))
    return Landing(spark, f"{tmp_path}/out", f"{tmp_path}/state", levels=("year", "month", "day"), arrival=at)


def land(job, lines):
    job.start(m.stream_lines(job.spark, lines)).awaitTermination()


def test_every_line_lands_once(spark, job, tmp_path):
    lines = f"{tmp_path}/lines"
    first = [kline(0), kline(1, closed=False), kline(2) + kline(3), "oops", '{"e":"trade","s":"A"}']
    put(spark, lines, first)
    land(job, lines)
    put(spark, lines, [kline(4), json.dumps(GOLDEN)])
    land(job, lines)
    land(job, lines)  # nothing new
    counts = {r.kind: r.records for r in job.counts().collect()}
    assert counts == {"closed": 3, "in_progress": 1, "other": 1, "rejected": 2}
    assert sorted(r.line for r in job.rejected().collect()) == sorted(first[2:4])
    stored = [r for r in job.messages().collect() if r.symbol == GOLDEN["symbol"]]
    assert [json.loads(r.data) for r in stored] == [GOLDEN["data"]]
    assert stored[0].received_at == GOLDEN["received_at"]
    assert job.candles().count() == 3


def test_a_replayed_batch_lands_once(spark, job, tmp_path):
    rows = spark.createDataFrame([(kline(0),), ("oops",)], "value string")
    job.process(rows, 0)
    once = bag(job.rows())
    job.process(rows, 0)
    assert bag(job.rows()) == once and len(once) == 2


def test_nothing_landed(job):
    assert job.rows().count() == 0 and job.messages().count() == 0 and job.candles().count() == 0


def test_late_and_timeless_candles_are_told(spark, job, tmp_path):
    lines = f"{tmp_path}/lines"
    live = LiveJob(spark, job.out, job.state, levels=("year", "month", "day"))

    def run():
        live.run(m.stream_lines(spark, lines), kline_candles, flush_from=m.read_lines(spark, lines))
        land(job, lines)

    put(spark, lines, [kline(i) for i in range(10, 20)])
    run()
    put(spark, lines, [kline(0), kline(30), kline(31, t=None)])
    run()
    left = job.left_out(read_candles(spark, f"{job.out}/raw")).collect()
    assert sorted((r.timestamp.minute if r.timestamp else -1) for r in left) == [-1, 0]


def test_live_command_lands_what_arrives(spark, tmp_path):
    put(spark, f"{tmp_path}/lines", [kline(0), kline(1), "oops"])
    main(["live", "--input", f"{tmp_path}/lines", "--output", f"{tmp_path}/out", "--state", f"{tmp_path}/state"])
    counts = {r.kind: r.records for r in Landing(spark, f"{tmp_path}/out", "").counts().collect()}
    assert counts == {"closed": 2, "rejected": 1}


def test_landed_candles_parse_no_text(spark, tmp_path):
    from helpers import GOLDEN, bag, table, wave

    rows = table(spark, wave("A", range(5)) + [{**r, "close": None, "symbol": "b"} for r in wave("b", range(2))])
    lines = m.message_lines(m.candle_messages(rows, closed=F.lit(True), received_at=F.lit(3.0)))
    job = Landing(spark, str(tmp_path / "out"), str(tmp_path / "state"), levels=("year",))
    job.process(lines, 0)
    good, _ = m.split_malformed(lines)
    found = job.candles(extra=("received_at",))
    assert bag(found) == bag(m.typed_candles(m.klines(good), extra=("received_at",)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "get_json_object" not in plan
    # numbers as numbers or as text, and fields of another type
    odd = {**GOLDEN["data"]["k"], "o": 310.25, "n": "37", "c": {"not": "a number"}, "h": "high"}
    job.process(spark.createDataFrame([(json.dumps({**GOLDEN, "data": {"e": "kline", "k": odd}}),)], "value string"), 1)
    (row,) = job.candles(after=0).collect()
    assert (row.symbol, row.open, row.number_of_trades, row.close, row.high) == ("ONETWO", 310.25, 37, None, None)
    assert job.candles().count() == 8 and job.newest_batch() == 1
