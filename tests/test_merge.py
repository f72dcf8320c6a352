"""Late and corrected candles merged into stored features, and the commit records."""

import glob
import random
from datetime import timedelta

import pytest
from helpers import START, bag, candle, table, wave
from pyspark.sql import functions as F

from wickwork.operators.candles import dedupe_candles
from wickwork.operators.features import engineer_features
from wickwork.schemas import CANDLE_SCHEMA, FEATURE_COLUMNS
from wickwork.sinks.versioned import VersionedTables
from wickwork.sources import messages as m
from wickwork.streaming.landing import Landing
from wickwork.streaming.merge import FeatureStore, rows_after


def arrived(spark, rows, at):
    return table(spark, rows).withColumn("received_at", F.lit(float(at)))


def store_at(spark, path, **options):
    options.setdefault("levels", ("year", "month", "day", "hour"))
    options.setdefault("chunk", "hour")
    return FeatureStore(spark, str(path / "store"), **options)


def matches(store, everything):
    want = engineer_features(dedupe_candles(everything).drop("received_at"), None)
    return bag(store.features().select(*FEATURE_COLUMNS)) == bag(want)


def test_any_order_gives_the_batch_result(spark, tmp_path):
    rnd = random.Random(4)
    rows = wave("A", range(0, 300, 2)) + wave("B", range(0, 300, 7)) + [candle("C", 5, 1.0)]
    rows += [{**r, "interval": "5m", "close": r["close"] + 3} for r in wave("A", range(0, 300, 5))]
    corrections = [{**r, "close": r["close"] * 2} for r in rnd.sample(rows, 12)]
    rnd.shuffle(rows)
    parts = [arrived(spark, rows[i::4], i) for i in range(4)] + [arrived(spark, corrections, 9)]
    store, everything = store_at(spark, tmp_path), parts[0].limit(0)
    for part in parts:
        store.merge(part)
        everything = everything.unionByName(part)
        assert matches(store, everything)


def test_only_the_folders_reached_are_replaced(spark, tmp_path):
    rows = wave("A", range(600)) + wave("B", range(600))
    late = next(r for r in rows if r["symbol"] == "A" and r["timestamp"] == START + timedelta(minutes=310))
    store = store_at(spark, tmp_path)
    store.merge(arrived(spark, [r for r in rows if r is not late], 1))
    first = store.tables.state()
    state = store.merge(arrived(spark, [late], 2))
    moved = [f for f, v in state.folders["features"].items() if v != first.folders["features"][f]]
    assert moved == [("2024", "01", "01", "05")]  # minutes 310 to 329 are in hour 5
    assert [f for f, v in state.folders["candles"].items() if v == state.number] == moved
    assert matches(store, arrived(spark, rows, 1))


def test_copies_move_nothing(spark, tmp_path):
    rows = wave("A", range(60))
    store = store_at(spark, tmp_path)
    before = store.merge(arrived(spark, rows, 5))
    # an older version of a candle does not replace a newer one
    older = [{**rows[30], "close": 1.0}]
    state = store.merge(arrived(spark, older, 2))
    assert state.folders == before.folders
    state = store.merge(arrived(spark, rows[30:31], 7))
    assert state.folders["features"] == before.folders["features"]
    assert store.candles().where("received_at = 7").count() == 1
    # which counts from now on
    store.merge(arrived(spark, older, 6))
    assert matches(store, arrived(spark, rows, 5))


def test_candles_without_a_time_and_empty_tables(spark, tmp_path):
    store = store_at(spark, tmp_path)
    nothing = arrived(spark, [candle("A", 0)], 1).limit(0)
    state = store.merge(nothing, note=3)
    assert (state.number, state.note, state.folders) == (0, 3, {})
    assert store.features().count() == store.candles().count() == 0
    store.merge(arrived(spark, [candle("A", None), candle(None, 1), candle(None, 2, 11.0)], 1))
    assert store.candles().count() == store.features().count() == 2
    assert store.tables.state().note == 3


def test_a_reader_sees_one_state(spark, tmp_path):
    rows = wave("A", range(100))
    store = store_at(spark, tmp_path)
    store.merge(arrived(spark, rows, 1))
    before, state = store.features(), store.tables.state()
    store.merge(arrived(spark, [{**r, "close": 1.0} for r in rows[:50]], 2))
    assert bag(before.select(*FEATURE_COLUMNS)) == bag(engineer_features(table(spark, rows), None))
    assert before.count() == store.tables.read("features", state).count() == 100
    # a change that dies before its record is not seen, and its number is used again
    torn = VersionedTables(spark, store.tables.path, store.tables.schemas, store.tables.levels)
    now = torn.state()
    target = f"{torn.path}/features/version={now.number + 1}/year=1999/month=01/day=01/hour=00"
    store.features().limit(3).write.parquet(target)
    assert store.features().count() == 100
    store.merge(arrived(spark, [candle("Z", 1)], 3))
    assert store.features().count() == 101


def test_records_are_kept_in_slots(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "v"), {"t": CANDLE_SCHEMA}, ("year", "month", "day"))
    state = tables.state()
    for i in range(11):
        rows = table(spark, [candle("A", i * 1440, float(i + 1))])
        state = tables.replace(state, {"t": (rows, tables.folders_of(rows))}, note=i)
    assert tables.state() == state and (state.number, state.note) == (10, 10)
    assert sorted(r.close for r in tables.read("t").collect()) == [float(i + 1) for i in range(11)]
    assert len(glob.glob(str(tmp_path / "v/commits/slot=*"))) == 8
    some = tables.read("t", folders=[("2024", "01", "03"), ("2030", "01", "01")])
    assert [r.close for r in some.collect()] == [3.0]
    # a folder left without rows is gone
    state = tables.replace(state, {"t": (rows.limit(0), [("2024", "01", "03")])})
    assert tables.read("t").count() == 10 and ("2024", "01", "03") not in state.folders["t"]


@pytest.mark.parametrize("backward", [False, True])
def test_rows_next_to_a_mark(spark, backward):
    rows = table(spark, wave("A", range(0, 200, 3)) + wave("B", range(50)))
    marks = table(spark, [candle("A", 31), candle("A", 60), candle("A", 150), candle("B", 40)]).select(
        "symbol", "interval", "timestamp"
    )
    got = rows_after(rows, marks, 4, "hour", backward).collect()
    minute = {(r.symbol, int((r.timestamp.replace(tzinfo=START.tzinfo) - START).total_seconds() // 60)) for r in got}
    if backward:
        want = {("A", x) for x in (30, 27, 24, 21, 57, 54, 51, 48, 147, 144, 141, 138)} | {("B", x) for x in (39, 38, 37, 36)}
    else:
        want = {("A", x) for x in (33, 36, 39, 42, 63, 66, 69, 72, 153, 156, 159, 162)} | {("B", x) for x in (41, 42, 43, 44)}
    assert minute == want


def test_what_landed_is_followed(spark, tmp_path):
    rows = wave("A", range(120))
    landing = Landing(spark, str(tmp_path / "out"), str(tmp_path / "state"), levels=("year",))
    store = store_at(spark, tmp_path, levels=("year", "month", "day"))
    assert store.follow(landing).note == -1

    def land(part, batch, at):
        sent = m.candle_messages(table(spark, part), closed=F.lit(True), received_at=F.lit(at))
        landing.process(m.message_lines(sent), batch)
        return store.follow(landing)

    assert land(rows[:50] + rows[60:], 0, 1.0).note == 0
    assert land(rows[50:60], 1, 2.0).note == 1
    again = store.follow(landing)
    assert again.note == 1
    assert bag(store.features().select(*FEATURE_COLUMNS)) == bag(
        engineer_features(table(spark, rows).withColumn("exchange", F.lit("test")), None)
    )


def test_command_line_merges_what_landed(spark, tmp_path, monkeypatch, capsys):
    from wickwork import __main__ as cli
    from wickwork.sinks import files as sinks

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    raw, live, out = (str(tmp_path / n) for n in ("raw", "live", "merged"))
    rows = wave("A", range(40))
    lines = m.message_lines(m.candle_messages(table(spark, rows), closed=F.lit(True)))
    sinks.append_lines(lines, raw)
    cli.main(["live", "--input", raw, "--output", live, "--state", f"{live}/state"])
    cli.main(["merge", "--input", live, "--output", out])
    assert "landed up to batch 0" in capsys.readouterr().out
    store = FeatureStore(spark, out)
    assert store.features().count() == 40
    cli.main(["merge", "--input", live, "--output", out])
    assert store.features().count() == 40


def test_command_line_collects_once(spark, tmp_path, monkeypatch):
    from wickwork import __main__ as cli
    from wickwork.sinks import files as sinks
    from wickwork.sources import files as sources

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    raw, old, out, state = (str(tmp_path / n) for n in ("raw", "old", "out", "state"))
    lines = m.message_lines(m.candle_messages(table(spark, wave("A", range(6))), closed=F.lit(True)))
    sinks.append_lines(lines.limit(2), old)
    sinks.append_lines(lines, raw)
    sinks.append_lines(lines, raw)
    args = ["collect", "--input", raw, "--output", out, "--state", state, "--duration", "20"]
    cli.main([*args, "--history", old])
    assert sources.read_collected(spark, out).count() == 6
