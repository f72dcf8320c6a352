import glob
import json
import os

import pytest
from helpers import GOLDEN, bag, candle, table, wave
from pyspark.sql import functions as F

from wickwork.operators import training as t
from wickwork.operators.features import engineer_features, training_set
from wickwork.plans import batch
from wickwork.schemas import FEATURE_COLUMNS, MODEL_INPUTS, MODEL_LABEL
from wickwork.sinks import files as sinks
from wickwork.sources import files as sources
from wickwork.sources import messages as m


def features(spark):
    return engineer_features(table(spark, wave("A", range(1, 60)) + wave("B", range(1, 30))))


def test_parquet_by_time(spark, tmp_path):
    rows, path = features(spark), str(tmp_path / "t")
    sinks.write_by_time(rows, path)
    assert os.path.isdir(f"{path}/year=2024/month=01/day=01/hour=00/minute=07")
    assert all(f.endswith(".snappy.parquet") for f in glob.glob(f"{path}/**/part-*", recursive=True))
    # one file per minute holds all symbols
    assert len(glob.glob(f"{path}/year=2024/month=01/day=01/hour=00/minute=07/part-*")) == 1
    assert bag(sources.read_features(spark, path)) == bag(rows)
    pruned = spark.read.parquet(path).where("minute = '07'")
    assert "minute" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    # replacing some folders leaves the others alone
    sinks.write_by_time(rows.where("minute(timestamp) = 7 and symbol = 'A'"), path, replace="folders")
    assert sources.read_features(spark, path).count() == rows.count() - 1


def test_csv_by_symbol(spark, tmp_path):
    rows, path = features(spark), str(tmp_path / "c")
    counts = {r.symbol: r.records for r in sinks.write_csv_by_symbol(rows, path).collect()}
    assert counts == {"A": 59, "B": 29}
    (one,) = glob.glob(f"{path}/series=A/part-*.csv")
    text = open(one).read().splitlines()
    assert text[0].split(",") == FEATURE_COLUMNS
    stamps = [line.split(",")[0] for line in text[1:]]
    assert stamps == sorted(stamps) and len(stamps) == 59
    assert bag(sources.read_feature_csv(spark, path)) == bag(rows)
    # flat files read the same way
    assert sources.read_feature_csv(spark, f"{path}/series=B").count() == 29
    # overwrite drops what was there
    sinks.write_csv_by_symbol(rows.where("symbol = 'B'"), path)
    assert sources.read_feature_csv(spark, path).count() == 29


def test_lines_are_appended(spark, tmp_path):
    path = str(tmp_path / "l")
    one = spark.createDataFrame([(json.dumps(GOLDEN),)], "value string")
    sinks.append_lines(one, path)
    sinks.append_lines(one, path)
    assert m.load_candles(spark, path).count() == 2
    assert m.load_candles(spark, path, live=True).count() == 2


def test_a_collection_keeps_its_history(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    old = spark.createDataFrame([(json.dumps(GOLDEN),)] * 3, "value string")
    live = spark.createDataFrame([(json.dumps(GOLDEN["data"]),)] * 2, "value string")
    sinks.append_lines(live, path)
    for _ in range(2):
        sinks.write_history(old, out)
        query = sinks.collect_closed(m.stream_lines(spark, path), out, str(tmp_path / "cp"), True)
        query.awaitTermination()
        assert sources.read_collected(spark, out).count() == 5
    assert sources.read_collected(spark, str(tmp_path / "none")).count() == 0


def test_collecting_closed_messages(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    body = '{"e":"kline","s":"A","k":{"t":%d,"s":"A","x":%s}}'
    rows = [
        body % (1, "true"),
        body % (2, "false"),
        '{"stream":"a@kline_1m","data":' + body % (3, "true") + "}",
        '{"e":"kline","s":"A","k":{"t":4}}',
        '{"e":"trade","s":"A"}',
        "broken",
    ]
    sinks.append_lines(spark.createDataFrame([(r,) for r in rows], "value string"), path)
    state = str(tmp_path / "cp")
    query = sinks.collect_closed(m.stream_lines(spark, path), out, state, available_now=True)
    query.awaitTermination(60)
    good, _ = m.split_malformed(sources.read_collected(spark, out))
    got = m.klines(good)
    assert sorted(r.open_ms for r in got.collect()) == [1, 3]
    assert got.where("received_at is null or exchange != 'binance'").count() == 0


def test_command_line(spark, tmp_path, monkeypatch):
    from wickwork import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    source = [{**r, "volume": r["volume"] + 1} for r in wave("A", range(1, 60))]
    lines = m.message_lines(m.candle_messages(table(spark, source), closed=F.lit(True)))
    sinks.append_lines(lines, raw)
    cli.main(["batch", "--input", raw, "--output", out])
    assert sources.read_features(spark, f"{out}/features").count() == 59
    cli.main(["train", "--input", f"{out}/csv", "--output", f"{out}/model"])
    cli.main(
        ["live", "--input", raw, "--output", f"{out}/live", "--state", f"{out}/state", "--model", f"{out}/model"]
    )
    assert spark.read.parquet(f"{out}/live/clean").count() == 59
    assert spark.read.parquet(f"{out}/live/outcomes").count() == 39


def test_union_keeps_copies(spark):
    rows = table(spark, [candle("A", 0)])
    assert sources.concat(rows, rows, rows.drop("volume")).count() == 3


@pytest.mark.parametrize("mode", ["time", "table"])
def test_ordered_split(spark, mode):
    rows = table(spark, [candle("A", i) for i in range(11)] + [candle("B", i) for i in range(6)])
    got = t.ordered_split(rows, mode, chunk="hour").collect()
    test = sorted((r.symbol, r.timestamp.minute) for r in got if r.part == "test")
    if mode == "table":
        # ceil(0.2 * 17) = 4 rows at the end of the last symbol
        assert test == [("B", 2), ("B", 3), ("B", 4), ("B", 5)]
    else:
        assert test == [("A", 8), ("A", 9), ("A", 10), ("B", 4), ("B", 5)]


def planted(spark, n=400):
    """Inputs where the label follows one of them."""
    names = [*MODEL_INPUTS, MODEL_LABEL]
    rows = spark.range(n).select(
        F.lit("A").alias("symbol"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
        *[F.sin(F.col("id") * (i + 1) / 7.0).alias(c) for i, c in enumerate(MODEL_INPUTS)],
    )
    return rows.withColumn(MODEL_LABEL, F.col("momentum_5") * 3).select("symbol", "timestamp", *names)


def test_model_beats_the_mean_and_survives_saving(spark, tmp_path):
    split = t.ordered_split(planted(spark))
    model = t.train(split, trees=20)
    test = split.where("part = 'test'")
    score = t.evaluate(t.apply_model(model, test)).first()
    mean = split.where("part = 'train'").agg(F.avg(MODEL_LABEL)).first()[0]
    flat = t.evaluate(test.withColumn("prediction", F.lit(mean))).first()
    assert score.rmse < 0.5 * flat.rmse and score.test_rows == 80
    t.save_model(model, str(tmp_path / "model"))
    again = t.load_model(str(tmp_path / "model"))
    assert bag(t.apply_model(again, test)) == bag(t.apply_model(model, test))


def test_model_defaults(spark):
    forest = t.forest().getStages()[1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)


def test_small_tables_are_not_trained_on(spark, tmp_path):
    assert t.train(t.ordered_split(planted(spark, 9))) is None
    empty = features(spark).limit(0)
    assert batch.train_on(empty, str(tmp_path / "m")) == (None, None)


def test_batch_job(spark, tmp_path):
    raw, out, model = (str(tmp_path / n) for n in ("raw", "out", "model"))
    source = [
        {**r, "volume": r["volume"] + 1} for r in wave("A", range(1, 90)) + wave("B", range(1, 90))
    ]
    candles = table(spark, source)
    sinks.append_lines(m.message_lines(m.candle_messages(candles)), raw)
    resent = m.candle_messages(candles.limit(1), received_at=F.lit(5.0))
    sinks.append_lines(m.message_lines(resent), raw)
    sinks.append_lines(spark.createDataFrame([('{"event_type":',)], "value string"), raw)
    done = batch.run_batch(spark, raw, out, model_path=model)
    assert bag(done.features) == bag(engineer_features(candles))
    assert {r.symbol: r.records for r in done.counts.collect()} == {"A": 89, "B": 89}
    report = {(r.check, r.key): r.value for r in done.report.collect()}
    assert report[("total_records", None)] == "179"
    assert report[("duplicate_timestamps", None)] == "1"
    assert done.quarantine.count() == 1
    assert done.evaluation.first().test_rows == 2 * 16
    assert batch.load_model(model).stages
    model2, _ = batch.train_from_csv(spark, f"{out}/csv", str(tmp_path / "m2"))
    assert model2 is not None
    fit = training_set(candles)
    assert bag(t.apply_model(model2, fit).select("prediction")) == bag(
        t.apply_model(done.model, fit).select("prediction")
    )
