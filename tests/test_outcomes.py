import pytest
from helpers import candle, table, wave
from pyspark.sql import functions as F

from wickwork.operators import market as mk
from wickwork.operators import outcomes as o
from wickwork.operators.features import engineer_features


def outcomes_table(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, t long, predicted_return double, actual_return double"
    ).select(
        "symbol",
        F.timestamp_seconds("t").alias("timestamp"),
        "predicted_return",
        "actual_return",
        (F.col("predicted_return") * F.col("actual_return") > 0).alias("direction_correct"),
    )


def test_asof_takes_the_latest_earlier_prediction(spark):
    candles = table(spark, [candle("A", m, 10.0 + m) for m in range(6)] + [candle("B", 3, 1.0)])
    made = candles.where("symbol = 'A' and close in (11, 13)").select(
        "symbol", "timestamp", F.col("close").alias("current_price"),
        (F.col("close") - 12).alias("predicted_return"),
    )
    got = sorted(o.asof_outcomes(candles, made).collect(), key=lambda r: r.timestamp)
    assert [(r.timestamp.minute, r.predicted_return, r.direction_correct) for r in got] == [
        (2, -1.0, False), (3, -1.0, False), (4, 1.0, True), (5, 1.0, True),
    ]
    assert got[1].actual_return == pytest.approx((13 - 11) / 11 * 100)


def test_next_row_and_asof_agree(spark):
    rows = table(spark, wave("A", range(1, 60)) + wave("B", range(1, 90, 2)))
    features = engineer_features(rows, label=True, warm=True).where("is_warm").dropna(subset=["momentum_5"])
    direct = o.next_row_outcomes(features, o.linear_score())
    joined = o.asof_outcomes(rows, o.predictions(features, o.linear_score()))
    key = lambda r: (r.symbol, r.timestamp)
    a, b = (sorted(d.collect(), key=key) for d in (direct, joined))
    assert [key(r) for r in a] == [key(r) for r in b]
    assert [r.actual_return for r in a] == pytest.approx([r.actual_return for r in b])


def test_metrics_use_the_last_outcomes(spark):
    rows = [("A", 0, 1.0, -1.0), ("A", 1, 1.0, 2.0), ("B", 1, -1.0, 0.0), ("B", 2, 2.0, 3.0)]
    got = o.metrics(outcomes_table(spark, rows), "2024-01-01 00:00:00", n=3).first()
    assert got.total_predictions == 3
    assert got.accuracy_direction == pytest.approx(200 / 3)
    assert got.mae == pytest.approx(1.0) and got.rmse == pytest.approx(1.0)
    assert got.last_trained.year == 2024
    none = o.metrics(outcomes_table(spark, rows).limit(0)).first()
    assert none.total_predictions == 0 and none.accuracy_direction == 0.0


def test_running_accuracy(spark):
    rows = [("A", i * 4000, 1.0, 1.0 if i % 3 else -1.0) for i in range(40)]
    got = sorted(o.running_accuracy(outcomes_table(spark, rows), n=6, chunk="day").collect(), key=lambda r: r.timestamp)
    for i, r in enumerate(got):
        part = [bool(k % 3) for k in range(max(0, i - 5), i + 1)]
        assert r.counted == len(part)
        assert r.accuracy == pytest.approx(sum(part) / len(part) * 100)


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_running_accuracy_across_chunks_and_symbols(spark, n):
    rows = [
        (s, i * 30_000, 1.0, 1.0 if (i * 7 + len(s)) % 3 else -1.0)
        for s in ("A", "BB") for i in range(25)
    ]
    made = outcomes_table(spark, rows)
    made = made.withColumn("direction_correct", F.when(F.minute("timestamp") != 20, F.col("direction_correct")))
    got = o.running_accuracy(made, n=n, chunk="day").orderBy("symbol", "timestamp").collect()
    assert len(got) == 50
    for s in ("A", "BB"):
        mine = [r for r in got if r.symbol == s]
        hits = [r.direction_correct for r in mine]
        for i, r in enumerate(mine):
            part = [h for h in hits[max(0, i - n + 1) : i + 1] if h is not None]
            assert r.counted == min(i + 1, n)
            assert r.accuracy == (pytest.approx(sum(part) / len(part) * 100) if part else None)


def test_lookup(spark):
    made = o.predictions(
        table(spark, [candle("AAA", 1, 100.0)]).withColumn("momentum_5", F.lit(2.0)), o.linear_score()
    )
    metrics = o.metrics(outcomes_table(spark, [("A", 0, 1.0, 1.0)]))
    names = spark.createDataFrame([("AAA", "Triple A")], "symbol string, name string")
    asked = spark.createDataFrame([("aaa",), ("bbb",)], "symbol string")
    got = {r.symbol: r for r in o.lookup(asked, made, metrics, names).collect()}
    assert got["AAA"].status is None and got["AAA"].name == "Triple A"
    assert got["AAA"].predicted_price == pytest.approx(100.2)
    assert got["AAA"].confidence == "High" and got["AAA"].total_predictions == 1
    assert got["BBB"].status == "waiting_for_data" and got["BBB"].total_predictions is None


def trades_table(spark, rows):
    return spark.createDataFrame(
        rows, "id long, symbol string, s long, price double, quantity double, is_buyer_maker boolean"
    ).withColumn("time", F.timestamp_seconds("s"))


def test_buy_share_is_half_without_trades(spark):
    empty = trades_table(spark, [(1, "A", 0, 1.0, 1.0, True)]).limit(0)
    row = mk.buy_sell(empty).first()
    assert (row.buys, row.sells, row.buy_percent) == (0, 0, 50.0)
    both = mk.buy_sell(trades_table(spark, [(i, "A", 0, 1.0, 1.0, i == 0) for i in range(4)])).first()
    assert both.buy_percent == 75.0


def test_day_stats_window(spark):
    day = 86400
    rows = [(1, "A", 0, 50.0, 1.0, True), (2, "A", 1, 10.0, 2.0, True), (3, "A", day, 15.0, 1.0, False), (4, "B", 5, 7.0, 1.0, True)]
    got = {r.symbol: r for r in mk.day_stats(trades_table(spark, rows)).collect()}
    a = got["A"]
    assert (a.price, a.price_change, a.price_change_percent, a.direction) == (15.0, 5.0, 50.0, "up")
    assert (a.high_24h, a.low_24h, a.volume_24h, a.trade_count) == (15.0, 10.0, 3.0, 2)
    assert got["B"].direction == "flat"


def test_recent_trades(spark):
    rows = [(i, "A", i // 2, 1.0, 1.0, i % 2 == 0) for i in range(9)]
    got = mk.recent_trades(trades_table(spark, rows), 3).collect()
    assert [(r.id, r.side) for r in got] == [(8, "SELL"), (7, "BUY"), (6, "SELL")]
    per_symbol = mk.recent_trades_by_symbol(trades_table(spark, rows), 2).collect()
    assert sorted(r.id for r in per_symbol) == [7, 8]


def test_chart(spark):
    got = mk.chart_series(table(spark, [candle("A", 1, 2.0), candle("A", 0, 1.0)])).collect()
    assert [(r.time, r.close) for r in got] == [(1704067200, 1.0), (1704067260, 2.0)]
