import math

import pytest
from helpers import GOLDEN, bag, candle, table, wave

from wickwork.operators import features as f
from wickwork.schemas import DERIVED_COLUMNS, FEATURE_COLUMNS, MODEL_INPUTS
from wickwork.sources.messages import candles_from_rows


def by_time(df, symbol="A"):
    return sorted((r for r in df.collect() if r.symbol == symbol), key=lambda r: r.timestamp)


def stdev(xs):
    mean = sum(xs) / len(xs)
    return math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1))


def test_single_golden_candle(spark):
    row = f.engineer_features(candles_from_rows(spark, [GOLDEN])).first()
    assert row.__fields__ == FEATURE_COLUMNS
    nulls = {
        "price_change", "price_change_pct", "log_return", "volatility_10",
        "volume_change_pct", "momentum_5", "momentum_10",
    }
    assert {c for c in DERIVED_COLUMNS if row[c] is None} == nulls
    assert row.ma_5 == row.ma_10 == row.ma_20 == 312.5
    assert row.volume_ma_5 == 64.25 and row.hl_spread == 6.0
    assert row.hl_spread_pct == pytest.approx(6 / 308 * 100)


@pytest.mark.parametrize("chunk", [None, "hour", "week"])
def test_every_row_of_a_series(spark, chunk):
    source = wave("A", range(50, 110))
    rows = by_time(f.engineer_features(table(spark, source), chunk))
    close = [r["close"] for r in source]
    volume = [r["volume"] for r in source]
    returns = [None] + [math.log(b / a) for a, b in zip(close, close[1:])]
    for i, r in enumerate(rows):
        for n, name in ((5, "ma_5"), (10, "ma_10"), (20, "ma_20")):
            part = close[max(0, i - n + 1) : i + 1]
            assert r[name] == pytest.approx(sum(part) / len(part))
        part = volume[max(0, i - 4) : i + 1]
        assert r.volume_ma_5 == pytest.approx(sum(part) / len(part))
        if i == 0:
            assert r.price_change is None and r.log_return is None
        else:
            assert r.price_change == pytest.approx(close[i] - close[i - 1])
            assert r.price_change_pct == pytest.approx((close[i] / close[i - 1] - 1) * 100)
            assert r.log_return == pytest.approx(returns[i])
            before = volume[i - 1]
            want = None if before == 0 else pytest.approx((volume[i] - before) / before * 100)
            assert r.volume_change_pct == want
        for n, name in ((5, "momentum_5"), (10, "momentum_10")):
            want = None if i < n else pytest.approx((close[i] / close[i - n] - 1) * 100)
            assert r[name] == want
        known = [x for x in returns[max(0, i - 9) : i + 1] if x is not None]
        want = pytest.approx(stdev(known)) if len(known) > 1 else None
        assert r.volatility_10 == want


@pytest.mark.parametrize("stored", [False, True])
def test_chunks_change_nothing(spark, stored):
    minutes = [*range(0, 70), 75, 300, 301, 5000, *range(5010, 5100), 40000]
    rows = table(spark, wave("A", minutes) + wave("B", [3, 9000]) + wave("C", range(100)))
    whole = f.engineer_features(rows, None, label=True, warm=True)
    for chunk in ("hour", "day"):
        cut = f.engineer_features(rows, chunk, label=True, warm=True, stored=stored)
        assert bag(cut) == bag(whole)


def test_edge_rows(spark):
    rows = [
        candle("zero", 0, 10.0, volume=0.0),
        candle("zero", 1, 10.0, volume=5.0, low=0.0),
        candle("neg", 0, 5.0),
        candle("neg", 1, -1.0),
        candle("neg", 2, 5.0),
        candle("none", 0, 5.0),
        candle("none", 1, None),
        candle("gap", 1, 10.0),
        candle("gap", 2, 20.0),
        candle("gap", 5, 30.0),
    ]
    done = f.engineer_features(table(spark, rows))
    zero = by_time(done, "zero")
    assert zero[1].volume_change_pct is None and zero[1].hl_spread_pct is None
    assert zero[1].log_return == 0.0
    neg = by_time(done, "neg")
    assert neg[1].log_return is None and neg[2].log_return is None
    assert neg[1].price_change_pct == pytest.approx(-120.0)
    none = by_time(done, "none")
    assert none[1].price_change is None and none[1].ma_5 == 5.0
    gap = by_time(done, "gap")
    assert gap[2].price_change == 10.0


def test_rows_without_time_or_symbol_are_kept(spark):
    rows = [candle("A", None, 1.0), candle(None, 1, 2.0), candle("A", 1, 3.0)]
    assert f.engineer_features(table(spark, rows)).count() == 3


def test_serving_needs_twenty_candles(spark):
    rows = table(spark, wave("A", range(20)) + wave("B", range(19)))
    got = f.serving_features(rows).collect()
    assert [r.symbol for r in got] == ["A"]
    whole = by_time(f.engineer_features(rows))[-1]
    assert all(got[0][c] == pytest.approx(whole[c]) for c in MODEL_INPUTS)


def test_serving_skips_a_null_input(spark):
    rows = wave("A", range(25))
    rows[-2]["volume"] = 0.0
    assert f.serving_features(table(spark, rows)).count() == 0


def test_training_rows(spark):
    source = wave("A", range(1, 40))
    for r in source:
        r["volume"] = 1.0 + r["volume"]
    rows = by_time(f.training_set(table(spark, source)))
    assert len(rows) == 39 - 10 - 1
    for r in rows:
        assert r.target_return == pytest.approx((r.next_close / r.close - 1) * 100)
    again = by_time(f.labelled(f.engineer_features(table(spark, source))))
    assert [r.target_return for r in again] == pytest.approx([r.target_return for r in rows])


def test_recent_window(spark):
    got = by_time(f.recent_candles(table(spark, wave("A", range(80)))))
    assert len(got) == 50 and got[0].timestamp.minute == 30


def test_one_wide_shuffle(spark, folder):
    """Candles are built once and the rows move once more, by symbol and chunk."""
    from wickwork.plans.queries import REGISTRY

    df = REGISTRY["features_full"](spark, folder)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan


def test_intervals_are_series_of_their_own(spark):
    rows = wave("A", range(30))
    wide = [dict(r, interval="5m") for r in wave("A", range(0, 30, 5), base=900.0)]
    apart = bag(f.engineer_features(table(spark, rows))) + bag(f.engineer_features(table(spark, wide)))
    assert bag(f.engineer_features(table(spark, rows + wide))) == sorted(apart)
