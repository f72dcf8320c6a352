import random

import pytest
from helpers import START, bag, candle, table
from pyspark.sql import functions as F

from wickwork.operators import series

BY, ORDER = ["symbol"], ["timestamp"]


def sparse(spark, seed, n=120):
    """Series with long gaps, so that chunks hold from none to many rows."""
    rnd = random.Random(seed)
    rows = []
    for symbol in ("A", "B", None):
        minute = 0
        for i in range(n if symbol != "B" else 15):
            minute += rnd.choice([1, 1, 1, 5, 60, 700, 4000])
            rows.append(candle(symbol, minute, float(i)))
    rows.append(candle("A", None, -1.0))
    rnd.shuffle(rows)
    return table(spark, rows)


@pytest.mark.parametrize("unit, long_rows", [("hour", None), ("day", 50), ("week", None), ("week", 0)])
@pytest.mark.parametrize("seed", [1, 2])
def test_halo_windows_equal_whole_series_windows(spark, unit, long_rows, seed):
    rows = sparse(spark, seed)

    def windows(df, w):
        return df.select(
            "*",
            F.lag("close", 7).over(w).alias("back"),
            F.lead("close", 2).over(w).alias("forth"),
            F.sum("close").over(w.rowsBetween(-7, 2)).alias("around"),
        )

    haloed = series.with_halo(rows, BY, ORDER, unit, before=7, after=2, long_rows=long_rows)
    got = series.own_rows(windows(haloed, series.chunk_window(BY, ORDER)))
    want = windows(rows, series.series_window(BY, ORDER))
    assert bag(got) == bag(want)


def test_halo_copies_are_exactly_the_rows_needed(spark):
    rows = sparse(spark, 3)
    haloed = series.with_halo(rows, BY, ORDER, "day", before=4)
    per_chunk = haloed.groupBy("symbol", series.CHUNK).agg(
        F.count_if(~F.col(series.OWN)).alias("copies"), F.count_if(series.OWN).alias("own")
    )
    assert per_chunk.where("copies > 4 or own = 0").count() == 0


def test_short_series_stay_in_one_piece(spark):
    rows = sparse(spark, 3)
    haloed = series.with_halo(rows, BY, ORDER, "hour", before=4, long_rows=50)
    copied = haloed.where(~F.col(series.OWN)).select("symbol").distinct().collect()
    assert {r.symbol for r in copied} == {"A", None}
    assert haloed.where("symbol = 'B'").select(series.CHUNK).distinct().count() == 1


def test_slim_halo_reads_only_what_is_needed(spark):
    rows = sparse(spark, 4)
    haloed = series.with_halo(rows, BY, ORDER, "day", before=1, needed=["close"])
    copy = haloed.where(~F.col(series.OWN)).first()
    assert copy.close is not None and copy.open is None and copy.volume is None


@pytest.mark.parametrize("unit", ["hour", "week"])
def test_series_index(spark, unit):
    rows = sparse(spark, 5)
    got = series.series_index(rows, "symbol", ORDER, unit).collect()
    key = lambda r: (r.symbol is not None, r.symbol or "", r.timestamp is not None, r.timestamp or START.replace(tzinfo=None))
    ordered = sorted(got, key=key)
    assert [r.table_pos for r in ordered] == list(range(len(ordered)))
    sizes = {}
    for r in ordered:
        assert r.series_pos == sizes.get(r.symbol, 0)
        sizes[r.symbol] = r.series_pos + 1
    assert all(r.series_rows == sizes[r.symbol] and r.table_rows == len(got) for r in got)


@pytest.mark.parametrize("unit", ["hour", "week", None])
def test_last_before_against_brute_force(spark, unit):
    rows = sparse(spark, 6).where(F.col("timestamp").isNotNull())
    marks = rows.where(F.col("close") % 5 == 0).select(
        "symbol", F.col("timestamp").alias("made_at"), (F.col("close") * 10).alias("mark")
    )
    got = series.last_before(
        rows.select("symbol", "timestamp", "close"), marks, BY, "timestamp", "made_at", "seen", unit
    ).collect()
    known = marks.collect()
    assert len(got) == rows.count()
    for r in got:
        earlier = [m for m in known if m.symbol == r.symbol and m.made_at < r.timestamp]
        best = max(earlier, key=lambda m: m.made_at, default=None)
        assert (r.seen.mark if r.seen else None) == (best.mark if best else None)


def test_recent_rows_are_limited_before_the_shuffle(spark):
    rows = sparse(spark, 7)
    recent = series.recent_rows(rows, BY, ORDER, 5)
    assert recent.groupBy("symbol").count().where("count != 5").count() == 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
