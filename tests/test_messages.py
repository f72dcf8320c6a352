import json

import pytest
from helpers import GOLDEN, bag, candle, table
from pyspark.sql import functions as F

from wickwork.sources import messages as m


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def kline(**k):
    return json.dumps({"event_type": "kline", "symbol": "R", "exchange": "x", "data": {"k": k}})


def fields(spark, rows):
    good, _ = m.split_malformed(lines(spark, rows))
    return m.klines(good)


def test_golden_message(spark):
    row = m.candles_from_rows(spark, [GOLDEN]).first()
    assert row.timestamp.isoformat() == "2024-04-01T00:00:00"
    assert (row.symbol, row.interval, row.exchange) == ("ONETWO", "1m", "binance")
    assert (row.open, row.high, row.low, row.close) == (310.25, 314.0, 308.0, 312.5)
    assert (row.volume, row.taker_buy_volume) == (64.25, 31.5)
    assert (row.quote_volume, row.taker_buy_quote_volume) == (20010.5, 9800.75)
    assert row.number_of_trades == 37


def test_case_only_keys_stay_apart(spark):
    row = fields(spark, [kline(t=1000, T=61000, v="1", V="2", q="3", Q="4")]).first()
    assert (row.open_ms, row.close_ms) == (1000, 61000)
    assert (row.volume, row.taker_buy_volume) == (1.0, 2.0)
    assert (row.quote_volume, row.taker_buy_quote_volume) == (3.0, 4.0)


def test_close_time_keeps_or_drops_milliseconds(spark):
    f = fields(spark, [json.dumps(GOLDEN)])
    kept = m.typed_candles(f, extra=("kline_close_time",)).first().kline_close_time
    cut = m.typed_candles(f, extra=("kline_close_time",), whole_seconds=True).first().kline_close_time
    assert kept.microsecond == 999000
    assert cut.microsecond == 0 and cut.second == kept.second


def test_malformed_lines_are_set_aside(spark):
    rows = ['{"event_type":', "not json", "123", "[1,2]", "", json.dumps(GOLDEN)]
    good, bad = m.split_malformed(lines(spark, rows))
    assert good.count() == 1
    assert sorted(r.line for r in bad.collect()) == sorted(rows[:5])


def test_text_after_the_object_is_set_aside(spark):
    one = json.dumps(GOLDEN)
    rows = [one + one, one + "," + one, one + " tail", one + "}", one + "]", '{"a":1},"x":2', "null"]
    good, bad = m.split_malformed(lines(spark, [*rows, one + "  "]))
    assert good.count() == 1
    assert sorted(r.line for r in bad.collect()) == sorted(rows)


def test_every_line_arrives_as_one_row(spark):
    body = '{"e":"kline","s":"A","k":{"t":1,"x":true}}'
    rows = [
        json.dumps(GOLDEN), body, '{"stream":"a@kline_1m","data":' + body + "}",
        '{"e":"kline","s":"A","k":{"t":1}}', '{"e":"trade","s":"A"}', '{"x":1}', "oops", "",
    ]
    got = m.arrived(lines(spark, rows), arrival=F.timestamp_seconds(F.lit(5))).collect()
    assert [r.kind for r in got] == ["closed"] * 3 + ["in_progress"] + ["other"] * 2 + ["rejected"] * 2
    assert [r.line for r in got] == [None] * 6 + ["oops", ""]
    assert got[0].received_at == GOLDEN["received_at"] and got[1].received_at == 5.0
    assert [json.loads(r.data) for r in got[:3]] == [GOLDEN["data"], json.loads(body), json.loads(body)]


def test_other_events_are_dropped(spark):
    rows = [
        json.dumps({"event_type": "trade", "data": {"p": "1"}}),
        json.dumps({"e": "trade", "s": "A"}),
        kline(t=1),
    ]
    assert fields(spark, rows).count() == 1


def test_closed_rule(spark):
    rows = [kline(t=1, x=True), kline(t=2, x=False), kline(t=3)]
    f = fields(spark, rows)
    assert [r.open_ms for r in m.closed_only(f).collect()] == [1]
    assert m.typed_candles(f).count() == 3


def test_bad_numbers_become_null_or_zero(spark):
    f = fields(spark, [kline(t=1, o="abc", c="2.5", n="x")])
    row = m.typed_candles(f).first()
    assert row.open is None and row.close == 2.5 and row.number_of_trades is None
    zero = m.typed_candles(f, defaults="zero").first()
    assert zero.open == 0.0 and zero.number_of_trades == 0 and zero.volume == 0.0
    with pytest.raises(ValueError):
        m.typed_candles(f, defaults="other")


def test_missing_start_becomes_null_or_epoch(spark):
    f = fields(spark, [kline(o="1")])
    assert m.typed_candles(f).first().timestamp is None
    assert m.typed_candles(f, defaults="zero").first().timestamp.year == 1970


def test_symbol_fallback(spark):
    rows = [
        kline(s="K"),
        kline(t=1),
        json.dumps({"event_type": "kline", "data": {"k": {"t": 1}}}),
    ]
    got = [(r.symbol, r.interval) for r in m.typed_candles(fields(spark, rows)).collect()]
    assert got == [("K", "1m"), ("R", "1m"), ("UNKNOWN", "1m")]
    bare = json.dumps({"event_type": "kline", "data": {"k": {"t": 1}}})
    assert m.typed_candles(fields(spark, [bare])).first().exchange == "binance"


def test_envelope_is_unwrapped(spark):
    body = '{"e":"kline","s":"A","k":{"t":1,"x":false}}'
    rows = ['{"stream":"a@kline_1m","data":' + body + "}", body]
    got = m.unwrap_envelope(lines(spark, rows)).collect()
    assert [r.stream for r in got] == ["a@kline_1m", None]
    assert all(json.loads(r.value)["k"]["t"] == 1 for r in got)
    # both shapes parse to the same candle fields
    f = fields(spark, rows).select("open_ms", "root_symbol", "is_closed").collect()
    assert f[0] == f[1]


def test_normalise_adds_arrival(spark):
    arrival = F.timestamp_seconds(F.lit(1704067200.5))
    body = '{"stream":"a@kline_1m","data":{"e":"kline","s":"A","k":{"t":1,"x":true}}}'
    out = m.normalise(lines(spark, [body, "oops"]), arrival=arrival)
    row = out.first()
    assert out.count() == 1
    assert (row.event_type, row.symbol, row.exchange) == ("kline", "A", "binance")
    assert row.received_at == 1704067200.5
    assert row.client_timestamp == "2024-01-01T00:00:00.500000Z"
    good, _ = m.split_malformed(m.message_lines(out))
    back = m.closed_only(m.klines(good)).first()
    assert back.open_ms == 1 and back.received_at == 1704067200.5


def test_positional_arrays(spark):
    text = (
        '[1499040000000,"0.01634","0.80000","0.01575","0.01577","148976.1",'
        '1499644799999,"2434.19",308,"1756.87","28.46","0"]'
    )
    arrays = lines(spark, [text, "[1499040000000,\"1\",\"2\",\"3\",\"4\",\"5\"]"])
    full, short = m.typed_candles(m.positional_fields(arrays, F.lit("ABC"))).collect()
    assert (full.symbol, full.open, full.high, full.low, full.close) == (
        "ABC", 0.01634, 0.8, 0.01575, 0.01577,
    )
    assert full.number_of_trades == 308 and full.taker_buy_quote_volume == 28.46
    assert short.volume == 5.0 and short.quote_volume is None


def test_candles_survive_the_message_form(spark):
    rows = table(spark, [candle("A", 0, 10.5), candle("B", 1, 3.25)])
    good, _ = m.split_malformed(m.message_lines(m.candle_messages(rows)))
    assert bag(m.typed_candles(m.klines(good))) == bag(rows)


def test_subscriptions(spark):
    symbols = m.configured_symbols(spark, " aaa, ,bbb ")
    names = sorted(r.name for r in m.subscriptions(symbols, ["kline_1m", " trade "]).collect())
    assert names == ["aaa@kline_1m", "aaa@trade", "bbb@kline_1m", "bbb@trade"]
    seen = spark.createDataFrame([("aaa@trade",), ("z@trade",)], "stream string")
    assert m.subscribed(seen, names).count() == 1


def test_the_line_is_parsed_once(spark):
    good, _ = m.split_malformed(lines(spark, [json.dumps(GOLDEN)]))
    plan = m.closed_only(m.klines(good))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_messages_of_odd_candles_are_whole(spark):
    rows = [
        candle("A", 0, 1.0), candle(None, 1, 2.0), candle('q"\\x', 2, 3.0), candle("B", None, 4.0),
        candle("C", 3, 5.0, interval="1h"),
    ]
    out = m.message_lines(m.candle_messages(table(spark, rows), closed=F.lit(True)))
    good, bad = m.split_malformed(out)
    assert bad.count() == 0
    back = m.typed_candles(m.klines(good), extra=("kline_close_time",)).collect()
    assert sorted((r.symbol, r.close) for r in back) == sorted(
        [("A", 1.0), ("UNKNOWN", 2.0), ('q"\\x', 3.0), ("B", 4.0), ("C", 5.0)]
    )
    times = {r.close: r for r in back}
    assert times[4.0].timestamp is None and times[4.0].kline_close_time is None
    for close, seconds in ((1.0, 59.999), (5.0, 3599.999)):
        row = times[close]
        assert (row.kline_close_time - row.timestamp).total_seconds() == seconds
