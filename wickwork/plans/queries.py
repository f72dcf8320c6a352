"""The registered queries: each takes (spark, folder) and reads whole tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.functions.columns import direction, time_parts
from wickwork.operators import indicators, market, outcomes, quality, series
from wickwork.operators.candles import build_candles, dedupe_candles
from wickwork.operators.features import (
    engineer_features,
    recent_candles,
    serving_features,
    training_set,
)
from wickwork.operators.training import (
    TEST,
    TRAIN,
    apply_model,
    evaluate,
    load_model,
    ordered_split,
    save_model,
    train,
)
from wickwork.plans.batch import run_batch
from wickwork.schemas import CANDLE_COLUMNS, FEATURE_SCHEMA, MODEL_INPUTS, MODEL_LABEL
from wickwork.session import materialise, pin_utc, scratch_path
from wickwork.sinks.files import append_lines, collect_closed, write_by_time, write_csv_by_symbol
from wickwork.sources.files import concat, read_candles, read_collected, read_feature_csv, read_features
from wickwork.sources.messages import (
    candle_messages,
    candles_from_rows,
    closed_only,
    klines,
    message_lines,
    normalise,
    parse_lines,
    positional_fields,
    read_lines,
    split_malformed,
    stream_lines,
    subscriptions,
    typed_candles,
)
from wickwork.sources.tables import as_trades, events, hourly_candles, trades
from wickwork.streaming.compact import CompactedTable
from wickwork.streaming.landing import Landing
from wickwork.streaming.live import LiveJob, kline_candles, trade_candles
from wickwork.streaming.merge import FeatureStore

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name, run with the session zone pinned."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        pin_utc(spark)
        return fn(spark, folder)

    REGISTRY[fn.__name__] = run
    return run


# -------------------------------------------------------------------- helpers
def tidy(df: DataFrame) -> DataFrame:
    """Six decimals and zone-free timestamps, so two engines can be compared."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "double":
            c = F.round(c, 6)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        out.append(c.alias(name))
    return df.select(*out)


def dirty_candles(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly candles with repeated keys, zero lows and missing volumes put in."""
    base = hourly_candles(spark, folder)
    busy = base.where(F.col("number_of_trades") >= 5)
    return concat(base, busy).select(
        *[
            F.when(F.col("taker_buy_volume") != 0, F.col("low")).otherwise(F.lit(0.0)).alias(c)
            if c == "low"
            else F.when(F.hour("timestamp") != 0, F.col("volume")).alias(c)
            if c == "volume"
            else F.col(c)
            for c in CANDLE_COLUMNS
        ]
    )


def timed(spark: SparkSession, folder: str) -> DataFrame:
    return trades(spark, folder).withColumnRenamed("time", "timestamp")


def labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Rows fit to score, with what followed them."""
    rows = engineer_features(hourly_candles(spark, folder), label=True, warm=True)
    return rows.where("is_warm").dropna(subset=MODEL_INPUTS)


def stored_training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Training rows as a written table, for steps that read them repeatedly."""
    return materialise(training_set(hourly_candles(spark, folder)), "training")


def _is_closed() -> Column:
    return F.col("number_of_trades") >= 2


def kline_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Candles as messages; hours with one trade count as still open."""
    return candle_messages(hourly_candles(spark, folder), closed=_is_closed())


def trade_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = trades(spark, folder)
    payload = F.to_json(
        F.struct(
            F.lit("trade").alias("e"),
            F.col("symbol").alias("s"),
            F.col("price").cast("string").alias("p"),
            F.col("quantity").cast("string").alias("q"),
        )
    )
    return rows.select(
        F.lit("trade").alias("event_type"),
        "symbol",
        F.lit("events").alias("exchange"),
        payload.alias("data"),
        F.lit(None).cast("double").alias("received_at"),
        F.lit(None).cast("string").alias("client_timestamp"),
    )


def wrapped_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Both kinds of message in their ``{stream, data}`` envelope."""
    both = concat(kline_messages(spark, folder), trade_messages(spark, folder))
    kind = F.when(F.col("event_type") == "kline", F.lit("kline_1h")).otherwise(F.lit("trade"))
    text = F.concat(
        F.lit('{"stream":"'),
        F.lower("symbol"),
        F.lit("@"),
        kind,
        F.lit('","data":'),
        F.col("data"),
        F.lit("}"),
    )
    return both.select(text.alias("value"))


# ------------------------------------------------------------ candles, ingest
@query
def candles_hourly(spark, folder):
    return tidy(hourly_candles(spark, folder))


@query
def candles_by_user(spark, folder):
    return tidy(hourly_candles(spark, folder, symbol="user_id"))


@query
def trades_normalized(spark, folder):
    return tidy(trades(spark, folder))


@query
def subscription_streams(spark, folder):
    symbols = quality.distinct_symbols(trades(spark, folder))
    return subscriptions(symbols, ["kline_1m", "trade"])


@query
def kline_roundtrip(spark, folder):
    messages = concat(kline_messages(spark, folder), trade_messages(spark, folder))
    good, _ = split_malformed(message_lines(messages))
    return tidy(typed_candles(closed_only(klines(good))))


@query
def kline_history_roundtrip(spark, folder):
    """History rows carry no closed flag and are all kept."""
    lines = message_lines(candle_messages(hourly_candles(spark, folder)))
    good, _ = split_malformed(lines)
    return tidy(typed_candles(klines(good)))


@query
def positional_klines(spark, folder):
    candles = hourly_candles(spark, folder)
    start = F.unix_millis(F.col("timestamp").cast("timestamp"))
    parts = [
        start,
        *[F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in ("open", "high", "low", "close", "volume")],
        start + 3_599_999,
        F.concat(F.lit('"'), F.col("quote_volume").cast("string"), F.lit('"')),
        F.col("number_of_trades"),
        F.concat(F.lit('"'), F.col("taker_buy_volume").cast("string"), F.lit('"')),
        F.concat(F.lit('"'), F.col("taker_buy_quote_volume").cast("string"), F.lit('"')),
        F.lit('"0"'),
    ]
    text = F.concat(F.lit("["), F.concat_ws(",", *[p.cast("string") for p in parts]), F.lit("]"))
    fields = positional_fields(
        candles.select("symbol", text.alias("value")), F.col("symbol"), "1h", "events"
    )
    done = typed_candles(fields, extra=("kline_close_time",), whole_seconds=True)
    return tidy(done)


@query
def normalised_messages(spark, folder):
    arrival = F.timestamp_seconds(F.lit(1704067200))
    done = normalise(wrapped_lines(spark, folder), "events", arrival)
    return done.groupBy("event_type", "symbol", "exchange").agg(
        F.count(F.lit(1)).alias("messages"), F.max("received_at").alias("received_at")
    )


@query
def malformed_quarantine(spark, folder):
    """Lines of one-trade hours are cut in half and must end up set aside."""
    candles = hourly_candles(spark, folder)
    lines = message_lines(candle_messages(candles, closed=_is_closed()))
    broken = F.get_json_object("value", "$.data.k.n").cast("int") == 1
    half = F.expr("substring(value, 1, length(value) div 2)")
    mixed = lines.select(F.when(broken, half).otherwise(F.col("value")).alias("value"))
    good, bad = split_malformed(mixed)
    counted = concat(
        good.select(F.lit("parsed").alias("status")), bad.select(F.lit("quarantined").alias("status"))
    )
    return counted.groupBy("status").agg(F.count(F.lit(1)).alias("lines"))


def _gappy_lines(spark, folder):
    """Candle lines that lack fields: those of one-trade hours lack the close, the
    others the kline's symbol."""
    lines = message_lines(candle_messages(hourly_candles(spark, folder)))
    lone = F.get_json_object("value", "$.data.k.n").cast("int") == 1
    no_close = F.regexp_replace("value", '"c":"[^"]*",', "")
    no_symbol = F.regexp_replace("value", r'("k":\{.*?)"s":"[^"]*",', "$1")
    return lines.select(F.when(lone, no_close).otherwise(no_symbol).alias("value"))


@query
def kline_zero_defaults(spark, folder):
    """Missing numbers read as zero; a missing symbol is the record's."""
    good, _ = split_malformed(_gappy_lines(spark, folder))
    return tidy(typed_candles(klines(good), defaults="zero").drop("exchange"))


@query
def kline_null_defaults(spark, folder):
    """The same with missing numbers as NULL."""
    good, _ = split_malformed(_gappy_lines(spark, folder))
    return tidy(typed_candles(klines(good)).drop("exchange"))


@query
def stream_counters(spark, folder):
    fields = parse_lines(wrapped_lines(spark, folder)).select(
        "stream",
        F.coalesce("e", F.col("data.e")).alias("kind"),
        F.col("data.k").getItem("x").try_cast("boolean").alias("is_closed"),
    )
    return market.stream_counters(fields)


@query
def partition_columns(spark, folder):
    parts = timed(spark, folder).select(*time_parts(F.col("timestamp")))
    return parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("records"))


@query
def minute_batches(spark, folder):
    return quality.rows_per_minute(timed(spark, folder))


@query
def due_batches(spark, folder):
    rows = timed(spark, folder)
    return quality.due_batches(rows, rows.agg(F.max("timestamp")).scalar())


@query
def dedupe_latest(spark, folder):
    """Each candle meets a changed copy of itself; the later arrival stays."""
    first = hourly_candles(spark, folder).withColumn(
        "received_at", F.col("number_of_trades").cast("double")
    )
    again = first.withColumn("close", F.col("close") + 1).withColumn("received_at", F.lit(3.5))
    return tidy(dedupe_candles(concat(first, again)))


@query
def union_history_live(spark, folder):
    candles = hourly_candles(spark, folder)
    late = candles.where(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return concat(candles, late).groupBy("symbol").agg(F.count(F.lit(1)).alias("records"))


# ------------------------------------------------------------------- features
@query
def features_full(spark, folder):
    return tidy(engineer_features(hourly_candles(spark, folder)))


@query
def features_by_user(spark, folder):
    """Many thin series: only those with more than 100 candles are cut."""
    candles = hourly_candles(spark, folder, symbol="user_id")
    return tidy(engineer_features(candles, chunk="week", long_rows=100))


def _group(name: str, columns: list[str]) -> None:
    def run(spark, folder):
        rows = engineer_features(hourly_candles(spark, folder))
        return tidy(rows.select("symbol", "timestamp", *columns))

    run.__name__ = name
    query(run)


_group("features_returns", ["price_change", "price_change_pct", "log_return"])
_group("features_moving_avg", ["ma_5", "ma_10", "ma_20"])
_group("features_volatility", ["volatility_10"])
_group("features_volume", ["volume_ma_5", "volume_change_pct"])
_group("features_momentum", ["momentum_5", "momentum_10"])
_group("features_spread", ["hl_spread", "hl_spread_pct"])


@query
def serving_rows(spark, folder):
    return tidy(serving_features(hourly_candles(spark, folder)))


@query
def training_rows(spark, folder):
    return tidy(training_set(hourly_candles(spark, folder), chunk="day"))


@query
def recent_50(spark, folder):
    return tidy(recent_candles(hourly_candles(spark, folder)))


@query
def latest_candle(spark, folder):
    return tidy(series.latest_row(hourly_candles(spark, folder), ["symbol"], ["timestamp"]))


def _split(mode: str) -> Query:
    def run(spark, folder):
        split = ordered_split(stored_training_rows(spark, folder), mode, chunk="day")
        return split.groupBy("symbol", "part").agg(
            F.count(F.lit(1)).alias("records"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        )

    run.__name__ = f"ordered_split_{mode}"
    return query(run)


_split("time")
_split("table")


@query
def price_direction(spark, folder):
    rows = engineer_features(hourly_candles(spark, folder))
    moves = rows.select("symbol", direction(F.col("price_change")).alias("direction"))
    return moves.groupBy("symbol", "direction").agg(F.count(F.lit(1)).alias("records"))


# -------------------------------------------------------------------- quality
@query
def quality_report(spark, folder):
    return quality.quality_report(dirty_candles(spark, folder))


@query
def records_by_symbol(spark, folder):
    return quality.records_by_symbol(dirty_candles(spark, folder))


@query
def time_ranges(spark, folder):
    return quality.time_ranges(dirty_candles(spark, folder))


@query
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(dirty_candles(spark, folder))


@query
def invalid_prices(spark, folder):
    return tidy(quality.invalid_prices(dirty_candles(spark, folder)))


@query
def null_counts(spark, folder):
    return quality.null_counts(dirty_candles(spark, folder))


@query
def distinct_symbols(spark, folder):
    return quality.distinct_symbols(dirty_candles(spark, folder))


# ---------------------------------------------------- predictions and outcomes
@query
def predictions_latest(spark, folder):
    fit = serving_features(hourly_candles(spark, folder))
    return tidy(outcomes.predictions(fit, outcomes.linear_score()))


def _outcomes(spark, folder):
    return outcomes.next_row_outcomes(labelled_features(spark, folder), outcomes.linear_score())


@query
def prediction_outcomes(spark, folder):
    return tidy(_outcomes(spark, folder))


@query
def asof_outcomes(spark, folder):
    """Only rising momentum is predicted, so many candles look further back."""
    candles = materialise(hourly_candles(spark, folder), "candles")
    rows = engineer_features(candles, warm=True, stored=True)
    fit = rows.where("is_warm").dropna(subset=MODEL_INPUTS).where(F.col("momentum_5") > 0)
    made = outcomes.predictions(fit, outcomes.linear_score())
    return tidy(outcomes.asof_outcomes(candles, made, chunk="day"))


def two_widths(spark: SparkSession, folder: str) -> DataFrame:
    """Candles of one hour and of four, as one table."""
    wide = build_candles(trades(spark, folder), "4 hours", interval="4h", exchange="events")
    return materialise(concat(hourly_candles(spark, folder), wide), "widths")


@query
def outcomes_by_interval(spark, folder):
    """As-of outcomes and their running accuracy where a symbol has two series."""
    candles = two_widths(spark, folder)
    rows = engineer_features(candles, warm=True, stored=True)
    fit = rows.where("is_warm").dropna(subset=MODEL_INPUTS).where(F.col("momentum_5") > 0)
    made = outcomes.predictions(fit, outcomes.linear_score())
    done = outcomes.asof_outcomes(candles, made, chunk="day")
    return tidy(outcomes.running_accuracy(done, n=20, chunk="week"))


@query
def indicators_by_interval(spark, folder):
    candles = two_widths(spark, folder)
    keys = ["symbol", "interval", "timestamp"]
    parts = [
        indicators.rsi(candles, chunk="week").select(*keys, "rsi"),
        indicators.bollinger(candles).select(*keys, "upper_band"),
        indicators.sharpe(candles).select(*keys, "sharpe"),
    ]
    return tidy(parts[0].join(parts[1], keys).join(parts[2], keys))


@query
def split_by_interval(spark, folder):
    """Train and test rows of each series, and keys that occur twice: none, as copies of
    a time are of another width."""
    candles = two_widths(spark, folder)
    parts = ordered_split(candles, chunk="week").groupBy("symbol", "interval", "part").agg(
        F.count(F.lit(1)).alias("records"), F.min("timestamp").alias("first_timestamp")
    )
    again = quality.duplicate_keys(candles).select(F.count(F.lit(1)).alias("n")).scalar()
    return tidy(parts.withColumn("copies", again))


@query
def direction_accuracy(spark, folder):
    return tidy(outcomes.metrics(_outcomes(spark, folder)).drop("last_trained"))


@query
def running_accuracy(spark, folder):
    done = outcomes.running_accuracy(_outcomes(spark, folder), n=50, chunk="day")
    return tidy(done.select("symbol", "timestamp", "accuracy", "counted"))


@query
def running_accuracy_overall(spark, folder):
    done = outcomes.running_accuracy_overall(_outcomes(spark, folder), n=1000)
    return tidy(done.select("symbol", "timestamp", "accuracy", "counted"))


@query
def prediction_lookup(spark, folder):
    """Symbols of both trades and customers are asked for; the latter have none."""
    made = outcomes.predictions(
        serving_features(hourly_candles(spark, folder)), outcomes.linear_score()
    ).withColumn("symbol", F.upper("symbol"))
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    asked = concat(
        quality.distinct_symbols(trades(spark, folder)),
        customers.select(F.lower("c_mktsegment").alias("symbol")).distinct(),
    )
    overall = outcomes.metrics(_outcomes(spark, folder)).drop("last_trained")
    return tidy(outcomes.lookup(asked, made, overall))


@query
def symbol_names(spark, folder):
    """Latest candle of every user's series with the matching customer's data."""
    latest = series.latest_row(
        hourly_candles(spark, folder, symbol="user_id"), ["symbol"], ["timestamp"]
    )
    names = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("symbol"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("icon"),
    )
    return tidy(market.with_names(latest.select("symbol", "timestamp", "close"), names))


@query
def naive_evaluation(spark, folder):
    """Test-part errors of the fixed linear score."""
    split = ordered_split(stored_training_rows(spark, folder), "time")
    scored = split.where(F.col("part") == TEST).withColumn("prediction", outcomes.linear_score())
    return tidy(evaluate(scored))


# --------------------------------------------------------------------- market
@query
def buy_sell_ratio(spark, folder):
    return tidy(market.buy_sell(trades(spark, folder), ["symbol"]))


@query
def stats_24h(spark, folder):
    return tidy(market.day_stats(trades(spark, folder)))


@query
def stats_24h_panes(spark, folder):
    """The same from stored hourly panes and the trades of the hour the day begins in."""
    rows = trades(spark, folder)
    panes = materialise(market.trade_panes(rows), "panes")
    return tidy(market.day_stats_from_panes(panes, rows))


@query
def recent_trades(spark, folder):
    return tidy(market.recent_trades(trades(spark, folder)))


@query
def recent_trades_by_symbol(spark, folder):
    return tidy(market.recent_trades_by_symbol(trades(spark, folder)))


@query
def chart_series(spark, folder):
    return tidy(market.chart_series(hourly_candles(spark, folder)))


# ---------------------------------------------------------------------- sinks
@query
def csv_by_symbol(spark, folder):
    path = scratch_path(spark, "csv")
    write_csv_by_symbol(engineer_features(hourly_candles(spark, folder)), path)
    return tidy(read_feature_csv(spark, path))


@query
def csv_of_one_symbol(spark, folder):
    """One symbol's file out of the folders of all, pruned by a table of names."""
    path = scratch_path(spark, "csv")
    write_csv_by_symbol(engineer_features(hourly_candles(spark, folder)), path)
    first = quality.distinct_symbols(trades(spark, folder)).agg(F.min("symbol").alias("symbol"))
    return tidy(read_feature_csv(spark, path, symbols=first))


@query
def parquet_by_time(spark, folder):
    path = scratch_path(spark, "parquet")
    rows = engineer_features(hourly_candles(spark, folder))
    write_by_time(rows, path, levels=("year", "month", "day"))
    return tidy(read_features(spark, path))


@query
def csv_in_time_order(spark, folder):
    """Rows of each symbol's files, and how many stand before an earlier one."""
    path = scratch_path(spark, "csv")
    write_csv_by_symbol(engineer_features(hourly_candles(spark, folder)), path)
    rows = read_feature_csv(spark, path).select(
        "symbol", "timestamp", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place")
    )
    before = F.lag("timestamp").over(Window.partitionBy("symbol", "file").orderBy("place"))
    placed = rows.withColumn("before", before)
    return placed.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("before") > F.col("timestamp")).alias("out_of_order")
    )


@query
def lines_appended(spark, folder):
    """Candle lines appended twice and read back; both copies are there."""
    path = scratch_path(spark, "lines")
    lines = message_lines(kline_messages(spark, folder))
    append_lines(lines, path)
    append_lines(lines, path)
    good, _ = split_malformed(read_lines(spark, path))
    return quality.records_by_symbol(typed_candles(klines(good)))


@query
def collected_once(spark, folder):
    """Closed messages collected as a stream; those of the first half of the month came
    before, and every message of the second half is sent twice."""
    root = scratch_path(spark, "collect")
    candles = hourly_candles(spark, folder)
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    old = candles.where(F.col("timestamp") < half)
    append_lines(message_lines(candle_messages(old, closed=F.lit(True))), f"{root}/out/history")
    every = message_lines(candle_messages(concat(candles, candles), closed=F.lit(True)))
    append_lines(every, f"{root}/in")
    known = read_collected(spark, f"{root}/out")
    collect_closed(
        stream_lines(spark, f"{root}/in"), f"{root}/out", f"{root}/state", True, within="1 day", history=known
    ).awaitTermination()
    good, _ = split_malformed(read_collected(spark, f"{root}/out"))
    return quality.records_by_symbol(typed_candles(klines(good)))


# ----------------------------------------------------------------------- jobs
@query
def batch_job_report(spark, folder):
    """The whole batch job over candle lines, copies included; its report."""
    raw = scratch_path(spark, "raw")
    lines = message_lines(candle_messages(dirty_candles(spark, folder)))
    append_lines(lines, raw)
    return run_batch(spark, raw, scratch_path(spark, "job")).report


@query
def rows_to_candles(spark, folder):
    """The last 50 candles of one symbol as in-memory records, as an exchange's history
    answer has them, and back to a table."""
    candles = recent_candles(hourly_candles(spark, folder), 50)
    first = candles.agg(F.min("symbol")).scalar()
    sent = message_lines(candle_messages(candles.where(F.col("symbol") == first)))
    return tidy(candles_from_rows(spark, [json.loads(r.value) for r in sent.collect()]))


@query
def forest_learns(spark, folder):
    """A forest fitted, stored, loaded and applied where the label is the side of one input."""
    rows = stored_training_rows(spark, folder).withColumn(
        MODEL_LABEL, F.when(F.col("momentum_5") > 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    )
    split = materialise(ordered_split(rows), "split")
    path = scratch_path(spark, "model")
    save_model(train(split, trees=20), path)
    test = split.where(F.col("part") == TEST)
    scored = apply_model(load_model(path), test)
    mean = split.where(F.col("part") == TRAIN).agg(F.avg(MODEL_LABEL)).scalar()
    flat = evaluate(test.withColumn("prediction", mean)).select("rmse").scalar()
    return evaluate(scored).select((F.col("rmse") < 0.5 * flat).alias("beats_the_mean"), "test_rows")


@query
def forest_predictions(spark, folder):
    split = materialise(ordered_split(stored_training_rows(spark, folder)), "split")
    model = train(split)
    if model is None:
        return split.withColumn("prediction", F.lit(None).cast("double")).limit(0)
    scored = apply_model(model, split.where(F.col("part") == TEST))
    return tidy(outcomes.predictions(scored))


def _landing(spark, folder) -> tuple[Landing, str]:
    """Wrapped lines as a stream into the landing table. Messages of one-trade even
    hours are cut in half, and each closed candle of noon has a line glued to it."""
    root = scratch_path(spark, "landing")
    lines = wrapped_lines(spark, folder)
    payload = F.get_json_object("value", "$.data.k")
    lone = F.get_json_object(payload, "$.n").cast("int") == 1
    hour = (F.get_json_object(payload, "$.t").cast("bigint") / 3_600_000).cast("bigint") % 24
    text = (
        F.when(lone & (hour % 2 == 0), F.expr("substring(value, 1, length(value) div 2)"))
        .when(~lone & (hour == 12), F.concat("value", "value"))
        .otherwise(F.col("value"))
    )
    append_lines(lines.select(text.alias("value")), f"{root}/lines")
    job = Landing(
        spark,
        f"{root}/out",
        f"{root}/state",
        exchange="events",
        levels=("year", "month"),
        arrival=F.timestamp_seconds(F.lit(1704067200)),
    )
    job.start(stream_lines(spark, f"{root}/lines")).awaitTermination()
    return job, root


@query
def landed_lines(spark, folder):
    """Everything that arrived, by kind: messages of each symbol and rejected lines."""
    job, _ = _landing(spark, folder)
    return job.rows().groupBy("kind", "event_type", "symbol").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("data").alias("messages"),
        F.count("line").alias("lines"),
        F.max("received_at").alias("received_at"),
    )


@query
def landed_candles(spark, folder):
    """Candles read back from the raw messages that landed."""
    job, _ = _landing(spark, folder)
    return tidy(job.candles().drop("exchange"))


@query
def left_out_candles(spark, folder):
    """Of the candles that landed, those the live job had written none of: here
    the second half of the month, as it ran on the lines of the first."""
    job, root = _landing(spark, folder)
    half = F.lit("2024-01-15").cast("timestamp_ntz").cast("timestamp")
    early = job.candles().where(F.col("timestamp") < half)
    append_lines(message_lines(candle_messages(early, closed=F.lit(True))), f"{root}/early")
    live = LiveJob(spark, f"{root}/out", f"{root}/state", levels=("year", "month"))
    live.run(
        stream_lines(spark, f"{root}/early"),
        lambda lines: kline_candles(lines, "40 days"),
        flush_from=read_lines(spark, f"{root}/early"),
    )
    return quality.records_by_symbol(job.left_out(read_candles(spark, f"{root}/out/raw")))


@query
def late_candles_merged(spark, folder):
    """Features kept while candles land in three parts: those of most hours, then the
    hours left out, then busy ones again with another close and the rest unchanged."""
    root = scratch_path(spark, "merge")
    candles = hourly_candles(spark, folder)
    late = F.hour("timestamp") % 7 == 3
    busy = F.col("number_of_trades") >= 6
    again = candles.withColumn("close", F.when(busy, F.col("close") + 1).otherwise(F.col("close")))
    landing = Landing(spark, f"{root}/out", f"{root}/state", exchange="events", levels=("year",))
    store = FeatureStore(spark, f"{root}/store")
    for number, part in enumerate((candles.where(~late), candles.where(late), again.where(busy | late))):
        sent = candle_messages(part, closed=F.lit(True), received_at=F.lit(float(number)))
        landing.process(message_lines(sent), number)
        store.follow(landing)
    return tidy(store.features().drop("is_warm"))


def _stream(spark, folder, score=None) -> LiveJob:
    """Trades as a stream into hourly candles and features, flushed at the end."""
    out = scratch_path(spark, "live")
    job = LiveJob(
        spark,
        f"{out}/tables",
        f"{out}/state",
        score=score,
        levels=("year", "month"),
        width="1 hour",
    )
    _run_stream(job, folder)
    return job


def _run_stream(job: LiveJob, folder) -> None:
    spark = job.spark
    table = events(spark, folder)
    source = (
        spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )

    def build(rows):
        return trade_candles(as_trades(rows), "1 hour", "1h", "events")

    job.run(source, build, flush_from=table)


@query
def stream_features(spark, folder):
    job = _stream(spark, folder)
    return tidy(read_features(spark, f"{job.out}/clean"))


@query
def stream_features_restarted(spark, folder):
    """The same job started again with nothing new to read: nothing changes."""
    job = _stream(spark, folder)
    _run_stream(job, folder)
    return tidy(read_features(spark, f"{job.out}/clean"))


def _in_parts(job: LiveJob, candles: DataFrame, step) -> None:
    """The candles of each fifth of January as a micro-batch, then what ``step`` does."""
    stored = materialise(candles, "parts")
    part = F.least(F.floor((F.dayofmonth("timestamp") - 1) / 7), F.lit(4))
    for number in range(5):
        step(stored.where(part == number), number)


@query
def stream_replayed(spark, folder):
    """Every second micro-batch is run twice, as after a failure: nothing changes."""
    out = scratch_path(spark, "replayed")
    job = LiveJob(spark, f"{out}/tables", f"{out}/state", levels=("year", "month"))

    def step(rows, number):
        for _ in range(1 + number % 2):
            job.process(rows, number)

    _in_parts(job, hourly_candles(spark, folder), step)
    return tidy(read_features(spark, f"{job.out}/clean"))


@query
def stream_compacted(spark, folder):
    """Batches compacted while more arrive; a reader sees every row once."""
    out = scratch_path(spark, "compacted")
    job = LiveJob(spark, f"{out}/tables", f"{out}/state", levels=("year", "month"))
    table = CompactedTable(job, "clean", FEATURE_SCHEMA, ("year", "month"))

    def step(rows, number):
        job.process(rows, number)
        if number % 2:
            table.compact()

    _in_parts(job, hourly_candles(spark, folder), step)
    return tidy(table.read())


@query
def stream_after_history(spark, folder):
    """The first half of the month is loaded, the second arrives as lines."""
    out = scratch_path(spark, "bootstrap")
    half = F.lit("2024-01-15").cast("timestamp_ntz").cast("timestamp")
    candles = hourly_candles(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    job = LiveJob(spark, f"{out}/tables", f"{out}/state", levels=("year", "month"))
    job.seed(candles.where(F.col("timestamp") < half))
    lines = message_lines(candle_messages(candles.where(F.col("timestamp") >= half), closed=F.lit(True)))
    append_lines(lines, f"{out}/in")
    job.run(
        stream_lines(spark, f"{out}/in"),
        lambda rows: kline_candles(rows, "40 days"),
        flush_from=read_lines(spark, f"{out}/in"),
    )
    return tidy(read_features(spark, f"{job.out}/clean"))


@query
def stream_written(spark, folder):
    """Rows of each table by the stored counts, after a restart."""
    job = _stream(spark, folder, score=outcomes.linear_score())
    _run_stream(job, folder)
    return job.written().select("table", "records")


@query
def stream_by_the_clock(spark, folder):
    """No flush and no later trade: the last windows end by the clock."""
    out = scratch_path(spark, "clock")
    table = events(spark, folder)
    later = table.agg((F.max("ts").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("timestamp"))
    later.coalesce(1).write.parquet(f"{out}/beats")
    beats = spark.readStream.schema("timestamp timestamp").parquet(f"{out}/beats")
    job = LiveJob(spark, f"{out}/tables", f"{out}/state", levels=("year", "month"), width="1 hour")
    source = spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    job.run(source, lambda rows: trade_candles(as_trades(rows), "1 hour", "1h", "events", beats=beats))
    return tidy(read_features(spark, f"{job.out}/clean"))


@query
def stream_outcomes(spark, folder):
    job = _stream(spark, folder, score=outcomes.linear_score())
    done = spark.read.parquet(f"{job.out}/outcomes")
    return tidy(done.drop("batch", "year", "month"))


# ----------------------------------------------------------------- indicators
@query
def indicator_rsi(spark, folder):
    done = indicators.rsi(hourly_candles(spark, folder), chunk="day")
    return tidy(done.select("symbol", "timestamp", "rsi"))


@query
def indicator_bollinger(spark, folder):
    done = indicators.bollinger(hourly_candles(spark, folder))
    return tidy(done.select("symbol", "timestamp", "middle_band", "upper_band", "lower_band"))


@query
def indicator_anomalies(spark, folder):
    done = indicators.anomalies(hourly_candles(spark, folder))
    return tidy(done.select("symbol", "timestamp", "zscore", "is_anomaly"))


@query
def indicator_sharpe(spark, folder):
    done = indicators.sharpe(hourly_candles(spark, folder))
    return tidy(done.select("symbol", "timestamp", "sharpe"))


@query
def indicator_sliding(spark, folder):
    return tidy(indicators.sliding_stats(trades(spark, folder), "5 hours", "1 hour"))


@query
def indicator_macd(spark, folder):
    done = indicators.macd(hourly_candles(spark, folder), chunk="week")
    return tidy(
        done.select("symbol", "timestamp", "macd", "macd_signal", "macd_histogram")
    )
