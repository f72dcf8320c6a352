"""The live job: messages or trades to candles, features, scores, outcomes.

Candles come out of a watermarked aggregate in append mode, so each window is
emitted once, after it is complete, and every symbol's candles reach the batch
function in time order. ``lag`` is not a streaming operator, so the features
are computed per micro-batch by the same code as in batch jobs, over the new
candles plus the last 20 of each symbol, which are kept in a small table.

All tables are written per batch id and overwritten on a replay, so a failed
batch can be run again with the same result. Kept rows are in buckets by series
(``buckets.py``), of which a batch reads and writes those it has candles for. The
last write of a batch is its progress: its id, the newest candle so far and which
kept rows count; a restart and the flush at the end go by that, not by the
query's progress report.

A window is complete when a later event moves the watermark past it. On a quiet
stream that takes a clock: ``heartbeats`` joins the passing time to the stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wickwork.operators.candles import build_candles, dedupe_candles
from wickwork.operators.features import BY, engineer_features, recent_candles
from wickwork.operators.outcomes import asof_outcomes, latest_predictions, predictions
from wickwork.operators.series import DEFAULT_CHUNK
from wickwork.operators.training import apply_model
from wickwork.schemas import (
    CANDLE_COLUMNS,
    CANDLE_SCHEMA,
    FEATURE_SCHEMA,
    MODEL_INPUTS,
    PREDICTION_SCHEMA,
    WARMUP_ROWS,
)
from wickwork.sinks.files import ALL_LEVELS, write_by_time
from wickwork.sources.messages import closed_only, klines, split_malformed, typed_candles
from wickwork.streaming.buckets import BUCKETS, Buckets

CLEAN_SCHEMA = T.StructType(
    [*FEATURE_SCHEMA.fields, T.StructField("is_warm", T.BooleanType())]
)
GENERATIONS = T.ArrayType(T.IntegerType())
PROGRESS = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("newest", T.LongType()),
        T.StructField("tail", GENERATIONS),
        T.StructField("latest", GENERATIONS),
    ]
)
WRITTEN = T.StructType(
    [T.StructField("table", T.StringType()), T.StructField("records", T.LongType()), T.StructField("batch", T.LongType())]
)
PENDING = -1
SLOTS = 3
TABLES = ("raw", "clean", "predictions", "outcomes")


def heartbeats(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """The passing time as a stream, for ``beats``: column ``timestamp``."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load().select("timestamp")


def _watermarked(rows: DataFrame, time: str, delay: str, beats: DataFrame | None) -> DataFrame:
    """``rows`` with a watermark on ``time`` that ``beats`` move on too, if given.

    Beats go up to the watermark and no further. The condition that drops them reads
    the time, as Spark moves other conditions below the watermark.
    """
    if beats is None or not rows.isStreaming:
        return rows.withWatermark(time, delay)
    clock = beats.select(F.col("timestamp").cast("timestamp").alias(time), F.lit(True).alias("_beat"))
    both = rows.withColumn("_beat", F.lit(False)).unionByName(clock, allowMissingColumns=True)
    event = F.col(time).isNotNull() & ~F.col("_beat")
    return both.withWatermark(time, delay).where(F.when(F.col(time).isNotNull(), event)).drop("_beat")


def kline_candles(lines: DataFrame, delay: str = "2 minutes", beats: DataFrame | None = None) -> DataFrame:
    """Kline messages to complete candles, resends resolved to the last arrival.

    Works on a stream and on a static table. On a stream, a candle is emitted
    once a candle starting ``delay`` later was seen; what arrives after that is
    dropped and counted by Spark. Candles without a start time are dropped. With
    ``beats`` (see ``heartbeats``) a candle is also complete ``delay`` after its start by
    the clock, without any later candle; not for a backlog, which is late by the clock.
    """
    good, _ = split_malformed(lines)
    fields = klines(good)
    if lines.isStreaming:
        closed = F.coalesce("is_closed", F.lit(False))
        fields = fields.observe(
            "ingest",
            F.count(F.lit(1)).alias("klines_received"),
            F.count_if(~closed).alias("in_progress_skipped"),
            F.count_if(closed).alias("closed_sent"),
        )
    candles = typed_candles(closed_only(fields), extra=("received_at",))
    timed = _watermarked(candles.where(F.col("timestamp").isNotNull()), "timestamp", delay, beats)
    return dedupe_candles(timed).select(*CANDLE_COLUMNS)


def trade_candles(
    trades: DataFrame,
    width: str = "1 minute",
    interval: str = "1m",
    exchange: str = "trades",
    delay: str = "2 minutes",
    beats: DataFrame | None = None,
) -> DataFrame:
    """Trades to complete candles, on a stream or a static table; ``beats`` as for klines."""
    timed = trades.withColumn("time", F.col("time").cast("timestamp"))
    return build_candles(_watermarked(timed, "time", delay, beats), width, interval, exchange)


@dataclass
class LiveJob:
    """Where a live job writes and how it scores.

    ``out`` holds the result tables and ``state`` the kept rows; both are
    shared folders. ``model`` or ``score`` turns scoring on. ``width`` is the
    candle width when candles are built from trades, as those stay open until
    their window ends; ready-made candles need none. ``chunk`` cuts the series of a
    micro-batch as in batch jobs, so that a backlog is spread over tasks; with
    ``None`` one task handles a symbol's new candles.
    """

    spark: SparkSession
    out: str
    state: str
    model: PipelineModel | None = None
    score: Column | None = None
    levels: tuple[str, ...] = ALL_LEVELS
    chunk: str | None = DEFAULT_CHUNK
    width: str = "0 seconds"
    buckets: int = BUCKETS

    def __post_init__(self):
        state, seed = self.state, f"{self.state}/seed"
        self.tail = Buckets(self.spark, f"{state}/tail", f"{seed}/tail", CANDLE_SCHEMA, BY, self.buckets)
        self.latest = Buckets(self.spark, f"{state}/latest", f"{seed}/latest", PREDICTION_SCHEMA, BY, self.buckets)

    @property
    def _scores(self) -> bool:
        return self.model is not None or self.score is not None

    # ------------------------------------------------------------ tables
    def path(self, table: str, batch_id: int) -> str:
        return f"{self.out}/{table}/batch={batch_id}"

    def _progress(self, before: int | None = None):
        """The progress of the last finished batch, or of the last one before a batch."""
        try:
            rows = self.spark.read.schema(PROGRESS).parquet(f"{self.state}/progress").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        done = [r for r in rows if before is None or r.batch < before]
        nothing = {"batch": PENDING, "newest": None, "tail": self.tail.start(), "latest": self.latest.start()}
        return max(done, key=lambda r: r.batch).asDict() if done else nothing

    def finished(self) -> int:
        """The last batch whose tables are complete, or -1."""
        return self._progress()["batch"]

    def _mark(self, progress: dict, batch_id: int) -> None:
        row = [(batch_id, progress["newest"], progress["tail"], progress["latest"])]
        self.spark.createDataFrame(row, PROGRESS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.state}/progress/slot={batch_id % SLOTS}"
        )

    def _exists(self, path: str) -> bool:
        """Whether a folder can be read, asked through Spark's own reader."""
        try:
            self.spark.read.format("text").load(path).limit(0).collect()
            return True
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def _write(self, rows: DataFrame, table: str, batch_id: int) -> None:
        write_by_time(rows, self.path(table, batch_id), levels=self.levels)

    def _count(self, tables: list[str], batch_id: int) -> None:
        """Store how many rows a batch has in each table, from the files it wrote."""
        rows = [
            (table, self.spark.read.schema("timestamp timestamp").parquet(self.path(table, batch_id)).count())
            for table in tables
        ]
        self.spark.createDataFrame(rows, "table string, records long").coalesce(1).write.mode("overwrite").parquet(
            f"{self.out}/metrics/batch={batch_id}"
        )

    def written(self) -> DataFrame:
        """(table, batches, records): what all batches wrote, restarts and replays included."""
        try:
            rows = self.spark.read.schema(WRITTEN).parquet(f"{self.out}/metrics")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], WRITTEN)
        return rows.groupBy("table").agg(
            F.count_if(F.col("records") > 0).alias("batches"), F.sum("records").alias("records")
        )

    # ------------------------------------------------------------ batches
    def seed(self, history: DataFrame) -> None:
        """Load history before the stream starts: the first batch continues it.

        The last 50 candles per symbol are kept, 30 more than the features look
        back, so up to 30 of them may come again on the stream. Once a batch
        is done its own rows count: seeding again on a restart changes nothing.
        """
        self.tail.write_seed(recent_candles(history.select(*CANDLE_COLUMNS)))

    def process(self, candles: DataFrame, batch_id: int, keep: bool = True) -> None:
        """One micro-batch. Everything after the first write reads that table."""
        self._write(candles.select(*CANDLE_COLUMNS), "raw", batch_id)
        new = self._read_raw(batch_id)
        progress = self._progress(batch_id if batch_id != PENDING else None)
        touched = self.tail.touched(new)
        if not touched:
            # Most triggers complete no candle; what is kept stays where it is.
            if keep:
                self._mark(progress, batch_id)
            return
        # Loaded history may overlap the first live candles; the live ones count.
        tail = self.tail.read(progress["tail"], touched)
        tail = tail.join(new, ["symbol", "interval", "timestamp"], "left_anti").select(*CANDLE_COLUMNS)
        both = new.withColumn("is_new", F.lit(True)).unionByName(
            tail.withColumn("is_new", F.lit(False))
        )
        features = engineer_features(both, self.chunk, warm=True, stored=True, keep=("is_new",))
        features = features.where("is_new").drop("is_new")
        self._write(features, "clean", batch_id)
        if keep:
            kept = recent_candles(both.drop("is_new"), WARMUP_ROWS)
            progress["tail"] = self.tail.write(kept, progress["tail"], touched)
        tables = ["raw", "clean"]
        if self._scores:
            progress["latest"] = self._score(new, batch_id, progress["latest"], keep)
            tables += ["predictions", "outcomes"]
        self._count(tables, batch_id)
        if keep:
            newest = new.agg(F.max(F.unix_micros("timestamp"))).first()[0]
            progress["newest"] = max((t for t in (progress["newest"], newest) if t is not None), default=None)
            self._mark(progress, batch_id)

    def _score(self, new: DataFrame, batch_id: int, generations: list[int], keep: bool) -> list[int]:
        clean = self.spark.read.schema(CLEAN_SCHEMA).parquet(self.path("clean", batch_id))
        fit = clean.where("is_warm").dropna(subset=MODEL_INPUTS)
        if self.model is not None:
            made = predictions(apply_model(self.model, fit))
        else:
            made = predictions(fit, self.score)
        self._write(made, "predictions", batch_id)
        made = self.spark.read.schema(PREDICTION_SCHEMA).parquet(self.path("predictions", batch_id))
        known = self.latest.read(generations, self.latest.touched(new))
        all_made = known.unionByName(made.select(*known.columns))
        self._write(asof_outcomes(new, all_made, self.chunk), "outcomes", batch_id)
        touched = self.latest.touched(made) if keep else []
        if touched:
            newest = latest_predictions(all_made.where(self.latest.bucket().isin(touched)))
            generations = self.latest.write(newest, generations, touched)
        return generations

    def _read_raw(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(CANDLE_SCHEMA).parquet(self.path("raw", batch_id)).select(
            *CANDLE_COLUMNS
        )

    # ------------------------------------------------------------ running
    def start(self, candles: DataFrame, available_now: bool = True, every: str = "5 seconds") -> StreamingQuery:
        """Start the query; ``available_now`` stops it when the input is read."""
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return (
            candles.writeStream.foreachBatch(lambda rows, i: self.process(rows, i))
            .option("checkpointLocation", f"{self.state}/checkpoint")
            .outputMode("append")
            .trigger(**trigger)
            .start()
        )

    def run(
        self,
        source: DataFrame,
        build: Callable[[DataFrame], DataFrame],
        flush_from: DataFrame | None = None,
        timeout: float | None = None,
    ) -> StreamingQuery:
        """Read what is there (or for ``timeout`` seconds), then stop.

        ``build`` makes candles from the source. With ``flush_from``, the same
        input as a static table, the windows still open at the end are written
        too, under batch -1. They stay in the stream's state, so a later run
        emits them again under its own id; it first empties batch -1.
        """
        self._clear_pending()
        query = self.start(build(source), available_now=timeout is None)
        if timeout is None:
            query.awaitTermination()
        else:
            query.awaitTermination(timeout)
            query.stop()
        if flush_from is not None:
            self.flush(build(flush_from))
        return query

    def _clear_pending(self) -> None:
        """Empty batch -1: a write of no rows leaves no files in its folders."""
        nothing = self.spark.createDataFrame([], CANDLE_SCHEMA)
        there = [table for table in TABLES if self._exists(self.path(table, PENDING))]
        for table in there:
            self._write(nothing, table, PENDING)
        if there:
            self._count(there, PENDING)

    def flush(self, candles: DataFrame) -> None:
        """Write the windows that no batch has written.

        Candles leave the stream in the order of their end, so those after the
        newest written one are the open ones.
        """
        newest = self._progress()["newest"]
        open_rows = candles
        if newest is not None:
            open_rows = candles.where(F.col("timestamp") > F.timestamp_micros(F.lit(newest)))
        self.process(open_rows, PENDING, keep=False)
