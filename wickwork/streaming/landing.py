"""Everything that arrives, stored as it came: the raw side of a live job.

The live job writes complete candles. This one writes every line of the same
input before any rule is applied, one row each, in folders by kind and arrival
time: closed klines, klines in progress, other events, unreadable lines. So
the kinds add up to the lines read, and what the live job leaves out (late
candles, candles without a start time) can be told from the two tables.

A message is also stored as a variant. Later steps take the paths they need from
that and parse no text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wickwork.schemas import CANDLE_COLUMNS, DEFAULT_EXCHANGE, LANDED_SCHEMA, MESSAGE_SCHEMA
from wickwork.sinks.files import ALL_LEVELS, write_by_time
from wickwork.sources.messages import (
    CLOSED,
    REJECTED,
    arrived,
    payload_fields,
    typed_candles,
)

LANDED = "landed"
PAYLOAD = "payload"


@dataclass
class Landing:
    """Where lines land: below ``out``, beside the tables of the live job.

    Each micro-batch is a folder of its own, overwritten when it is replayed, so
    nothing is lost or stored twice by a restart. ``arrival`` defaults to the time
    of the micro-batch.
    """

    spark: SparkSession
    out: str
    state: str
    exchange: str = DEFAULT_EXCHANGE
    levels: tuple[str, ...] = ALL_LEVELS
    arrival: Column | None = None

    def process(self, lines: DataFrame, batch_id: int) -> None:
        rows = arrived(lines, self.exchange, self.arrival)
        write_by_time(
            rows.withColumn(PAYLOAD, F.try_parse_json(F.col("data"))),
            f"{self.out}/{LANDED}/batch={batch_id}",
            time="arrival",
            levels=self.levels,
            first=("kind",),
        )

    def start(
        self, lines: DataFrame, available_now: bool = True, every: str = "5 seconds"
    ) -> StreamingQuery:
        """Start the query; ``available_now`` stops it when the input is read."""
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return (
            lines.writeStream.foreachBatch(lambda rows, i: self.process(rows, i))
            .option("checkpointLocation", f"{self.state}/landing")
            .trigger(**trigger)
            .start()
        )

    # ------------------------------------------------------------ reading
    def _stored(self) -> DataFrame:
        """All that has landed, with its micro-batch."""
        own = [T.StructField(PAYLOAD, T.VariantType()), T.StructField("batch", T.LongType())]
        schema = T.StructType([*LANDED_SCHEMA.fields, *own])
        try:
            return self.spark.read.schema(schema).parquet(f"{self.out}/{LANDED}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def newest_batch(self) -> int:
        """The last micro-batch that has rows, or -1."""
        newest = self._stored().agg(F.max("batch")).first()[0]
        return -1 if newest is None else newest

    def _after(self, after: int | None) -> DataFrame:
        stored = self._stored()
        return stored if after is None else stored.where(F.col("batch") > after)

    def rows(self, after: int | None = None) -> DataFrame:
        """What has landed, as ``LANDED_SCHEMA``: all, or only micro-batches after one.
        Filters on batch and kind prune folders."""
        return self._after(after).select(*LANDED_SCHEMA.names)

    def messages(self, after: int | None = None) -> DataFrame:
        """The raw messages of closed klines."""
        return self.rows(after).where(F.col("kind") == CLOSED).select(*MESSAGE_SCHEMA.names)

    def rejected(self) -> DataFrame:
        """Lines that are not one JSON object, with their arrival."""
        return self.rows().where(F.col("kind") == REJECTED).select("arrival", "line")

    def counts(self) -> DataFrame:
        """Rows of each kind; they add up to the lines read."""
        return self.rows().groupBy("kind").agg(F.count(F.lit(1)).alias("records"))

    def candles(self, after: int | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
        """Typed candles of the closed klines, copies included."""
        closed = self._after(after).where(F.col("kind") == CLOSED)
        return typed_candles(payload_fields(closed, PAYLOAD), extra=extra)

    def left_out(self, written: DataFrame) -> DataFrame:
        """Closed candles whose key is in no row of ``written``, the candles that the
        live job wrote: those too late, those without a start time and those still
        open. Copies are included."""
        keys = ["symbol", "interval", "timestamp"]
        known = written.select(*keys).distinct()
        return self.candles().join(known, keys, "left_anti").select(*CANDLE_COLUMNS)
