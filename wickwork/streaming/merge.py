"""Late and corrected candles merged into stored features.

The live job writes a candle once and leaves out what comes later. This store
takes candles in any order. A candle that is new or changed alters its own
features and those of the LOOKBACK rows after it, so only these rows are computed
again, from themselves and the LOOKBACK rows before. Their folders, and no others,
are replaced, candles and features in one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.functions.columns import time_parts
from wickwork.operators import series
from wickwork.operators.candles import dedupe_candles
from wickwork.operators.features import BY, LOOKBACK, engineer_features
from wickwork.schemas import CANDLE_SCHEMA, FEATURE_SCHEMA
from wickwork.session import materialise
from wickwork.sinks.versioned import State, VersionedTables
from wickwork.streaming.landing import Landing

CANDLES, FEATURES = "candles", "features"
KEYS = [*BY, "timestamp"]
ARRIVED = T.StructType([*CANDLE_SCHEMA.fields, T.StructField("received_at", T.DoubleType())])
STORED = T.StructType([*FEATURE_SCHEMA.fields, T.StructField("is_warm", T.BooleanType())])


def _mirrored(time: str):
    """A time whose order is reversed."""
    return F.timestamp_micros(-F.unix_micros(time))


def rows_after(rows: DataFrame, marks: DataFrame, n: int, chunk: str, backward: bool = False) -> DataFrame:
    """The keys of the ``n`` rows that follow each mark in its series, or come before it.

    A row counts for the mark next to it; each task keeps ``n`` rows of a mark
    before anything is shuffled for their ranks.
    """
    time = _mirrored("timestamp") if backward else F.col("timestamp")
    own = rows.select(*KEYS, time.alias("at"))
    seen = series.last_before(own, marks.select(*BY, time.alias("mark")), BY, "at", "mark", "seen", chunk)
    near = seen.where(F.col("seen").isNotNull()).select(*KEYS, "at", F.col("seen.mark").alias("mark"))
    rank = F.row_number().over(Window.partitionBy(*BY, "mark").orderBy("at"))
    return near.withColumn("rank", rank).where(F.col("rank") <= n).select(*KEYS)


class FeatureStore:
    """Candles and features below ``path``, kept equal to a batch job over all that arrived."""

    def __init__(
        self, spark: SparkSession, path: str, levels: tuple[str, ...] = ("year", "month", "day"),
        chunk: str = series.DEFAULT_CHUNK,
    ):
        self.spark, self.chunk = spark, chunk
        self.tables = VersionedTables(spark, path, {CANDLES: ARRIVED, FEATURES: STORED}, levels)

    def candles(self) -> DataFrame:
        return self.tables.read(CANDLES)

    def features(self) -> DataFrame:
        return self.tables.read(FEATURES)

    def follow(self, landing: Landing) -> State:
        """Merge what has landed since the last time; the commit notes how far that is."""
        state = self.tables.state()
        # What lands in the meantime may be read now and again next time.
        newest = landing.newest_batch()
        rows = landing.candles(after=state.note, extra=("received_at",))
        return self.merge(rows, note=max(state.note, newest), state=state)

    def merge(self, arrivals: DataFrame, note: int | None = None, state: State | None = None) -> State:
        """Take candles (with ``received_at``) in; of copies the last arrival counts.

        Candles without a start time have no place in a series and are left out.
        Without anything new or changed, only the note is written.
        """
        state = state or self.tables.state()
        late = dedupe_candles(arrivals.select(*ARRIVED.names).where(F.col("timestamp").isNotNull()))
        late = materialise(late, "late")
        touched = self.tables.folders_of(late)
        stored = self.tables.read(CANDLES, state, touched)
        merged = materialise(dedupe_candles(stored.unionByName(late)), "merged")
        changed = materialise(merged.subtract(stored), "changed")
        folders = self.tables.folders_of(changed)
        if not folders:
            return self.tables.replace(state, {}, note)
        candles = merged.where(self._inside(folders))
        content = {CANDLES: (candles, folders)}
        # A copy that differs in its arrival only moves no feature.
        names = CANDLE_SCHEMA.names
        moved = materialise(merged.select(*names).subtract(stored.select(*names)).select(*KEYS), "moved")
        if not moved.isEmpty():
            features, dirty = self._recomputed(state, folders, candles, moved)
            places = self.tables.folders_of(dirty)
            kept = series.attach(self.tables.read(FEATURES, state, places), dirty, KEYS, "left_anti")
            content[FEATURES] = kept.unionByName(features), places
        return self.tables.replace(state, content, note)

    def _inside(self, folders: list[tuple]):
        """Whether a row belongs to one of ``folders``."""
        place = F.concat_ws("/", *time_parts(F.col("timestamp"), self.tables.levels))
        return place.isin(["/".join(f) for f in folders])

    def _recomputed(
        self, state: State, folders: list[tuple], candles: DataFrame, marks: DataFrame
    ) -> tuple[DataFrame, DataFrame]:
        """Features of the rows that a change at the keys ``marks`` reaches, and their keys.

        ``candles`` is the new content of ``folders``. Of the others the keys are read, and
        whole rows only of the folders that hold a row needed.
        """

        def now(places) -> DataFrame:
            rest = self.tables.read(CANDLES, state, [f for f in places if f not in set(folders)])
            return rest.unionByName(candles)

        keys = now(state.folders.get(CANDLES, {})).select(*KEYS)
        own = series.attach(keys, marks.select(*BY).distinct(), BY, "left_semi")
        dirty = marks.union(rows_after(own, marks, LOOKBACK, self.chunk)).distinct()
        dirty = materialise(dirty, "dirty")
        before = rows_after(own, marks, LOOKBACK, self.chunk, backward=True)
        before = series.attach(before, dirty, KEYS, "left_anti")
        needed = dirty.withColumn("is_dirty", F.lit(True)).union(before.distinct().withColumn("is_dirty", F.lit(False)))
        needed = materialise(needed, "needed")
        region = materialise(series.attach(now(self.tables.folders_of(needed)), needed, KEYS), "region")
        done = engineer_features(region, self.chunk, warm=True, stored=True, keep=("is_dirty",))
        return materialise(done.where("is_dirty").drop("is_dirty"), "recomputed"), dirty
