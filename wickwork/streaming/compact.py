"""Many small batches of a live job swapped for time folders.

A live job writes a folder for each micro-batch. Compaction moves the finished ones
into time folders and then says in one commit record up to which batch it did; a
reader takes the folders of that record and the batches after it, so it sees
every row once, before, during and after the swap.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.sinks.files import write_by_time
from wickwork.sinks.versioned import State, VersionedTables
from wickwork.streaming.live import PENDING, LiveJob


class CompactedTable:
    """One table of a live job, read across its batches and what was compacted."""

    def __init__(self, job: LiveJob, table: str, schema: T.StructType, levels: tuple[str, ...] = ("year", "month", "day")):
        self.job, self.table, self.schema = job, table, schema
        self.tables = VersionedTables(job.spark, f"{job.out}/compacted/{table}", {table: schema}, levels)

    def _batches(self) -> DataFrame:
        """The rows of all batch folders; filters on batch prune them."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        try:
            return self.job.spark.read.schema(schema).parquet(f"{self.job.out}/{self.table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.job.spark.createDataFrame([], schema)

    def read(self, state: State | None = None) -> DataFrame:
        """Every row once: the folders of a commit record, the batches after it and the
        flushed part, which belongs to no batch yet."""
        state = state or self.tables.state()
        rest = self._batches().where((F.col("batch") > state.note) | (F.col("batch") == PENDING))
        return self.tables.read(self.table, state).unionByName(rest.select(*self.schema.names))

    def compact(self) -> State:
        """Take the finished batches in. Only the time folders that they have rows for
        are written again. The files of batches that the record before already had
        are removed now, when no reader of an earlier record should need them."""
        state, done = self.tables.state(), self.job.finished()
        if done <= state.note:
            return state
        own = self._batches().where(F.col("batch").between(state.note + 1, done)).select(*self.schema.names)
        folders = self.tables.folders_of(own)
        whole = self.tables.read(self.table, state, folders).unionByName(own)
        new = self.tables.replace(state, {self.table: (whole, folders)}, note=done)
        if state.note >= 0:
            self._empty(state.note)
        return new

    def _empty(self, upto: int) -> None:
        """Overwrite the batches that have rows, up to ``upto``, with none."""
        left = self._batches().where(F.col("batch").between(0, upto)).select("batch").distinct()
        nothing = self.job.spark.createDataFrame([], self.schema)
        for row in left.collect():
            # By folders: without rows nothing is left, not even an empty file.
            write_by_time(nothing, self.job.path(self.table, row.batch), levels=self.job.levels)
