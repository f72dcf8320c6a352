"""Tables in time folders whose folders are replaced together, by a commit record.

A change writes the new content of the folders it touches below a version of its
own and then one small record that names the version of every folder, for all
tables at once. Readers follow the newest record, so they see a change whole
or not at all, and folders that a change does not touch are not written again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.functions.columns import time_parts
from wickwork.sinks.files import write_by_time

# The newest records are kept; a change overwrites the oldest of them.
RECORDS = 8


@dataclass
class State:
    """A commit record: its number, a note of the writer's, and the version of each
    folder of each table. It has as many entries as there are folders."""

    number: int = -1
    note: int = -1
    folders: dict[str, dict[tuple, int]] = field(default_factory=dict)


class VersionedTables:
    """Tables below ``path``, each with a schema that has the column ``timestamp``.

    One writer at a time. A writer that dies leaves a version that no record
    names; the next change writes the same version again.
    """

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, T.StructType], levels: tuple[str, ...]):
        self.spark, self.path, self.schemas, self.levels = spark, path, schemas, levels
        self.record = T.StructType(
            [
                T.StructField("number", T.LongType()),
                T.StructField("note", T.LongType()),
                T.StructField("table", T.StringType()),
                T.StructField("version", T.LongType()),
                *[T.StructField(level, T.StringType()) for level in levels],
            ]
        )

    # ------------------------------------------------------------ reading
    def state(self) -> State:
        try:
            records = self.spark.read.schema(self.record).parquet(f"{self.path}/commits")
            newest = records.agg(F.max("number")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            newest = None
        if newest is None:
            return State()
        found = State(newest)
        for row in records.where(F.col("number") == newest).collect():
            found.note = row.note
            if row.table is not None:
                place = tuple(row[level] for level in self.levels)
                found.folders.setdefault(row.table, {})[place] = row.version
        return found

    def read(self, table: str, state: State | None = None, folders=None) -> DataFrame:
        """A table as of ``state``, or only those of its ``folders`` that exist."""
        state = state or self.state()
        own = state.folders.get(table, {})
        places = own if folders is None else [f for f in folders if f in own]
        schema = self.schemas[table]
        if not places:
            return self.spark.createDataFrame([], schema)
        paths = [self._folder(table, own[place], place) for place in places]
        base = f"{self.path}/{table}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def _folder(self, table: str, version: int, place: tuple) -> str:
        below = "/".join(f"{level}={part}" for level, part in zip(self.levels, place, strict=True))
        return f"{self.path}/{table}/version={version}/{below}"

    def folders_of(self, rows: DataFrame) -> list[tuple]:
        """The folders that ``rows`` belong to."""
        parts = rows.select(*time_parts(F.col("timestamp"), self.levels)).distinct()
        return [tuple(r) for r in parts.collect()]

    # ------------------------------------------------------------ writing
    def replace(self, state: State, content: dict[str, tuple[DataFrame, list[tuple]]], note: int | None = None) -> State:
        """The state after ``state`` in which ``content[table] = (rows, folders)`` is all
        that these folders hold. Folders without rows are gone."""
        new = State(state.number + 1, state.note if note is None else note, {t: dict(f) for t, f in state.folders.items()})
        for table, (rows, folders) in content.items():
            target = f"{self.path}/{table}/version={new.number}"
            names = self.schemas[table].names
            write_by_time(rows.select(*names), target, levels=self.levels)
            own = new.folders.setdefault(table, {})
            for place in folders:
                own.pop(place, None)
            written = self.spark.read.schema(T.StructType([self.schemas[table]["timestamp"]])).parquet(target)
            own.update(dict.fromkeys(self.folders_of(written), new.number))
        rows = [
            (new.number, new.note, table, version, *place)
            for table, own in new.folders.items()
            for place, version in own.items()
        ] or [(new.number, new.note, None, None, *[None] * len(self.levels))]
        record = self.spark.createDataFrame(rows, self.record).coalesce(1)
        record.write.mode("overwrite").parquet(f"{self.path}/commits/slot={new.number % RECORDS}")
        return new
