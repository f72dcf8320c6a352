"""Helpers shared by the corpus operators."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.session import materialise

# Row numbers are made as Spark makes them: the task's number, then the row's in it.
TASK_SHIFT = 33


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with only A-Z lowered; Spark's ``lower`` also lowers other letters.

    A text with as many bytes as characters is ASCII, where both agree.
    """
    translated = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(translated)


def fold(id_column: Column, n: int) -> Column:
    """crc32 of the id as text modulo ``n``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % n


def first_row_number() -> int:
    """The number of this task's first row, for rows numbered inside a task."""
    return TaskContext.get().partitionId() << TASK_SHIFT


def with_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` with column ``name``, which tells its rows apart and is the same whenever
    they are read: by the file and the place in it.

    Numbers made while reading are not, as Spark cuts files by the cores it has. A
    table that is not read from Parquet files as it stands is stored first.
    """
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return df.select("*", place.alias(name))
    except AnalysisException:
        return materialise(df, "rows").select("*", place.alias(name))


def small_batches(batches, rows: int = 256):
    """Arrow batches cut to few rows, so that few texts at a time are Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def vector_sum(df: DataFrame, per_batch, size: int) -> np.ndarray:
    """Element-wise sum of the vectors that ``per_batch(RecordBatch)`` gives, one
    from each task; zeros for an empty table."""

    def vectors(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(batch)
        yield pa.record_batch([pa.array([total], pa.list_(pa.float64()))], ["v"])

    nothing = df.sparkSession.range(1).select(F.array_repeat(F.lit(0.0), size).alias("v"))
    rows = df.mapInArrow(vectors, "v array<double>").union(nothing)
    return np.array(rows.agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).first().v)
