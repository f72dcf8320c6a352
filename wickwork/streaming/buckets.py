"""Rows kept between micro-batches, in buckets of which a batch writes those it touches.

A series belongs to a bucket by a hash of its keys. Each bucket alternates between
SLOTS folders: a batch reads the slot of its predecessor and writes the next, so
it never reads what it writes and a replay writes the same slot again. Which slot
counts is a number for each bucket, its generation, which the batch stores with its
progress. A bucket nobody touches is neither read nor written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 3
BUCKETS = 64
NEVER = -1


class Buckets:
    """The rows of one table, below ``path``; those in ``seed`` count until a bucket is written."""

    def __init__(
        self, spark: SparkSession, path: str, seed: str, schema: T.StructType, keys: list[str], buckets: int = BUCKETS
    ):
        self.spark, self.path, self.seed, self.schema = spark, path, seed, schema
        self.keys, self.buckets = keys, buckets

    def start(self) -> list[int]:
        """The generations before anything was written."""
        return [NEVER] * self.buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that ``rows`` belong to: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def read(self, generations: list[int], buckets: list[int]) -> DataFrame:
        """The kept rows of some buckets."""
        written = [b for b in buckets if generations[b] != NEVER]
        fresh = [b for b in buckets if generations[b] == NEVER]
        found = self.spark.createDataFrame([], self.schema)
        if written:
            paths = [f"{self.path}/bucket={b}/slot={generations[b] % SLOTS}" for b in written]
            found = self.spark.read.schema(self.schema).parquet(*paths)
        if fresh and (seed := self._seeded()) is not None:
            found = found.unionByName(seed.where(F.col("bucket").isin(fresh)).select(*self.schema.names))
        return found

    def _seeded(self) -> DataFrame | None:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(self.seed)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def write_seed(self, rows: DataFrame) -> None:
        own = rows.select(*self.schema.names).withColumn("bucket", self.bucket()).repartition("bucket")
        own.write.mode("overwrite").partitionBy("bucket").parquet(self.seed)

    def write(self, rows: DataFrame, generations: list[int], buckets: list[int]) -> list[int]:
        """Replace ``buckets`` by ``rows``, which has rows in each of them; the new generations."""
        new = [g + 1 if b in set(buckets) else g for b, g in enumerate(generations)]
        slots = F.array(*[F.lit(max(g, 0) % SLOTS) for g in new])
        own = rows.select(*self.schema.names).withColumn("bucket", self.bucket())
        own = own.withColumn("slot", F.get(slots, F.col("bucket"))).repartition("bucket")
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "slot").parquet(self.path)
        return new
