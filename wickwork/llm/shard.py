"""A reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered 0 to n-1 in the order of their ids. A keyed permutation of
those numbers gives each row its place in the shuffle; shard and slot are the
remainder and quotient of the place. Both directions are computed from the
number alone: no shuffle order is stored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wickwork.llm.common import TASK_SHIFT
from wickwork.session import materialise

SHARDS = 24
KEY = 20240607
ROUNDS = 6


class Permutation:
    """A bijection of 0..n-1, and its inverse.

    A Feistel network permutes the numbers of twice ``half`` bits, the smallest
    such domain with n numbers, so fewer than four times n. A result beyond n is
    permuted again; on a cycle of a bijection that ends, at the latest at the
    number it began with.
    """

    def __init__(self, n: int, key: int = KEY, rounds: int = ROUNDS):
        self.n, self.rounds = n, rounds
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        seeds = np.random.Generator(np.random.Philox(key)).integers(0, 1 << 63, rounds)
        self.keys = [np.uint64(s) for s in seeds]

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        shift = np.uint64(self.half)
        left, right = x >> shift, x & self.mask
        if back:
            for key in reversed(self.keys):
                left, right = right ^ self._mix(left, key), left
        else:
            for key in self.keys:
                left, right = right, left ^ self._mix(right, key)
        return (left << shift) | right

    def __call__(self, numbers, back: bool = False) -> np.ndarray:
        x = np.asarray(numbers, dtype=np.uint64).copy()
        left = np.arange(len(x))
        while len(left):
            x[left] = self._once(x[left], back)
            left = left[x[left] >= self.n]
        return x.astype(np.int64)

    def row_at(self, shard: int, slot: int, shards: int = SHARDS) -> int:
        """The number of the row in a slot of a shard."""
        return int(self(np.array([slot * shards + shard]), back=True)[0])


def numbered(rows: DataFrame, order: list, number: str) -> DataFrame:
    """``rows`` with gapless numbers from 0 in the order of the columns ``order``.

    Rows are cut into ranges and numbered in each; a range begins with the
    number of rows in those before it. Rows alike in all of ``order`` are told
    apart by where they were read, so that a large group of them is cut too.
    """
    ranges = rows.withColumn("_read", F.monotonically_increasing_id())
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [*order, "_read"]
    cut = ranges.repartitionByRange(width, *sort).sortWithinPartitions(*sort).drop("_read")
    cut = materialise(cut.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", TASK_SHIFT)
    sizes = cut.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row for each range: their number is that of the shuffle's partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_at").bitwiseAND((1 << TASK_SHIFT) - 1)
    return (
        cut.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(number, F.col("_start") + within)
        .drop("_part", "_start", "_at")
    )


def shard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    key: int = KEY,
) -> DataFrame:
    """(id, size, text_crc32, row_number, place, shard, slot), one row for every
    row of ``docs``, repeated rows included.

    Rows are numbered by id, missing ids first, then by the text's hashes; alike
    rows take their numbers in any order, which gives the same result. Shards
    differ by one row at most. size is the text's bytes plus 8; a missing text
    has none, and the crc32 of nothing. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text_col).alias("tie"),
    )
    rows = numbered(rows, ["id", "size", "text_crc32", "tie"], "row_number")
    permutation = Permutation(rows.count(), key)

    @pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permutation(number.to_numpy()))

    placed = rows.withColumn("place", place("row_number"))
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "row_number",
        "place",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {int(shards)}").alias("slot"),
    )
