"""Importance resampling towards a target: n-gram features in hashed buckets,
log ratios as an array of gains, and a weighted draw without replacement.

A document's weight is the sum of the gains of its features' buckets. Its score
adds noise that is a function of the id, so the highest scores are a draw with
chances in proportion to the weights. The cutoff is found by bisection on the
numbers themselves: each step is one exact count over the stored scores, so no
row is sorted to find it. Only the drawn rows are then cut into ranges and
ranked.
"""

from __future__ import annotations

import string
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wickwork.llm.common import small_batches
from wickwork.llm.shard import numbered
from wickwork.session import materialise

BUCKETS = 10_000
LENGTHS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# Thresholds that one count job tries: four halvings at a time.
WAYS = 16
NO_ID = (1 << 63) - 1
# Words are runs of ASCII digits and letters and of all else beyond ASCII.
_KEPT = (string.ascii_letters + string.digits).encode()
_BREAKS = bytes(b if b > 0x7F or b in _KEPT else 0x20 for b in range(256)).lower()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BREAKS).split()


def feature_buckets(words: list[bytes], lengths: int = LENGTHS, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every run of 1 to ``lengths`` words; a longer run goes on from
    the checksum of the run before its last word."""
    runs = [list(map(crc32, words))]
    spaced = [b" " + w for w in words]
    for n in range(1, lengths):
        runs.append(list(map(crc32, spaced[n:], runs[-1])))
    return np.array([c for run in runs for c in run], dtype=np.int64) % buckets


def bucket_counts(texts: DataFrame, lengths: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs; ``buckets`` numbers come to the driver."""

    def counted(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in small_batches(batches):
            for text in batch.column(0):
                total += np.bincount(feature_buckets(words_of(text.as_py()), lengths, buckets), minlength=buckets)
        places = np.flatnonzero(total)
        yield pa.record_batch([pa.array(places), pa.array(total[places])], names=["bucket", "n"])

    rows = texts.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of each bucket's smoothed shares, floored."""
    n = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + n) / ((source + 1.0) * (float(target.sum()) + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def scored_rows(docs: DataFrame, id_col: str, text_col: str, gain: np.ndarray, lengths: int) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = StructType([rows.schema["id"], *[StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]])

    def weighed(batches):
        own = shared.value
        for batch in small_batches(batches):
            found = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                places = feature_buckets(words, lengths, len(own))
                found.append((len(words), len(places), int(own[places].sum())))
            columns = np.array(found, dtype=np.int64).reshape(-1, 3)
            yield pa.record_batch([batch.column(0), *[pa.array(columns[:, i]) for i in range(3)]], names=out.names)

    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(share)))
    return rows.mapInArrow(weighed, out).withColumn("score", F.col("weight") + noise)


def threshold(rows: DataFrame, value: Column, wanted: int) -> tuple[int, int, int]:
    """(v, below, equal): the least v with at least ``wanted`` rows at or below it,
    the number of rows below it and that of the rows equal to it.

    ``value`` is a whole number in every row and there are at least ``wanted`` rows.
    """
    ends = rows.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n")).first()
    low, high, below, upto = ends.low, ends.high, 0, ends.n
    while low < high:
        cuts = sorted({low + (high - low) * i // WAYS for i in range(1, WAYS)})
        inside = rows.where(value.between(F.lit(low), F.lit(high)))
        counts = [below + n for n in inside.agg(*[F.count_if(value <= F.lit(c)) for c in cuts]).first()]
        for cut, count in zip(cuts, counts, strict=True):
            if count >= wanted:
                high, upto = cut, count
                break
            low, below = cut + 1, count
    return low, below, upto - below


def first_rows(rows: DataFrame, order: list[Column], wanted: int) -> Column:
    """A condition that holds for the first ``wanted`` rows in ``order``.

    ``order`` holds whole numbers and tells all rows apart. Each column is
    bisected among the rows that tie in those before it.
    """
    chosen, tied = F.lit(False), F.lit(True)
    if not wanted:
        return chosen
    for value in order:
        v, below, equal = threshold(rows.where(tied), value, wanted)
        chosen |= tied & (value < F.lit(v))
        tied &= value == F.lit(v)
        wanted -= below
        if wanted == equal:
            break
    return chosen | tied


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    lengths: int = LENGTHS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_features, weight, score, rank), one row for every row of ``docs``,
    repeated rows and missing ids included.

    ``percent`` of the rows with at least ``least_words`` words are drawn, rounded
    down, and ranked from 1 by score, ties to the smaller id; rank is null
    elsewhere. Ids are whole numbers. A missing id has the noise of an empty one
    and comes last among ties; rows alike in score and id are taken by fewer
    features first, and those alike in all columns in any order. A missing text
    has no features and weight 0. Without target texts all features count as
    absent there. Other columns are not read; an empty table gives an empty result.
    """
    source = bucket_counts(docs.select(text_col), lengths, buckets)
    gain = gains(source, bucket_counts(target.select(text_col), lengths, buckets))
    rows = scored_rows(docs, id_col, text_col, gain, lengths)
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "resample-scores")
    fit = F.col("n_words") >= least_words
    wanted = rows.where(fit).count() * percent // 100
    key = F.coalesce(F.col("id").cast("long"), F.lit(NO_ID))
    order = [-F.col("score"), key, F.col("n_features"), F.col("row")]
    drawn = fit & first_rows(rows.where(fit), order, wanted)
    ranked = numbered(rows.where(drawn), [F.desc("score"), key.asc(), "n_features"], "place")
    both = ranked.withColumn("rank", (F.col("place") + 1).cast("long")).unionByName(
        rows.where(~drawn).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True
    )
    return both.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
