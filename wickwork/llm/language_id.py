"""Language ID of documents that mix languages.

A document's n-grams are drawn from a mixture of languages. Expectation-
maximisation estimates the proportions for a set of languages; sets grow one
language at a time while the penalised likelihood rises.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

from wickwork.llm.common import fold, small_batches

FOLDS, HELD_OUT = 4, 2
NGRAM = 3
BUCKETS = 1 << 16
# The model is fitted on so many distinct labelled texts of each language at
# most: those of smallest hash.
TRAIN_ROWS = 2000
SMOOTHING = 0.5
ROUNDS = 12
# A further language must raise the log likelihood by so much for each n-gram of the
# document. So a passage is named only if it is long enough for its document: one
# that gains 2 for each of its own n-grams, as far languages do, from a share of 1 %.
GAIN_PER_NGRAM = 0.02
# ... and by this multiple of log(number of n-grams), as in the Bayesian criterion.
GAIN_PER_LOG = 2.0
UNDETERMINED = "und"
# As in Spark's rlike: half signs, raised digits and Roman numerals are no letters.
LETTER = regex.compile(r"\p{L}")


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the lower-cased text's character n-grams, hashed.

    Runs of anything but letters count as one space, and the ends as spaces.
    """
    plain = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    h = np.zeros(max(len(points) - NGRAM + 1, 1), dtype=np.uint64)
    for i in range(NGRAM):
        part = points[i : i + len(h)]
        h[: len(part)] = h[: len(part)] * np.uint64(0x9E3779B1) + part
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    counts = np.bincount(h.astype(np.int64), minlength=BUCKETS)
    places = np.flatnonzero(counts)
    return places, counts[places]


class Model:
    """P(n-gram bucket | language), and the inference of mixtures from it."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.p = np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T)
        self.log_p = np.log(self.p)

    def mixture(self, p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions and log likelihood by expectation-maximisation."""
        share = np.full(p.shape[1], 1.0 / p.shape[1])
        total = counts.sum()
        for _ in range(ROUNDS):
            weight = counts / (p @ share)
            share = share * (weight @ p) / total
        return share, float(counts @ np.log(p @ share))

    def infer(self, text: str) -> dict[str, float]:
        """Languages of a text with their proportions; the first is the largest."""
        places, counts = ngram_counts(text)
        counts = counts.astype(np.float64)
        alone = counts @ self.log_p[places]
        chosen = [int(np.argmax(alone))]
        best, shares = float(alone[chosen[0]]), np.ones(1)
        n = counts.sum()
        price = GAIN_PER_NGRAM * n + GAIN_PER_LOG * np.log(max(n, 2.0))
        p = self.p[places]
        while len(chosen) < len(self.languages):
            now = p[:, chosen] @ shares
            tries = []
            for k in range(len(self.languages)):
                # By concavity of the likelihood in the proportions, it cannot rise
                # by more than its slope towards the new language.
                slope = float(counts @ (p[:, k] / now)) - n
                if k not in chosen and slope > price:
                    share, value = self.mixture(p[:, [*chosen, k]], counts)
                    tries.append((value, -k, share))
            if not tries:
                break
            value, k, share = max(tries, key=lambda t: t[:2])
            if value - best <= price:
                break
            chosen, best, shares = [*chosen, -k], value, share
        order = sorted(range(len(chosen)), key=lambda i: (-shares[i], self.languages[chosen[i]]))
        return {self.languages[chosen[i]]: float(shares[i]) for i in order}


def training_rows(docs: DataFrame, text_col: str, lang_col: str, most: int) -> DataFrame:
    """(lang, text): of each language, the ``most`` distinct texts of smallest hash.

    The hashes are ranked without the texts.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")
    )
    ranked = rows.select("lang", "h").distinct().withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    )
    # One row for each language, as many as the model has.
    last = ranked.where(F.col("r") <= most).groupBy("lang").agg(F.max("h").alias("last"))
    own = rows.join(F.broadcast(last), "lang").where(F.col("h") <= F.col("last"))
    return own.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, text_col: str, lang_col: str, train_rows: int) -> Model | None:
    """A model from at most ``train_rows`` texts of each language; None without any.

    Counts come to the driver summed: a number for each language and bucket.
    """
    rows = training_rows(docs, text_col, lang_col, train_rows)

    def counted(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                places, counts = ngram_counts(text)
                totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))[places] += counts
        for lang, total in totals.items():
            places = np.flatnonzero(total)
            yield pa.record_batch(
                [pa.array([lang] * len(places), pa.string()), pa.array(places, pa.int32()), pa.array(total[places])],
                names=["lang", "place", "n"],
            )

    summed = rows.mapInArrow(counted, "lang string, place int, n long").groupBy("lang", "place").agg(
        F.sum("n").alias("n")
    )
    found = summed.toPandas()
    if found.empty:
        return None
    languages = sorted(found["lang"].unique())
    table = np.zeros((len(languages), BUCKETS))
    table[found["lang"].map({x: i for i, x in enumerate(languages)}), found["place"]] = found["n"]
    return Model(languages, table)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_rows: int = TRAIN_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """(id, held_out, lang_pred, score, languages) and the columns in ``keep``, for
    every row of ``docs``, repeated rows and missing ids included.

    Learns from rows whose crc32(id) modulo 4 is not 2 and whose language is
    given; predictions read the text only. ``languages`` maps each language of
    the document to its proportion, lang_pred is the largest, ties to the
    smaller name, and score its proportion. A text that is missing or without
    letters, or any text if nothing could be learned, is ``und`` with score 0.
    """
    held_out = fold(F.col(id_col), FOLDS) == HELD_OUT
    model = fit(docs.where(~held_out), text_col, lang_col, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = docs.columns if keep is None else keep
    # A text that is kept is sent to the workers once, inside its row.
    place = keep.index(text_col) if text_col in keep else None
    apart = [] if place is not None else [F.col(text_col).alias("text")]
    rows = docs.select(F.struct(*keep).alias("row"), held_out.alias("held_out"), *apart)
    out = StructType(
        [
            rows.schema["row"],
            rows.schema["held_out"],
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
            StructField("languages", MapType(StringType(), DoubleType())),
        ]
    )

    def predicted(batches):
        own = shared.value
        for batch in small_batches(batches):
            texts = batch.column(2) if place is None else pc.struct_field(batch.column(0), [place])
            found = [
                own.infer(t) if own and t and LETTER.search(t) else {UNDETERMINED: 0.0} for t in texts.to_pylist()
            ]
            first = [next(iter(f.items())) for f in found]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([k for k, _ in first], pa.string()),
                    pa.array([min(max(s, 0.0), 1.0) for _, s in first], pa.float64()),
                    pa.array([list(f.items()) for f in found], pa.map_(pa.string(), pa.float64())),
                ],
                names=[f.name for f in out],
            )

    return rows.mapInArrow(predicted, out)
