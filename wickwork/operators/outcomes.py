"""Predictions, what followed them, and how good they were."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.functions.columns import confidence, direction_hit, pct_change, predicted_price
from wickwork.operators import series
from wickwork.schemas import OUTCOME_HISTORY, WAITING
from wickwork.session import materialise


def linear_score() -> Column:
    """A fixed stand-in for a trained model: a tenth of the 5-row momentum."""
    return F.lit(0.1) * F.col("momentum_5")


def predictions(features: DataFrame, score: Column | None = None) -> DataFrame:
    """Feature rows to prediction rows. ``score`` defaults to the column
    ``prediction`` a fitted model adds."""
    expected = F.col("prediction") if score is None else score
    scored = features.withColumn("predicted_return", expected)
    return scored.select(
        *series.keys_of(features),
        "timestamp",
        F.col("close").alias("current_price"),
        predicted_price(F.col("close"), F.col("predicted_return")).alias("predicted_price"),
        "predicted_return",
        confidence(F.col("predicted_return")).alias("confidence"),
    )


def latest_predictions(made: DataFrame) -> DataFrame:
    """The newest prediction per series; one row per series and task is shuffled."""
    by = series.keys_of(made)
    rest = [c for c in made.columns if c not in (*by, "timestamp")]
    newest = made.groupBy(*by).agg(F.max(F.struct("timestamp", *rest)).alias("p"))
    return newest.select(*by, *[F.col(f"p.{c}").alias(c) for c in ("timestamp", *rest)])


def _outcome(actual: Column) -> list[Column]:
    return [
        F.col("predicted_return"),
        actual.alias("actual_return"),
        direction_hit(F.col("predicted_return"), actual).alias("direction_correct"),
    ]


def next_row_outcomes(labelled: DataFrame, score: Column) -> DataFrame:
    """Outcome of a prediction on every row, from the row's own next close."""
    scored = labelled.withColumn("predicted_return", score).where(
        F.col("next_close").isNotNull() & F.col("predicted_return").isNotNull()
    )
    return scored.select(
        *series.keys_of(labelled), F.col("next_timestamp").alias("timestamp"), *_outcome(F.col("target_return"))
    )


def asof_outcomes(
    candles: DataFrame, made: DataFrame, chunk: str | None = series.DEFAULT_CHUNK
) -> DataFrame:
    """Each candle against the latest earlier prediction of its series.

    Predictions and candles are separate tables. A prediction of the same time
    as the candle is made from that candle, so it does not count.
    """
    by = [c for c in series.keys_of(candles) if c in made.columns]
    rows = candles.select(*by, "timestamp", "close")
    marks = made.select(*by, F.col("timestamp").alias("made_at"), "current_price", "predicted_return")
    seen = series.last_before(rows, marks, by, "timestamp", "made_at", "seen", chunk)
    matched = seen.where(F.col("seen").isNotNull()).select(
        *by, "timestamp", "close", "seen.current_price", "seen.predicted_return"
    )
    actual = pct_change(F.col("close"), F.col("current_price"))
    return matched.select(*by, "timestamp", *_outcome(actual))


def _score_columns() -> list[Column]:
    error = F.col("predicted_return") - F.col("actual_return")
    hits = F.avg(F.col("direction_correct").cast("double")) * 100
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.coalesce(hits, F.lit(0.0)).alias("accuracy_direction"),
        F.count(F.lit(1)).alias("total_predictions"),
    ]


def recent_outcomes(outcomes: DataFrame, n: int = OUTCOME_HISTORY) -> DataFrame:
    """The last ``n`` outcomes of all symbols: a top-n, ``n`` rows per task."""
    return outcomes.orderBy(F.desc("timestamp"), *[F.desc(c) for c in series.keys_of(outcomes)]).limit(n)


def metrics(outcomes: DataFrame, last_trained=None, n: int = OUTCOME_HISTORY) -> DataFrame:
    """One row of metrics over the last ``n`` outcomes."""
    row = recent_outcomes(outcomes, n).agg(*_score_columns())
    return row.withColumn("last_trained", F.lit(last_trained).cast("timestamp"))


def _hit_totals() -> dict[str, Column]:
    hit = F.col("direction_correct").cast("bigint")
    return {
        "_pos": F.lit(1).cast("bigint"),
        "_hits": F.coalesce(hit, F.lit(0)),
        "_known": hit.isNotNull().cast("bigint"),
    }


def running_accuracy(
    outcomes: DataFrame, n: int = OUTCOME_HISTORY, chunk: str = series.DEFAULT_CHUNK
) -> DataFrame:
    """Per series, hit rate and count over the ``n`` outcomes up to each one.

    The difference of two running totals, ``n`` positions apart: no row is copied,
    whatever ``n`` is. Totals are counts, so differences are exact.
    """
    totals = _hit_totals()
    stored = materialise(outcomes, "outcomes")
    by = series.keys_of(outcomes)
    now = materialise(series.running_totals(stored, by, ["timestamp"], totals, chunk), "running")
    return _last_n(now, outcomes.columns, n, by)


def running_accuracy_overall(outcomes: DataFrame, n: int = OUTCOME_HISTORY) -> DataFrame:
    """Hit rate and count over the last ``n`` outcomes of all symbols up to each one.

    Outcomes of one time are taken in the order of their symbols, missing ones first;
    those alike in both by interval, predicted and actual return.
    """
    names = ["timestamp", *series.keys_of(outcomes), "predicted_return", "actual_return"]
    order = [F.col(c).asc_nulls_first() for c in names]
    now = series.ordered_totals(outcomes, order, _hit_totals(), "accuracy")
    return _last_n(now, outcomes.columns, n, [])


def _last_n(now: DataFrame, columns: list[str], n: int, by: list[str]) -> DataFrame:
    """Accuracy from the totals of each row and of the row ``n`` positions before it
    among those with equal ``by``."""
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], F.lit(True))
    then = now.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        (F.col("_pos") + n).alias("_at"),
        F.col("_hits").alias("_hits_then"),
        F.col("_known").alias("_known_then"),
    )
    joined = now.join(then, same & (F.col("_pos") == F.col("_at")), "left")
    hits = F.col("_hits") - F.coalesce("_hits_then", F.lit(0))
    known = F.col("_known") - F.coalesce("_known_then", F.lit(0))
    return joined.select(
        *columns,
        F.when(known > 0, hits / known * 100).alias("accuracy"),
        F.least("_pos", F.lit(n).cast("bigint")).alias("counted"),
    )


def lookup(
    requested: DataFrame, latest: DataFrame, metrics_row: DataFrame, names: DataFrame | None = None
) -> DataFrame:
    """Requested symbols with their latest prediction and the overall metrics.

    A symbol without a prediction gets the waiting status. The metrics row is a
    scalar subquery. The joins carry no hint: Spark broadcasts a side only when
    its measured size is under the session's threshold.
    """
    keys = requested.select(F.upper("symbol").alias("symbol"))
    known = latest.withColumn("found", F.lit(True))
    joined = keys.join(known, "symbol", "left")
    if names is not None:
        joined = joined.join(names, "symbol", "left")
    fields = metrics_row.columns
    overall = metrics_row.select(F.struct(*fields).alias("m"))
    found = F.col("found").isNotNull()
    joined = joined.withColumn("m", F.when(found, overall.scalar()))
    status = F.when(~found, F.lit(WAITING)).alias("status")
    rest = [c for c in joined.columns if c not in ("symbol", "found", "m")]
    return joined.select("symbol", status, *rest, *[F.col(f"m.{c}").alias(c) for c in fields])
