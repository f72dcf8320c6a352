"""Split, fit, evaluate, keep and apply the return model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.operators import series
from wickwork.schemas import MODEL_INPUTS, MODEL_LABEL

TRAIN = "train"
TEST = "test"
MIN_ROWS = 10


def ordered_split(
    rows: DataFrame,
    mode: str = "time",
    test_share: float = 0.2,
    chunk: str = series.DEFAULT_CHUNK,
) -> DataFrame:
    """Adds ``part``. No shuffling of rows between parts.

    ``mode="time"``: the last share of every series is the test part.
    ``mode="table"``: the last share of the table in ``(symbol, interval, timestamp)``
    order, so the test part is the tail of the last symbols.
    """
    placed = series.series_index(rows, series.keys_of(rows), ["timestamp"], chunk)
    pos, total = {
        "time": ("series_pos", "series_rows"),
        "table": ("table_pos", "table_rows"),
    }[mode]
    held_out = F.ceil(F.lit(test_share) * F.col(total))
    part = F.when(F.col(pos) < F.col(total) - held_out, F.lit(TRAIN)).otherwise(F.lit(TEST))
    return placed.withColumn("part", part).drop(
        "series_pos", "series_rows", "table_pos", "table_rows"
    )


def forest(trees: int = 100, depth: int = 10, seed: int = 42) -> Pipeline:
    """The seven inputs as a vector and a random forest on it."""
    vector = VectorAssembler(inputCols=MODEL_INPUTS, outputCol="inputs", handleInvalid="skip")
    trees_ = RandomForestRegressor(
        featuresCol="inputs",
        labelCol=MODEL_LABEL,
        predictionCol="prediction",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        featureSubsetStrategy="all",
    )
    return Pipeline(stages=[vector, trees_])


def has_rows(rows: DataFrame, least: int = MIN_ROWS) -> bool:
    """Whether at least ``least`` rows exist; reads no further than that."""
    return rows.limit(least).count() >= least


def evaluate(scored: DataFrame, label: str = MODEL_LABEL, predicted: str = "prediction") -> DataFrame:
    """MAE and RMSE as one row, in one pass."""
    error = F.col(predicted) - F.col(label)
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(error).alias("test_rows"),
    )


def train(
    split: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42
) -> PipelineModel | None:
    """Fit on the train part; None when the table is too small to train on."""
    if not has_rows(split):
        return None
    fitted_on = split.where(F.col("part") == TRAIN).select(*MODEL_INPUTS, MODEL_LABEL)
    return forest(trees, depth, seed).fit(fitted_on)


def apply_model(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Adds ``prediction``; rows with a NULL input are skipped."""
    return model.transform(features).drop("inputs")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
