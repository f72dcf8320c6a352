"""The batch job: raw lines to features, report, CSV and a trained model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.operators.candles import dedupe_candles
from wickwork.operators.features import engineer_features, labelled
from wickwork.operators.quality import quality_report
from wickwork.operators.series import DEFAULT_CHUNK
from wickwork.operators.training import (
    TEST,
    apply_model,
    evaluate,
    has_rows,
    load_model,
    ordered_split,
    save_model,
    train,
)
from wickwork.schemas import KLINE
from wickwork.session import materialise
from wickwork.sinks.files import write_by_time, write_csv_by_symbol
from wickwork.sources.files import read_feature_csv, read_features
from wickwork.sources.messages import (
    REJECTED,
    event_kind,
    kline_fields,
    parse_lines,
    read_lines,
    typed_candles,
)

FEATURE_LEVELS = ("year", "month", "day")


@dataclass
class BatchResult:
    """Lazy tables over what the job wrote, and the model if one was trained."""

    features: DataFrame
    quarantine: DataFrame
    report: DataFrame
    counts: DataFrame
    model: PipelineModel | None = None
    evaluation: DataFrame | None = None


def land(spark: SparkSession, source, path: str) -> tuple[DataFrame, DataFrame]:
    """Raw lines to a Parquet table ``landed`` below ``path``, in folders by kind: its
    candles and its rejected lines.

    The text is read and parsed once. Every candle that arrived is kept, history and
    live, copies included; lines that cannot be read are stored once, as text.
    """
    parsed = parse_lines(read_lines(spark, source))
    kind = F.when(~F.col("readable"), REJECTED).when(event_kind() == KLINE, KLINE)
    own = parsed.withColumns({"kind": kind, "line": F.when(~F.col("readable"), F.col("value"))})
    fields = kline_fields(own.where(F.col("kind").isNotNull()), keep=("kind", "line"))
    rows = typed_candles(fields, extra=("received_at", "kind", "line"))
    write_by_time(rows, f"{path}/landed", levels=FEATURE_LEVELS, first=("kind",))
    landed = spark.read.schema(rows.schema).parquet(f"{path}/landed")
    return (
        landed.where(F.col("kind") == KLINE).drop("kind", "line"),
        landed.where(F.col("kind") == REJECTED).select("line"),
    )


def run_batch(
    spark: SparkSession,
    source,
    out: str,
    dedupe: bool = True,
    model_path: str | None = None,
    chunk: str = DEFAULT_CHUNK,
    split_mode: str = "time",
) -> BatchResult:
    """Candles and features are each written once; later steps read the tables.

    The report covers the rows as they arrived, duplicates included.
    """
    arrived, bad = land(spark, source, out)
    candles = dedupe_candles(arrived) if dedupe else arrived
    features = engineer_features(candles, chunk, stored=not dedupe)
    write_by_time(features, f"{out}/features", levels=FEATURE_LEVELS)
    features = read_features(spark, f"{out}/features")
    counts = write_csv_by_symbol(features, f"{out}/csv")
    result = BatchResult(features, bad, quality_report(arrived), counts)
    if model_path:
        result.model, result.evaluation = train_on(features, model_path, chunk, split_mode)
    return result


def train_on(
    features: DataFrame, model_path: str, chunk: str = DEFAULT_CHUNK, split_mode: str = "time"
) -> tuple[PipelineModel | None, DataFrame | None]:
    """Label, split, fit, evaluate and save; nothing for an empty or tiny table."""
    if not has_rows(features, 1):
        return None, None
    # The forest reads its input several times, so the split is written once.
    split = materialise(ordered_split(labelled(features, chunk), split_mode, chunk=chunk), "split")
    model = train(split)
    if model is None:
        return None, None
    save_model(model, model_path)
    return model, evaluate(apply_model(model, split.where(F.col("part") == TEST)))


def train_from_csv(spark: SparkSession, csv_path, model_path: str, **options):
    return train_on(read_feature_csv(spark, csv_path), model_path, **options)


__all__ = ["BatchResult", "land", "load_model", "run_batch", "train_from_csv", "train_on"]
