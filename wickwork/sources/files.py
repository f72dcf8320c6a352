"""Readers of the files this package writes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.schemas import CANDLE_SCHEMA, FEATURE_SCHEMA, MESSAGE_SCHEMA
from wickwork.sinks.files import HISTORY, LIVE, SERIES


def read_feature_csv(spark: SparkSession, path, symbols=None) -> DataFrame:
    """Feature CSV files as one table: in folders by symbol, nested otherwise or flat.

    ``symbols``, names or a table with the column ``symbol``, limits it to some. In
    folders by symbol (``series=``) only their folders are read: names become a filter
    on the folders, a table prunes them when the query runs. The schema is given, so
    there is no inference pass over the files.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    if SERIES in reader.schema(FEATURE_SCHEMA).csv(path).columns:
        # Named in the schema, a folder's name stays text.
        rows = reader.schema(T.StructType([*FEATURE_SCHEMA.fields, T.StructField(SERIES, T.StringType())])).csv(path)
        own = F.col(SERIES)
    else:
        rows = reader.schema(FEATURE_SCHEMA).option("recursiveFileLookup", True).csv(path)
        own = F.col("symbol")
    if isinstance(symbols, DataFrame):
        asked = symbols.select(F.col("symbol").alias("_asked")).distinct()
        rows = rows.join(asked, own == F.col("_asked"), "left_semi")
    elif symbols is not None:
        rows = rows.where(own.isin(list(symbols)))
    return rows.select(*FEATURE_SCHEMA.names)


def read_features(spark: SparkSession, path) -> DataFrame:
    """Feature Parquet; filters on time partitions prune folders."""
    return spark.read.parquet(path).select(*FEATURE_SCHEMA.names)


def read_candles(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path).select(*CANDLE_SCHEMA.names)


def read_messages(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path).select(*MESSAGE_SCHEMA.names)


def read_collected(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a collection: its history, if it has one, and what was streamed."""
    parts = []
    for name in (HISTORY, LIVE):
        try:
            parts.append(spark.read.text(f"{path}/{name}"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return concat(*parts) if parts else spark.createDataFrame([], "value string")


def concat(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates stay."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
