"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    html_text,
    importance,
    language_id,
    language_model,
    minhash,
    nearest,
    shard,
    simhash,
    token_counts,
    warc,
)
from wickwork.llm.common import table


def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_documents(table(spark, folder, "documents"))


def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_shard(spark: SparkSession, folder: str) -> DataFrame:
    rows = shard.shard(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number", "place",
    )


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    rows = language_id.identify(table(spark, folder, "documents"), keep=["doc_id"])
    return rows.select("row.doc_id", "held_out", "lang_pred", "score")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, folder, "documents"))
    return rows.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


def op11_resample(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


REGISTRY = {
    f.__name__: f
    for f in (
        op1_lm_score, op2_nearest, op3_decontaminate, op4_shard, op5_byte_bpe,
        op6_language, op7_simhash, op8_html_text, op9_warc, op10_token_counts, op11_resample, op12_divergence, op13_minhash,
    )
}
