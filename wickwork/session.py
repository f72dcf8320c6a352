"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

MAX_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Of texts that are sent to a Python worker at a time.
BATCH_BYTES = 4 << 20


def build_session(app: str = "wickwork", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are written for.

    The shuffle width is left to the cluster: adaptive execution merges small
    partitions, so a high ``spark.sql.shuffle.partitions`` is safe there.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Timestamps with and without a zone then read the same on every cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def bound_batches(spark: SparkSession) -> None:
    """Rows then go to Python workers in batches of about BATCH_BYTES, unless the session
    names a size itself.

    By default a batch is up to 64 MB of texts. Executors and workers hold several at a
    time, outside the Java heap.
    """
    if MAX_BYTES not in spark.conf.getAll:
        spark.conf.set(MAX_BYTES, str(BATCH_BYTES))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    Only a session with a local master may go without one: its executors are in
    this process and share a temporary folder. Anything else raises, because
    each executor would write to its own disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wickwork-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, unique to this call."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage with a real table: a lost executor re-reads files, it does not
    recompute the plan above them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
