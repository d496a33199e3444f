"""Session construction and the shared checkpoint folder.

On a cluster the session is built by the platform; we only add SQL
settings that matter for these jobs (AQE, skew handling, UTC). The
checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir``; a folder of our own is set only when that
setting is absent (local runs and tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "indicarium") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def materialize(df):
    """Compute ``df`` once into a parquet table in the shared checkpoint
    folder and return a DataFrame reading it (never a local checkpoint).

    For a small intermediate with several consumers: column pruning trims
    each consumer's copy of the plan differently, so Spark cannot reuse
    the exchange and would recompute the expensive part (a large join)
    per consumer. The written table also cuts the lineage, so a lost
    executor does not send recovery back through that join. A parquet
    table rather than ``DataFrame.checkpoint``: one job (an uncached RDD
    checkpoint computes its input twice) and columnar reads with pruning."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/materialized/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which outlives the
    application. A local session that names none gets one of its own; on a
    cluster, whose executors share no local disk, it must be set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="indicarium-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """``shared_folder``, also set as the session's checkpoint folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder
