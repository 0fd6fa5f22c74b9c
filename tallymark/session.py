"""Session settings the jobs are tuned for. A caller that has a session does not need this module."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Spark's own defaults are kept where they fit; these are the ones that matter here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tallymark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder; on a cluster None is returned.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None and context.master.startswith("local") and not context.master.startswith("local-cluster"):
        named = tempfile.mkdtemp(prefix="tallymark-checkpoint-")
    if named is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def require_checkpoint_dir(spark: SparkSession) -> str:
    named = checkpoint_dir(spark)
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor and are computed once."""
    require_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
