"""Shared scratch space: checkpoints and staged files.

A cluster names a folder all executors can reach in ``spark.checkpoint.dir``.
Only where it is unset (tests, laptops) is a private folder made.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="filmgrain-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/staged-{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
