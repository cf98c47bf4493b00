"""Cutting lineage in iterative jobs so that a lost executor costs one step, not the run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; a temporary one only where none is set."""
    if spark.sparkContext.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """The same rows, written to the checkpoint folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
