"""The folder that driver and executors share: intermediate tables and the files that operators write."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """URI of a new folder below the session's spark.checkpoint.dir; a temporary folder only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/waymark-{uuid.uuid4().hex}"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (file, hdfs, s3, gs)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def saved(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: cuts lineage, keeps column pruning."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A small table through checkpoint(); the cluster's cleaner removes its files once nothing refers to it."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        df.sparkSession.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return df.checkpoint(eager=True)


def remove(uri: str) -> None:
    fs, path = opened(uri)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)
