"""Compute a frame once and cut its lineage in storage that outlives executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martwright-"))
    return spark.sparkContext.getCheckpointDir()


# Folders that this process wrote and nobody has taken away yet.
_written: list[str] = []


def release(spark: SparkSession) -> None:
    """Delete what `materialize` wrote in this process. Frames that still read it can no longer be used."""
    while _written:
        remove_folder(spark, _written.pop())


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later jobs read the same rows, also after an executor is lost, and of Parquet only the columns they use.
    The folder stays until `release`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/materialized-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, whatever store it is in.

    Only the driver's own session reaches the store; through a remote one the folder stays.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
