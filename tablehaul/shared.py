"""Folders that every executor can reach, and tables written to them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tablehaul-")
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tablehaul-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path that no other run uses, below a folder of this application's own."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_staged(spark: SparkSession) -> None:
    """Delete what this application staged. DataFrames that read from there end with it."""
    _delete(spark, _application_folder(spark))


def unstage(staged: DataFrame) -> None:
    """Delete one staged table, once all that was made from it has been written elsewhere."""
    _delete(staged.sparkSession, staged.staged_at)


def stage(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read from there.

    What follows no longer depends on how ``df`` was computed: a lost executor cannot change
    it, and nothing upstream runs again. Unlike a checkpoint the rows are computed once
    and a later read takes only the columns it needs.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged
