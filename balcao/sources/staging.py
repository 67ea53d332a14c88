"""Intermediate tables in the shared folder the cluster names for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which every executor can reach."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several consumers share one run.

    A written table survives lost executors, and its true size decides later joins.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
