"""Cutting the lineage of iterative operators in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of this machine only for a session in one process that names none. Raises on a cluster that names none."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``cut``, for many rows of repeated values: stored in columns, which takes a small part of a checkpoint's disk."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
