"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a folder of this machine only for a session that runs in one process and names none.

    Raises on a cluster that names none: what is stored on one machine is lost with it.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-"))
    return named or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, reliably stored: a lost executor costs no recomputation of what came before."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
