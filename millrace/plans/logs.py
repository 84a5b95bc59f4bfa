"""Logs of a process: one line format, UTF-8 on its streams, and Spark's own level."""

from __future__ import annotations

import logging
import sys

from pyspark.sql import SparkSession

FORMAT = "%(asctime)s %(levelname)s %(name)s: %(message)s"


def configure_logs(level: str = "INFO", spark: SparkSession | None = None) -> None:
    """Sets the level for this process and, with a session, for Spark; an unknown level is an error. May be called again."""
    number = logging.getLevelNamesMapping().get(level.strip().upper())
    if number is None:
        raise ValueError(f"no such level: {level}")
    for stream in (sys.stdout, sys.stderr):
        if hasattr(stream, "reconfigure"):
            stream.reconfigure(encoding="utf-8", errors="replace")
    logging.basicConfig(level=number, format=FORMAT, force=True)
    if spark is not None:
        spark.sparkContext.setLogLevel({"WARNING": "WARN", "CRITICAL": "FATAL"}.get(logging.getLevelName(number), logging.getLevelName(number)))
