"""Reading the input tables. Paths go to Spark's readers alone, so any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table's columns (all without any named); zoneless timestamps become UTC instants."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    zoneless = {c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"}
    return df.withColumns(zoneless) if zoneless else df
