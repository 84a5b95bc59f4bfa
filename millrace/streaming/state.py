"""Streaming forms of the stateful operators.

Watermarks need an instant, so zoneless times are taken as UTC. Every query names its own
checkpoint and writes through ``foreachBatch`` under the batch's number, so a batch that is
run again after a failure replaces what it wrote before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.lineage import shared_folder


def read_stream(spark: SparkSession, path: str, event_time: str) -> DataFrame:
    """A table's files as a stream, with ``event_time`` as an instant. The path is a pattern, so a single file will do too."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]").withColumn(event_time, F.col(event_time).cast("timestamp"))


def first_of_each(stream: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """One row of each key within the delay; state older than that is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)


def weekly_counts(stream: DataFrame, by: list[str], event_time: str, delay: str = "7 days") -> DataFrame:
    """Rows by week, Monday to Sunday, and ``by``."""
    week = F.window(event_time, "7 days", "7 days", "4 days")
    return stream.withWatermark(event_time, delay).groupBy(week.alias("week"), *by).agg(F.count("*").alias("n")).select(F.col("week.start").cast("date").alias("monday"), *by, "n")


def source_health(stream: DataFrame, source: str, event_time: str, failed: Column) -> DataFrame:
    """Per source the last attempt, success and outcome so far."""
    return stream.groupBy(source).agg(F.max(event_time).alias("last_attempt"), F.max(F.when(~failed, F.col(event_time))).alias("last_success"), F.max_by(F.when(failed, "failure").otherwise("success"), event_time).alias("outcome"))


def split_late(stream: DataFrame, event_time: str, now: Column, days: int) -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows with a reason): late ones are audited, not lost."""
    late = F.col(event_time) < now - F.expr(f"INTERVAL {days} DAYS")
    return stream.where(~late), stream.where(late).withColumn("reason", F.lit("stale publication date"))


def run_available(stream: DataFrame, mode: str, folder: str | None = None) -> DataFrame:
    """What a stream gives for the data there is: all rows in append mode, the last state otherwise."""
    spark = stream.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    numbers: list[int] = []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
        numbers.append(number)

    stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(keep).start().awaitTermination()
    if not numbers:
        return spark.createDataFrame([], stream.schema)
    kept = sorted(set(numbers)) if mode == "append" else [max(numbers)]
    return spark.read.schema(stream.schema).parquet(*(f"{folder}/out/batch={k}" for k in kept))


def deduplicated_batch(seen_path: str, key: str, sink: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step: rows not seen before go to the sink, and then their keys to the store.

    Keys are recorded per batch number, and a repeated batch ignores its own earlier record.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([key]).withColumn("__batch", F.lit(number))
        try:
            seen = spark.read.parquet(seen_path).where(F.col("batch") < number).select(key)
            rows = rows.join(seen, key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
        rows = rows.drop("__batch").persist()
        try:
            sink(rows)
            rows.select(key).write.mode("overwrite").parquet(f"{seen_path}/batch={number}")
        finally:
            rows.unpersist()

    return step
