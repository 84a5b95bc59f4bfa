"""State that runs carry over, and sinks. Tables are appended to or replaced whole; a reader never sees half of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.urls import safe_http_url, url_hash
from millrace.operators.identity import keep_existing
from millrace.sources.schema import only_known

SEEN = "url_hash string, title string, canonical_url string, source string, page_id string, created_at timestamp"


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """The latest record of each hash; a store that isn't there yet is empty."""
    try:
        rows = spark.read.schema(SEEN).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], SEEN)
    return rows.groupBy("url_hash").agg(F.max_by(F.struct("title", "canonical_url", "source", "page_id", "created_at"), "created_at").alias("r")).select("url_hash", "r.*")


def record_seen(rows: DataFrame, path: str) -> None:
    """Appends; to be called after the rows' own sink has succeeded."""
    rows.select(*(c.split()[0] for c in SEEN.split(", "))).write.mode("append").parquet(path)


def read_seen_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object from hash to record, one file; anything else is an error."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,struct<title:string,canonical_url:string,source:string,page_id:string,created_at:string>>", {"mode": "FAILFAST"}).alias("m"))
    return raw.select(F.explode("m").alias("url_hash", "r")).select("url_hash", "r.*")


def prune_seen(seen: DataFrame, existing: DataFrame) -> DataFrame:
    return keep_existing(seen, "page_id", existing)


def latest_health(attempts: DataFrame) -> DataFrame:
    """Per source its last attempt and outcome; successes clear the error, failures keep the last success."""
    ok = F.col("outcome").isin("Success", "Unchanged", "Empty")
    return attempts.groupBy("source_id").agg(
        F.max("attempted_at").alias("last_attempt"), F.max(F.when(ok, F.col("attempted_at"))).alias("last_success"), F.max_by("outcome", F.struct("attempted_at", "outcome")).alias("outcome"),
        F.max_by(F.when(ok, "").otherwise(F.substring(F.coalesce("error", F.lit("")), 1, 1000)), F.struct("attempted_at", "outcome")).alias("error"),
    )


def write_winners(winners: DataFrame, path: str, target: DataFrame | None = None) -> None:
    """Appends the winners' columns that the target has."""
    (only_known(winners, target.schema) if target is not None else winners).write.mode("append").parquet(path)


def insert_missing(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key isn't there yet, one each: what find-or-create has to create."""
    return rows.dropDuplicates(key).join(existing.select(*key).distinct(), key, "left_anti")


def write_audit(detail: DataFrame, summary: DataFrame, folder: str) -> None:
    """Detail as JSON lines; the summary, which is small, as one CSV file too."""
    detail.write.mode("overwrite").json(f"{folder}/detail")
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/summary")


IMAGES = "url_hash string, image_url string, provider string, recorded_at timestamp"


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """The image last recorded for each address; a cache that isn't there yet is empty."""
    try:
        rows = spark.read.schema(IMAGES).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], IMAGES)
    return rows.groupBy("url_hash").agg(F.max_by(F.struct("image_url", "provider", "recorded_at"), F.struct("recorded_at", "image_url")).alias("r")).select("url_hash", "r.*")


def record_images(rows: DataFrame, path: str) -> None:
    """Appends the images that are safe addresses; the last one of an address counts."""
    rows.where(safe_http_url(F.col("image_url")) != "").select(*(c.split()[0] for c in IMAGES.split(", "))).write.mode("append").parquet(path)


def with_images(articles: DataFrame, cache: DataFrame) -> DataFrame:
    """Articles (with canonical) with the ``image_url`` and ``image_provider`` that the cache holds for them, empty without one."""
    known = cache.select(F.col("url_hash").alias("__hash"), F.col("image_url").alias("__image"), F.col("provider").alias("__provider"))
    joined = articles.join(known, url_hash(F.col("canonical")) == F.col("__hash"), "left")
    told = joined.withColumns({"image_url": F.coalesce("__image", F.lit("")), "image_provider": F.coalesce("__provider", F.lit(""))})
    return told.drop("__hash", "__image", "__provider")
