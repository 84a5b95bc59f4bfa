"""Runs as queries, with stand-ins for what is called outside: fixed functions of a title and a snippet."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text, urls
from millrace.plans import assisted, ingestion, weekly_run
from millrace.plans.catalog import query
from millrace.plans.lineage import shared_folder
from millrace.plans.scalar_queries import articles
from millrace.plans.values import REGIONS, EngineConfig

PLACES = (*REGIONS, "")


def classify(items: list[dict]) -> list[dict]:
    """decision|relevance|region by the lengths of title and snippet."""
    told = lambda i: f"{('Irrelevant', 'Borderline', 'Relevant', 'Relevant')[len(i['title']) % 4]}|{3 + len(i['title']) % 3}|{PLACES[len(i['snippet']) % 5]}"
    return [{"id": i["id"], "decision": told(i)} for i in items]


def enrich(row: dict) -> dict:
    n, m = len(row["title"]), len(row["snippet"])
    if n % 13 == 0:
        raise TimeoutError("no answer")
    return {"relevance": 3 + n % 3, "significance": 1 + m % 5, "story": "conflict_security" if n % 11 == 0 else "development", "novelty": ("true", "unclear", "false")[min(2, n % 17)] if n % 17 > 1 and n % 7 == 0 else "true", "region": REGIONS[m % 4]}


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles of registered and other publishers."""
    rows = articles(spark, sf_dir)
    return rows.select(
        F.col("doc_id").cast("string").alias("key"), "url", "title", text.snippet(F.col("body")).alias("snippet"), urls.hostname(F.col("url")).alias("publisher"), (F.length("source") % 2 == 0).alias("registered"),
        (F.length("title") % 10 + 1).cast("double").alias("quality"), "published",
    )


@query("assisted_run")
def assisted_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many articles of each phase every label decided about."""
    told = assisted.run(feed(spark, sf_dir), F.lit("2024-02-01").cast("timestamp"), EngineConfig(), assisted.Model(classify, enrich))
    return assisted.stages(told).groupBy("phase", "stage", F.coalesce("reason", F.lit("selected")).alias("reason")).agg(F.count("*").alias("n"))


@query("weekly_runs")
def weekly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winners of two runs of one week over all documents: the second one finds what the first one left, and takes nothing twice."""
    desk = weekly_run.Desk(spark, f"{shared_folder(spark)}/desk-{uuid.uuid4().hex}")
    rows = articles(spark, sf_dir)
    for _ in range(2):
        desk.run(rows, ingestion.registry(rows), datetime(2024, 2, 1), EngineConfig(targets=(6, 8, 6, 4)))
    return desk.queue().select("run", "pick", "key", "region", "publisher", "url", "score")
