"""All sources scanned in one plan: who is supported, what was fetched, what the bodies hold, and one attempt row each.

Recorded fetches stand in for a network: rows of (url, attempt, status, content, error,
started_at, ended_at), of which the first that isn't to be repeated counts. Its body is parsed
where it lies, so one bad source costs the others nothing, and every supported source has one
attempt row with its outcome, its number of articles and how long it took.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.sources import feeds, search

#: Collection methods that a scan can serve; others are left to other scans.
SUPPORTED = ("rss", "atom", "feed")
FETCHES = "url string, attempt int, status int, content binary, error string, started_at timestamp, ended_at timestamp"


def supported(registry: DataFrame, methods: tuple[str, ...] = SUPPORTED) -> DataFrame:
    """The registry's rows that have a feed and a supported method, in any case and white space."""
    return registry.where(F.lower(F.trim(F.coalesce("collection_method", F.lit("")))).isin(*methods) & (F.trim(F.coalesce("feed_url", F.lit(""))) != ""))


def final_fetch(fetches: DataFrame, retries: int = 2) -> DataFrame:
    """(url, status, content, error, attempts, started_at, ended_at, fetched): of each url the first attempt that isn't to be repeated.

    ``fetched`` is Success, Unchanged or HTTP Error; times span all attempts up to that one.
    """
    told = fetches.where(F.col("attempt") <= retries + 1).withColumn("fetched", search.fetch_outcome(F.col("status"), F.col("attempt"), retries))
    # bodies stay out of the aggregation: only the final attempt's one is fetched by the join
    last = told.where("fetched <> 'retry'").groupBy("url").agg(F.min("attempt").alias("__last"))
    spans = told.join(last, "url").where("attempt <= __last").groupBy("url", "__last").agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"))
    final = told.select("url", "attempt", "status", "content", "error", "fetched").dropDuplicates(["url", "attempt"])
    return spans.join(final.withColumnRenamed("attempt", "__last"), ["url", "__last"]).withColumnRenamed("__last", "attempts")


def collected(registry: DataFrame, fetches: DataFrame, wrapper: str = "news.google.com", retries: int = 2) -> tuple[DataFrame, DataFrame]:
    """(articles, attempts) of a registry (source_id, source_name, feed_url, collection_method, source_region, topics, quality).

    Articles carry their source's name, region, topics and quality. Outcomes of attempts: Success, Unchanged, Empty, Parse
    Error, HTTP Error, and Fetch Error where nothing was recorded. Sources of one feed each get its articles.
    """
    sources = supported(registry)
    final = final_fetch(fetches, retries)
    bodies = final.where((F.col("fetched") == "Success") & F.col("content").isNotNull()).select(F.col("url").alias("path"), "content")
    raw = feeds.parse_feeds(bodies)
    parsed = feeds.feed_attempts(raw).select(F.col("path").alias("url"), F.col("outcome").alias("parsed"), "article_count", F.col("error").alias("parse_error"))
    known = sources.join(final.drop("content"), F.trim("feed_url") == F.col("url"), "left").drop("url").join(parsed, F.trim("feed_url") == F.col("url"), "left")
    outcome = F.when(F.col("fetched").isNull(), "Fetch Error").when(F.col("fetched") != "Success", F.col("fetched")).otherwise(F.coalesce("parsed", F.lit("Empty")))
    took = (F.unix_millis("ended_at") - F.unix_millis("started_at")).cast("int")
    error = F.when(F.col("fetched").isNull(), "no answer").otherwise(F.substring(F.coalesce(F.nullif("parse_error", F.lit("")), F.when(F.col("fetched") == "HTTP Error", F.coalesce("error", F.concat(F.lit("status "), "status"), F.lit("no status"))), F.lit("")), 1, 1000))
    attempts = known.select("source_id", "source_name", outcome.alias("outcome"), error.alias("error"), F.col("started_at").alias("attempted_at"), F.coalesce("article_count", F.lit(0)).cast("int").alias("article_count"), took.alias("duration_ms"), "attempts")
    of_source = sources.select("source_id", "source_name", F.trim("feed_url").alias("path"), "source_region", "topics", "quality")
    articles = feeds.feed_articles(raw, wrapper).join(of_source, "path").withColumn("publisher_key", urls.hostname(F.col("url"))).drop("path")
    return articles, attempts


def scan_order() -> list[Column]:
    """The order in which a scan's articles are listed, whatever order sources answered in."""
    return [F.col("publisher_key"), F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.col("url"), F.lower("title"), F.col("source_id"), F.col("pos")]
