"""Search providers behind recorded answers: bounded requests, typed outcomes, discovery for regions that lack rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Bounds of requests, and statuses that tell of a limit and of a passing failure.
MOST_RESULTS, MOST_DOMAINS, MOST_PHOTOS = 50, 20, 30
LIMIT_STATUSES = (402, 403, 429)
TRANSIENT_STATUSES = (408, 425, 429)


def clamped_count(count: Column, most: int = MOST_RESULTS) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(most), F.coalesce(count.cast("int"), F.lit(10))))


def provider_outcome(status: Column) -> Column:
    """ok, provider limit or provider error of a status; none is an error."""
    return F.when(status.isin(*LIMIT_STATUSES), "provider limit").when((status >= 200) & (status < 300), "ok").otherwise("provider error")


def fetch_outcome(status: Column, attempt: Column, retries: int = 2) -> Column:
    """Of an attempt: Success, Unchanged, retry while any is left for a passing failure, else HTTP Error."""
    passing = status.isNull() | status.isin(*TRANSIENT_STATUSES) | (status >= 500)
    return F.when(status == 304, "Unchanged").when((status >= 200) & (status < 300), "Success").when(passing & (attempt <= retries), "retry").otherwise("HTTP Error")


def fetched(attempts: DataFrame, key: str, attempt: str, status: str, retries: int = 2) -> DataFrame:
    """(key, outcome, attempts): each source's first attempt that isn't to be repeated, and how many it took."""
    told = attempts.where(F.col(attempt) <= retries + 1).withColumn("outcome", fetch_outcome(F.col(status), F.col(attempt), retries)).where("outcome <> 'retry'")
    return told.groupBy(key).agg(F.min_by("outcome", attempt).alias("outcome"), F.min(attempt).alias("attempts"))


def search(requests: DataFrame, index: DataFrame, words: str = "words") -> DataFrame:
    """(request_id, id, position): for each request the newest rows of an index that hold all words of its query.

    Requests have request_id, query words, count, language, domains, since and until; null predicates ask for nothing.
    The distinct words of all queries go to every task, where each row of the index keeps those it
    holds. They are counted, and each request meets the rows of its rarest word with all else that they
    hold; a limited rank keeps ``MOST_RESULTS`` of a request in each task before the only large shuffle.
    """
    asked = requests.withColumns({"count": clamped_count(F.col("count")), "domains": F.slice(F.coalesce("domains", F.array().cast("array<string>")), 1, MOST_DOMAINS)})
    terms = asked.select("request_id", F.explode(F.array_distinct("query")).alias("word"))
    known = terms.agg(F.collect_set("word").alias("__known"))
    told = index.join(F.broadcast(known)).withColumn("__held", F.array_intersect(words, "__known")).drop("__known", words).where(F.size("__held") > 0)
    posted = told.withColumn("word", F.explode("__held"))
    seen = posted.groupBy("word").agg(F.count("*").alias("n"))
    counted = terms.join(seen, "word", "left")
    probe = counted.groupBy("request_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("r")).select("request_id", F.col("r.word").alias("word"))
    hit = posted.join(probe.join(asked, "request_id"), "word")
    good = F.size(F.array_except("query", "__held")) == 0
    for rule in (
        F.col("language").isNull() | (F.col("lang") == F.col("language")),
        (F.size("domains") == 0) | F.array_contains("domains", F.col("domain")),
        F.col("since").isNull() | (F.col("published") >= F.col("since")),
        F.col("until").isNull() | (F.col("published") <= F.col("until")),
    ):
        good = good & rule
    w = W.partitionBy("request_id").orderBy(F.desc_nulls_last("published"), "id")
    return hit.where(good).withColumn("position", F.row_number().over(w)).where(F.col("position") <= MOST_RESULTS).where(F.col("position") <= F.col("count")).select("request_id", "id", "position")


def discovered(found: DataFrame, deficits: dict[str, int], excluded: DataFrame, most: int) -> DataFrame:
    """Rows (region, provider, url_hash, published, ...) of regions that lack some: not excluded, each address for its first region, ``most`` a region, ordered."""
    needy = [r for r, n in deficits.items() if n > 0]
    rank = F.array_position(F.array(*map(F.lit, needy or ["-"])), F.col("region"))
    fresh = found.where(F.col("region").isin(*needy or ["-"])).join(excluded.select("url_hash").distinct(), "url_hash", "left_anti").withColumn("__rank", rank)
    order = [F.desc_nulls_last("published"), F.asc("url_hash")]
    once = fresh.withColumn("__n", F.row_number().over(W.partitionBy("url_hash").orderBy("__rank", "provider", *order))).where("__n = 1")
    return once.withColumn("position", F.row_number().over(W.partitionBy("region").orderBy("provider", *order))).where(F.col("position") <= most).drop("__rank", "__n")


def region_query(region: Column, terms: dict[str, str], topics: Column) -> Column:
    """A boolean query of a region's terms and of topics in quotes; either may be missing."""
    names = F.create_map(*(F.lit(x) for pair in terms.items() for x in pair))
    place = F.coalesce(F.try_element_at(names, region), F.lit(""))
    said = F.array_join(F.transform(F.filter(topics, lambda t: F.trim(t) != ""), lambda t: F.concat(F.lit('"'), t, F.lit('"'))), " OR ")
    return F.when((place != "") & (said != ""), F.concat(F.lit("("), place, F.lit(") AND ("), said, F.lit(")"))).when(place != "", place).otherwise(said)


def provider_order(sources: DataFrame, provider: str, quality: str, order: list[Column]) -> DataFrame:
    """The best source of each provider, best first, with ``rank``: a row for each provider."""
    best = sources.withColumn("__n", F.row_number().over(W.partitionBy(provider).orderBy(F.desc(quality), *order))).where("__n = 1").drop("__n")
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc(quality), provider)))


def preferred_domains(sources: DataFrame, regions: str, wanted: tuple[str, ...], by: str, host: Column, quality: str) -> DataFrame:
    """(by, hosts): the hosts of sources that cover a wanted region, best quality first."""
    covered = sources.where(F.arrays_overlap(regions, F.array(*map(F.lit, wanted))))
    hosts = covered.groupBy(by, host.alias("host")).agg(F.max(quality).alias("q"))
    return hosts.groupBy(by).agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("q")).alias("q"), "host"))), lambda x: x["host"]).alias("hosts"))
