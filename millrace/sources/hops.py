"""Redirects followed over a table of recorded answers, one hop of all addresses a round.

Each distinct address is followed once, however many rows carry it. A round joins the
addresses that are still under way with the answers to where they stand; those that have
arrived, failed or must not go on leave it, so rounds shrink, and there are ``most`` at the
most. Where a redirect leads has to be a public destination at every hop, the first included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.plans.lineage import cut

#: The hops that a client follows, and the answers that lead on.
MOST, REDIRECTS = 20, (301, 302, 303, 307, 308)
OUTCOMES = ("arrived", "failed", "refused destination", "loop", "too many hops", "no answer")


def followed(rows: DataFrame, answers: DataFrame, url: str = "url", most: int = MOST) -> DataFrame:
    """``rows`` with ``final_url``, ``final_status``, ``hops`` and ``outcome``.

    ``answers`` has url, status and location, for each url one row (of several the least). An
    address arrives where an answer below 400 doesn't redirect, or redirects without a location;
    from 400 on it failed. ``loop``: an address comes again; ``final_url`` is that address.
    ``too many hops``: the answer after ``most`` hops still redirects. ``refused destination``:
    the address isn't public, and nobody asks for it. ``no answer``: none is recorded. Null and
    empty addresses are refused destinations with no hop.
    """
    known = answers.where(F.col("url").isNotNull()).groupBy("url").agg(F.min(F.struct("status", "location")).alias("a")).select(F.col("url").alias("__at"), "a.status", "a.location")
    start = rows.select(F.col(url).alias("start")).distinct().where("start is not null")
    way = start.select("start", F.col("start").alias("at"), F.lit(0).alias("hops"), F.array("start").alias("past"), F.lit(None).cast("string").alias("ended"))
    way = cut(way.withColumn("ended", F.when(~_public(F.col("at")), "refused destination")))
    done = [way.where("ended is not null").select("start", "at", F.lit(None).cast("int").alias("status"), "hops", "ended")]
    way = way.where("ended is null")
    for hop in range(most + 1):
        asked = way.join(known, F.col("at") == F.col("__at"), "left")
        redirects = F.col("status").isin(*REDIRECTS) & (F.coalesce("location", F.lit("")) != "")
        to = F.regexp_replace(urls.resolved(F.col("location"), F.col("at")), "#.*$", "")
        step = asked.withColumn("to", F.when(redirects, to))
        ended = (
            F.when(F.col("__at").isNull(), "no answer").when(F.col("status") >= 400, "failed").when(F.col("to").isNull(), "arrived").when(F.lit(hop == most), "too many hops")
            .when(~_public(F.col("to")), "refused destination").when(F.array_contains("past", F.col("to")), "loop")
        )
        stored = cut(step.withColumn("ended", ended).select("start", "at", "status", "to", "hops", "past", "ended"))
        gone = F.col("ended").isin("refused destination", "loop")
        done.append(stored.where("ended is not null").select("start", F.when(gone, F.col("to")).otherwise(F.col("at")).alias("at"), "status", F.when(gone, F.col("hops") + 1).otherwise(F.col("hops")).alias("hops"), "ended"))
        way = stored.where("ended is null").select("start", F.col("to").alias("at"), (F.col("hops") + 1).alias("hops"), F.concat("past", F.array("to")).alias("past"), "ended")
        if hop == most or way.isEmpty():
            break
    told = done[0]
    for more in done[1:]:
        told = told.unionByName(more)
    found = told.select(F.col("start").alias("__start"), F.col("at").alias("final_url"), F.col("status").alias("final_status"), "hops", F.col("ended").alias("outcome"))
    joined = rows.join(found, F.col(url) == F.col("__start"), "left").drop("__start")
    return joined.withColumns({"final_url": F.coalesce("final_url", F.col(url)), "hops": F.coalesce("hops", F.lit(0)), "outcome": F.coalesce("outcome", F.lit("refused destination"))})


def _public(url: Column) -> Column:
    return F.coalesce(urls.public_destination(url), F.lit(False))


def host_chains(pages: DataFrame) -> DataFrame:
    """Answers in which each page leads to the next of its host, for chains out of pages (page_id, url)."""
    host = F.regexp_extract("url", r"://([^/?#]*)", 1)
    order = W.partitionBy("host").orderBy("page_id")
    return pages.select("page_id", "url", host.alias("host")).withColumns({"next": F.lead("url").over(order), "first": F.first("url").over(order)})
