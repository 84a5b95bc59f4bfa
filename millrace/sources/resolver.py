"""Wrapper addresses resolved within a budget, from recorded answers: each address once, in order, up to the first refusal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import urls

# The most attempts of a run and the least seconds between requests.
ATTEMPTS, SPACING = 48, 2


def resolution(rows: DataFrame, answers: DataFrame, key: str, url: str, order: list[Column], attempts: int = ATTEMPTS, spacing: int = SPACING) -> DataFrame:
    """(key, status, resolved, cached, sent_after) of rows whose address is a wrapper's.

    ``answers`` has url, status and target. The first row of each address is asked for, the others
    are served from memory. Addresses beyond ``attempts``, and all after the first that was
    refused, aren't asked. A target counts only if it is a public address and under
    ``expected``, where a row has one; that is checked for each row, remembered or not.
    Only as many addresses as attempts are ever ranked together. ``key`` is unique and settles equal ``order``.
    """
    at = F.struct(*(c.alias(f"o{k}") for k, c in enumerate([*order, F.col(key)])))
    # an address that many rows carry is one row of each task, and a row that comes back to them by a join
    firsts = rows.groupBy(F.col(url).alias("__of")).agg(F.min(at).alias("__first"))
    placed = rows.withColumn("__at", at).join(firsts, F.col(url).eqNullSafe(F.col("__of"))).withColumn("__again", F.col("__at") != F.col("__first")).drop("__of", "__at")
    asked = firsts.select(F.col("__of").alias(url), "__first").orderBy("__first").limit(attempts).withColumn("__place", F.row_number().over(W.orderBy("__first")))
    known = asked.join(answers, url, "left").withColumn("status", F.coalesce("status", F.lit("failed")))
    refused = F.coalesce(F.sum((F.col("status") == "refused").cast("int")).over(W.orderBy("__place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sent = known.withColumn("status", F.when(refused > 0, "skipped after refusal").otherwise(F.col("status"))).withColumn("sent_after", F.when(F.col("status") != "skipped after refusal", (F.col("__place") - 1) * spacing))
    told = placed.join(F.broadcast(sent.select(url, "status", "target", "sent_after")), url, "left")  # ``attempts`` rows at most
    safe = urls.public_destination(F.col("target")) & ((F.coalesce("expected", F.lit("")) == "") | urls.host_is_under(urls.hostname(F.col("target")), F.col("expected")))
    status = F.when(F.col("status").isNull(), "attempt budget exhausted").when((F.col("status") == "resolved") & ~F.coalesce(safe, F.lit(False)), "unsafe target").otherwise(F.col("status"))
    return told.withColumn("status", status).select(key, "status", F.when(F.col("status") == "resolved", F.col("target")).alias("resolved"), F.col("__again").alias("cached"), F.when(~F.col("__again"), F.col("sent_after")).alias("sent_after"))


def framed_value(body: Column, name: str) -> Column:
    """The second string of the one JSON array whose first is ``name``, one array a line; null unless there is exactly one."""
    arrays = F.transform(F.filter(F.split(body, r"\r?\n"), lambda x: F.trim(x).startswith("[")), lambda x: F.from_json(F.trim(x), "array<string>"))
    found = F.filter(arrays, lambda a: F.coalesce(F.try_element_at(a, F.lit(1)) == name, F.lit(False)))
    return F.when(F.size(found) == 1, F.try_element_at(F.try_element_at(found, F.lit(1)), F.lit(2)))


def attribute(markup: Column, name: str) -> Column:
    """The value of a tag's attribute, empty without one."""
    return F.regexp_extract(markup, rf"""\s{name}=["']([^"']*)["']""", 1)
