"""Checks of drafted text against its evidence, line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import claims, urls
from millrace.functions.bind import let


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("pos", "line"))


def sections(rows: DataFrame, key: str, heading: Column) -> DataFrame:
    """Line rows with ``section``: how many headings have come so far, 0 before the first."""
    return rows.withColumn("section", F.sum(heading.cast("int")).over(W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)))


def story_text(rows: DataFrame, key: str, heading: Column) -> DataFrame:
    """One row for each section: what it claims, without its heading, sources, images and tag lines."""
    kept = rows.where(~heading & ~F.col("line").rlike(r"(?i)^\s*(sources?\s*:|!\[|#\w|tags?\s*:)") & (F.trim("line") != ""))
    return kept.groupBy(key, "section").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("story"), F.count("*").alias("lines"))


def source_urls(rows: DataFrame, key: str) -> DataFrame:
    """(key, section, urls) that stand on a sources line or after it in the section."""
    label = F.col("line").rlike(r"(?i)^\s*sources?\s*:")
    after = F.max(label.cast("int")).over(W.partitionBy(key, "section").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    found = rows.withColumn("__after", after).where("__after = 1").select(key, "section", F.explode(F.regexp_extract_all("line", F.lit(r"(https?://[^\s)>\]]+)"), 1)).alias("u"))
    return found.groupBy(key, "section").agg(F.array_sort(F.collect_set(urls.canonical_url(F.regexp_replace("u", r"[.,;:]+$", "")))).alias("urls"))


def evidence_warning(status: Column) -> Column:
    return F.when(status.isin("extracted", "feed_content"), F.lit(None)).when(status == "", "no evidence was retrieved").otherwise(F.concat(F.lit("evidence is "), status))


def number_warnings(stories: DataFrame, evidence: DataFrame, on: list[str]) -> DataFrame:
    """Each story's claims that its own evidence lacks; stories without evidence have none supported."""
    joined = stories.join(evidence, on, "left")
    both = F.struct(claims.numeric_claims(F.col("story")).alias("s"), claims.numeric_claims(F.coalesce("evidence", F.lit(""))).alias("e"))
    left = let(both, lambda x: claims.unsupported(x["s"], x["e"]))
    return joined.select(*on, F.explode(left).alias("c")).select(*on, F.col("c.value").alias("value"), F.col("c.unit").alias("unit"))


def zip_by_position(sections_: DataFrame, articles: DataFrame, on: list[str]) -> DataFrame:
    """Sections and articles of equal place, with ``status``: ok, missing section or extra section."""
    both = sections_.withColumn("__s", F.lit(1)).join(articles.withColumn("__a", F.lit(1)), on, "full")
    return both.withColumn("status", F.when(F.col("__s").isNull(), "missing section").when(F.col("__a").isNull(), "extra section").otherwise("ok")).drop("__s", "__a")


def replaced_section(rows: DataFrame, key: str, start: str, end: str, new: DataFrame) -> DataFrame:
    """Line rows with what lies from a start to an end marker exchanged for ``new`` (key, n, line).

    Without the end marker the section reaches to the end; without the start, new lines come last.
    Running it twice changes nothing more.
    """
    w = W.partitionBy(key).orderBy("pos")
    opened = F.sum((F.trim("line") == start).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))
    closed = F.coalesce(F.sum((F.trim("line") == end).cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    marked = rows.withColumn("__in", (opened > 0) & (closed == 0))
    place = rows.groupBy(key).agg(F.min(F.when(F.trim("line") == start, F.col("pos"))).alias("__at"), (F.max("pos") + 1).alias("__end"))
    outside = marked.where(~F.col("__in")).select(key, F.col("pos").cast("double").alias("place"), F.lit(0).alias("n"), "line")
    inside = new.join(place, key).select(key, F.coalesce("__at", "__end").cast("double").alias("place"), (F.col("n") + 1).alias("n"), "line")
    return outside.unionByName(inside).select(key, (F.row_number().over(W.partitionBy(key).orderBy("place", "n")) - 1).alias("pos"), "line")


def inserted_after(rows: DataFrame, key: str, anchors: DataFrame) -> DataFrame:
    """Line rows with ``anchors`` (key, pos, line) inserted after the given places."""
    both = rows.select(key, F.col("pos").cast("double").alias("place"), F.lit(0).alias("n"), "line").unionByName(anchors.select(key, F.col("pos").cast("double").alias("place"), F.lit(1).alias("n"), "line"))
    return both.select(key, (F.row_number().over(W.partitionBy(key).orderBy("place", "n", "line")) - 1).alias("pos"), "line")


def joined_lines(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("text"))
