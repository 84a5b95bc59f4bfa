"""Orders, round-robins and limits, all as windows with a unique last key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def metadata_order() -> list[Column]:
    """More specific, better rated, concrete, newer, longer snippet, then the address."""
    return [F.desc("specificity"), F.desc(F.coalesce("quality", F.lit(0.0))), F.desc("concrete"), F.desc_nulls_last("published"), F.desc(F.least(F.length("snippet"), F.lit(500))), F.asc("url")]


def final_order() -> list[Column]:
    return [F.desc("score"), F.desc("relevance"), F.desc("significance"), F.desc(F.coalesce("quality", F.lit(0.0))), F.desc_nulls_last("published"), F.asc("url")]


def decision_order() -> list[Column]:
    tier = F.when(F.col("decision") == "Relevant", 0).when(F.col("decision") == "Borderline", 1).otherwise(2)
    return [tier, F.desc("relevance"), F.desc(F.coalesce("quality", F.lit(0.0))), F.desc_nulls_last("published"), F.asc("url")]


def round_robin(rows: DataFrame, group: list[str], publisher: str, order: list[Column], top: int | None = None) -> DataFrame:
    """``rows`` with ``turn`` and ``position``: every publisher's first, in the order of these, then every second one.

    With ``top``, only the first so many positions of a group are kept; no publisher can place
    more rows among them, so the rest goes before the group's own sort.
    """
    ranked = rows.withColumn("turn", F.row_number().over(W.partitionBy(*group, publisher).orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("turn") <= top)
    firsts = ranked.where("turn = 1")
    lead = firsts.select(*group, publisher, F.row_number().over(W.partitionBy(*group).orderBy(*order)).alias("__lead"))
    if top is not None:
        lead = lead.where(F.col("__lead") <= top)
    placed = ranked.join(lead, [*group, publisher]).withColumn("position", F.row_number().over(W.partitionBy(*group).orderBy("turn", "__lead"))).drop("__lead")
    return placed.where(F.col("position") <= top) if top is not None else placed


def top_k(rows: DataFrame, group: list[str], order: list[Column], k: int, position: str = "position") -> DataFrame:
    return rows.withColumn(position, F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col(position) <= k)


def budgeted(rows: DataFrame, group: list[str], position: str, consumes: Column, budget: Column) -> DataFrame:
    """``rows`` with ``used`` and ``within``: rows before ``position`` that consume, and whether the budget still holds for this one."""
    w = W.partitionBy(*group).orderBy(position)
    used = F.coalesce(F.sum(consumes.cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("used", used).withColumn("within", F.col("used") < budget)


def first_distinct(rows: DataFrame, group: list[str], identity: str, order: list[Column]) -> DataFrame:
    """In each group the first row of every identity, with its place among these."""
    first = rows.withColumn("__n", F.row_number().over(W.partitionBy(*group, identity).orderBy(*order))).where("__n = 1").drop("__n")
    return first.withColumn("position", F.row_number().over(W.partitionBy(*group).orderBy(*order)))


def featured(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first rows of all; each task keeps no more than these."""
    return rows.orderBy(*order).limit(most)
