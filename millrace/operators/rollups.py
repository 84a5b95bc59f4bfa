"""Roll-ups, evaluation metrics and comparisons, as aggregations with partial sums before every shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.ranges import exact_median, running


def stage_rollup(rows: DataFrame, grain: list[str], flags: dict[str, Column], identity: str) -> DataFrame:
    """By phase and region, by phase, and overall: rows, conditional counts and distinct identities.

    An approximate distinct count is no substitute here; the exact one expands rows once for
    each distinct column only.
    """
    counts = [F.count_if(c).alias(name) for name, c in flags.items()]
    return rows.rollup(*grain).agg(F.count("*").alias("n"), *counts, F.count_distinct(identity).alias("identities"))


def reconsidered(rows: DataFrame, identity: str, phase: str, seq: str, region: str) -> DataFrame:
    """For each identity its phases, whether it was seen in more than one, and its region in the last."""
    return rows.groupBy(identity).agg(F.count_distinct(phase).alias("phases"), F.max_by(region, F.struct(seq, region)).alias("last_region")).withColumn("again", F.col("phases") > 1)


def best_then_count(rows: DataFrame, identity: str, best: list[Column], method: str, flags: dict[str, str]) -> DataFrame:
    """One representative of each identity with any() of its flags, then counts by method."""
    pick = F.max_by(method, F.struct(*best))
    one = rows.groupBy(identity).agg(pick.alias(method), *(F.bool_or(c).alias(name) for name, c in flags.items()))
    return one.groupBy(method).agg(F.count("*").alias("n"), *(F.count_if(name).alias(name) for name in flags))


def binary_metrics(rows: DataFrame, predicted: Column, actual: Column, by: list[str] | None = None) -> DataFrame:
    """TP, FP, FN, TN, precision and recall (null without cases); null predictions or labels count as unresolved."""
    known = predicted.isNotNull() & actual.isNotNull()
    n = lambda p, a: F.count_if(known & (predicted == F.lit(p)) & (actual == F.lit(a)))
    out = rows.groupBy(*(by or [])).agg(n(True, True).alias("tp"), n(True, False).alias("fp"), n(False, True).alias("fn"), n(False, False).alias("tn"), F.count_if(~known).alias("unresolved"))
    share = lambda a, b: F.round(F.try_divide(F.col(a), F.col(a) + F.col(b)), 6)
    return out.withColumns({"precision": share("tp", "fp"), "recall": share("tp", "fn")})


def with_total(rows: DataFrame, grain: list[str], aggregates: list[Column], median: tuple[str, str] | None = None, label: str = "ALL") -> DataFrame:
    """Groups by ``grain``, and again without its first column, which then reads ALL; with the exact ``median`` of a column under a name."""
    first, rest = grain[0], grain[1:]
    sets = [[F.col(c) for c in grain], [F.col(c) for c in rest]]
    out = rows.groupingSets(sets, *(F.col(c) for c in grain)).agg(F.grouping(first).alias("__all"), *aggregates)
    told = out.withColumn(first, F.when(F.col("__all") == 1, label).otherwise(F.col(first).cast("string"))).drop("__all")
    if median is None:
        return told
    value, into = median
    twice = rows.select(F.explode(F.array(F.col(first).cast("string"), F.lit(label))).alias(first), *rest, value)
    found = exact_median(twice, grain, value, into).select(*(F.col(c).alias(f"__{c}") for c in grain), into)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in grain])
    return told.join(found, same, "left").drop(*(f"__{c}" for c in grain))


def run_diff(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """For keys of both runs the fields that differ, nulls equal to nulls."""
    l, r = left.alias("l"), right.alias("r")  # noqa: E741
    changed = F.array_compact(F.array(*(F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), F.lit(c)) for c in fields)))
    return l.join(r, F.col(f"l.{key}") == F.col(f"r.{key}")).select(F.col(f"l.{key}").alias(key), changed.alias("changed")).where(F.size("changed") > 0)


def running_ledger(rows: DataFrame, by: list[str], order: list[str], cost: Column, cap: float) -> DataFrame:
    """``rows`` with the running total in each group and whether it is still under the cap. The order is unique; no group gathers in one task."""
    return running(rows, by, order, {"spent": cost}).withColumn("spent", F.round("spent", 2)).withColumn("allowed", F.col("spent") <= cap)


def success_rates(rows: DataFrame, by: str, ok: Column, value: str, least: float, most: float) -> DataFrame:
    """(by, n, ok, share, rule): GO if the share of successes reaches ``least`` and the exact median of ``value`` is at most ``most``."""
    told = rows.groupBy(by).agg(F.count("*").alias("n"), F.count_if(ok).alias("ok"))
    middle = exact_median(rows, [by], value, "__median")
    go = (F.col("ok") >= least * F.col("n")) & (F.col("__median") <= most)
    return told.join(middle, by).withColumns({"share": F.round(F.col("ok") / F.col("n"), 6), "rule": F.when(go, "GO").otherwise("NO-GO")}).drop("__median")


def token_usage(rows: DataFrame, by: list[str], tokens: Column) -> DataFrame:
    """(by, tokens, unknown, requests): sums in which unknown counts are 0, and how many are unknown."""
    return rows.groupBy(*by).agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"), F.count_if(tokens.isNull()).alias("unknown"), F.count("*").alias("requests"))


def merged_maps(rows: DataFrame, by: list[str], maps: str) -> DataFrame:
    """(by, key, value): the maps of all rows of a group added key by key."""
    return rows.select(*by, F.explode(maps)).groupBy(*by, "key").agg(F.sum("value").alias("value"))


def union_keys(*parts: tuple[DataFrame, str], into: str = "k") -> DataFrame:
    """The distinct non-null keys of several tables."""
    return reduce(DataFrame.unionByName, [rows.select(F.col(c).alias(into)) for rows, c in parts]).where(F.col(into).isNotNull()).distinct()


def union_relations(old: Column, new: Column) -> Column:
    """struct<related, changed>: the old relations in order, then new ones that aren't among them; unchanged ones need no write."""
    both = F.array_union(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>")))
    return F.struct(both.alias("related"), (F.size(both) > F.size(F.array_distinct(F.coalesce(old, F.array().cast("array<string>"))))).alias("changed"))


def tier_counts(rows: DataFrame, tier: str, tiers: tuple[str, ...], by: list[str] | None = None) -> DataFrame:
    """How many rows of each tier, zeros included."""
    return rows.groupBy(*(by or [])).agg(*(F.count_if(F.col(tier) == t).alias(t) for t in tiers))


def set_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys in both and in either one alone."""
    both = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))).groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return both.agg(F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("overlap"), F.count_if((F.col("l") == 1) & (F.col("r") == 0)).alias("unique_left"), F.count_if((F.col("l") == 0) & (F.col("r") == 1)).alias("unique_right"))


def stratified_turns(rows: DataFrame, by: str, order: list[Column], budget: int) -> DataFrame:
    """Turn by turn one row of each group, up to ``budget`` rows in all.

    No group can give more than ``budget`` rows, so each keeps that many before the global order.
    """
    ranked = rows.withColumn("turn", F.row_number().over(W.partitionBy(by).orderBy(*order))).where(F.col("turn") <= budget)
    return ranked.orderBy("turn", by).limit(budget)
