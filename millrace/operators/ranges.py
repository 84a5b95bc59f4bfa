"""Ranks and running sums of groups of any size: a group is spread over ranges of its order, and none of it meets in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.plans.lineage import cut


def ranged(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows``, stored in ranges of (by, order), with the range as ``__part``. Storing fixes the ranges, which are sampled."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(max(1, parts), *by, *order)).withColumn("__part", F.spark_partition_id())


def running(rows: DataFrame, by: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with running sums over each group in order, the row itself included. The order is unique in a group; nulls count as 0.

    Each range sums up its part of a group; a group's parts, one row for each range at most,
    give what stands before each; within a range the sums run on from there.
    """
    own = [f"__{n}" for n in sums]
    stored = ranged(rows.withColumns({f"__{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()}), by, order)
    part = stored.groupBy("__part", *by).agg(*(F.sum(c).alias(c) for c in own))
    earlier = W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = part.select("__part", *(F.col(b).alias(f"__by_{b}") for b in by), *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__before{c}") for c in own))
    inside = W.partitionBy("__part", *by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    within = stored.withColumns({f"__in{c}": F.sum(c).over(inside) for c in own}).withColumnRenamed("__part", "__at")
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__by_{b}")) for b in by], F.col("__at") == F.col("__part"))
    told = within.join(before, same).withColumns({n: F.col(f"__in__{n}") + F.col(f"__before__{n}") for n in sums})
    return told.select(*rows.columns, *sums)


def exact_median(rows: DataFrame, by: list[str], value: str, into: str) -> DataFrame:
    """(by, into): the exact median of each group's values, null without any.

    Only the ranges that hold a group's middle are ranked; counts of ranges tell which those are.
    """
    stored = ranged(rows.select(*by, value).where(F.col(value).isNotNull()), by, [value])
    counts = stored.groupBy("__part", *by).agg(F.count("*").alias("n"))
    all_, earlier = W.partitionBy(*by), W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    placed = counts.withColumns({"total": F.sum("n").over(all_), "before": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    middle = placed.where((F.col("before") < high) & (F.col("before") + F.col("n") >= low)).select(F.col("__part").alias("__at"), *(F.col(b).alias(f"__by_{b}") for b in by), (low - F.col("before")).alias("low"), (high - F.col("before")).alias("high"))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__by_{b}")) for b in by], F.col("__at") == F.col("__part"))
    ranked = stored.join(middle, same).withColumn("rank", F.row_number().over(W.partitionBy("__part", *by).orderBy(value)))
    found = ranked.where((F.col("rank") == F.col("low")) | (F.col("rank") == F.col("high"))).groupBy(*by).agg(F.avg(value).alias(into))
    groups = rows.select(*by).distinct()
    match = reduce(lambda a, b: a & b, [F.col(f"g.{b}").eqNullSafe(F.col(f"f.{b}")) for b in by])
    return groups.alias("g").join(found.alias("f"), match, "left").select(*(F.col(f"g.{b}").alias(b) for b in by), into)


class Machine:
    """What ``folded`` runs along a group: a new one begins each group, and ``step`` takes a row's values to its results."""

    def step(self, *values: object) -> tuple:
        raise NotImplementedError


def folded(rows: DataFrame, by: list[str], order: list[Column], inputs: dict[str, Column], machine: Callable[[], Machine], outputs: str) -> DataFrame:
    """``rows`` with ``outputs``, which a sequential rule gives row by row along each group in order.

    Rows are dealt by group and sorted, which spills; a task reads them as a stream of batches
    and carries one machine across them, so a group may be of any length and nothing of it is
    held but the machine's own state. A rule that needs every earlier decision can't be split
    further; what can is ``running``. Null keys are a group; the order decides all, ties included.
    """
    kinds, names = dict(rows.dtypes), [f.strip().split()[0] for f in outputs.split(",")]
    marked = rows.withColumns({f"__i{k}": c for k, c in enumerate(inputs.values())} | {f"__o{k}": c for k, c in enumerate(order)})
    ready = marked.repartition(*by).sortWithinPartitions(*by, *(F.col(f"__o{k}") for k in range(len(order)))).drop(*(f"__o{k}" for k in range(len(order))))
    keys, width = [rows.columns.index(b) for b in by], len(rows.columns)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rows.columns), outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = object(), None
        for batch in batches:
            told: list[tuple] = []
            columns = batch.columns
            for key, values in zip(zip(*(columns[k].to_pylist() for k in keys), strict=True), zip(*(c.to_pylist() for c in columns[width:]), strict=True), strict=True):
                if key != at:
                    at, now = key, machine()
                told.append(now.step(*values))
            made = [pa.array(list(c)) for c in zip(*told, strict=True)] or [pa.nulls(0)] * len(names)
            yield pa.RecordBatch.from_arrays([*columns[:width], *(m.cast(t) for m, t in zip(made, types, strict=True))], names=[*batch.schema.names[:width], *names])

    types = [to_arrow_type(f.dataType) for f in rows.sparkSession.createDataFrame([], outputs).schema]
    return ready.mapInArrow(run, schema)
