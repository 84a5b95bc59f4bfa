"""A document store behind a table: filtered, sorted and paged scans, lookups, ordered children, and keyed changes.

What a remote store does by requests is a plan here: predicates and sorts are expressions that
Parquet can use, and changes give the table that the store has after them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The most rows of a page, and of a request that appends.
PAGE, APPEND = 100, 100


def predicate(tree: dict) -> Column:
    """A condition from {and: [...]}, {or: [...]} or {property, one of equals, is_in, contains, on_or_after, on_or_before, is_empty}; a null value doesn't hold."""
    if "and" in tree or "or" in tree:
        key = "and" if "and" in tree else "or"
        parts = [predicate(t) for t in tree[key]]
        return reduce(lambda a, b: a & b if key == "and" else a | b, parts, F.lit(key == "and"))
    c, (rule, value) = F.col(tree["property"]), next((k, v) for k, v in tree.items() if k != "property")
    rules = {
        "equals": lambda: c == F.lit(value), "is_in": lambda: c.isin(*value), "contains": lambda: c.contains(value), "on_or_after": lambda: c >= F.lit(value), "on_or_before": lambda: c <= F.lit(value),
        "is_empty": lambda: (F.coalesce(c.cast("string"), F.lit("")) == "") == F.lit(value), "relates_to": lambda: F.array_contains(c, value),
    }
    if rule not in rules:
        raise ValueError(f"no such rule: {rule}")
    return F.coalesce(rules[rule](), F.lit(False))


def scan(rows: DataFrame, where: dict | None = None, sorts: list[Column] | None = None, most: int | None = None, page: int = PAGE) -> DataFrame:
    """The rows that a paged request gives, with ``page`` and ``place``; ``most`` stops it early. The sorts have a unique last key."""
    if not 1 <= page <= PAGE:
        raise ValueError(f"a page has 1 to {PAGE} rows")
    found = rows.where(predicate(where)) if where else rows
    if most is not None:
        found = found.orderBy(*(sorts or [F.col(rows.columns[0])])).limit(most)  # a bounded sort in every task
        place = F.row_number().over(W.orderBy(*(sorts or [F.col(rows.columns[0])])))
        return found.withColumn("place", place).withColumn("page", F.floor((F.col("place") - 1) / page).cast("int"))
    return found.orderBy(*sorts) if sorts else found


def lookup(rows: DataFrame, key: str, value: object) -> DataFrame:
    """The row of a key, or none."""
    return rows.where(F.col(key) == F.lit(value)).limit(1)


def first_of(rows: DataFrame, by: list[str], where: dict, order: list[Column]) -> DataFrame:
    """For each group the first row that a predicate holds for, as repeated requests with a limit of one would give."""
    return rows.where(predicate(where)).withColumn("__n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where("__n = 1").drop("__n")


def children(blocks: DataFrame, parent: str, pos: str, page: int = PAGE) -> DataFrame:
    """Blocks with their place within the parent and the page that brings them."""
    place = F.row_number().over(W.partitionBy(parent).orderBy(pos))
    return blocks.withColumn("place", place).withColumn("page", F.floor((F.col("place") - 1) / page).cast("int"))


def append_requests(blocks: DataFrame, parent: str, pos: str, size: int = APPEND) -> DataFrame:
    """(parent, request, blocks): how many blocks each request appends, in order."""
    return children(blocks, parent, pos, size).groupBy(parent, F.col("page").alias("request")).agg(F.count("*").alias("blocks"))


def changed(rows: DataFrame, changes: DataFrame, key: str, seq: str) -> DataFrame:
    """The table after inserts, updates and deletes, given as rows with ``op`` and ``seq``; the last change of a key counts."""
    columns = [c for c in rows.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct("op", *columns), F.struct(seq, "op")).alias("__c"))
    joined = rows.join(last, key, "full").where(F.col("__c").isNull() | (F.col("__c.op") != "delete"))
    return joined.select(key, *(F.when(F.col("__c").isNull(), F.col(c)).otherwise(F.col(f"__c.{c}")).alias(c) for c in columns))


def transitioned(rows: DataFrame, status: str, wanted: str, allowed: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows with their new status and ``moved``; one that isn't reached from the old status leaves it as it is."""
    pairs = [(a, b) for a, targets in allowed.items() for b in targets]
    may = reduce(lambda x, y: x | y, [(F.col(status) == a) & (F.col(wanted) == b) for a, b in pairs], F.lit(False))
    moved = F.coalesce(may, F.lit(False))
    return rows.withColumn("moved", moved).withColumn(status, F.when(F.col("moved"), F.col(wanted)).otherwise(F.col(status)))
