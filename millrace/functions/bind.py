"""Naming an intermediate value within an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression that uses a value several times and computes it once; without it, nested uses multiply the plan."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(rows: DataFrame, **values: Column) -> DataFrame:
    """``rows`` with columns that are computed once, however often later ones use them: projections alone would be merged into their users."""
    for name, value in values.items():
        rows = rows.select("*", F.explode(F.array(value)).alias(name))
    return rows
