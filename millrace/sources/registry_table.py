"""The table of sources: validated as a whole, read in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.gates import source_errors
from millrace.sources.schema import SOURCE, assert_schema


def row_errors(rows: DataFrame) -> DataFrame:
    """(id, errors) of the rows that break a rule."""
    c = F.col
    return rows.select("id", source_errors(c("source_type"), c("quality"), c("check_frequency"), c("collection_method"), c("feed_url")).alias("errors")).where(F.size("errors") > 0)


def active_sources(rows: DataFrame) -> DataFrame:
    """Active sources by name, then id; any invalid one fails the load, naming up to a hundred."""
    active = assert_schema(rows, SOURCE).where("active")
    wrong = row_errors(active).orderBy("id").limit(100).collect()
    if wrong:
        raise ValueError("; ".join(f"{r['id']}: {', '.join(r['errors'])}" for r in wrong))
    return active.orderBy(F.lower("name"), "id")


def property_text(column: str) -> Column:
    """The plain text of a property that is an array of {plain_text}."""
    return F.array_join(F.transform(F.coalesce(F.col(column), F.array().cast("array<struct<plain_text:string>>")), lambda x: F.coalesce(x["plain_text"], F.lit(""))), "")
