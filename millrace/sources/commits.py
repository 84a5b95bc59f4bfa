"""Several outputs made visible at once: folders are staged first, then one small manifest names them all.

A version of a place is a list of names with their folders. It is one file, which appears
whole by the rename that ends Spark's write, so a reader sees the version before or the
version after, never half of one, and a writer that fails leaves what was there. Two writers
who start from one version can't both publish the next: the second one's write is an error.
Folders that no version names are what failed writers left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "name string, folder string"


def versions(spark: SparkSession, place: str) -> list[int]:
    """All published versions, ascending; none for a place that isn't there yet."""
    try:
        found = spark.read.format("binaryFile").load(f"{place}/manifest/version=*/part-*").select("path")
        return sorted({int(r["path"].split("/version=")[1].split("/")[0]) for r in found.collect()})
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []


def current(spark: SparkSession, place: str, version: int | None = None) -> tuple[int, dict[str, list[str]]]:
    """(version, folders by name) of the latest version, or of a given one; (0, {}) if there is none."""
    known = versions(spark, place)
    if not known:
        return 0, {}
    at = version or known[-1]
    named: dict[str, list[str]] = {}
    for r in spark.read.schema(MANIFEST).json(f"{place}/manifest/version={at}").orderBy("name", "folder").collect():  # a row for each output
        named.setdefault(r["name"], []).append(r["folder"])
    return at, named


def staged(place: str, name: str) -> str:
    """A new folder for an output, which nobody sees before it is published."""
    return f"{place}/data/{name}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, place: str, base: int, named: dict[str, list[str]]) -> int:
    """Makes the folders the next version after ``base``; an error if someone else did so before."""
    rows = [(name, folder) for name, folders in sorted(named.items()) for folder in folders]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{place}/manifest/version={base + 1}")
    return base + 1


def read(spark: SparkSession, schema: str, folders: list[str] | None) -> DataFrame:
    """The rows of an output's folders; none without any."""
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
