"""A store that holds one row for each key, in buckets of which an upsert writes the touched ones alone.

A key's bucket follows its hash. An upsert reads the buckets that its rows fall into, keeps
the latest row of each key, writes these buckets into a new folder and publishes a version
in which they replace the old ones; all other buckets stay as files where they are. So every
bucket is always compact, a reader's version never changes under it, and an upsert that fails
leaves the version before.

The latest row of a key is that of greatest ``order``, nulls first; of equal ones the row of
the later upsert, and within one upsert the greatest row. Rows without a key have no identity
and aren't stored. An upsert of no rows publishes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.sources import commits


@dataclass(frozen=True)
class KeyedStore:
    """``schema`` names the columns; ``buckets`` bounds what an upsert reads and writes again, and the length of a manifest."""

    spark: SparkSession
    place: str
    schema: str
    key: str
    order: str
    buckets: int = 64

    @property
    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.schema.split(", ")]

    def rows(self, version: int | None = None) -> DataFrame:
        """All rows of the latest version, or of an earlier one."""
        _, named = commits.current(self.spark, self.place, version)
        return commits.read(self.spark, self.schema, [f for folders in named.values() for f in folders])

    def get(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys of a table that has the key's column; only their buckets are read."""
        wanted = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        _, named = commits.current(self.spark, self.place)
        return commits.read(self.spark, self.schema, self._folders(named, self._touched(wanted))).join(wanted, self.key, "left_semi")

    def upsert(self, rows: DataFrame) -> int:
        """Adds or replaces the rows' keys; the version that holds them."""
        version, named = commits.current(self.spark, self.place)
        new = rows.select(*self.columns).where(F.col(self.key).isNotNull())
        touched = self._touched(new)
        if not touched:
            return version
        old = commits.read(self.spark, self.schema, self._folders(named, touched))
        both = old.withColumn("__turn", F.lit(0)).unionByName(new.withColumn("__turn", F.lit(1)))
        rank = W.partitionBy(self.key).orderBy(F.desc_nulls_last(self.order), F.desc("__turn"), *(F.desc(c) for c in self.columns))
        latest = both.withColumn("__n", F.row_number().over(rank)).where("__n = 1").select(*self.columns, self._bucket().alias("__bucket"))
        folder = commits.staged(self.place, "buckets")
        # one task, and so one file, for each bucket
        latest.repartition(len(touched), "__bucket").sortWithinPartitions("__bucket", self.key).write.partitionBy("__bucket").parquet(folder)
        told = {b: fs for b, fs in named.items() if b not in touched} | {b: [f"{folder}/__bucket={b}"] for b in touched}
        return commits.publish(self.spark, self.place, version, told)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _touched(self, rows: DataFrame) -> list[str]:
        """The buckets of rows, as manifests name them: ``buckets`` at most."""
        return sorted(str(r[0]) for r in rows.select(self._bucket().alias("b")).distinct().collect())

    @staticmethod
    def _folders(named: dict[str, list[str]], buckets: list[str]) -> list[str]:
        return [f for b in buckets for f in named.get(b, [])]


def seen_store(spark: SparkSession, place: str) -> KeyedStore:
    """Addresses that runs have passed on."""
    return KeyedStore(spark, place, "url_hash string, title string, canonical_url string, source string, page_id string, created_at timestamp", "url_hash", "created_at")


def image_store(spark: SparkSession, place: str) -> KeyedStore:
    """The image that was last found for each address."""
    return KeyedStore(spark, place, "url_hash string, image_url string, provider string, recorded_at timestamp", "url_hash", "recorded_at")
