"""A week's quotas as state that a stream carries from one delivery to the next.

Rows are grouped by week and region. Of each delivery the earliest rows are admitted, by time
and then by id, while the region has room and their publisher is below its cap; what earlier
deliveries admitted counts. An id of a publisher is admitted once, at its earliest time. The
watermark follows the ends of weeks: a week stays open until rows of a week ``weeks`` later
arrive. Then its timer tells the total and forgets the state; rows of it that come still
later are dropped.

A task holds no more of a delivery than a region has room for, whatever arrives: of each
publisher its earliest rows up to the cap, and of all the earliest. Null times have no week and
are dropped, null ids too; null regions and publishers are a region and a publisher.
"""

from __future__ import annotations

from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Fixed value: the state store that carries named states and timers.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WEEK_MS = 7 * 24 * 3600 * 1000
FIELDS = "monday date, region string, publisher string, id long, at timestamp, place long, kind string"


def earliest(rows: Iterator[tuple], room: int, cap: int, used: dict, known: set) -> list[tuple]:
    """Of (at, id, publisher) the earliest ``room``, at most ``cap`` of a publisher with what it has ``used``."""
    kept: list[tuple] = []
    of: dict = defaultdict(list)
    for row in rows:
        at, number, publisher = row
        free = cap - used.get(publisher, 0)
        mine = of[publisher]
        if free <= 0 or not room or (publisher, number) in known or (len(kept) == room and row >= kept[-1]):
            continue
        old = next((m for m in mine if m[1] == number), mine[-1] if len(mine) == free else None)
        if old is not None:  # a later time of the same id, or the publisher's last within its cap
            if row >= old:
                continue
            mine.remove(old), kept.remove(old)
        insort(mine, row), insort(kept, row)
        if len(kept) > room:
            last = kept.pop()
            of[last[2]].remove(last)
    return kept


class WeeklyQuota(StatefulProcessor):
    """State of one week and region: how many are admitted, by publisher, and which."""

    def __init__(self, targets: dict[str, int], cap: int):
        self.targets, self.cap = targets, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.taken = handle.getValueState("taken", "n long")
        self.publishers = handle.getMapState("publishers", "publisher string", "n long")
        self.admitted = handle.getListState("admitted", "publisher string, id long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  the interface's names
        monday, region = key
        count = self.taken.get()[0] if self.taken.exists() else 0
        used = {k[0]: v[0] for k, v in self.publishers.iterator()} if count else {}
        known = {(r[0], r[1]) for r in self.admitted.get()} if count else set()
        if not count:
            self.handle.registerTimer(_millis(monday) + WEEK_MS)
        given = ((r["at"], r["id"], r["publisher"] or "") for r in rows)
        for at, number, publisher in earliest(given, max(0, self.targets.get(region, 0) - count), self.cap, used, known):
            count += 1
            used[publisher] = used.get(publisher, 0) + 1
            self.publishers.updateValue((publisher,), (used[publisher],))
            self.admitted.appendValue((publisher, number))
            yield Row(monday=monday, region=region, publisher=publisher, id=number, at=at, place=count, kind="admitted")
        self.taken.update((count,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        total = self.taken.get()[0] if self.taken.exists() else 0
        self.taken.clear(), self.publishers.clear(), self.admitted.clear()
        yield Row(monday=key[0], region=key[1], publisher=None, id=None, at=None, place=total, kind="closed")

    def close(self) -> None:
        pass


def _millis(monday) -> int:
    from datetime import UTC, datetime

    return int(datetime(monday.year, monday.month, monday.day, tzinfo=UTC).timestamp() * 1000)


def monday(at: Column) -> Column:
    return F.date_trunc("week", at).cast("date")


def weekly_quota(stream: DataFrame, at: str, number: str, region: Column, publisher: Column, targets: dict[str, int], cap: int, weeks: int = 2) -> DataFrame:
    """Rows admitted, as they are, and one of kind ``closed`` for each week and region that has ended."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    given = stream.where(F.col(at).isNotNull() & F.col(number).isNotNull()).withColumn("__ends", F.date_trunc("week", F.col(at)) + F.expr("INTERVAL 7 DAYS")).withWatermark("__ends", f"{7 * weeks} days")
    named = given.select("__ends", monday(F.col(at)).alias("monday"), F.coalesce(region.cast("string"), F.lit("")).alias("region"), publisher.cast("string").alias("publisher"), F.col(number).cast("long").alias("id"), F.col(at).alias("at"))
    return named.groupBy("monday", "region").transformWithState(WeeklyQuota(targets, cap), FIELDS, "append", "eventtime")


def admitted(rows: DataFrame, at: str, number: str, region: Column, publisher: Column, targets: dict[str, int], cap: int, delivery: Column | None = None) -> DataFrame:
    """The batch form, by ranks: of all rows in the order of their deliveries, those that ``weekly_quota`` admits.

    Ranks are limited, so Spark keeps ``cap`` rows of a publisher and ``target`` of a region in each task before it shuffles.
    """
    given = rows.where(F.col(at).isNotNull() & F.col(number).isNotNull()).select(
        monday(F.col(at)).alias("monday"), F.coalesce(region.cast("string"), F.lit("")).alias("region"), F.coalesce(publisher.cast("string"), F.lit("")).alias("publisher"),
        F.col(number).cast("long").alias("id"), F.col(at).alias("at"), (delivery if delivery is not None else F.lit(0)).alias("delivery"),
    )
    first = W.partitionBy("monday", "region", "publisher", "id").orderBy("delivery", "at")
    once = given.withColumn("n", F.row_number().over(first)).where("n = 1")
    own = once.withColumn("n", F.row_number().over(W.partitionBy("monday", "region", "publisher").orderBy("delivery", "at", "id"))).where(F.col("n") <= cap)
    most = max(targets.values(), default=0)
    place = own.withColumn("place", F.row_number().over(W.partitionBy("monday", "region").orderBy("delivery", "at", "id"))).where(F.col("place") <= most)
    goal = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in targets.items() for x in pair)), F.col("region")), F.lit(0)) if targets else F.lit(0)
    return place.where(F.col("place") <= goal).select("monday", "region", "publisher", "id", "at", F.col("place").cast("long").alias("place"))
