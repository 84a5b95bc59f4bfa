"""A run with all that it carries: registry and seen store read, the week's state read back, winners and audit published together.

A desk is a folder with a queue of winners, the audits of its runs and a store of seen
addresses. A run reads which addresses are taken and what the week has, decides every
article, stages the winners and the audit, and publishes both in one step, so no reader sees
winners without their audit or half of either. An audit that can't be written doesn't stop
the run: its winners are published with the audit before, and the report tells why. Seen
addresses are recorded after the winners are published. A run that breaks off between the
two loses nothing, since the queue's own addresses count as seen too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.operators import replay, selection
from millrace.plans import ingestion
from millrace.plans.lineage import cut
from millrace.plans.values import EngineConfig
from millrace.sources import commits
from millrace.sources.keyed_store import KeyedStore, seen_store

QUEUE = "run int, monday date, pick int, phase string, key long, url string, url_hash string, title string, region string, publisher string, source string, score double, published timestamp"
DETAIL = "run int, key long, url string, title string, outcome string, reason string, tier string, region string, score double, pick int"
REGISTRY = "source string, source_region string, quality double"


@dataclass(frozen=True)
class Report:
    """What a run did; ``outcomes`` counts its articles."""

    run: int
    winners: int
    outcomes: dict[str, int] = field(default_factory=dict)
    audit_error: str = ""

    def lines(self) -> list[str]:
        """The report as a console shows it."""
        told = [f"run {self.run}: {self.winners} winners of {sum(self.outcomes.values())} articles"]
        told += [f"  {n:>8}  {name}" for name, n in sorted(self.outcomes.items(), key=lambda x: (-x[1], x[0]))]
        return told + ([f"audit not written: {self.audit_error}"] if self.audit_error else [])


@dataclass(frozen=True)
class Desk:
    spark: SparkSession
    place: str

    @property
    def seen(self) -> KeyedStore:
        return seen_store(self.spark, f"{self.place}/seen")

    def queue(self) -> DataFrame:
        """All winners so far."""
        return commits.read(self.spark, QUEUE, self._named().get("queue"))

    def audit(self) -> tuple[DataFrame, list[str]]:
        """(detail, lines of the index) of the last run whose audit was written."""
        named = self._named()
        index = named.get("index")
        lines = [r["value"] for r in self.spark.read.text(index).collect()] if index else []  # a line for each outcome
        detail = named.get("detail")
        return self.spark.read.schema(DETAIL).json(detail) if detail else self.spark.createDataFrame([], DETAIL), lines

    def _named(self) -> dict[str, list[str]]:
        return commits.current(self.spark, self.place)[1]

    def run(self, articles: DataFrame, registry: DataFrame, now: datetime, config: EngineConfig | None = None, seams: ingestion.Seams | None = None, write_audit: Callable[[DataFrame, str, str], None] | None = None) -> Report:
        """One run over articles (doc_id, title, body, source, url, published); sources without a registry row have no region of their own."""
        config = (config or EngineConfig()).validate()
        version, named = commits.current(self.spark, self.place)
        number, monday = version + 1, F.date_trunc("week", F.lit(now)).cast("date")
        queue = commits.read(self.spark, QUEUE, named.get("queue"))
        week = selection.week_state(queue.where(F.col("monday") == monday))  # as many rows as a week's targets
        taken = self.seen.rows().select("url_hash").unionByName(queue.select("url_hash"))
        known = articles.join(registry.select(*(c.split()[0] for c in REGISTRY.split(", "))), "source", "left")
        pool = cut(ingestion.candidates(known.select("doc_id", *(c for c in known.columns if c != "doc_id")), F.lit(now), config, taken, seams))
        decided = cut(ingestion.select_all(pool, config, week))
        rows = pool.select(F.col("doc_id").alias("key"), "url", "title", "source", "published", "canonical", F.col("reason").alias("gate"))
        won = rows.join(F.broadcast(decided.where("pick is not null")), "key")  # broadcast: the run's winners
        winners = won.select(F.lit(number).alias("run"), monday.alias("monday"), "pick", "phase", "key", F.col("canonical").alias("url"), urls.url_hash(F.col("canonical")).alias("url_hash"), "title", "region", "publisher", "source", "score", "published")
        folder = commits.staged(self.place, "queue")
        winners.coalesce(1).write.parquet(folder)
        after = {**named, "queue": [*named.get("queue", []), folder]}
        detail = rows.join(decided, "key", "left").select(
            F.lit(number).alias("run"), "key", "url", "title", F.when(F.col("pick").isNotNull(), "selected").when(F.col("tier").isNotNull(), "not selected").otherwise("rejected").alias("outcome"),
            F.coalesce(F.when(F.col("tier").isNotNull(), F.col("reason")), F.when(F.col("tier").isNull(), F.col("gate"))).alias("reason"), "tier", "region", "score", "pick",
        )
        outcomes = {r["o"]: r["n"] for r in detail.groupBy(F.concat_ws(": ", "outcome", "reason").alias("o")).agg(F.count("*").alias("n")).collect()}  # a row for each reason
        error = ""
        try:
            paths = commits.staged(self.place, "detail"), commits.staged(self.place, "index")
            (write_audit or self._write_audit)(detail, *paths)
            after |= {"detail": [paths[0]], "index": [paths[1]]}
        except Exception as e:  # noqa: BLE001  whatever keeps an audit from being written
            error = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500]
        commits.publish(self.spark, self.place, version, after)
        stored = commits.read(self.spark, QUEUE, [folder])
        self.seen.upsert(stored.select("url_hash", "title", F.col("url").alias("canonical_url"), "source", F.concat_ws("-", F.lit(number), F.col("key")).alias("page_id"), F.lit(now).alias("created_at")))
        return Report(number, sum(n for o, n in outcomes.items() if o.startswith("selected")), outcomes, error)

    def _write_audit(self, detail: DataFrame, detail_path: str, index_path: str) -> None:
        """Every article as a line of JSON, and the counts by outcome as a Markdown table."""
        detail.write.json(detail_path)
        counts = self.spark.read.schema(DETAIL).json(detail_path).groupBy("outcome", "reason").agg(F.count("*").alias("articles"))
        text = replay.markdown_report(counts, ["outcome", "reason", "articles"], "Articles by outcome")
        self.spark.createDataFrame([(line,) for line in text.split("\n")], "value string").coalesce(1).write.text(index_path)
