"""A run with a model: every article is classified, a bounded number is assessed in detail, and winners are selected.

Gates, classification and ranks are distributed. The detailed assessment is a remote call per
article under a budget of a few dozen, and the order of calls depends on what came back, so
that loop runs on the driver, over the rows that can be reached by it: in each region no
more publishers than the budget and the week have, and no more rows of one than the budget.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import scores
from millrace.operators import assessment, events, gates, ranking, selection
from millrace.plans.ingestion import EVENT_FEATURES, event_features
from millrace.plans.lineage import cut
from millrace.plans.values import REGIONS, EngineConfig

#: Of an article: relevance, significance, region, story, novelty; it may raise.
Enrich = Callable[[dict], dict]
#: Of shortages by region: more articles.
Discover = Callable[[dict[str, int]], DataFrame | None]


@dataclass(frozen=True)
class Model:
    classify: assessment.Model
    enrich: Enrich
    discover: Discover = field(default=lambda shortages: None)
    #: What a retrieval changes of an article, by default nothing; it may raise.
    retrieve: Callable[[dict], dict] = field(default=lambda row: row)


ASSESSED = "key string, reason string, relevance int, significance int, region string, score double, outcome string"


def classified_pool(articles: DataFrame, now: Column, config: EngineConfig, model: Model, seen: DataFrame | None, phase: str) -> DataFrame:
    """All articles with ``reason`` from objective checks or the model's veto, ``decision``, ``score5`` and ``region``; an article without a verdict stays."""
    gated = cut(gates.objective_gate(articles, now, config, seen, "key"))  # every round of calls reads it
    asked = gated.where("reason is null").select(F.col("key").alias("id"), "title", "snippet")
    verdicts = assessment.classified(asked, ["title", "snippet"], model.classify)
    parts = F.split("decision", "[|]")  # decision|relevance|region
    told = verdicts.select(F.col("id").alias("key"), parts[0].alias("decision"), F.try_element_at(parts, F.lit(2)).try_cast("int").alias("score5"), F.try_element_at(parts, F.lit(3)).alias("__region"), F.col("error").alias("classification_error"))
    joined = gated.withColumnRenamed("reason", "objective").join(told, "key", "left")
    region = F.when(F.col("__region").isin(*REGIONS), F.col("__region"))
    reason = F.coalesce("objective", F.when(F.col("decision") == "Irrelevant", "classified irrelevant"))
    return joined.withColumns({"region": region, "reason": reason, "phase": F.lit(phase)}).drop("__region")


def _order() -> list[Column]:
    return ranking.decision_order()


def reachable(pool: DataFrame, budget: int, publishers: int) -> DataFrame:
    """Open rows that an assessment of ``budget`` rows can come to, whatever it finds, in weeks that have so many ``publishers``."""
    rows = pool.where("reason is null").withColumns({"relevance": F.coalesce("score5", F.lit(0)), "__region": F.coalesce("region", F.lit(""))})
    ranked = rows.withColumn("__n", F.row_number().over(W.partitionBy("__region", "publisher").orderBy(*_order()))).where(F.col("__n") <= budget)
    leads = ranked.where("__n = 1").withColumn("__lead", F.row_number().over(W.partitionBy("__region").orderBy(*_order())))
    kept = leads.where(F.col("__lead") <= budget + publishers).select("__region", "publisher")
    return ranked.join(kept, ["__region", "publisher"]).drop("__n", "__region")


class _Run:
    def __init__(self, pool: DataFrame, config: EngineConfig, model: Model, week: selection.State, excluded: set[str]):
        self.config, self.model, self.week, self.excluded = config, model, week, excluded
        self.targets = dict(zip(REGIONS, config.targets, strict=True))
        self.attempted: set[str] = set()
        self.tried: Counter = Counter()
        self.done: dict[str, dict] = {}
        self.same: dict[tuple[str, str], bool] = {}
        self.take(pool)

    def take(self, pool: DataFrame) -> None:
        """Brings what can be reached to the driver, in rank order."""
        short = reachable(pool, self.config.budget_max, len(self.week.publishers))
        self.features = cut(event_features(short).select("key", *EVENT_FEATURES))
        columns = ("key", "url", "canonical", "title", "snippet", "publisher", "registered", "quality", "published", "region", "decision", "score5")
        known = F.lit(False)
        if self.week.titles:
            known = selection._titles_known(F.col("title"), self.week.titles, self.config.event_similarity)
        self.rows = [r.asDict() for r in short.select(*columns, known.alias("known")).withColumn("relevance", F.coalesce("score5", F.lit(0))).orderBy(*_order()).collect()]
        for r in self.rows:
            decided = {"Relevant": 0, "Borderline": 1}.get(r["decision"], 2)
            r["merit"] = (decided, -(r["score5"] or 0), -(r["quality"] or 0), -(r["published"].timestamp() if r["published"] else 0))
            if r["known"] and r["key"] not in self.done:
                self.done[r["key"]] = {"reason": "existing event"}

    def pairs(self, keys: list[str]) -> None:
        """Learns which of these and the assessed rows are one event; as many as a budget, in one small job."""
        old = [k for k, d in self.done.items() if d.get("tier")]
        new = [(a, b) for i, a in enumerate(keys) for b in (*old, *keys[:i]) if a != b and (a, b) not in self.same]
        if not new:
            return
        asked = self.features.sparkSession.createDataFrame(new, "a string, b string")
        side = lambda name, at: self.features.select(F.col("key").alias(name), F.struct(*EVENT_FEATURES).alias(at))
        told = asked.join(side("a", "l"), "a").join(side("b", "r"), "b").select("a", "b", events.same_event("l", "r", self.config.event_similarity, policy=True).alias("same"))
        for r in told.collect():
            self.same[r["a"], r["b"]] = self.same[r["b"], r["a"]] = r["same"]

    def select(self, fallback: bool = False) -> tuple[list[dict], selection.State]:
        rows = [d for d in self.done.values() if d.get("tier")]
        rows.sort(key=lambda d: (-d["score"], -d["relevance"], -d["significance"], -(d["quality"] or 0), -(d["published"].timestamp() if d["published"] else 0), d["url"]))
        return selection.decide(rows, lambda a, b: self.same.get((a, b), False), self.targets, self.week, self.limit, self.config.publisher_cap, fallback)

    @property
    def limit(self) -> int:
        return self.config.run_limit

    def assess(self, budget: int, missing: dict[str, int], positive: bool = False, backfill: bool = False) -> int:
        open_ = [r for r in self.rows if r["key"] not in self.done and (not positive or r["decision"] is not None)]
        order = selection.allocate(open_, missing, budget, Counter(self.week.publishers) + self.tried, backfill)
        used = 0
        for at, row in enumerate(order):
            if used >= budget or (sum(1 for d in self.done.values() if d.get("tier") == "strict") >= self.limit and len(self.select()[0]) >= self.limit):
                break
            if at % max(1, budget) == 0:
                self.pairs([r["key"] for r in order[at : at + budget]])
            try:
                row = self.model.retrieve(row)
            except Exception:  # noqa: BLE001  a failed retrieval leaves the article as it was
                pass
            if row["canonical"] in self.excluded or row["canonical"] in self.attempted:
                self.done[row["key"]] = {"reason": "duplicate URL"}
                continue
            used += 1
            self.attempted.update((row["canonical"], row["url"]))
            self.tried[row["publisher"]] += 1
            self.done[row["key"]] = self.assessed(row)
        return used

    def assessed(self, row: dict) -> dict:
        required = self.config.minimum_relevance if row["registered"] else self.config.unregistered_relevance
        base = {"outcome": "attempted"}
        try:
            found = self.model.enrich(row)
        except Exception:  # noqa: BLE001  any failure of a call is an outcome, and has cost its place
            return base | {"reason": "enrichment failed: provider error"}
        scope = gates.scope_of(found["story"], found["novelty"])
        if scope:
            return base | {"reason": scope}
        relevance, significance = found["relevance"], max(1, min(5, found["significance"]))
        low = f"relevance below {required}" if relevance < required else None
        near = relevance < max(4, required) and relevance >= self.config.fallback_floor and significance >= self.config.fallback_floor and row["registered"]
        if low and not near:
            return base | {"reason": low}
        region = row["region"] or (found["region"] if found["region"] in REGIONS else None)
        if region is None:
            return base | {"reason": low or "geography unresolved after enrichment"}
        score = scores.score_of(relevance, significance, row["quality"], self.config.weights)
        told = {"key": row["key"], "url": row["canonical"], "region": region, "publisher": row["publisher"], "relevance": relevance, "significance": significance, "quality": row["quality"], "published": row["published"], "score": score}
        return base | told | {"reason": low, "tier": "fallback" if low else "strict"}


def run(articles: DataFrame, now: Column, config: EngineConfig, model: Model, week: selection.State | None = None, seen: DataFrame | None = None) -> DataFrame:
    """(key, phase, decision, region, reason, pick, tier, score) of every article: winners have a pick, all others the reason why not.

    Articles have key string, url, title, snippet, publisher, registered, quality and published. Three quarters of the
    initial budget go to what is there, the rest to that and to what is discovered for regions that lack rows; then
    small batches by quality, until the run is full, the budget is spent or no positive row is left.
    """
    config, week = config.validate(), week or selection.State()
    pool = cut(classified_pool(articles, now, config, model, seen, "rss"))
    own = _Run(pool, config, model, week, set(week.urls))
    missing = lambda state: {r: max(0, n - state.regions[r]) for r, n in own.targets.items()}
    room = min(config.run_limit, max(0, sum(own.targets.values()) - sum(week.regions[r] for r in own.targets)))
    used = own.assess((3 * config.budget_initial + 3) // 4, missing(week)) if room else 0
    winners, state = own.select()
    if room and used < config.budget_initial and len(winners) < room:
        more = model.discover(missing(state)) if any(missing(state).values()) else None
        if more is not None:
            known = pool.select(F.sha2(F.trim("canonical"), 256).alias("url_hash"))
            fresh = classified_pool(more, now, config, model, known if seen is None else known.union(seen.select("url_hash")), "expansion")
            pool = cut(pool.unionByName(fresh, allowMissingColumns=True))
            own.take(pool)
        used += own.assess(config.budget_initial - used, missing(state))
        winners, state = own.select()
    while room and used < config.budget_max and len(winners) < room:
        if not any(r["key"] not in own.done and r["decision"] in ("Relevant", "Borderline") for r in own.rows):
            break
        extra = own.assess(min(config.backfill, config.budget_max - used), missing(state), positive=True, backfill=True)
        used += extra
        winners, state = own.select()
        if not extra:
            break
    rest = "enrichment budget exhausted" if used >= config.budget_max else "assessment deferred; run coverage filled" if len(winners) >= room else "assessment deferred; no eligible backfill"
    winners, _ = own.select(fallback=True)
    picks = {w["key"]: k for k, w in enumerate(winners, 1)}
    rows = [(k, d.get("reason"), picks.get(k), d.get("tier") if k in picks else None, d.get("score"), d.get("region"), d.get("outcome")) for k, d in own.done.items()]
    told = articles.sparkSession.createDataFrame(rows, "__key string, __reason string, pick int, tier string, score double, __region string, outcome string")  # what the budget reached
    joined = pool.join(F.broadcast(told), (F.col("key") == F.col("__key")) & F.col("reason").isNull(), "left")
    late = F.when(F.col("pick").isNotNull(), None).when(F.col("outcome").isNotNull(), F.coalesce("__reason", F.lit("qualified, not selected"))).otherwise(F.coalesce("__reason", F.lit(rest)))
    region = F.coalesce("__region", "region")
    return joined.select("key", "phase", "decision", region.alias("region"), F.coalesce("reason", late).alias("reason"), "pick", "tier", "score", F.coalesce("outcome", F.lit("")).alias("outcome"), "objective", "classification_error", "registered")


def stages(told: DataFrame, fallback: bool = True) -> DataFrame:
    """``run``'s rows with ``stage``, the label of what decided about each."""
    reason = F.coalesce("reason", F.lit(""))
    near = reason.startswith("relevance below") & F.col("score").isNotNull()
    return told.withColumn("stage", gates.decision_stage([
        (F.col("pick").isNotNull(), "final_selection"),
        (F.lit(fallback) & near, "fallback_qualified_not_selected"),
        (F.col("objective").isNotNull(), "objective_cleanup_rejection"),
        (reason == "classified irrelevant", "classification_rejection"),
        (reason.startswith("editorial scope"), "editorial_scope_rejection"),
        (F.col("classification_error").isNotNull() & (F.col("outcome") == ""), "classification_unresolved_deferred"),
        (reason == "geography unresolved after enrichment", "geography_unresolved"),
        (reason == "duplicate URL", "duplicate_before_enrichment"),
        (reason.isin("outside geographic mandate", "no exact target region"), "geography_routing_rejection"),
        (reason.startswith("relevance below") & F.col("registered"), "relevance_rejection"),
        (reason.startswith("relevance below"), "unregistered_publisher_threshold_rejection"),
        (reason.startswith("enrichment failed:"), "enrichment_failure"),
        (reason.isin("shortlist ceiling", "shortlist deferred", "enrichment budget exhausted") | reason.startswith("assessment deferred;"), "deferred"),
        (reason.isin("enrichment disabled", "assessment disabled"), "enrichment_disabled"),
        (reason == "regional target already complete", "regional_quota_complete"),
        (reason == "qualified, not selected", "qualified_not_selected"),
    ]))
