"""A run from articles to winners, each stage a DataFrame; steps from outside come in as functions on DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import keywords, relevance, scores, text, urls
from millrace.functions.bind import once
from millrace.operators import events, gates, ranking, selection
from millrace.plans.lineage import cut
from millrace.plans.scalar_queries import articles
from millrace.plans.values import REGIONS, EngineConfig

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Seams:
    """What a deployment exchanges: the assessment of candidates, by default a fixed expression."""

    assess: Step | None = None


def default_assess(rows: DataFrame) -> DataFrame:
    """Stands in for an outside model: relevance by distinct words, significance by length. Deterministic."""
    variety = F.size(F.array_distinct(F.split("body", r"\s+")))
    return once(rows, relevance=scores.clamped(F.ceil(variety / 40))).withColumns({"significance": scores.clamped(F.ceil(F.length("body") / 800)), "story": F.lit("development"), "novelty": F.lit("true")})


def candidates(rows: DataFrame, now: Column, config: EngineConfig, seen: DataFrame | None = None, seams: Seams | None = None) -> DataFrame:
    """All articles with the first reason that excludes them, or with score, tier and region."""
    gated = gates.objective_gate(rows, now, config, seen)
    if "snippet" not in rows.columns:
        gated = once(gated, snippet=F.when(F.col("reason").isNull(), text.snippet(F.col("body"))))
    if "region" not in rows.columns:
        gated = routed(gated)
    assess = (seams.assess if seams else None) or default_assess
    judged = assess(gated).withColumns({"scope": gates.scope_reason(F.col("story"), F.col("novelty")), "registered": F.col("source").isNotNull(), "publisher": urls.hostname(F.col("url"))})
    required = F.when(F.col("registered"), config.minimum_relevance).otherwise(config.unregistered_relevance)
    low = F.concat(F.lit("relevance below "), required.cast("string"))
    reason = F.coalesce("reason", "scope", F.when(F.col("region").isNull(), "geography unresolved"), F.when(F.col("relevance") < required, low))
    fallback = gates.fallback_eligible(F.col("relevance"), F.col("significance"), required, F.col("registered"), F.col("region"), reason, F.lit(False), config.fallback_floor)
    tier = F.when(reason.isNull(), "strict").when(fallback, "fallback")
    return judged.withColumns({"required": required, "reason": reason, "tier": tier, "score": scores.queue_score(F.col("relevance"), F.col("significance"), F.col("quality"), config.weights)})


EVENT_FEATURES = ("canonical", "place", "measures", "tokens", "published", "said", "told")


def event_features(rows: DataFrame) -> DataFrame:
    """What the composite event rule reads, of rows with url, title, published and, if there is one, snippet."""
    title, snippet = F.col("title"), F.col("snippet") if "snippet" in rows.columns else F.lit("")
    place = F.coalesce(keywords.reported_location(title)["place"], keywords.reported_location(F.coalesce(snippet, F.lit("")))["place"])
    # an empty address is none
    return rows.withColumns({"canonical": F.nullif(F.col("url"), F.lit("")), "place": place, "measures": events.measures(title), "tokens": text.title_tokens(title), "said": events.announcement_tokens(title), "told": events.announcement_tokens(snippet)})


def tells_event_of(rows: DataFrame, winners: DataFrame, threshold: float) -> DataFrame:
    """The keys of rows that tell the event of one of the few ``winners``, whose features go into the plan as values."""
    won = [r.asDict() for r in winners.select("key", *EVENT_FEATURES).collect()]  # as many as a run picks
    kinds = dict(rows.dtypes)

    def value(name: str, x: object) -> Column:
        if isinstance(x, dict):
            pairs = [F.lit(v) for kv in x.items() for v in kv]
            return F.create_map(*pairs).cast(kinds[name])
        return (F.array(*map(F.lit, x)) if isinstance(x, list) else F.lit(x)).cast(kinds[name])

    told = rows.select("key", F.struct(*EVENT_FEATURES).alias("__row"), *(F.struct(*(value(n, w[n]).alias(n) for n in EVENT_FEATURES)).alias(f"__w{k}") for k, w in enumerate(won)))
    same = F.lit(False)
    for k in range(len(won)):
        same = same | F.coalesce(events.same_event("__row", f"__w{k}", threshold, policy=True), F.lit(False))
    return told.where(same).select("key")


def select_all(pool: DataFrame, config: EngineConfig, week: selection.State | None = None) -> DataFrame:
    """Every candidate of a tier: winners with pick and phase, all others with the reason why not; see ``selection.select_week``.

    The pool is stored once, with the features that decide which rows are one event.
    """
    kept = pool.where("tier is not null").withColumnRenamed("doc_id", "key").select(*selection.FIELDS, "title", *(c for c in ("snippet", "required") if c in pool.columns))
    rows = cut(event_features(kept))
    ranked = lambda part: part.withColumn("rank", F.struct((-F.col("score")).alias("s"), (-F.col("relevance")).alias("r"), (-F.col("significance")).alias("g"), (-F.coalesce("quality", F.lit(0.0))).alias("q"), F.coalesce(-F.unix_timestamp("published"), F.lit(2**62)).alias("p"), "url", "key"))
    dedupe = lambda part: events.dedupe_same_events(ranked(part).select("key", "rank", *EVENT_FEATURES), "key", "rank", config.event_similarity).select("key", "kept")
    protect = lambda part, won: tells_event_of(part, rows.join(F.broadcast(won.select("key")), "key", "left_semi"), config.event_similarity)
    return selection.select_week(rows, dict(zip(REGIONS, config.targets, strict=True)), config.run_limit, config.publisher_cap, week, dedupe, protect, config.event_similarity)


def select(pool: DataFrame, config: EngineConfig, week: selection.State | None = None) -> DataFrame:
    """The winners of ``select_all``."""
    return select_all(pool, config, week).where("pick is not null").drop("reason")


def shortlists(pool: DataFrame, config: EngineConfig) -> DataFrame:
    """For each region the publishers' candidates in turn, as many as may be assessed."""
    return ranking.round_robin(pool.where("reason is null"), ["region"], "publisher", ranking.final_order(), config.shortlist_max)


def registry(rows: DataFrame) -> DataFrame:
    """Sources as a registry would list them: a region and a quality for each. The tables at hand have none, so both follow the name."""
    names = F.element_at(F.array(*map(F.lit, REGIONS)), (F.pmod(F.xxhash64("source"), F.lit(len(REGIONS))) + 1).cast("int"))
    return rows.select("source").where("source is not null").distinct().withColumns({"source_region": names, "quality": (F.pmod(F.xxhash64("source"), F.lit(97)) % 10 + 1).cast("double")})


def routed(rows: DataFrame) -> DataFrame:
    """Articles with ``region``: by title and snippet, else by their source's, blocked if foreign-local, Global if systemic. Those with a ``reason`` already aren't asked."""
    open_ = F.col("reason").isNull()
    read = once(rows, __words=F.when(open_, relevance.article_words(F.col("title"), F.col("snippet"))))
    read = once(read, __scope=F.when(open_, F.struct(relevance.foreign_local(F.col("title"), F.col("__words")).alias("local"), relevance.systemic(F.col("__words")).alias("wide"))))
    at = keywords.assigned_region(F.col("title"), F.col("snippet"), F.array("source_region"), F.lit(False), F.col("__scope.local"), F.col("__scope.wide"))
    return once(read, __at=F.when(open_, at)).withColumns({"region": F.col("__at.region"), "region_basis": F.col("__at.basis")}).drop("__words", "__scope", "__at")


def pool(spark: SparkSession, sf_dir: str, config: EngineConfig, seams: Seams | None = None) -> DataFrame:
    """Documents as articles with their source's registry row, gated and routed."""
    rows = articles(spark, sf_dir)
    known = rows.join(registry(rows), "source", "left")
    told = known.select("doc_id", *(c for c in known.columns if c != "doc_id"))
    return candidates(told, F.lit("2024-02-01").cast("timestamp"), config, seams=seams)


def run(spark: SparkSession, sf_dir: str, config: EngineConfig | None = None, week: selection.State | None = None) -> DataFrame:
    config = (config or EngineConfig()).validate()
    return select(pool(spark, sf_dir, config), config, week)
