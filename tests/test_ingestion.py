"""The whole run against the same rules row by row."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import events, selection
from millrace.plans import ingestion
from millrace.plans.values import REGIONS, EngineConfig


def naive(rows, same, targets, limit, cap, week):
    """Winners and reasons by plain loops over all tiered rows."""
    state, reason, winners = week.copy(), {}, []
    room = min(limit, max(0, sum(targets.values()) - sum(week.regions[g] for g in targets)))
    order = lambda r: (-r["score"], -r["relevance"], -r["significance"], -(r["quality"] or 0), -(r["published"].timestamp() if r["published"] else 0), r["url"])
    for tier in ("strict", "fallback"):
        if tier == "fallback" and len(winners) >= room:
            break
        before, kept = list(winners), []
        for r in sorted((r for r in rows if r["tier"] == tier), key=order):
            k = r["key"]
            if r["url"] in state.urls:
                reason[k] = "existing URL"
            elif r["known"]:
                reason[k] = "existing event"
            elif any((k, w["key"]) in same for w in before):
                reason[k] = "same event"
            elif state.publishers[r["publisher"]] >= cap:
                reason[k] = "publisher weekly cap"
            elif any((k, x["key"]) in same for x in kept):
                reason[k] = "same event"
            else:
                kept.append(r)
        left = list(kept)
        while len(winners) < room:
            options = []
            for at, g in enumerate(targets):
                able = [r for r in left if r["region"] == g and state.publishers[r["publisher"]] < cap]
                if targets[g] > state.regions[g] and able:
                    options.append((len(able) / (targets[g] - state.regions[g]), at, able[0]))
            pick = min(options, key=lambda o: o[:2])[2] if options else next((r for r in left if state.publishers[r["publisher"]] < cap), None)
            if pick is None:
                break
            left.remove(pick), winners.append(pick)
            state.regions[pick["region"]] += 1
            state.publishers[pick["publisher"]] += 1
        state.urls.update(w["url"] for w in winners)
        for r in left:
            reason[r["key"]] = "publisher weekly cap" if state.publishers[r["publisher"]] >= cap else "run capacity" if len(winners) >= room else "regional coverage complete"
    return [w["key"] for w in winners], reason


@pytest.mark.parametrize("case", range(3))
def test_run_equals_the_rules_row_by_row(spark, sf, case):
    config = [EngineConfig(), EngineConfig(targets=(20, 20, 20, 20), run_limit=60, publisher_cap=9), EngineConfig(targets=(1, 9, 0, 30), run_limit=25, publisher_cap=4)][case]
    def assess(rows):
        return rows.withColumns({"relevance": (3 + F.length("title") % 3).cast("int"), "significance": (3 + F.length("body") % 3).cast("int"), "story": F.lit("development"), "novelty": F.lit("true")})

    pool = ingestion.pool(spark, sf, config, ingestion.Seams(assess)).cache()
    tiered = pool.where("tier is not null").withColumnRenamed("doc_id", "key")
    some = tiered.orderBy("key").limit(2).collect()
    week = selection.State() if case < 2 else selection.State(Counter({"UAE": 2}), Counter({some[0].publisher: 1}), {some[0].url}, [some[1].title])
    known = selection._titles_known(F.col("title"), week.titles, 0.72) if week.titles else F.lit(False)
    rows = [r.asDict() for r in tiered.withColumn("known", known).select(*selection.FIELDS, "known").collect()]
    at = ingestion.event_features(tiered).select("key", F.struct(*ingestion.EVENT_FEATURES).alias("f"))
    pairs = at.toDF("a", "l").crossJoin(at.toDF("b", "r")).where("a <> b").where(events.same_event("l", "r", policy=True)).select("a", "b").collect()
    won, reason = naive(rows, {(r.a, r.b) for r in pairs}, dict(zip(REGIONS, config.targets, strict=True)), config.run_limit, config.publisher_cap, week)
    told = ingestion.select_all(pool, config, week).collect()
    assert [r.key for r in sorted((r for r in told if r.pick), key=lambda r: r.pick)] == won and len(won) > 5
    assert {r.key: r.reason for r in told if r.reason} == reason
    assert {r.tier for r in told} == {"strict", "fallback"} and (case == 0 or len(set(reason.values())) > 1)
