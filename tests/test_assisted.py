"""The model-assisted run against the same rules over the whole pool, row by row."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import assessment, events, gates, selection
from millrace.plans import assisted, assisted_queries
from millrace.plans.ingestion import EVENT_FEATURES, event_features
from millrace.plans.values import REGIONS, EngineConfig


def naive(rows, same, config, week):
    """Rows are dicts of all articles; no shortlist, no batching of pairs, every stop checked by selecting anew."""
    targets = dict(zip(REGIONS, config.targets, strict=True))
    reason = {r["key"]: r["reason"] for r in rows}
    open_ = [r for r in rows if r["reason"] is None]
    for r in open_:
        if r["known"]:
            reason[r["key"]] = "existing event"
    rank = lambda r: ({"Relevant": 0, "Borderline": 1}.get(r["decision"], 2), -(r["score5"] or 0), -(r["quality"] or 0), -(r["published"].timestamp()), r["url"])
    done, tried, attempted = {}, Counter(week.publishers), set()
    deficits = lambda regions: {g: max(0, n - regions[g]) for g, n in targets.items()}
    room = min(config.run_limit, max(0, sum(targets.values()) - sum(week.regions[g] for g in targets)))

    def select(fallback=False):
        regions, publishers, used, winners = Counter(week.regions), Counter(week.publishers), set(week.urls), []
        best = lambda d: (-d["score"], -d["relevance"], -d["significance"], -(d["quality"] or 0), -d["published"].timestamp(), d["url"])
        for tier in ("strict", "fallback") if fallback else ("strict",):
            if len(winners) >= room:
                break
            before, left = list(winners), []
            for d in sorted((d for d in done.values() if d["tier"] == tier), key=best):
                if d["url"] not in used and publishers[d["publisher"]] < config.publisher_cap and not any((d["key"], x["key"]) in same for x in before + left):
                    left.append(d)
            won_here = 0
            while len(winners) < room:
                options = []
                for at, g in enumerate(REGIONS):
                    able = [d for d in left if d["region"] == g and publishers[d["publisher"]] < config.publisher_cap]
                    if targets[g] > regions[g] and able:
                        options.append((len(able) / (targets[g] - regions[g]), at, able[0]))
                pick = min(options, key=lambda o: o[:2])[2] if options else next((d for d in left if publishers[d["publisher"]] < config.publisher_cap), None)
                if pick is None:
                    break
                left.remove(pick), winners.append(pick), used.add(pick["url"])
                regions[pick["region"]] += 1
                publishers[pick["publisher"]] += 1
                won_here += 1
        return winners, regions

    def assess(budget, missing, positive=False, backfill=False):
        left = [r for r in open_ if reason[r["key"]] is None and r["key"] not in done and (not positive or r["decision"] is not None)]
        order, seen, served, used = [], Counter(tried), Counter(), 0
        while left:
            merit = (lambda r: (*rank(r)[:2], seen[r["publisher"]], *rank(r)[2:-1], missing.get(r["region"], 0) <= 0, r["url"])) if backfill else (lambda r: (seen[r["publisher"]], *rank(r)))
            pool, able = left, []
            if not backfill and len(order) < budget:
                able = [g for g in REGIONS if served[g] < 2 * missing[g] and any(r["region"] == g for r in left)]
            if able:
                g = min(able, key=lambda g: (served[g] / missing[g], REGIONS.index(g)))
                pool = [r for r in left if r["region"] == g]
            r = min(pool, key=merit)
            left.remove(r), order.append(r)
            served[r["region"]] += 1
            seen[r["publisher"]] += 1
        for r in order:
            if used >= budget or len(select()[0]) >= config.run_limit:
                break
            if r["canonical"] in week.urls or r["canonical"] in attempted:
                reason[r["key"]] = "duplicate URL"
                continue
            used += 1
            attempted.update((r["canonical"], r["url"]))
            tried[r["publisher"]] += 1
            d = done[r["key"]] = {"tier": None, **{c: r[c] for c in ("key", "publisher", "quality", "published")}, "url": r["canonical"]}
            try:
                e = assisted_queries.enrich(r)
            except TimeoutError:
                reason[r["key"]] = "enrichment failed: provider error"
                continue
            scope = gates.scope_of(e["story"], e["novelty"])
            required = 4 if r["registered"] else 5
            low = f"relevance below {required}" if e["relevance"] < required else None
            near = low and r["registered"] and e["relevance"] >= 3 and e["significance"] >= 3
            d.update(relevance=e["relevance"], significance=e["significance"], region=r["region"] or e["region"], score=round(14 * e["relevance"] + 4 * e["significance"] + min(10, r["quality"]), 2))
            reason[r["key"]] = scope or low or "qualified, not selected"
            d["tier"] = None if scope or (low and not near) else "fallback" if low else "strict"
        return used

    used = assess((3 * config.budget_initial + 3) // 4, deficits(week.regions)) if room else 0
    winners, regions = select()
    if room and used < config.budget_initial and len(winners) < room:
        used += assess(config.budget_initial - used, deficits(regions))
        winners, regions = select()
    while room and used < config.budget_max and len(winners) < room and any(reason[r["key"]] is None and r["key"] not in done and r["decision"] in ("Relevant", "Borderline") for r in open_):
        extra = assess(min(config.backfill, config.budget_max - used), deficits(regions), True, True)
        used += extra
        winners, regions = select()
        if not extra:
            break
    rest = "enrichment budget exhausted" if used >= config.budget_max else "assessment deferred; run coverage filled" if len(winners) >= room else "assessment deferred; no eligible backfill"
    winners, _ = select(True)
    picks = {w["key"]: k for k, w in enumerate(winners, 1)}
    return {k: (None if k in picks else v or rest, picks.get(k)) for k, v in reason.items()}


@pytest.mark.parametrize("case", range(4))
def test_run_equals_the_rules_row_by_row(spark, sf, case):
    config = [EngineConfig(), EngineConfig(targets=(9, 9, 9, 9), run_limit=30, publisher_cap=1, budget_initial=9, budget_max=20, backfill=3), EngineConfig(targets=(1, 0, 2, 5), run_limit=6), EngineConfig(targets=(0, 0, 0, 0))][case]
    now = F.lit("2024-02-01").cast("timestamp")
    articles = assisted_queries.feed(spark, sf).cache()
    first = articles.where("title is not null").orderBy("key").first()
    week = selection.State() if case != 2 else selection.State(Counter({"Egypt": 1}), Counter({"src3.example.com": 1}), set(), [first.title])
    pool = assisted.classified_pool(articles, now, config, assisted.Model(assisted_queries.classify, assisted_queries.enrich), None, "rss").cache()
    known = selection._titles_known(F.col("title"), week.titles, 0.72) if week.titles else F.lit(False)
    rows = [r.asDict() for r in pool.withColumn("known", known).collect()]
    at = event_features(pool.where("reason is null")).select("key", F.struct(*EVENT_FEATURES).alias("f"))
    same = {(r.a, r.b) for r in at.toDF("a", "l").crossJoin(at.toDF("b", "r")).where("a <> b").where(events.same_event("l", "r", policy=True)).select("a", "b").collect()}
    want = naive(rows, same, config, week)
    told = assisted.run(articles, now, config, assisted.Model(assisted_queries.classify, assisted_queries.enrich), week)
    assert {r.key: (r.reason, r.pick) for r in told.collect()} == want
    labels = {r.stage for r in assisted.stages(told).select("stage").distinct().collect()}
    assert "objective_cleanup_rejection" in labels and "metadata_rejection" not in labels and (case == 3 or "final_selection" in labels)


def test_discovery_fills_what_is_missing(spark):
    day = dt.datetime(2024, 1, 30, tzinfo=dt.UTC)
    kinds = "key string, url string, title string, snippet string, publisher string, registered boolean, quality double, published timestamp"
    row = lambda k, word: (k, f"https://{k}.org/x", f"A story of {word} and its many sides", "s" * {"u": 1, "e": 3}[k[0]], f"{k}.org", True, 5.0, day)
    feed, more = spark.createDataFrame([row("u1", "one"), row("u2", "wide")], kinds), spark.createDataFrame([row("e1", "rivers"), row("u1", "one")], kinds)
    asked = []
    enrich = lambda r: {"relevance": 5, "significance": 3, "story": "development", "novelty": "true", "region": "UAE"}
    classify = lambda items: [{"id": i["id"], "decision": f"Relevant|5|{assisted_queries.PLACES[len(i['snippet']) % 5]}"} for i in items]
    config = EngineConfig(targets=(0, 2, 0, 1), run_limit=3)
    told = assisted.run(feed, F.lit("2024-02-01").cast("timestamp"), config, assisted.Model(classify, enrich, lambda m: asked.append(m) or more))
    got = [(r.key, r.phase, r.pick, r.reason) for r in told.orderBy("phase", "key").collect()]
    assert {g[0] for g in got if g[2]} == {"u1", "u2", "e1"} and asked == [{"Global": 0, "UAE": 0, "KSA": 0, "Egypt": 1}]
    assert ("u1", "expansion", None, "duplicate URL") in got and ("e1", "expansion", 3, None) in got


def test_a_refusal_ends_the_run(spark):
    def model(items):
        if any(i["id"] == "5" for i in items):
            raise PermissionError("quota")
        return [{"id": i["id"], "decision": "Relevant"} for i in items]

    rows = spark.createDataFrame([(str(k), "t") for k in range(200)], "id string, title string").repartition(1)
    got = {r.id: (r.decision, r.error) for r in assessment.classified(rows, ["title"], model, size=5, rounds=8).collect()}
    at = {r.id: r.k for r in rows.select("id", F.pmod(F.xxhash64("id"), F.lit(8)).alias("k")).collect()}
    later = [k for k in got if at[k] > at["5"]]
    assert len(got) == 200 and got["5"] == (None, "refused: quota") and later and all(got[k] == (None, "refused: quota") for k in later)
    assert any(d for d, _ in got.values()) or at["5"] == 0
