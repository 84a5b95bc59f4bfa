"""Selection under regional quotas and publisher caps.

The picks depend on each other, so the last step is a sequential state machine. What it
reads is small whatever the pool: after event leaders are chosen, only the best ``cap``
rows of each (region, publisher) can win, and of the others no more than their number
matters. Both come from distributed aggregations; of publishers, only those that can still
win in a region are passed on, with counts of the rest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators.gates import first_reason
from millrace.operators.ranking import final_order
from millrace.plans.lineage import cut


def capacity(rows: DataFrame, region: str, targets: DataFrame, limit: int, by: list[str] | None = None) -> DataFrame:
    """One row, or one for each group of ``by``: target and existing totals of the target regions, what remains, and how many may be taken."""
    by, goals = by or [], [(r["region"], r["target"]) for r in targets.collect()]  # a row for each quota region
    total = F.lit(sum(n for _, n in goals)).cast("long")
    have = rows.groupBy(*by).agg(F.count_if(F.col(region).isin([r for r, _ in goals])).alias("existing"))
    left = F.greatest(F.lit(0), F.col("target") - F.col("existing"))
    return have.withColumn("target", total).select(*by, "target", "existing", left.alias("remaining"), F.least(F.lit(limit), left).alias("effective"))


def deficits(rows: DataFrame, region: str, targets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """For each region of ``targets`` (region, target), in each group of ``by``, what is still missing."""
    by, goals = by or [], [(r["region"], r["target"]) for r in targets.collect()]  # a row for each quota region
    counts = rows.groupBy(*by).agg(*(F.count_if(F.col(region) == r).alias(f"__{k}") for k, (r, _) in enumerate(goals)))
    told = F.array(*(F.struct(F.lit(r).alias("region"), F.lit(n).alias("target"), F.col(f"__{k}").alias("current")) for k, (r, n) in enumerate(goals)))
    return counts.select(*by, F.inline(told)).withColumn("deficit", F.greatest(F.lit(0).cast("long"), F.col("target") - F.col("current")))


@dataclass
class State:
    """What a week has so far; picks change its counts."""

    regions: Counter = field(default_factory=Counter)
    publishers: Counter = field(default_factory=Counter)
    urls: set[str] = field(default_factory=set)
    titles: list[str] = field(default_factory=list)

    def copy(self) -> State:
        return State(Counter(self.regions), Counter(self.publishers), set(self.urls), list(self.titles))


def week_state(rows: DataFrame) -> State:
    """The state of a week from its rows (region, publisher, url, title): all it has, about as many as its targets add up to."""
    state = State()
    for r in rows.select("region", "publisher", "url", "title").toLocalIterator():
        if r.region is not None:
            state.regions[r.region] += 1
        if r.publisher is not None and r.publisher != "":
            state.publishers[r.publisher] += 1
        if r.url:
            state.urls.add(r.url)
        if r.title:
            state.titles.append(r.title)
    return state


def open_candidates(candidates: DataFrame, week: State, cap: int, threshold: float = 0.72) -> DataFrame:
    """Candidates whose address and event the week doesn't have, and whose publisher is below its cap.

    To be called before events are deduped, so that a row that can't win displaces no other. A title is asked for only
    if the week has titles.
    """
    full = [p for p, n in week.publishers.items() if n >= cap]
    if week.urls:
        candidates = candidates.where(~F.coalesce(F.col("url").isin(*week.urls), F.lit(False)))
    if week.titles:
        have = F.array(*(text.title_tokens(F.lit(t)) for t in sorted(set(week.titles))))
        same = F.exists(have, lambda t: F.coalesce(text.jaccard(text.title_tokens(F.col("title")), t) >= threshold, F.lit(False)))
        candidates = candidates.where(~same)
    return candidates.where(~F.coalesce(F.col("publisher").isin(*full), F.lit(False))) if full else candidates


def select_tier(rows: list[dict], counts: dict[tuple[str, str], int], targets: dict[str, int], state: State, limit: int, cap: int, overflow: bool = True) -> list[dict]:
    """The rows picked, in order, with ``phase``.

    ``rows`` are in final order, at most ``cap`` of each (region, publisher); ``counts`` says how
    many there were. While a region lacks rows, the scarcest is served: that with the fewest
    eligible rows for each missing one, ties by the order of ``targets``. Then, with
    ``overflow``, any row in order. A publisher at its cap is passed over.
    """
    left, picked, taken, regions = list(rows), [], Counter(), list(targets)

    def pick(row: dict, phase: str) -> None:
        left.remove(row)
        state.regions[row["region"]] += 1
        state.publishers[row["publisher"]] += 1
        taken[row["region"], row["publisher"]] += 1
        picked.append(row | {"phase": phase})

    while len(picked) < limit:
        options = []
        for at, region in enumerate(regions):
            missing = targets[region] - state.regions[region]
            if missing <= 0:
                continue
            open_ = sum(n - taken[key] for key, n in counts.items() if key[0] == region and state.publishers[key[1]] < cap)
            best = next((r for r in left if r["region"] == region and state.publishers[r["publisher"]] < cap), None)
            if best is not None:
                options.append((open_ / missing, at, best))
        if not options:
            break
        pick(min(options, key=lambda o: o[:2])[2], "coverage")
    if overflow:
        for row in list(left):
            if len(picked) >= limit:
                break
            if state.publishers[row["publisher"]] < cap:
                pick(row, "overflow")
    return picked


def two_tiers(rows: list[dict], counts: dict[str, dict[tuple[str, str], int]], targets: dict[str, int], existing: State, limit: int, cap: int) -> list[dict]:
    """Strict rows first; spare room goes to fallback rows under the same caps."""
    room = min(limit, max(0, sum(targets.values()) - sum(n for r, n in existing.regions.items() if r in targets)))
    out = select_tier([r for r in rows if r["tier"] == "strict"], counts.get("strict", {}), targets, existing, room, cap)
    if len(out) < room:
        out += select_tier([r for r in rows if r["tier"] == "fallback"], counts.get("fallback", {}), targets, existing, room - len(out), cap)
    return out


def shortlist(candidates: DataFrame, cap: int, limit: int) -> DataFrame:
    """The candidates that can win, with ``pool``: how many their (tier, region, publisher) has.

    A row can only win as one of its publisher's best ``cap`` in the region. At any time at
    most limit publishers have been picked from, so publishers beyond the best
    ``limit + cap`` of a region can't be reached either, and go in as numbers alone.
    """
    by = W.partitionBy("tier", "region", "publisher")
    best = candidates.withColumn("__n", F.row_number().over(by.orderBy(*final_order()))).where(F.col("__n") <= cap)
    sizes = candidates.groupBy("tier", "region", "publisher").agg(F.count("*").alias("pool"))
    leads = best.where("__n = 1").withColumn("__lead", F.row_number().over(W.partitionBy("tier", "region").orderBy(*final_order())))
    reachable = leads.where(F.col("__lead") <= limit + cap).select("tier", "region", "publisher")
    rest = sizes.join(reachable, ["tier", "region", "publisher"], "left_anti").groupBy("tier", "region").agg(F.sum("pool").alias("others"))
    kept = best.drop("__n").join(reachable, ["tier", "region", "publisher"]).join(sizes, ["tier", "region", "publisher"])
    return kept.join(rest, ["tier", "region"], "left").withColumn("others", F.coalesce("others", F.lit(0)))


FIELDS = ("key", "tier", "region", "publisher", "score", "relevance", "significance", "quality", "published", "url")


def _machine(pools: Iterator[pd.DataFrame], targets: dict[str, int], limit: int, cap: int, week: State) -> Iterator[pd.DataFrame]:
    frames = [p for p in pools if len(p)]
    if not frames:
        return
    pool = pd.concat(frames)
    pool["__q"], pool["__p"] = pool["quality"].fillna(0), pool["published"].fillna(pd.Timestamp.min)
    pool = pool.sort_values(["score", "relevance", "significance", "__q", "__p", "url"], ascending=[False] * 5 + [True])
    counts: dict[str, dict] = {}
    for r in pool.itertuples():
        tier = counts.setdefault(r.tier, {})
        tier[r.region, r.publisher] = r.pool
        if r.others:
            tier[r.region, None] = r.others  # publishers that can't be reached
    rows = [{"key": r.key, "tier": r.tier, "region": r.region, "publisher": r.publisher, "score": r.score} for r in pool.itertuples()]
    won = two_tiers(rows, counts, targets, week.copy(), limit, cap)
    if won:
        yield pd.DataFrame([w | {"pick": k} for k, w in enumerate(won, 1)])[["pick", "key", "tier", "region", "publisher", "score", "phase"]]


def select_final(candidates: DataFrame, targets: dict[str, int], limit: int, cap: int, week: State | None = None, threshold: float = 0.72) -> DataFrame:
    """Winners (pick, key, tier, region, publisher, score, phase) of candidates with columns ``FIELDS``.

    What the ``week`` already has counts for targets, capacity and caps, and isn't picked again. Publishers at their cap
    are left out before the shortlist, so they take no place in it.
    """
    week = week or State()
    candidates = open_candidates(candidates, week, cap, threshold)
    short = shortlist(candidates.select(*FIELDS), cap, limit)
    kinds = dict(candidates.dtypes)
    schema = f"pick int, key {kinds['key']}, tier string, region string, publisher {kinds['publisher']}, score double, phase string"
    # at most 2 tiers x regions x (limit + cap) publishers x cap rows; an exchange of their own keeps what comes before parallel
    return short.repartition(1).mapInPandas(partial(_machine, targets=targets, limit=limit, cap=cap, week=week), schema)


def _titles_known(title: Column, titles: list[str], threshold: float) -> Column:
    """Whether a title tells an event of ``titles``; those are few, what one week has."""
    have = F.array(*(text.title_tokens(F.lit(t)) for t in sorted(set(titles))))
    own = text.title_tokens(title)
    return F.exists(have, lambda t: F.coalesce(text.jaccard(own, t) >= threshold, F.lit(False)))


def constraint_reasons(rows: DataFrame, week: State, cap: int, threshold: float = 0.72, protected: DataFrame | None = None) -> DataFrame:
    """Rows with ``reason``: the first of existing URL, existing event, same event (of keys in ``protected``) and publisher weekly cap."""
    full = [p for p, n in week.publishers.items() if n >= cap]
    checks: list[tuple[Column, str]] = []
    if "required" in rows.columns:
        checks.append(((F.col("tier") == "strict") & (F.col("relevance") < F.greatest(F.lit(4), F.col("required"))), "relevance below required threshold"))
    if week.urls:
        checks.append((F.col("url").isin(*week.urls), "existing URL"))
    if week.titles:
        checks.append((_titles_known(F.col("title"), week.titles, threshold), "existing event"))
    if protected is not None:
        rows = rows.join(protected.select("key", F.lit(True).alias("__protected")).distinct(), "key", "left")
        checks.append((F.col("__protected"), "same event"))
    if full:
        checks.append((F.col("publisher").isin(*full), "publisher weekly cap"))
    return rows.withColumn("reason", first_reason(checks)).drop("__protected")


Dedupe = Callable[[DataFrame], DataFrame]
Protect = Callable[[DataFrame, DataFrame], DataFrame]


def select_week(pool: DataFrame, targets: dict[str, int], limit: int, cap: int, week: State | None = None, dedupe: Dedupe | None = None, protect: Protect | None = None, threshold: float = 0.72, fallback: bool = True) -> DataFrame:
    """Every row of a tier with ``pick`` and ``phase`` if it wins, else with the ``reason`` why it doesn't.

    Strict rows are decided whole, coverage and overflow, before fallback rows, which then fill
    what room there is under what the week and the strict winners have. Within a tier rows that
    break a constraint go first, then ``dedupe`` gives (key, kept) of the others, one of each
    event, and the rest is picked from. ``protect`` gives the keys of rows that tell the event
    of a winner of the tier before. Fallback rows have neither if strict ones fill the run.
    Winners, at most ``limit``, are the only rows that the driver sees.
    """
    state, out = (week or State()).copy(), []
    room = min(limit, max(0, sum(targets.values()) - sum(n for r, n in state.regions.items() if r in targets)))
    kinds = dict(pool.dtypes)
    won_schema = f"pick int, key {kinds['key']}, tier string, region string, publisher {kinds['publisher']}, score double, phase string, url string"
    winners: list[dict] = []
    for tier in ("strict", "fallback"):
        rows = pool.where(F.col("tier") == tier)
        if tier == "fallback" and (not fallback or len(winners) >= room):
            out.append(rows.select("key", "tier", "region", "publisher", "score", F.lit(None).cast("string").alias("reason")))
            continue
        guarded = protect(rows, pool.sparkSession.createDataFrame(winners, won_schema)) if protect is not None and winners else None
        checked = cut(constraint_reasons(rows, state, cap, threshold, guarded))
        open_ = checked.where("reason is null")
        kept = cut(dedupe(open_).select("key", "kept")) if dedupe is not None else open_.select("key", F.lit(True).alias("kept"))
        pool_ = open_.join(kept.where("kept").select("key"), "key")
        start = State(state.regions, state.publishers)
        found = [r.asDict() for r in select_final(pool_, targets, room - len(winners), cap, start).orderBy("pick").collect()] if room > len(winners) else []
        urls = {r["key"]: r["url"] for r in pool_.where(F.col("key").isin([w["key"] for w in found])).select("key", "url").collect()} if found else {}
        for w in found:
            winners.append(w | {"pick": len(winners) + 1, "url": urls[w["key"]]})
            state.regions[w["region"]] += 1
            state.publishers[w["publisher"]] += 1
            state.urls.add(urls[w["key"]])
        full = [p for p, n in state.publishers.items() if n >= cap]
        late = first_reason([
            (F.col("reason").isNotNull(), F.col("reason")),
            (F.col("kept").isNull() | ~F.col("kept"), "same event"),
            (F.col("key").isin([w["key"] for w in found]), F.lit(None).cast("string")),
            *([(F.col("publisher").isin(*full), "publisher weekly cap")] if full else []),
            (F.lit(True), "run capacity" if len(winners) >= room else "regional coverage complete"),
        ])
        out.append(checked.join(kept, "key", "left").select("key", "tier", "region", "publisher", "score", late.alias("reason")))
    picks = pool.sparkSession.createDataFrame(winners, won_schema).select("key", "pick", "phase")  # at most ``limit`` rows
    return out[0].unionByName(out[1]).join(F.broadcast(picks), "key", "left").select("pick", "key", "tier", "region", "publisher", "score", "phase", "reason")


def decide(rows: list[dict], same: Callable[[object, object], bool], targets: dict[str, int], week: State, limit: int, cap: int, fallback: bool = False) -> tuple[list[dict], State]:
    """(winners with tier and phase, state after them) of assessed rows, each with key, url, tier, region, publisher, in final order.

    As ``select_week``, for the few rows that a budget allows to assess: ``same`` tells whether two keys are one event.
    """
    state, winners = week.copy(), []
    room = min(limit, max(0, sum(targets.values()) - sum(n for r, n in state.regions.items() if r in targets)))
    for tier in ("strict", "fallback") if fallback else ("strict",):
        if tier == "fallback" and len(winners) >= room:
            break
        kept: list[dict] = []
        for r in rows:
            out = r["tier"] != tier or r["url"] in state.urls or state.publishers[r["publisher"]] >= cap
            if not out and not any(same(r["key"], x["key"]) for x in (*winners, *kept)):
                kept.append(r)
        counts = Counter((r["region"], r["publisher"]) for r in kept)
        picked = select_tier(kept, dict(counts), targets, state, room - len(winners), cap)
        state.urls.update(r["url"] for r in picked)
        winners += picked
    return winners, state


def allocate(rows: list[dict], missing: dict[str, int], budget: int, publishers: Counter | None = None, backfill: bool = False) -> list[dict]:
    """The order in which rows, given in rank order, are assessed.

    While the budget lasts, regions that have had less than twice what they lack come first, the
    one served least for its need before others, and of its rows that of the publisher seen
    least, then by rank; after that all rows compete. ``backfill`` goes by decision and score,
    then by publishers seen, quality and date, then by need.
    """
    left, out, seen, served = list(enumerate(rows)), [], Counter(publishers or {}), Counter()
    order = list(missing)

    def merit(item: tuple[int, dict]) -> tuple:
        at, r = item
        if backfill:
            return (*r["merit"][:2], seen[r["publisher"]], *r["merit"][2:], missing.get(r["region"], 0) <= 0, r["url"])
        return seen[r["publisher"]], at

    while left:
        pool = left
        if not backfill and len(out) < budget:
            open_ = [g for g in order if served[g] < 2 * missing[g] and any(x["region"] == g for _, x in left)]
            if open_:
                region = min(open_, key=lambda g: (served[g] / missing[g], order.index(g)))
                pool = [x for x in left if x[1]["region"] == region]
        best = min(pool, key=merit)
        left.remove(best)
        out.append(best[1])
        seen[best[1]["publisher"]] += 1
        served[best[1]["region"]] += 1
    return out
