"""Same-event records: similarity pairs by prefix filtering, vetoes, and greedy leaders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.functions.bind import let
from millrace.plans.lineage import cut
from millrace.plans.values import ANNOUNCEMENT_WORDS, EVENT_STOP_WORDS, EVENT_WORD_FORMS, POLICY_WORDS

#: Longs of a set's signature.
SIGNS = 4


def event_classes(rows: DataFrame, key: str, tokens: str, rank: str | None = None) -> DataFrame:
    """(tokens, rep) of each distinct token set: its member of least rank, or least key. Empty sets are left out."""
    order = F.col(rank or key)
    return rows.select(key, *([rank] if rank else []), F.array_sort(tokens).alias("tokens")).where(F.size("tokens") > 0).groupBy("tokens").agg(F.min_by(key, order).alias("rep"))


def _signature(tokens: str) -> Column:
    """The tokens' hashes in ``SIGNS`` longs, each of which turns one bit over."""
    word = f"aggregate(filter(transform({tokens}, x -> xxhash64(x)), h -> pmod(h, {SIGNS}) = {{}}), 0L, (s, h) -> s ^ shiftleft(1L, cast(pmod(shiftright(h, 8), 64) as int)))"
    return F.struct(*(F.expr(word.format(k)).alias(f"s{k}") for k in range(SIGNS)))


def class_pairs(classes: DataFrame, threshold: float = 0.72) -> DataFrame:
    """(x, y, similarity), x < y, of representatives whose sets have a Jaccard similarity of the threshold or more.

    Of each set only the rarest tokens are joined on, as many as leave no room for a match
    without one of them, so frequent words never meet. What meets is told apart within the join,
    before any shuffle, by sizes and by ``_signature``: tokens that only one set has are at least as
    many as the bits that differ. The exact check follows.
    """
    seen = classes.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    signed = classes.select("rep", F.size("tokens").alias("size"), _signature("tokens").alias("sign"), "tokens")
    ranked = signed.select("rep", "size", "sign", F.explode("tokens").alias("token")).join(seen, "token")
    ordered = ranked.groupBy("rep", "size", "sign").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
    prefix = F.slice("t", 1, F.col("size") - F.ceil(threshold * F.col("size") - 1e-9).cast("int") + 1)
    probes = ordered.select("rep", "size", "sign", F.explode(F.transform(prefix, lambda x: x["token"])).alias("token"))
    a, b = probes.alias("a"), probes.alias("b")
    both, alone = F.col("a.size") + F.col("b.size"), F.lit(0)
    for k in range(SIGNS):
        alone = alone + F.bit_count(F.col(f"a.sign.s{k}").bitwiseXOR(F.col(f"b.sign.s{k}")))
    on = (
        (F.col("a.token") == F.col("b.token")) & (F.col("a.rep") < F.col("b.rep")) & (F.least("a.size", "b.size") >= threshold * F.greatest("a.size", "b.size") - 1e-9)
        & (alone <= both * (1 - threshold) / (1 + threshold) + 1e-6)
    )
    near = a.join(b, on).select(F.col("a.rep").alias("x"), F.col("b.rep").alias("y")).distinct()
    side = lambda name: classes.select(F.col("rep").alias(name), F.col("tokens").alias(f"t{name}"))
    scored = near.join(side("x"), "x").join(side("y"), "y").withColumn("similarity", text.jaccard(F.col("tx"), F.col("ty")))
    return scored.where(F.col("similarity") >= threshold).select("x", "y", "similarity")


def event_pairs(rows: DataFrame, key: str, tokens: str, threshold: float = 0.72) -> DataFrame:
    """(a, b, similarity), a < b, of all rows; where copies abound, ``dedupe_events`` needs no such list."""
    classes = event_classes(rows, key, tokens)
    members = rows.select(F.col(key).alias("member"), F.array_sort(tokens).alias("tokens")).join(classes, "tokens").select("rep", "member")
    links = class_pairs(classes, threshold).union(classes.select(F.col("rep").alias("x"), F.col("rep").alias("y"), F.lit(1.0).alias("similarity")))
    one, two = members.toDF("x", "m"), members.toDF("y", "n")
    pairs = links.join(one, "x").join(two, "y").where((F.col("x") != F.col("y")) | (F.col("m") < F.col("n")))
    return pairs.select(F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b"), "similarity")


def dedupe_events(rows: DataFrame, key: str, tokens: str, rank: str, threshold: float = 0.72) -> DataFrame:
    """``rows`` with ``kept`` and ``leader``, greedy by ascending unique rank.

    Rows of equal sets stand or fall by their best one, so classes are decided and members
    follow; no pair within a class is ever made. Rows without tokens are kept.
    """
    classes = cut(event_classes(rows, key, tokens, rank))
    ranks = rows.select(F.col(key).alias("rep"), F.col(rank).alias("__rank"))
    decided = leaders(classes.join(ranks, "rep").select("rep", "__rank"), "rep", "__rank", class_pairs(classes, threshold).select(F.col("x").alias("a"), F.col("y").alias("b")))
    told = classes.join(decided.select("rep", "leader"), "rep")
    named = rows.withColumn("__t", F.array_sort(tokens)).join(told.withColumnRenamed("tokens", "__t"), "__t", "left")
    leader = F.coalesce("leader", F.when(F.col("rep") != F.col(key), F.col("rep")))
    return named.withColumn("leader", leader).withColumn("kept", F.col("leader").isNull()).drop("__t", "rep")


def dedupe_same_events(rows: DataFrame, key: str, rank: str, threshold: float = 0.72, days: int = 3) -> DataFrame:
    """``rows`` with ``kept`` and ``leader``, greedy by ascending unique rank under ``same_event`` with the policy rule.

    Rows have canonical, place, measures, tokens, published, said and told. Pairs come from the similarity join, from equal
    addresses, and from announcements of one place with a word in common and near dates; ``same_event`` decides. Rows that
    agree in all that it reads and match each other stand or fall by their best one: those of equal tokens, place and
    measures, and, if they share an address with others or announce a policy, of equal address, date, said and told too.
    """
    has = lambda words: F.arrays_overlap("said", F.array(*map(F.lit, words)))
    announces = F.coalesce(F.col("place").isNotNull() & F.col("published").isNotNull() & has(POLICY_WORDS) & has(ANNOUNCEMENT_WORDS), F.lit(False))
    shared = rows.where("canonical is not null").groupBy("canonical").agg(F.count("*").alias("__n")).where("__n > 1").select("canonical", F.lit(True).alias("__shared"))
    tokens, none = F.array_sort(F.coalesce("tokens", F.array().cast("array<string>"))), F.array().cast("array<string>")
    told = rows.withColumn("tokens", tokens).join(shared, "canonical", "left").withColumns({"__shared": F.coalesce("__shared", F.lit(False)), "__policy": announces})
    measured = F.array_sort(F.transform(F.map_entries("measures"), lambda e: F.struct(e["key"].alias("u"), F.array_sort(e["value"]).alias("v"))))
    own = F.struct(
        F.when(F.col("__shared"), F.col("canonical")).alias("url"), F.when(F.col("__policy"), F.col("published")).alias("date"),
        F.when(F.col("__policy"), F.array_sort("said")).otherwise(none).alias("said"), F.when(F.col("__policy"), F.array_sort(F.coalesce("told", none))).otherwise(none).alias("told"),
        F.when(F.size("tokens") == 0, F.col(key)).alias("key"),
    )
    signed = cut(told.withColumn("__sign", F.xxhash64(F.to_json(F.struct("tokens", "place", measured.alias("m"), own.alias("o"))))))
    best = signed.groupBy("__sign").agg(F.min_by(key, rank).alias("rep"))
    nodes = cut(signed.join(best, "__sign").where(F.col(key) == F.col("rep")).drop("__sign"))
    links = _event_candidates(nodes, threshold, days)
    features = ("canonical", "place", "measures", "tokens", "published", "said", "told")
    side = lambda name, at: nodes.select(F.col("rep").alias(name), F.struct(*features).alias(at))
    same = links.join(side("a", "l"), "a").join(side("b", "r"), "b").where(same_event("l", "r", threshold, policy=True)).select("a", "b")
    decided = leaders(nodes.select("rep", F.col(rank).alias("__rank")), "rep", "__rank", same).select("rep", "leader")
    named = signed.select(key, "__sign").join(best, "__sign").join(decided, "rep", "left")
    leader = F.coalesce("leader", F.when(F.col("rep") != F.col(key), F.col("rep")))
    return rows.join(named.select(key, leader.alias("leader")), key).withColumn("kept", F.col("leader").isNull())


def _event_candidates(nodes: DataFrame, threshold: float, days: int) -> DataFrame:
    """(a, b), a < b, of all that can be one event."""
    near = event_pairs(nodes, "rep", "tokens", threshold).select("a", "b")
    pair = [F.col("x.rep").alias("a"), F.col("y.rep").alias("b")]
    met = nodes.where("__shared").select("rep", "canonical")
    by_url = met.alias("x").join(met.alias("y"), (F.col("x.canonical") == F.col("y.canonical")) & (F.col("x.rep") < F.col("y.rep"))).select(*pair)
    # A window of dates meets its own and the next one.
    span = F.floor(F.unix_timestamp("published") / (days * 86400))
    word = F.explode(F.array_intersect("said", F.array(*map(F.lit, ANNOUNCEMENT_WORDS)))).alias("word")
    said = nodes.where("__policy").select("rep", "place", span.alias("span"), word)
    after = said.withColumn("span", F.explode(F.array(F.col("span") - 1, F.col("span"), F.col("span") + 1)))
    by_policy = said.alias("x").join(after.alias("y"), (F.col("x.place") == F.col("y.place")) & (F.col("x.span") == F.col("y.span")) & (F.col("x.word") == F.col("y.word")) & (F.col("x.rep") < F.col("y.rep"))).select(*pair)
    return near.union(by_url).union(by_policy).distinct()


def measures(title: Column) -> Column:
    """map<unit, distinct values> of capacities and shares; gigawatts count as megawatts."""
    part = lambda k: F.regexp_extract_all(F.lower(title), F.lit(r"\b(\d[\d,]*(?:\.\d+)?)\s*(%|percent\b|per cent\b|gwh\b|mwh\b|gw\b|mw\b)"), k)
    unit = lambda u: F.when(u.startswith("g"), F.concat(F.lit("m"), F.substring(u, 2, 2))).when(u.startswith("per"), "%").otherwise(u)
    number = lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")
    found = F.zip_with(part(1), part(2), lambda x, u: F.struct(unit(u).alias("u"), F.when(u.startswith("g"), number(x) * 1000).otherwise(number(x)).alias("v")))

    def by_unit(pairs: Column) -> Column:
        units = F.array_distinct(pairs["u"])
        return F.map_from_arrays(units, F.transform(units, lambda u: F.array_distinct(F.transform(F.filter(pairs, lambda p: p["u"] == u), lambda p: p["v"]))))

    return let(found, by_unit)


def measures_conflict(a: Column, b: Column) -> Column:
    """A unit that both have with no value in common."""
    return F.exists(F.array_intersect(F.map_keys(a), F.map_keys(b)), lambda u: ~F.arrays_overlap(F.element_at(a, u), F.element_at(b, u)))


def announcement_tokens(said: Column) -> Column:
    """The distinct words of two letters or more in their event form, without stop words."""
    forms = F.create_map(*(F.lit(x) for pair in EVENT_WORD_FORMS.items() for x in pair))
    words = F.array_except(F.regexp_extract_all(F.lower(F.coalesce(said, F.lit(""))), F.lit(r"([a-z0-9]{2,})"), 1), F.array(*map(F.lit, (*EVENT_STOP_WORDS, "more", "under"))))
    return F.array_distinct(F.transform(words, lambda w: F.coalesce(F.try_element_at(forms, w), w)))


def same_policy(left: str, right: str, days: int = 3) -> Column:
    """Whether two candidates announce one policy: one known place, dates within ``days``, a policy word on either side, a
    shared announcement word, and titles or snippets that nearly agree.

    Each side has place, published, and ``said`` and ``told``, the announcement tokens of title and snippet.
    """
    l, r = (lambda name: F.col(f"{left}.{name}")), (lambda name: F.col(f"{right}.{name}"))  # noqa: E731, E741
    has = lambda tokens, words: F.arrays_overlap(tokens, F.array(*map(F.lit, words)))
    shared, told = F.array_intersect(l("said"), r("said")), F.array_intersect(l("told"), r("told"))
    least, least_told = F.least(F.size(l("said")), F.size(r("said"))), F.least(F.size(l("told")), F.size(r("told")))
    anchored = (l("place") == r("place")) & (F.abs(F.unix_timestamp(l("published")) - F.unix_timestamp(r("published"))) <= days * 86400)
    worded = has(l("said"), POLICY_WORDS) & has(r("said"), POLICY_WORDS) & has(shared, ANNOUNCEMENT_WORDS)
    titles = has(shared, POLICY_WORDS) & (least >= 6) & (F.size(shared) >= 0.85 * least)
    snippets = (F.size(shared) >= 3) & (F.size(told) >= 12) & (F.size(told) >= 0.9 * least_told)
    return F.coalesce(anchored & worded & (titles | snippets), F.lit(False))


def same_event(left: str, right: str, threshold: float = 0.72, policy: bool = False) -> Column:
    """Whether two candidates tell of one event; each side has canonical, place, measures and tokens, for ``policy`` also what that asks for."""
    l, r = (lambda name: F.col(f"{left}.{name}")), (lambda name: F.col(f"{right}.{name}"))  # noqa: E731, E741
    return (
        F.when(l("canonical") == r("canonical"), True)
        .when(l("place").isNotNull() & r("place").isNotNull() & (l("place") != r("place")), False)
        .when(measures_conflict(l("measures"), r("measures")), False)
        .otherwise(F.coalesce(text.jaccard(l("tokens"), r("tokens")) >= threshold, F.lit(False)) | (same_policy(left, right) if policy else F.lit(False)))
    )


def leaders(rows: DataFrame, key: str, rank: str, pairs: DataFrame) -> DataFrame:
    """``rows`` with ``kept`` and ``leader``: greedy by ascending rank, a row goes if a kept better one matches it.

    Not connected components: what a dropped row matches stays. The greedy order is resolved in
    rounds over the pairs alone; in each, a row without undecided better neighbours is kept, and
    a row with a kept better neighbour goes. Ranks are unique.
    """
    order = rows.select(key, F.col(rank).alias("rank"))
    side = lambda k, r: order.select(F.col(key).alias(k), F.col("rank").alias(r))
    links = pairs.select("a", "b").union(pairs.select("b", "a")).toDF("x", "y").distinct().join(side("x", "rx"), "x").join(side("y", "ry"), "y").where("rx < ry")
    links = cut(links.select("x", "rx", "y"))
    kept = cut(links.select(F.col("x").alias("k")).distinct().join(links.select(F.col("y").alias("k")).distinct(), "k", "left_anti"))
    gone = cut(links.join(kept.withColumnRenamed("k", "x"), "x", "left_semi").groupBy("y").agg(F.min_by("x", "rx").alias("leader")).withColumnRenamed("y", "k"))
    while True:
        decided = kept.union(gone.select("k"))
        open_ = links.join(decided.withColumnRenamed("k", "y"), "y", "left_anti").join(gone.select(F.col("k").alias("x")), "x", "left_anti")
        waiting = open_.join(kept.withColumnRenamed("k", "x"), "x", "left_anti").select("y").distinct()
        rest = links.select(F.col("y").alias("k")).distinct().join(decided, "k", "left_anti")
        new = cut(rest.join(waiting.withColumnRenamed("y", "k"), "k", "left_anti"))
        if new.isEmpty():
            break
        kept = cut(kept.union(new))
        gone = cut(links.join(kept.withColumnRenamed("k", "x"), "x", "left_semi").join(kept.withColumnRenamed("k", "y"), "y", "left_anti").groupBy("y").agg(F.min_by("x", "rx").alias("leader")).withColumnRenamed("y", "k"))
    return rows.join(gone.select(F.col("k").alias(key), "leader"), key, "left").withColumn("kept", F.col("leader").isNull())
