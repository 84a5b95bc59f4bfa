"""Keyword and geography expressions. Word boundaries are spelt out, so that engines without look-around agree."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import phrases
from millrace.functions.bind import let
from millrace.plans.values import KEYWORD_VARIANTS, NEGATED, OTHER_LOCATIONS, PARTICIPANT_ORIGINS, PARTICIPANTS, REGION_ALIASES, REGION_KEYWORDS, WHOLE_KEYWORDS

# Fixed value: words that say a text tells of a project at a place.
PROJECT = r"(?iU)\b(?:projects?|plants?|facilit\w*|capacity|build\w*|construct\w*|manufactur\w*|farms?|flood\w*|drought|renewable|solar|water infrastructure)\b"
_END = r"(?![\p{L}\p{N}_])"


def without_negations(text: Column, words: tuple[str, ...] = NEGATED) -> Column:
    """``not about water`` and the like say nothing about water; ``not only water`` and ``not enough water`` do."""
    return F.regexp_replace(text, rf"(?iU)\b(?:not|neither|nor)\s+(?:about\s+)?(?:{'|'.join(map(re.escape, words))})\b", "")


def contains_phrase(text: Column, names: tuple[str, ...]) -> Column:
    """Whether a lower-case text holds any of the phrases, not within a longer word."""
    listed = "|".join(re.escape(p.strip()) for p in names)
    return text.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{listed}){_END}") if names else F.lit(False)


def without_participants(text: Column) -> Column:
    """A text without the nationality of those who take part, which doesn't tell where something is."""
    who = "|".join(PARTICIPANTS)
    return F.regexp_replace(text, rf"(?iU)\b(?:{'|'.join(PARTICIPANT_ORIGINS)})(?:['’]s\s+|[- ]based\s+(?=(?:{who})\b)|\s+(?=(?:{who})\b))", "")


def keyword_matches(text: Column, tokens: Column, keyword: str, whole: tuple[str, ...] = WHOLE_KEYWORDS) -> Column:
    """Of several words: anywhere in the text. Of one: a token, or the start of one from five letters on, but for ``whole``. Stated variants match as phrases."""
    variants = KEYWORD_VARIANTS.get(keyword)
    other = contains_phrase(text, variants) if variants else F.lit(False)
    if " " in keyword or "-" in keyword:
        return other | text.contains(keyword)
    exact = other | F.array_contains(tokens, keyword)
    return exact if len(keyword) < 5 or keyword in whole else exact | F.exists(tokens, lambda t: t.startswith(keyword))


def ascii_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([a-z0-9]+)"), 1)


def matched_topics(text: Column, topics: dict[str, tuple[str, ...]], whole: tuple[str, ...] = WHOLE_KEYWORDS) -> Column:
    """The topics, in their order, of which any keyword matches the lower-case text, by one scan for all of them."""
    return phrases.labels_of(text, topics, whole, KEYWORD_VARIANTS)


def matched_topics_by_expression(text: Column, topics: dict[str, tuple[str, ...]], whole: tuple[str, ...] = WHOLE_KEYWORDS) -> Column:
    """As ``matched_topics``, by an expression for each keyword: for a handful of keywords."""
    tokens = ascii_tokens(text)
    hit = lambda words: F.expr("false") if not words else reduce(lambda a, b: a | b, [keyword_matches(text, tokens, w, whole) for w in words])
    return F.array_compact(F.array(*(F.when(hit(words), F.lit(topic)) for topic, words in topics.items())))


def exact_region(label: Column) -> Column:
    """The quota region that a label names, else null."""
    names = F.create_map(*(F.lit(x) for pair in REGION_ALIASES.items() for x in pair))
    return F.try_element_at(names, F.lower(F.trim(label)))


def primary_region(labels: Column) -> Column:
    """That of the first label that names one."""
    return F.try_element_at(F.filter(F.transform(labels, exact_region), lambda x: x.isNotNull()), F.lit(1))


def _pattern(names: tuple[str, ...]) -> str:
    return "|".join(map(re.escape, sorted(names, key=lambda n: (-len(n), n))))


def mentions(text: Column, places: dict[str, tuple[str, ...]]) -> Column:
    """The place of each name in a text, in order; of names that start alike the longest counts.

    One pattern finds all of them. Bounds are doubled before, so that neighbours don't share one.
    """
    spread = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"([^\p{L}\p{N}_])", "$1$1"), F.lit(" "))
    alias = {n.replace(" ", "  "): p for p, names in places.items() for n in names}
    known = F.create_map(*(F.lit(x) for pair in alias.items() for x in pair))
    return F.transform(F.regexp_extract_all(spread, F.lit(rf"[^\p{{L}}\p{{N}}_]({_pattern(tuple(alias))})[^\p{{L}}\p{{N}}_]"), 1), lambda n: F.try_element_at(known, n))


def _counted(found: Column) -> Column:
    return F.transform(F.array_distinct(found), lambda p: F.struct(p.alias("k"), F.size(F.filter(found, lambda m: m == p)).alias("v")))


def mention_counts(text: Column, places: dict[str, tuple[str, ...]] | None = None) -> Column:
    """map<place, mentions> of a text, without places that aren't mentioned."""
    return let(mentions(text, REGION_KEYWORDS if places is None else places), lambda found: F.map_from_entries(_counted(found)))


def reported_location(text: Column) -> Column:
    """struct<place, basis> of one text, participants' origins aside.

    In a project's text the one place named after in, within or across; else the only place named; else one that the text
    begins with, unless it goes on to list others; else the place named most often, if one is.
    """
    places = REGION_KEYWORDS | OTHER_LOCATIONS
    alias = F.create_map(*(F.lit(x) for p, names in places.items() for n in names for x in (n, p)))
    names = _pattern(tuple(n for group in places.values() for n in group))
    told = lambda place, basis: F.struct(place.alias("place"), (F.lit(basis) if isinstance(basis, str) else basis).alias("basis"))
    nothing = F.lit(None).cast("string")

    def decide(said: Column) -> Column:
        lower, counts = said["t"], said["c"]
        explicit = F.regexp_extract_all(lower, F.lit(rf"(?U)\b(?:in|within|across)\s+(?:the\s+)?({names}){_END}"), 1)
        project = lower.rlike(PROJECT)
        first = F.try_element_at(alias, F.regexp_extract(lower, rf"^\s*(?>({names}){_END})(?!\s*(?:and\b|or\b|[&,/]))", 1))
        most = F.array_max(F.transform(counts, lambda c: c["v"]))
        leaders = F.filter(counts, lambda c: c["v"] == most)
        sites = F.when(project, F.array_distinct(F.transform(explicit, lambda n: F.try_element_at(alias, n))))
        return let(F.struct(sites.alias("s"), first.alias("f"), leaders.alias("l")), lambda x: (
            F.when(F.size(x["s"]) == 1, told(F.try_element_at(x["s"], F.lit(1)), "explicit project/event location"))
            .when(F.size(counts) == 1, told(F.try_element_at(counts, F.lit(1))["k"], F.when(project, "project/event subject").otherwise("title geography")))
            .when(x["f"].isNotNull(), told(x["f"], "project/event subject"))
            .when(F.size(x["l"]) == 1, told(F.try_element_at(x["l"], F.lit(1))["k"], "dominant article geography"))
            .otherwise(told(nothing, "ambiguous regional geography"))
        ))

    bare = F.lower(without_participants(text))
    named = let(bare, lambda t: F.struct(t.alias("t"), let(mentions(t, places), _counted).alias("c")))
    return let(named, lambda said: F.when(F.coalesce(F.size(said["c"]), F.lit(0)) <= 0, told(nothing, "")).otherwise(decide(said)))


def article_location(title: Column, snippet: Column) -> Column:
    """struct<place, basis> by the title, else by the snippet."""
    return let(F.struct(reported_location(title).alias("t"), reported_location(snippet).alias("s")), lambda x: (
        F.when(x["t"]["place"].isNotNull() | x["s"]["place"].isNull(), F.struct(x["t"]["place"].alias("place"), F.coalesce(F.nullif(x["t"]["basis"], F.lit("")), x["s"]["basis"], F.lit("")).alias("basis")))
        .otherwise(F.struct(x["s"]["place"].alias("place"), F.concat(F.lit("description: "), x["s"]["basis"]).alias("basis")))
    ))


def assigned_region(title: Column, snippet: Column, source_regions: Column, discovered: Column, foreign_local: Column | None = None, systemic: Column | None = None) -> Column:
    """struct<region, basis>: blocked if foreign-local, Global if systemic, else by title, by snippet, and by the source; found stories never by the source."""
    blocked, wide = (F.coalesce(c, F.lit(False)) if c is not None else F.lit(False) for c in (foreign_local, systemic))
    nothing = F.lit(None).cast("string")
    told = lambda region, basis: F.struct(region.alias("region"), basis.alias("basis"))

    def decide(x: Column) -> Column:
        place, basis, own = x["place"], x["basis"], primary_region(source_regions)
        return (
            F.when(blocked, told(nothing, F.lit("explicit foreign-local geography; publisher fallback blocked")))
            .when(wide & ~basis.contains("project/event"), told(F.lit("Global"), F.lit("explicit systemic or cross-border mission scope")))
            .when(place.isin(*REGION_KEYWORDS), told(place, F.concat(basis, F.lit(": "), place)))
            .when(place.isNotNull(), told(F.lit("Global"), F.concat(basis, F.lit(": "), place, F.lit("; other MENA coverage routed to Global"))))
            .when(basis != "", told(nothing, basis))
            .when(discovered, told(nothing, F.lit("no article geography; discovery query is not geographic evidence")))
            .otherwise(told(own, F.when(own.isNotNull(), "source-region fallback").otherwise("no exact regional evidence")))
        )

    return let(article_location(title, snippet), decide)
