"""What an article is about: topics, scope, geography and strength, from title and snippet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import keywords, text
from millrace.plans.values import (
    BATTERY, BATTERY_RESCUES, BATTERY_TOPICS, BATTERY_USE, CONCRETE_DEVELOPMENT, CONTEXT_KEYWORDS, DIRECT_KEYWORDS, INTEREST_PLACES, LOCAL_FOCUS, OFF_MISSION, OUTSIDE_PLACES, OVERSEAS_PATTERNS, SPECIFIC_MISSION,
    SYSTEMIC_PATTERNS, TOPIC_NAMES,
)


def article_words(title: Column, snippet: Column) -> Column:
    """Title and snippet as one lower-case line, without what is explicitly negated. The other functions take this."""
    return keywords.without_negations(F.lower(text.fold_blanks(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(snippet, F.lit(""))))))


def _holds(words: Column, *patterns: str) -> Column:
    return reduce(lambda a, b: a & b, (words.rlike("(?iU)" + p) for p in patterns))


def systemic(words: Column) -> Column:
    """A world-wide market, a strait's supplies, a development bank's programme, or investments of the region across overseas grids."""
    wide = reduce(lambda a, b: a | b, (_holds(words, *row) for row in SYSTEMIC_PATTERNS))
    return wide | (keywords.contains_phrase(words, INTEREST_PLACES) & _holds(words, *OVERSEAS_PATTERNS))


def foreign_local(title: Column, words: Column) -> Column:
    """A title set outside, in an article without a place of interest, that is local or has no systemic scope."""
    bare = F.lower(keywords.without_participants(text.fold_blanks(title)))
    inside = keywords.contains_phrase(keywords.without_participants(words), INTEREST_PLACES)
    return keywords.contains_phrase(bare, OUTSIDE_PLACES) & ~inside & (_holds(bare, LOCAL_FOCUS) | ~systemic(words))


def interest_geography(title: Column, words: Column) -> Column:
    """Whether an article isn't merely local to places outside."""
    near = systemic(words) | keywords.contains_phrase(words, INTEREST_PLACES) | ~keywords.contains_phrase(words, OUTSIDE_PLACES)
    return (words != "") & ~foreign_local(title, words) & near


def _topics(words: Column, topics: tuple[str, ...], *groups: dict[str, tuple[str, ...]], own_name: bool = False) -> Column:
    """The topics of which a keyword of any group matches; one without keywords stands for itself, if ``own_name``."""
    known = {t: tuple(k for g in groups for k in g.get(t.lower(), ())) or ((t.lower(),) if own_name else ()) for t in dict.fromkeys(topics)}
    return keywords.matched_topics(words, known)


def battery_alone(words: Column) -> Column:
    """Batteries without a use in the transition and without another topic."""
    return _holds(words, BATTERY) & ~_holds(words, BATTERY_USE) & (F.size(_topics(words, BATTERY_RESCUES, DIRECT_KEYWORDS)) == 0)


def direct_signals(words: Column, topics: tuple[str, ...] = TOPIC_NAMES) -> Column:
    """The topics that the words stand for by themselves; those of the transition not by a battery alone."""
    found = _topics(words, topics, DIRECT_KEYWORDS)
    return F.when(battery_alone(words), F.filter(found, lambda t: ~F.lower(t).isin(*BATTERY_TOPICS))).otherwise(found)


def contextual_signals(words: Column, topics: tuple[str, ...] = TOPIC_NAMES) -> Column:
    return _topics(words, topics, CONTEXT_KEYWORDS)


def company_topics(words: Column, topics: tuple[str, ...] = TOPIC_NAMES) -> Column:
    """All topics, by direct or contextual words or by their own name."""
    return _topics(words, topics, DIRECT_KEYWORDS, CONTEXT_KEYWORDS, own_name=True)


def mission_strength(words: Column, direct: Column) -> Column:
    """struct<strength, concrete>: 0 without direct signals, 1 for resilience alone, 2 or, with a specific mission, 3; concrete if something is built, paid or ruled."""
    core = F.size(F.array_remove(direct, "resilience")) > 0
    strength = F.when(core, F.when(_holds(words, SPECIFIC_MISSION), 3).otherwise(2)).otherwise(F.when(F.size(direct) > 0, 1).otherwise(0))
    return F.struct(strength.cast("int").alias("strength"), (core & _holds(words, CONCRETE_DEVELOPMENT)).alias("concrete"))


def off_mission(words: Column, direct: Column) -> Column:
    """Why an article is off the mission, else null."""
    beside = reduce(lambda a, b: a | b, (_holds(words, p) for p in OFF_MISSION))
    core = F.size(F.array_remove(direct, "resilience")) > 0
    return F.when(battery_alone(words), "battery coverage without a transition application").when(~core & beside, "consumer finance or passenger travel without a direct mission consequence")
