"""Many phrases in one scan of a text: an Aho-Corasick automaton with rules on its matches.

Every text is read once, whatever the number of phrases. The automaton is a trie of all
phrases with failure links, along which a match also tells of the shorter ones that end with
it; a task builds it once. A rule then looks at the characters around a match: ``anywhere``,
``word`` (a whole run of ASCII letters and digits), ``prefix`` (the start of such a run), or
``phrase`` (not within a longer run of letters, digits and underscores of any script).

Null and empty texts match nothing, and so do empty phrases; a phrase that no such run can
be never matches by ``word`` or ``prefix``. Texts and phrases are compared as they are:
lower-casing is the caller's.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

ANYWHERE, WORD, PREFIX, PHRASE = "anywhere", "word", "prefix", "phrase"
_RUN = re.compile(r"[a-z0-9]+")


def _in_run(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def holds(text: str, start: int, end: int, rule: str) -> bool:
    """Whether a match from ``start`` to ``end`` fits its rule."""
    if rule == ANYWHERE:
        return True
    if rule == PHRASE:
        return not (start and _in_word(text[start - 1])) and not (end < len(text) and _in_word(text[end]))
    return not (start and _in_run(text[start - 1])) and (rule == PREFIX or not (end < len(text) and _in_run(text[end])))


class Phrases:
    """The automaton of (phrase, rule, value) triples. Phrases that no text can match by their rule are left out."""

    def __init__(self, entries: Iterable[tuple[str, str, int]]):
        from ahocorasick import Automaton

        self.automaton, ends = Automaton(), defaultdict(list)
        for phrase, rule, value in sorted(set(entries)):
            if phrase and (rule in (ANYWHERE, PHRASE) or _RUN.fullmatch(phrase)):
                ends[phrase].append((len(phrase), rule, value))
        for phrase, told in ends.items():
            self.automaton.add_word(phrase, told)
        self.empty = not ends
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, value) of every match that its rule allows, in the order of their ends."""
        if self.empty:
            return
        for last, told in self.automaton.iter(text):
            for size, rule, value in told:
                if holds(text, last + 1 - size, last + 1, rule):
                    yield last + 1 - size, last + 1, value


def label_entries(labels: dict[str, tuple[str, ...]], whole: tuple[str, ...], variants: dict[str, tuple[str, ...]]) -> list[tuple[str, str, int]]:
    """The triples of keyword rules: of several words anywhere, else a word or, from five letters on and unless ``whole``, its start; stated variants as phrases."""
    out = []
    for k, words in enumerate(labels.values()):
        for word in words:
            out += [(v.strip(), PHRASE, k) for v in variants.get(word, ())]
            out.append((word, ANYWHERE if " " in word or "-" in word else WORD if len(word) < 5 or word in whole else PREFIX, k))
    return out


def labels_of(text: Column, labels: dict[str, tuple[str, ...]], whole: tuple[str, ...] = (), variants: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The labels, in their order, of which any keyword matches the text."""
    names, entries = tuple(labels), label_entries(labels, whole, variants or {})

    @pandas_udf(ArrayType(StringType()))
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton, most = Phrases(entries), len({k for _, _, k in entries})

        def one(said: str | None) -> list[str]:
            found: set[int] = set()
            for _, _, value in automaton.matches(said or ""):
                found.add(value)
                if len(found) == most:
                    break
            return [names[k] for k in sorted(found)]

        for batch in batches:
            yield batch.map(one)

    return scan(text)


def longest(text: Column, values: dict[str, str]) -> Column:
    """The value of the longest phrase that the text contains anywhere, of equally long ones the least; null if none."""
    phrases, entries = tuple(values), [(p, ANYWHERE, k) for k, p in enumerate(values)]

    @pandas_udf(StringType())
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = Phrases(entries)

        def one(said: str | None) -> str | None:
            found = {phrases[k] for _, _, k in automaton.matches(said or "")}
            return values[min(found, key=lambda p: (-len(p), p))] if found else None

        for batch in batches:
            yield batch.map(one)

    return scan(text)
