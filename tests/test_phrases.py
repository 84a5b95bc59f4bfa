"""Matches of many phrases against a search for each, and against the expressions that they replace."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import keywords, phrases
from millrace.operators import identity
from millrace.plans.values import CONTEXT_KEYWORDS, DIRECT_KEYWORDS

RULES = (phrases.ANYWHERE, phrases.WORD, phrases.PREFIX, phrases.PHRASE)


def brute(text, entries):
    before = {phrases.ANYWHERE: "", phrases.WORD: r"(?<![a-z0-9])", phrases.PREFIX: r"(?<![a-z0-9])", phrases.PHRASE: r"(?<!\w)"}
    after = {phrases.ANYWHERE: "", phrases.WORD: r"(?![a-z0-9])", phrases.PREFIX: "", phrases.PHRASE: r"(?!\w)"}
    out = []
    for phrase, rule, value in set(entries):
        if phrase and (rule in (phrases.ANYWHERE, phrases.PHRASE) or re.fullmatch("[a-z0-9]+", phrase)):
            out += [(m.start(), m.start() + len(phrase), value) for m in re.finditer(f"(?={before[rule]}{re.escape(phrase)}{after[rule]})", text)]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abé1_ -", max_size=30), st.lists(st.tuples(st.text(alphabet="abé1 -", max_size=4), st.sampled_from(RULES), st.integers(0, 3)), max_size=12))
def test_matches(text, entries):
    assert sorted(phrases.Phrases(entries).matches(text)) == brute(text, entries)


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_topics_equal_expressions(spark, folder):
    """On all documents: words of theirs by every rule, and the topics of the runs."""
    own = {"A": ("the and", "threa", "stion"), "B": ("ing", "water"), "C": ("not-there", "th-"), "D": ("que", "ción", "and the"), "E": (), "F": ("inger", "x1", "thand")}
    told = " waters " + ", ".join(w + tail for group in (DIRECT_KEYWORDS, CONTEXT_KEYWORDS) for words in group.values() for w, tail in zip(words, ("", "s", "x", "-y"), strict=False))
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", F.lower("text").alias("t"))
    docs = docs.withColumn("t", F.when(F.col("doc_id") % 3 == 0, F.concat("t", F.lit(told))).otherwise(F.col("t")))
    for topics in (own, DIRECT_KEYWORDS, CONTEXT_KEYWORDS):
        both = docs.select(keywords.matched_topics(F.col("t"), topics).alias("a"), keywords.matched_topics_by_expression(F.col("t"), topics).alias("b"))
        assert both.where("not (a <=> b)").count() == 0 and both.where("size(a) > 0").count() > 100


def test_nothing_to_match(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "some words")], "id int, t string")
    assert [r.x for r in df.select(phrases.labels_of(F.col("t"), {"a": (), "b": ("",)}).alias("x")).collect()] == [[], [], []]
    assert [r.x for r in df.select(phrases.longest(F.col("t"), {}).alias("x")).collect()] == [None, None, None]


def test_longest_override_both_ways(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "A Small RING of red"), (2, "smallest"), (3, None), (4, "blue bolt small"), (5, "")], "row_id long, name string")
    overrides = spark.createDataFrame([("small ring", "a"), ("Small", "b"), ("small", "c"), ("blue bolt", "d"), (None, "e")], "phrase string, value string")
    got = lambda: dict(identity.longest_override(rows, "name", overrides, "phrase", "value").collect())
    assert got() == {1: "a", 2: "b", 4: "d"}
    monkeypatch.setattr(identity, "SCANNED", 1)
    assert {k: v for k, v in got().items() if k != 2} == {1: "a", 4: "d"}
