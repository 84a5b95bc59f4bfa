"""Searches over an index against every row, with a word that all rows hold."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import search

REQUESTS = "request_id int, query array<string>, count int, language string, domains array<string>, since int, until int"


@pytest.mark.parametrize("seed", range(2))
def test_against_every_row(spark, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["en", "de", None]), rng.choice(["a.org", "b.org"]), rng.choice([None, *range(9)]), ["the", *rng.sample(["red", "blue", "green", "one", "two"], rng.randrange(5))]) for k in range(80)]
    asked = [(q, rng.sample(["the", "red", "blue", "green", "one", "nowhere"], rng.randrange(1, 4)), rng.choice([None, 0, 3, 99]), rng.choice([None, "en"]), rng.choice([None, [], ["a.org"], ["a.org", "b.org"]]), rng.choice([None, 3]), rng.choice([None, 6])) for q in range(30)]
    got = {}
    for r in search.search(spark.createDataFrame(asked, REQUESTS), spark.createDataFrame(rows, "id int, lang string, domain string, published int, words array<string>")).collect():
        got.setdefault(r.request_id, {})[r.position] = r.id
    want = {}
    for q, words, count, language, domains, since, until in asked:
        fits = [r for r in rows if set(words) <= set(r[4]) and (language is None or r[1] == language) and (not domains or r[2] in domains) and (since is None or (r[3] is not None and r[3] >= since)) and (until is None or (r[3] is not None and r[3] <= until))]
        fits.sort(key=lambda r: (r[3] is None, -(r[3] or 0), r[0]))
        most = max(1, min(search.MOST_RESULTS, 10 if count is None else count))
        if fits:
            want[q] = {k: r[0] for k, r in enumerate(fits[:most], 1)}
    assert got == want


def test_a_word_of_all_rows(spark):
    index = spark.range(20_000).select("id", F.lit("en").alias("lang"), F.lit("a.org").alias("domain"), F.col("id").alias("published"), F.when(F.col("id") % 5000 == 7, F.array(F.lit("the"), F.lit("rare"))).otherwise(F.array(F.lit("the"), F.lit("usual"))).alias("words"))
    requests = spark.createDataFrame([(1, ["the", "rare"], 50, None, None, None, None), (2, ["the", "usual"], 2, None, None, None, None), (3, ["the"], 3, "en", ["a.org"], 100, 19_000)], REQUESTS)
    got = sorted((r.request_id, r.position, r.id) for r in search.search(requests, index).collect())
    assert got == [(1, 1, 15_007), (1, 2, 10_007), (1, 3, 5_007), (1, 4, 7), (2, 1, 19_999), (2, 2, 19_998), (3, 1, 19_000), (3, 2, 18_999), (3, 3, 18_998)]


def test_only_words_that_are_asked_for_leave_a_row(spark, capsys):
    asked = spark.createDataFrame([(1, ["a", "b"], 5, None, None, None, None), (2, ["c"], 5, None, None, None, None)], REQUESTS)
    rows = spark.range(300).selectExpr("id", "'en' as lang", "'x' as domain", "cast(id as int) as published", "array('a', if(id % 2 = 0, 'b', 'z'), concat('w', id), 'a') as words")
    found = search.search(asked, rows)
    assert [(r.request_id, r.id) for r in found.orderBy("position").collect()] == [(1, k) for k in (298, 296, 294, 292, 290)]
    found.explain()
    # no list of all words is made again to meet the second rarest one
    assert "LeftSemi" not in capsys.readouterr().out
