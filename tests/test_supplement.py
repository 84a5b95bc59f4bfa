"""Unambiguous matches against all pairs, and a headline that very many rows share."""

import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.operators import identity

KINDS = "id long, publisher string, source string, title string, canonical string, published timestamp"


def made(rng, n, first):
    titles = ["a story of four words", "A Story, of FOUR words", "three words only", "quite another story told", None, ""]
    return [(first + k, rng.choice(["p", "q", None]), rng.choice(["", None]), rng.choice(titles), rng.choice(["", None, *(f"https://p.org/{j}" for j in range(40))]), rng.choice([None, datetime(2024, 1, 1) + timedelta(hours=rng.choice([0, 24, 48, 23, 25, 47, 49, 96, 95, 720]), seconds=rng.choice([0, 0, 1]))])) for k in range(n)]


def test_against_all_pairs(spark):
    for seed in range(4):
        rng = random.Random(seed)
        f, d = (spark.createDataFrame(made(rng, 30, k), KINDS) for k in (0, 1000))
        pairs = {tuple(r) for r in identity.clear_matches(f, d).collect()}
        lefts, rights = [p[0] for p in pairs], [p[1] for p in pairs]
        want = {p for p in pairs if lefts.count(p[0]) == 1 and rights.count(p[1]) == 1}
        assert {tuple(r) for r in identity.only_matches(f, d).collect()} == want


def test_a_headline_of_very_many(spark):
    """100,000 rows of one headline within one day on one side, two on the other, and single pairs beside them."""
    hot = lambda n, first: spark.range(n).select((F.col("id") + first).alias("id"), F.lit("p").alias("publisher"), F.lit("").alias("source"), F.lit("the one headline that all have").alias("title"), F.concat(F.lit("https://p.org/"), F.col("id") + first).alias("canonical"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400).alias("published"))
    own = lambda first: spark.range(50).select((F.col("id") + first).alias("id"), F.lit("p").alias("publisher"), F.lit("").alias("source"), F.concat(F.lit("a headline of number "), "id").alias("title"), F.concat(F.lit("https://p.org/x"), F.col("id") + first).alias("canonical"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 100_000).alias("published"))
    feed, direct = hot(100_000, 0).unionByName(own(500_000)), hot(20_000, 1_000_000).unionByName(own(2_000_000))
    began = time.perf_counter()
    assert {tuple(r) for r in identity.only_matches(feed, direct).collect()} == {(500_000 + k, 2_000_000 + k) for k in range(50)}
    assert time.perf_counter() - began < 120
