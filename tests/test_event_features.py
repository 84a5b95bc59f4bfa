"""What rows are read for before they meet in pairs: each text once, by every task."""

import contextlib
import io

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import events
from millrace.plans import pool_queries


def plan(df, mode="extended"):
    with contextlib.redirect_stdout(io.StringIO()) as told:
        df.explain(mode)
    return told.getvalue().split("== Physical Plan ==")[-1]


def test_features_bind_each_text_once(spark):
    df = spark.createDataFrame([("x",)], "x string")
    # number and unit; the publisher's name and the words; the words
    for make, most in ((events.measures, 2), (text.title_tokens, 2), (events.announcement_tokens, 1)):
        assert plan(df.select(make(F.col("x")).alias("y"))).count("regexp_") <= most


def test_announcements_are_dealt_out_before_they_are_read(spark, sf):
    physical = plan(pool_queries._announcements(spark, sf))
    assert physical.count("REPARTITION_BY_COL") == 2


def test_features_of_odd_texts(spark):
    said = ["12 GW, 5 %, 7 per cent and 1,200.5MW", "3. GWh 2,GW 12\tpercent 12 percentage 5 mws", "", None, "5% 5 % 5 percent"]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(said)], "k int, x string")
    got = [r.m for r in df.orderBy("k").select(events.measures(F.col("x")).alias("m")).collect()]
    assert got == [{"mw": [12000.0, 1200.5], "%": [5.0, 7.0]}, {"mw": [2000.0], "%": [12.0]}, {}, None, {"%": [5.0]}]
    words = df.orderBy("k").select(text.title_tokens(F.col("x")).alias("t"), events.announcement_tokens(F.lit("A plan, more plans: x y approved ab")).alias("a")).first()
    assert (words.t, words.a) == (["12", "200", "5mw", "cent", "gw", "per"], ["plan", "approve", "ab"])
