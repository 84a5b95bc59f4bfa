"""How often the run with a model reads its articles, and snippets told by a text's head."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.plans import assisted, assisted_queries
from millrace.plans.values import EngineConfig


def test_articles_are_gated_once_for_all_rounds_of_calls(spark):
    n, reads = 40, spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(title):
        reads.add(1)
        return title

    rows = [(str(k), f"https://x{k}.org/{k}", f"A title of {k} words", "told " * (k % 7), "x.org", True, 5.0, dt.datetime(2024, 1, 31)) for k in range(n)]
    kinds = "key string, url string, title string, snippet string, publisher string, registered boolean, quality double, published timestamp"
    articles = spark.createDataFrame(rows, kinds).withColumn("title", read("title"))
    told = assisted.classified_pool(articles, F.lit("2024-02-01").cast("timestamp"), EngineConfig(), assisted.Model(assisted_queries.classify, assisted_queries.enrich), None, "rss")
    assert sum(1 for r in told.collect() if r["decision"]) == n
    assert reads.value <= 2 * n  # the gate's own two uses


def test_snippets_by_head_are_those_of_the_whole_text(spark):
    cap = 20
    texts = ["word " * 30, "a" * 200, "a" * 20, "a" * 21, " " * 79 + "b" * 40, "x  " * 40, "w " * 40 + "<b>late</b> &amp; more", "w" * 79 + "<b>x</b>", "w" * 80 + "&amp;lt;b", "<p>" + "v " * 60, "n&nbsp;" * 30, " é" * 60, "y" * 19 + " z" * 50, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, x string")
    whole = text.clean_text(F.col("x"))
    want = F.when(F.length(whole) > cap, F.concat(F.rtrim(F.substring(whole, 1, cap)), F.lit("..."))).otherwise(whole)
    assert [r for r in df.select("k", text.snippet(F.col("x"), cap).alias("got"), want.alias("want")).collect() if r["got"] != r["want"]] == []
