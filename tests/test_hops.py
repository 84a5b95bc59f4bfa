"""Redirects against one address followed at a time."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.sources import hops, resolver

A = "https://a.org/"
ANSWERS = [
    (A + "1", 301, "/2"), (A + "2", 302, "3"), (A + "3", 200, None), (A + "in", 302, "//b.net/x"), ("https://b.net/x", 307, "http://127.0.0.1/secret"), (A + "p1", 301, A + "p2"), (A + "p2", 301, A + "p3"),
    (A + "p3", 301, "http://10.1.2.3/"), (A + "l1", 301, A + "l2"), (A + "l2", 301, A + "l1"), (A + "self", 302, "#top"), (A + "gone", 302, A + "nowhere"), (A + "bad", 301, A + "err"), (A + "err", 500, None),
    (A + "plain", 301, None), (A + "twice", 200, None), (A + "twice", 301, A + "3"), (A + "user", 301, "https://u:p@b.net/"), (A + "q?x=1", 301, "?x=2"), (A + "q?x=2", 200, ""),
    *((A + f"c{k}", 301, f"c{k + 1}") for k in range(30)), (A + "c30", 200, None),
]
STARTS = [u for u, _, _ in ANSWERS] + [None, "", "ftp://a.org/x", "http://localhost/", "https://a.org/unknown", "nonsense"]


def one(url, most, public):
    known = {}
    for u, s, to in sorted(ANSWERS, key=lambda a: (a[0], a[1])):
        known.setdefault(u, (s, to))
    if not url or not public(url):
        return url, 0, "refused destination"
    past = [url]
    while True:
        if url not in known:
            return url, len(past) - 1, "no answer"
        status, to = known[url]
        if status >= 400:
            return url, len(past) - 1, "failed"
        if status not in hops.REDIRECTS or not to:
            return url, len(past) - 1, "arrived"
        if len(past) - 1 == most:
            return url, most, "too many hops"
        to = urljoin(url, to).split("#")[0]
        if not public(to):
            return to, len(past), "refused destination"
        if to in past:
            return to, len(past), "loop"
        past.append(to)
        url = to


@pytest.mark.parametrize("most", [0, 3, 20])
def test_every_start(spark, most):
    answers = spark.createDataFrame(ANSWERS, "url string, status int, location string")
    rows = spark.createDataFrame([(k, u, "x") for k, u in enumerate(STARTS * 2)], "id int, url string, status string")
    seen = {a for u, s, to in ANSWERS for a in (u, urljoin(u, to or "").split("#")[0])} | {u for u in STARTS if u}
    told = {r.u: bool(r.p) for r in spark.createDataFrame([(u,) for u in seen], "u string").select("u", urls.public_destination(F.col("u")).alias("p")).collect()}
    got = {r.id: (r.final_url, r.hops, r.outcome) for r in hops.followed(rows, answers, most=most).collect()}
    assert got == {k: one(u, most, told.get) for k, u in enumerate(STARTS * 2)}
    assert most < 20 or {o for _, _, o in got.values()} == set(hops.OUTCOMES)


def test_a_hot_address_is_followed_once(spark):
    answers = spark.createDataFrame(ANSWERS, "url string, status int, location string")
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit(A), F.col("id"))).otherwise(A + "1").alias("url"))
    got = {(r.outcome, r.hops): r.n for r in hops.followed(rows, answers).groupBy("outcome", "hops").agg(F.count("*").alias("n")).collect()}
    assert got == {("arrived", 2): 18_000, ("no answer", 0): 2_000} or got[("arrived", 2)] == 18_000


def test_resolution_of_a_hot_wrapper(spark):
    """One address with most of the rows: its first row asks, all others are served from memory."""
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 60).otherwise(-1).cast("string").alias("url"), (F.col("id") % 7).alias("at"), F.lit(None).cast("string").alias("expected"))
    answers = spark.createDataFrame([(str(k), "resolved", f"https://p{k}.example.com/a") for k in range(-1, 60)], "url string, status string, target string")
    got = resolver.resolution(rows, answers, "id", "url", [F.col("at")])
    count = {(r.url, r.cached): r.n for r in got.join(rows.select("id", "url"), "id").groupBy("url", "cached").agg(F.count("*").alias("n")).collect()}
    assert count["-1", False] == 1 and count["-1", True] == 14_999 and sum(n for (_, c), n in count.items() if not c) == 16
