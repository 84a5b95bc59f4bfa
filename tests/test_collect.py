"""Sources scanned together: outcomes composed of fetch and parse, and streams of files."""

from datetime import datetime, timedelta

import pytest

from millrace.sources import collect, feeds
from millrace.streaming import state

AT = datetime(2024, 1, 1)


def feed(*items):
    return ("<rss><channel>" + "".join(f"<item><title>{t}</title><link>{u}</link><pubDate>Mon, 01 Jan 2024 0{k}:00:00 GMT</pubDate></item>" for k, (t, u) in enumerate(items)) + "</channel></rss>").encode()


def fetch(url, attempt, status, content=None, error=None, ms=100):
    return (url, attempt, status, content, error, AT + timedelta(seconds=attempt), AT + timedelta(seconds=attempt, milliseconds=ms))


REGISTRY = [
    ("1", "Good", " https://a.org/feed ", " RSS", "UAE", ["energy"], 7.0), ("2", "Late", "https://b.org/feed", "atom", None, None, None), ("3", "Gone", "https://c.org/feed", "rss", "KSA", [], 5.0),
    ("4", "Broken", "https://d.org/feed", "rss", "KSA", [], 5.0), ("5", "Empty", "https://e.org/feed", "Feed", "KSA", [], 5.0), ("6", "Silent", "https://f.org/feed", "rss", "KSA", [], 5.0),
    ("7", "Listing", "https://a.org/feed", "listing", "KSA", [], 5.0), ("8", "No address", " ", "rss", "KSA", [], 5.0), ("9", "Same feed", "https://a.org/feed", "rss", "Egypt", ["water"], 3.0),
    ("10", "Unchanged", "https://g.org/feed", "rss", "KSA", [], 5.0), ("11", "Down", "https://h.org/feed", "rss", "KSA", [], 5.0),
]
FETCHES = [
    fetch("https://a.org/feed", 1, 200, feed(("One story told", "https://a.org/1"), ("Two stories told", "https://a.org/2"))),
    fetch("https://b.org/feed", 1, 503), fetch("https://b.org/feed", 2, None, None, "timed out"), fetch("https://b.org/feed", 3, 200, feed(("Third time lucky", "https://b.org/1"))), fetch("https://b.org/feed", 4, 500),
    fetch("https://c.org/feed", 1, 404, b"<html>"), fetch("https://d.org/feed", 1, 200, b"<rss><channel"), fetch("https://e.org/feed", 1, 200, feed()), fetch("https://g.org/feed", 1, 304),
    *(fetch("https://h.org/feed", k, 500, None, "server error") for k in (1, 2, 3)),
]


def test_every_source_has_one_attempt(spark):
    registry = spark.createDataFrame(REGISTRY, "source_id string, source_name string, feed_url string, collection_method string, source_region string, topics array<string>, quality double")
    articles, attempts = collect.collected(registry, spark.createDataFrame(FETCHES, collect.FETCHES))
    got = {r.source_id: (r.outcome, r.article_count, r.duration_ms, r.attempts) for r in attempts.collect()}
    assert got == {
        "1": ("Success", 2, 100, 1), "2": ("Success", 1, 2100, 3), "3": ("HTTP Error", 0, 100, 1), "4": ("Parse Error", 0, 100, 1), "5": ("Empty", 0, 100, 1), "6": ("Fetch Error", 0, None, None),
        "9": ("Success", 2, 100, 1), "10": ("Unchanged", 0, 100, 1), "11": ("HTTP Error", 0, 2100, 3),
    }
    errors = {r.source_id: r.error for r in attempts.collect()}
    assert errors["11"] == "server error" and errors["3"] == "status 404" and errors["6"] == "no answer" and errors["4"] and errors["1"] == ""
    rows = [(r.source_id, r.url, r.source_region, r.topics, r.quality) for r in articles.orderBy(*collect.scan_order()).collect()]
    assert rows == [("1", "https://a.org/1", "UAE", ["energy"], 7.0), ("9", "https://a.org/1", "Egypt", ["water"], 3.0), ("1", "https://a.org/2", "UAE", ["energy"], 7.0), ("9", "https://a.org/2", "Egypt", ["water"], 3.0), ("2", "https://b.org/1", None, None, None)]


def test_files_that_arrive(spark, tmp_path):
    inbox, folder = tmp_path / "in", str(tmp_path / "q")
    inbox.mkdir()
    (inbox / "a.xml").write_bytes(feed(("One", "https://a.org/1")))
    (inbox / "b.xml").write_bytes(b"nothing")
    first = state.run_available(feeds.stream_feeds(spark, str(inbox)), "append", folder)
    assert sorted((r.outcome, r.pos) for r in first.collect()) == [("Parse Error", None), ("Success", 0)]
    (inbox / "c.xml").write_bytes(feed(("Two", "https://a.org/2"), ("Three", "https://a.org/3")))
    second = state.run_available(feeds.stream_feeds(spark, str(inbox)), "append", folder)
    assert sorted(r.title for r in second.collect()) == ["Three", "Two"]


def test_configuration_of_lists(spark):
    from millrace.plans.values import load_config

    got = load_config({"MILLRACE_TARGETS": "1, 2,3,4", "MILLRACE_WEIGHTS": "0.5,0.3,0.2", "MILLRACE_TOPICS": '{"Energy": [["solar"], ["grid", "fuel"]]}'})
    assert got.targets == (1, 2, 3, 4) and got.weights == (0.5, 0.3, 0.2) and got.topics == {"Energy": (("solar",), ("grid", "fuel"))}
    for name, value, told in (("TARGETS", "1,x", "targets: not numbers"), ("TARGETS", "1,2", "targets: one number"), ("WEIGHTS", "1", "weights: three"), ("TOPICS", "[1]", "topics"), ("TOPICS", '{"a": 1}', "topics")):
        with pytest.raises(ValueError, match=told):
            load_config({f"MILLRACE_{name}": value})
