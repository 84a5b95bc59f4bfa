"""Edge cases, and operators without SQL against brute force."""

import datetime as dt
import logging
import random
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import claims, dates, keywords, labels, pages, relevance, scores, text, urls
from millrace.operators import assessment, drafts, events, gates, identity, ranges, ranking, replay, rollups, selection
from millrace.plans import ingestion, pool_queries, scalar_queries
from millrace.plans.lineage import shared_folder
from millrace.plans.logs import configure_logs
from millrace.plans.values import EngineConfig, load_config
from millrace.sources import feeds, listings, registry_table, state
from millrace.sources.schema import SOURCE, SchemaMismatch, assert_schema


def values(spark, rows, make, kind="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


@pytest.mark.parametrize(("raw", "want"), [
    ("HTTP://User:pw@Example.COM.:80/a/b/?b=2&utm_source=x&a=1#f", "http://example.com/a/b?a=1&b=2"), ("example.com", "https://example.com"), ("https://x.org/", "https://x.org/"),
    ("https://x.org:8443/q?REF=1&k=", "https://x.org:8443/q?k="), ("  ", ""), ("https://www.x.org/a%20b?q=a%20b", "https://www.x.org/a%20b?q=a+b"),
])
def test_canonical(spark, raw, want):
    assert values(spark, [raw], urls.canonical_url) == [want]


def test_canonical_is_idempotent(spark):
    raw = ["http://a.b/?z=1&y=&x=%C3%A9", "https://a.b/c//", "a.b:443/x?x=1&x=0", None]
    once = values(spark, raw, urls.canonical_url)
    assert values(spark, once, urls.canonical_url) == once


def test_hosts(spark):
    got = spark.createDataFrame([("m.a.org", "a.org"), ("a.org", "m.a.org"), ("xa.org", "a.org"), ("", "a.org")], "l string, r string").select(urls.hosts_match(F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in got] == [True, True, False, False]
    assert values(spark, ["a.b.c"], urls.host_suffixes) == [["a.b.c", "b.c", "c"]]
    assert values(spark, ["http://a.org", "http://127.0.0.1/x", "ftp://a.org", "http://8.8.8.8", "http://u@a.org", "http://a.org:80"], urls.public_destination) == [True, False, False, True, False, False]


def test_text(spark):
    assert values(spark, ["<p>a &amp;lt; b</p>", None], text.clean_text) == ["a < b", ""]
    assert values(spark, ["x" * 700, "short"], text.snippet) == ["x" * 600 + "...", "short"]
    assert values(spark, ["one two three", "a b - -", "twelve chars and more", None], text.meaningful_title) == [True, False, True, False]
    labels = spark.createDataFrame([([" A", "b", "", "a", "B "],)], "x array<string>").select(text.merge_labels(F.col("x"))).first()[0]
    assert labels == ["A", "b"]
    assert values(spark, [1, 2, 3, 4, 11, 12, 13, 21, 112], text.ordinal, "int") == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "112th"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab c\n", max_size=60), min_size=1, max_size=8))
def test_chunks_keep_words(spark, texts):
    for raw, pieces in zip(texts, values(spark, texts, lambda x: text.chunks(x, 20)), strict=True):
        assert all(len(p) <= 20 for p in pieces)
        assert "".join("".join(pieces).split()) == "".join(raw.split())


def test_dates(spark):
    now = F.lit("2024-02-01").cast("timestamp")
    got = values(spark, ["2024-01-05T10:00:00Z", "1704448800", "1704448800000", "2 hours ago", "today", "yesterday", "Fri, 05 Jan 2024 10:00:00 +0000", "5 Jan 2024", "nonsense", None], lambda x: F.date_format(dates.parse_any(x, now), "yyyy-MM-dd HH"))
    assert got == ["2024-01-05 10"] * 3 + ["2024-01-31 22", "2024-02-01 00", "2024-01-31 00", "2024-01-05 10", "2024-01-05 00", None, None]
    assert values(spark, [dt.date(2024, 1, 7)], dates.week_title, "date") == ["2024-01-01 to 2024-01-05"]


def test_scores(spark):
    df = spark.createDataFrame([(5, 5, 10.0), (0, 0, None), (9, -1, 11.0), (4, 3, 7.25)], "r int, s int, q double")
    assert [x[0] for x in df.select(scores.queue_score(F.col("r"), F.col("s"), F.col("q"))).collect()] == [100.0, 0.0, 80.0, 75.25]
    assert values(spark, ["7", "0", "x", None], scores.clamped) == [5, 1, 3, 3]


def test_keywords(spark):
    topics = {"Water": ("water", "drinking water"), "Sun": ("solar",)}
    assert values(spark, ["waterways", "not a drop", "solar-power", "SOLAR"], lambda x: keywords.matched_topics(F.lower(x), topics, ("water",))) == [[], [], ["Sun"], ["Sun"]]
    told = values(spark, ["A plant in Dubai, say Qatar and Oman", "Iraq and Iraq beat Oman", "Oman or Iraq", "nowhere", None], keywords.reported_location)
    assert [t["place"] for t in told] == ["UAE", "Iraq", None, None, None]


def test_claims(spark):
    got = values(spark, ["On 2024-01-05, 1,200.50 MW and 5 percent; 3 km per day at https://x.org/9"], claims.numeric_claims)[0]
    assert [(c["value"], c["unit"]) for c in got] == [("2024-1-5", "date"), ("1200.5", "mw"), ("5", "%"), ("3", "km/day")]
    said = ["30 megawatt-hours", "Annual capacity of 5 MW, 1,200.50 m³ per day", "5 additional tons or 3 more megawatts daily", "daily water output 030 m3 but yearly growth of 5 percent", "30 cubic metres / day, x7 and 0.0", None]
    got = [[(c["value"], c["unit"]) for c in x] for x in values(spark, said, claims.numeric_claims)]
    assert got == [[("30", "mwh")], [("5", "mw/year"), ("1200.5", "m3/day")], [("5", "ton"), ("3", "mw/day")], [("30", "m3/day"), ("5", "%")], [("30", "m3/day"), ("0", "")], []]


def test_title_words_have_two_letters(spark):
    assert values(spark, ["A 2 x4 b plan for us - The Post", "a b c"], text.title_tokens) == [["plan", "us", "x4"], []]


def test_locations_and_routing(spark):
    cases = [
        ("Saudi firm wins Basra contract", "", "Iraq"), ("Saudi's utility to build solar plant in Cairo", "", "Egypt"), ("Saudi Arabia and Egypt sign", "", None), ("Egypt hosts Iraq and Iraq", "", "Egypt"),
        ("Talks: Iraq and Iraq, then Oman", "", "Iraq"), ("Nothing said", "A plant manufacturing in Doha with Oman", "Qatar"), ("Oman or Iraq", "", None), ("UAE-based developer builds across the Egypt of old", "", "Egypt"),
    ]
    df = spark.createDataFrame(cases, "t string, s string, want string")
    got = df.select("t", "want", keywords.article_location(F.col("t"), F.col("s")).alias("p")).collect()
    assert {r.t: r.p["place"] for r in got} == {t: w for t, _, w in cases}
    routed = [
        ("UN report: global grain prices rise after China export restrictions", "Global food security is affected.", "Global"), ("Egypt approves fertilizer manufacturing facility", "The facility will contribute to global fertilizer supply.", "Egypt"),
        ("Delhi city council repairs urban water pipes", "", None), ("A harvest report of the year", "", "KSA"), ("Oman or Iraq harvest", "", None),
    ]
    df = spark.createDataFrame(routed, "t string, s string, want string").withColumn("w", relevance.article_words(F.col("t"), F.col("s")))
    got = df.select("t", keywords.assigned_region(F.col("t"), F.col("s"), F.array(F.lit("KSA")), F.lit(False), relevance.foreign_local(F.col("t"), F.col("w")), relevance.systemic(F.col("w")))["region"].alias("r")).collect()
    assert {r.t: r.r for r in got} == {t: w for t, _, w in routed}


def test_topics_and_missions(spark):
    cases = [
        ("Waterfront towers and carbonara", [], 0, None), ("New wind farms and batteries for the grids", ["food security", "net zero transition", "energy transition", "agri-food"], 3, None), ("Drought hits the plains", ["resilience"], 1, None),
        ("Not about water but neither energy nor solar", [], 0, None), ("Lithium battery chemistry explained", [], 0, "battery coverage without a transition application"), ("Flights and bitcoin amid drought", ["resilience"], 1, "consumer finance or passenger travel without a direct mission consequence"),
        ("Desalination plant commissioned", ["water security", "desalination"], 3, None),
    ]
    df = spark.createDataFrame([(t,) for t, *_ in cases], "t string").withColumn("w", relevance.article_words(F.col("t"), F.lit(None))).withColumn("d", relevance.direct_signals(F.col("w")))
    got = {r.t: (r.d, r.s["strength"], r.o) for r in df.select("t", "d", relevance.mission_strength(F.col("w"), F.col("d")).alias("s"), relevance.off_mission(F.col("w"), F.col("d")).alias("o")).collect()}
    assert got == {t: (d, s, o) for t, d, s, o in cases}


def test_first_reason_order_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, None)], "a int, b int")
    got = df.select(gates.first_reason([(F.col("a") == 1, "one"), (F.col("b") == 5, "five")])).collect()
    assert [r[0] for r in got] == ["one", "five", None]


def test_objective_gate_keeps_one_of_each_address(spark):
    good = "A title of some words"
    day = dt.datetime(2024, 1, 30, tzinfo=dt.UTC)
    rows = [("1", "https://a.org/x", "bad", day), ("2", "https://a.org/x", good, day), ("3", "https://a.org/x?utm_source=q", good, None), ("4", "https://a.org/x#f", good, day), ("5", None, None, None)]
    df = spark.createDataFrame(rows, "id string, url string, title string, published timestamp")
    got = {r.id: r.reason for r in gates.objective_gate(df, F.lit("2024-02-01").cast("timestamp"), EngineConfig()).collect()}
    assert got == {"1": "invalid title", "2": None, "3": "unknown publication date", "4": "duplicate URL", "5": "invalid URL"}
    seen = spark.createDataFrame([(values(spark, ["https://a.org/x"], urls.url_hash)[0],)], "url_hash string")
    again = gates.objective_gate(df, F.lit("2024-02-01").cast("timestamp"), EngineConfig(), seen)
    assert again.where("reason is null").count() == 0


def test_objective_gate_where_rejected_rows_hold_their_address(spark):
    good, day = "A title of some words", dt.datetime(2024, 1, 30, tzinfo=dt.UTC)
    rows = [(1, "https://a.org/x", "bad", day), (2, "https://a.org/x", good, day), (3, "https://b.org/x", good, day - dt.timedelta(1)), (4, "https://b.org/x", good, day), (5, "https://b.org/x", good, None), (6, None, good, day), (7, None, good, day)]
    df = spark.createDataFrame(rows, "id int, url string, title string, published timestamp")
    got = {r.id: r.reason for r in gates.objective_gate(df, F.lit("2024-02-01").cast("timestamp"), EngineConfig(), shadowed=True).collect()}
    assert got == {1: "invalid title", 2: "duplicate URL", 3: "duplicate URL", 4: None, 5: "unknown publication date", 6: "invalid URL", 7: "invalid URL"}


def test_numeric_claims_name_each_step_once(spark):
    # each use of a value that isn't bound repeats its regular expressions
    assert str(claims.numeric_claims(F.col("t"))).count("regexp") < 40


def test_feeds_hand_on_their_entries_in_small_frames():
    files = feeds.pd.DataFrame({"path": ["a", "b", "c"], "content": [b"<rss>" + b"<item><title>t</title></item>" * 2500 + b"</rss>", b"<rss/>", b"none"]})
    frames = list(feeds._parsed(iter([files])))
    assert max(map(len, frames)) <= 1000 and sum(map(len, frames)) == 2502
    told = feeds.pd.concat(frames)
    assert [*told.where(told.path == "a").pos.dropna()] == [*range(2500)] and [*told.outcome[-2:]] == ["Empty", "Parse Error"]


def test_quality_label_rounds_as_stored(spark):
    # half a hundredth in decimals, less than that in binary once it is scaled
    assert values(spark, [0.145, 0.285, 1.015, 0.125, 9.999, 10.0, 0.0, None], scores.quality_label, "double") == ["0.14/10", "0.28/10", "1.01/10", "0.13/10", "10/10", "10/10", "0/10", "unscored"]


@pytest.mark.parametrize("seed", range(3))
def test_leaders_are_greedy(spark, seed):
    rng = random.Random(seed)
    rows = [(k, sorted({rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))}), rng.random()) for k in range(60)]
    kept, want = [], {}
    for k, t, _ in sorted(rows, key=lambda r: r[2]):
        want[k] = next((j for j, u in kept if t and u and len({*t} & {*u}) >= 0.6 * len({*t} | {*u})), None)
        if want[k] is None:
            kept.append((k, t))
    df = spark.createDataFrame(rows, "key int, tokens array<string>, rank double")
    got = {r.key: r.leader for r in events.dedupe_events(df, "key", "tokens", "rank", 0.6).collect()}
    assert got == want


def test_pairs_that_share_a_rare_word_alone_end_within_the_join(spark):
    rng = random.Random(5)
    sets = [sorted({"rare", *(f"w{rng.randrange(4000)}" for _ in range(rng.randint(5, 60)))}) for _ in range(120)]
    sets += [sorted({*t, f"x{k}"}) for k, t in enumerate(sets[:20])] + [["one"], ["one", "two"], ["one", "two", "three", "four"], ["one", "two", "three", "five"]]
    classes = spark.createDataFrame(list(enumerate(sets)), "rep int, tokens array<string>")
    near = lambda t, u: len({*t} & {*u}) >= 0.72 * len({*t} | {*u}) - 1e-9
    want = {(i, j) for i, t in enumerate(sets) for j, u in enumerate(sets) if i < j and near(t, u)}
    assert len(want) >= 20
    assert {(r.x, r.y) for r in events.class_pairs(classes).collect()} == want
    signs = [r[0] for r in classes.orderBy("rep").select(events._signature("tokens")).collect()]
    bits = lambda a, b: sum(((x ^ y) % 2**64).bit_count() for x, y in zip(a, b, strict=True))
    differ = [(bits(signs[i], signs[j]), len({*sets[i]} ^ {*sets[j]}), len(sets[i]) + len(sets[j])) for i in range(60) for j in range(60)]
    assert all(b <= d for b, d, _ in differ)
    assert sum(b > n * 0.28 / 1.72 for b, d, n in differ if d) > 0.98 * sum(1 for _, d, _ in differ if d)


@pytest.mark.parametrize("seed", range(3))
def test_distinct_assignment_serves_rows_in_order(spark, seed):
    rng = random.Random(seed)
    offers = [(r, p, rng.choice("abcdefghijkl")) for r in range(15) for p in range(rng.randint(0, 4))]
    used, want = set(), {}
    for r, p, i in sorted(offers):
        if r not in want and i not in used:
            want[r] = i
            used.add(i)
    got = identity.assign_distinct(spark.createDataFrame([*offers, (99, 0, None)], "rank int, pos int, image string"), "rank", "pos", "image").collect()
    assert {r["rank"]: r.image for r in got} == want


def test_distinct_assignment_stores_little_over_many_rounds(spark):
    folder = Path(urlparse(shared_folder(spark)).path)
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    offers = spark.range(24 * 300).select(F.floor(F.col("id") / 300).alias("rank"), (F.col("id") % 300).alias("pos"), F.concat(F.lit("https://images.example.org/of/the/day/"), F.col("id") % 300).alias("image"))
    before = size()
    got = identity.assign_distinct(offers, "rank", "pos", "image").collect()
    assert {r["rank"]: r.pos for r in got} == {k: k for k in range(24)}
    # each of the 24 rounds used to store all offers again
    assert size() - before < 2_000_000


def brute_select(rows, targets, limit, cap):
    """The same rules over the whole pool, without any compression."""
    regions, publishers, out = Counter(), Counter(), []
    for tier in ("strict", "fallback"):
        left = [r for r in rows if r["tier"] == tier]
        while len(out) < limit:
            options = []
            for at, (region, target) in enumerate(targets.items()):
                open_ = [r for r in left if r["region"] == region and publishers[r["publisher"]] < cap]
                if target > regions[region] and open_:
                    options.append((len(open_) / (target - regions[region]), at, open_[0]))
            if not options:
                break
            best = min(options, key=lambda o: o[:2])[2]
            left.remove(best), out.append(best["key"])
            regions[best["region"]] += 1
            publishers[best["publisher"]] += 1
        for r in list(left):
            if len(out) < limit and publishers[r["publisher"]] < cap:
                out.append(r["key"])
                publishers[r["publisher"]] += 1
                regions[r["region"]] += 1
    return out


@pytest.mark.parametrize(("limit", "cap"), [(12, 2), (5, 1), (30, 3)])
def test_selection_equals_brute_force(spark, sf, limit, cap):
    pool = pool_queries.candidates(spark, sf)
    rows = sorted((r.asDict() for r in pool.collect()), key=lambda r: (-r["score"], -r["relevance"], -r["significance"], -(r["quality"] or 0), -r["published"].timestamp(), r["url"]))
    targets = {"AFRICA": 3, "AMERICA": 4, "ASIA": limit // 2, "EUROPE": limit}
    got = [r.key for r in selection.select_final(pool, targets, limit, cap).orderBy("pick").collect()]
    assert got == brute_select(rows, targets, min(limit, sum(targets.values())), cap)


def test_allocation_serves_need_then_rank():
    rows = [{"key": k, "region": r, "publisher": p, "rank": k} for k, (r, p) in enumerate([("A", 1), ("A", 1), ("A", 2), ("B", 3), ("B", 3)])]
    assert [r["key"] for r in selection.allocate(rows, {"A": 1, "B": 1}, 4)] == [0, 3, 2, 4, 1]


def test_consume_counts_failures_not_duplicates():
    rows = [{"k": 1, "duplicate": True}, {"k": 2, "verdict": None, "required": 4}, {"k": 3, "verdict": 5, "required": 4}, {"k": 4, "verdict": 3, "required": 4}, {"k": 5, "verdict": 5, "required": 4}]
    got = [r["outcome"] for r in assessment.consume(rows, missing=1, initial=2, most=3)]
    assert got == ["duplicate URL", "enrichment failed", "qualified", "shortlist deferred", "shortlist deferred"]


def test_classify_isolates_the_bad_item():
    def model(group):
        if any(i["id"] == "x" for i in group):
            return []
        return [{"id": i["id"], "decision": "Relevant"} for i in group]

    got = assessment.classify([{"id": c} for c in "qxab"], model, 1000)
    assert [g["id"] for g in got] == list("qxab") and [g["decision"] for g in got] == ["Relevant", None, "Relevant", "Relevant"]

    def refused(group):
        raise PermissionError("no")

    assert {g["error"] for g in assessment.classify([{"id": "a"}, {"id": "b"}], refused, 1000)} == {"no"}


def test_metrics_without_cases_are_null(spark):
    df = spark.createDataFrame([(None, True), (False, None)], "p boolean, a boolean")
    row = rollups.binary_metrics(df, F.col("p"), F.col("a")).first()
    assert (row.tp, row.unresolved, row.precision, row.recall) == (0, 2, None, None)


def test_feeds():
    atom = b'<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>t</title><link href="https://a.org/1"/><updated>2024-01-05T00:00:00Z</updated></entry><entry><title>u'
    entries, error = feeds.parse_feed(atom)
    assert len(entries) == 1 and entries[0]["link"] == "https://a.org/1" and error == ""
    assert feeds.parse_feed(b"nothing")[1] and feeds.parse_feed(b"<rss></rss>") == ([], "")


def test_anchors_in_unclosed_markup():
    got = listings.parse_anchors('<nav><a href="/n">N</a></nav><p>one<br><a href="/x"><b>A story</a><p>two')
    assert [(a["href"], a["title"], a["navigation"]) for a in got] == [("/n", "N", True), ("/x", "A story", False)]
    assert listings.parse_anchors(None) == [] and listings.parse_anchors("<a href='/y'>" + "x" * 2_000_001) == []


def test_registry_and_schema(spark):
    row = ("1", "B", "Publisher", None, "https://f", "RSS", "Daily", None, None, 5.0, True, None, None)
    df = spark.createDataFrame([row, ("2", "a", *row[2:])], SOURCE)
    assert [r.id for r in registry_table.active_sources(df).collect()] == ["2", "1"]
    with pytest.raises(ValueError, match="1: quality"):
        registry_table.active_sources(df.withColumn("quality", F.lit(11.0)))
    with pytest.raises(SchemaMismatch, match="name: missing.*quality: string"):
        assert_schema(df.drop("name").withColumn("quality", F.lit("x")), SOURCE)


def test_seen_store(spark, tmp_path):
    path = str(tmp_path / "seen")
    assert state.read_seen(spark, path).count() == 0
    rows = spark.createDataFrame([("h", "t", "u", "s", "p", dt.datetime(2024, 1, 1))], state.SEEN)
    state.record_seen(rows, path)
    state.record_seen(rows.withColumn("title", F.lit("new")).withColumn("created_at", F.lit(dt.datetime(2024, 1, 2))), path)
    assert [r.title for r in state.read_seen(spark, path).collect()] == ["new"]


def test_config():
    assert load_config({}).run_limit == 12 and load_config({"MILLRACE_RUN_LIMIT": "3"}).run_limit == 3
    with pytest.raises(ValueError, match="run_limit"):
        load_config({"MILLRACE_RUN_LIMIT": "three"})
    with pytest.raises(ValueError, match="publisher_cap.*relevance"):
        EngineConfig(publisher_cap=0, minimum_relevance=9).validate()


def test_supplement_merges_clear_matches_alone(spark):
    day, later = dt.datetime(2024, 1, 1, tzinfo=dt.UTC), dt.datetime(2024, 1, 2, 1, tzinfo=dt.UTC)
    kinds = "id string, publisher string, source string, title string, canonical string, published timestamp, snippet string"
    same = "The very same opening of thirty letters and "
    feed = [
        ("f1", "p", "Post", same + "then one end - Post", "https://news.google.com/1", day, "own"),
        ("f2", "p", "Post", same + "then another end", "https://p.org/2", None, ""),
        ("f3", "p", "Post", "Three words only", "https://p.org/3", day, ""),
        ("f4", "p", "Post", "A story told much later", "https://p.org/4", day, ""),
        ("f5", "p", "Post", "One of two equal stories", "https://p.org/5", day, ""),
        ("f6", "p", "Post", "One of two equal stories", "https://p.org/6", day, ""),
        ("f7", "p", "Post", "A story without an address", "", day, ""),
        ("f8", "q", "Quote", "A story of another publisher", "https://q.org/8", day, ""),
    ]
    direct = [
        ("d1", "p", "Post", same + "THEN one \uff45nd", "https://p.org/1", day, "told"),
        ("d2", "p", "Post", "Unlike", "https://p.org/2", later, ""),
        ("d3", "p", "Post", "Three words only", "https://p.org/d3", day, ""),
        ("d4", "p", "Post", "A story told much later", "https://p.org/d4", later, ""),
        ("d5", "p", "Post", "One of two equal stories", "https://p.org/d5", day, ""),
        ("d7", "p", "Post", "A story without an address", "https://p.org/d7", day, ""),
        ("d8", "p", "Post", "A story of another publisher", "https://p.org/d8", day, ""),
    ]
    f, d = spark.createDataFrame(feed, kinds), spark.createDataFrame(direct, kinds)
    assert {tuple(r) for r in identity.clear_matches(f, d).collect()} == {("f1", "d1"), ("f2", "d2"), ("f5", "d5"), ("f6", "d5")}
    got = {r.id: r for r in identity.merge_supplement(f, d, F.contains("canonical", F.lit("news.google.com"))).collect()}
    assert set(got) == {r[0] for r in feed} | {"d3", "d4", "d5", "d7", "d8"} and {k for k, r in got.items() if r.merged} == {"f1", "f2"}
    assert (got["f1"].canonical, got["f1"].snippet, got["f2"].canonical) == ("https://p.org/1", "told", "https://p.org/2")
    assert got["f2"].published is not None and got["f4"].canonical == "https://p.org/4"


def test_articles_have_whole_titles(spark, tmp_path):
    line = "word " * 40 + "end"
    spark.createDataFrame([(1, line + "\nbody", "s", "en")], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert scalar_queries.articles(spark, str(tmp_path)).first().title == line


def test_second_run_of_a_week_counts_the_first(spark):
    title = lambda k: " ".join(f"word{k}x{j}" for j in range(6))
    day = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rows = [(k, "strict", "UAE" if k % 2 else "KSA", f"p{k // 3}", 100.0 - k, 4, 3, 5.0, day, f"https://p{k // 3}.org/{k}", title(k)) for k in range(12)]
    rows += [(20, "strict", "UAE", "p9", 200.0, 5, 5, 5.0, day, "https://p9.org/20", title(0)), (21, "strict", "KSA", "p9", 150.0, 5, 5, 5.0, day, "https://p0.org/0", title(21))]
    kinds = "key long, tier string, region string, publisher string, score double, relevance int, significance int, quality double, published timestamp, url string, title string"
    pool = spark.createDataFrame(rows, kinds)
    week = selection.week_state(spark.createDataFrame([("KSA", "p0", "https://p0.org/0", title(0)), ("UAE", "p0", "https://p0.org/1", title(1))], "region string, publisher string, url string, title string"))
    targets = {"UAE": 2, "KSA": 3}
    for _ in range(2):  # the state is only read
        won = [(r.key, r.region) for r in selection.select_final(pool, targets, 5, 2, week).orderBy("pick").collect()]
        # p0 is at its cap, 20 tells an event and 21 has an address of the week; 3 of the 5 places are left
        assert sorted(won) == [(3, "UAE"), (4, "KSA"), (6, "KSA")]
    config = EngineConfig(targets=(0, 2, 3, 0), run_limit=5)
    again = ingestion.select(pool.withColumnRenamed("key", "doc_id"), config, week)
    assert sorted(r.key for r in again.collect()) == [3, 4, 6]
    full = selection.State(Counter(UAE=2, KSA=3))
    assert selection.select_final(pool, targets, 5, 2, full).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_events_of_a_run_follow_the_composite_rule(spark, seed):
    rng = random.Random(seed)
    day = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    long = "one two three four five six seven eight nine ten eleven twelve thirteen"
    titles = ["Solar park of {n} GW opens in the north of {p} this summer", "Ministry approves water reuse plan for coastal cities of {p}", "Ministry approved a reuse plan in coastal cities of {p}", "{p} cabinet approves plan", "{p} council adopted a law and approved the plan", "", "the of"]
    rows = []
    for k in range(70):
        said = rng.choice(titles).format(n=rng.choice([2, 2, 3]), p=rng.choice(["Egypt", "Egypt", "Iraq", "land"]))
        rows.append((k, "strict", "UAE", f"p{k}", rng.random(), 4, 3, 5.0, rng.choice([None, *(day + dt.timedelta(days=d) for d in (0, 2, 5))]), rng.choice(["https://a.org/1", "https://a.org/2", *(f"https://a.org/{k}",) * 6]), said, rng.choice([long, long + " more", ""])))
    kinds = "key long, tier string, region string, publisher string, score double, relevance int, significance int, quality double, published timestamp, url string, title string, snippet string"
    table = ingestion.event_features(spark.createDataFrame(rows, kinds)).withColumn("rank", -F.col("score")).cache()
    at = table.select("key", F.struct(*ingestion.EVENT_FEATURES).alias("f"))
    pairs = at.toDF("a", "l").crossJoin(at.toDF("b", "r")).where("a <> b").where(events.same_event("l", "r", policy=True)).select("a", "b").collect()
    same, kept, want = {(r.a, r.b) for r in pairs}, [], {}
    for r in sorted(rows, key=lambda r: -r[4]):
        want[r[0]] = next((k for k in kept if (k, r[0]) in same), None)
        if want[r[0]] is None:
            kept.append(r[0])
    got = {r.key: r.leader for r in events.dedupe_same_events(table.select("key", "rank", *ingestion.EVENT_FEATURES), "key", "rank").collect()}
    assert got == want


def test_run_keeps_unlike_measures_and_drops_one_policy(spark):
    day = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    long = "one two three four five six seven eight nine ten eleven twelve thirteen"
    said = [("A 2 GW solar park opens in the north of the land", ""), ("A 3 GW solar park opens in the north of the land", ""), ("Egypt cabinet approves plan on water", long), ("Approval of new water law and plan by council of Egypt", long)]
    rows = [(k, "strict", "UAE", f"p{k}", 10.0 - k, 4, 3, 5.0, day, f"https://p{k}.org/", t, s) for k, (t, s) in enumerate(said)]
    kinds = "doc_id long, tier string, region string, publisher string, score double, relevance int, significance int, quality double, published timestamp, url string, title string, snippet string"
    won = ingestion.select(spark.createDataFrame(rows, kinds), EngineConfig(targets=(0, 4, 0, 0)))
    assert sorted(r.key for r in won.collect()) == [0, 1, 2]


def test_winners_and_audit_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a|b", 2.5), (2, "c\nd", None)], "key long, title string, score double")
    state.write_winners(rows, str(tmp_path / "w"), spark.createDataFrame([], "key long, title string"))
    state.write_winners(rows, str(tmp_path / "w"), spark.createDataFrame([], "key long, title string"))
    got = spark.read.parquet(str(tmp_path / "w"))
    assert got.columns == ["key", "title"] and got.count() == 4
    for _ in range(2):  # a repeated write replaces
        state.write_audit(rows, rows.groupBy().agg(F.count("*").alias("n")), str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit/detail")).count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "audit/summary")).first().n == "2"
    report = replay.markdown_report(rows, ["key", "title", "score"], "Audit")
    assert report == "## Audit\n\n| key | title | score |\n| --- | --- | --- |\n| 1 | a\\|b | 2.5 |\n| 2 | c d |  |\n"


def test_whole_batches_and_overlays(spark):
    replies = spark.createDataFrame([(1, "a", True), (1, "b", True), (2, "c", True), (2, "c", True), (3, "d", None), (4, "e", True)], "batch int, id string, good boolean")
    asked = spark.createDataFrame([(1, 2), (2, 2), (3, 1), (4, 2), (5, 1)], "batch int, asked int")
    assert {r.batch: r.accepted for r in assessment.whole_batches(replies, "batch", "id", F.col("good"), asked).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}
    df = spark.createDataFrame([("extracted", "new", "old"), ("Feed Content", "", "old"), ("blocked", "new", "old"), (None, "new", None)], "status string, new string, old string")
    assert [r[0] for r in df.select(pages.overlay(F.col("status"), F.col("new"), F.col("old"))).collect()] == ["new", "old", "old", None]
    assert values(spark, ["12", " 7 ", "-1", "x", None], labels.content_length, "string") == [12, 7, None, None, None]
    assert values(spark, ["![a b](https://x.org/i.png)", "text ![a](b)", "![](u)"], text.markdown_image) == [("a b", "https://x.org/i.png"), None, ("", "u")]
    assert spark.createDataFrame([(["a", " ", "b", "a", "A"],)], "x array<string>").select(text.distinct_labels(F.col("x"))).first()[0] == ["a", "b", "A"]


def test_eligibility(spark):
    df = spark.createDataFrame([("", True, None), (None, True, None), ("why", True, None), (None, False, None), (None, True, "scope")], "reason string, enriched boolean, scope string")
    assert [r[0] for r in df.select(gates.eligible(F.col("reason"), F.col("enriched"), F.col("scope"))).collect()] == [True, True, False, False, False]
    stories = ["development", "conflict_security", "explainer_background", "commentary_opinion", "gossip"]
    rows = spark.createDataFrame([(s, n) for s in stories for n in ("true", "false", "unclear", "maybe")], "s string, n string")
    assert all((r[2] or "") == gates.scope_of(r.s, r.n) for r in rows.select("s", "n", gates.scope_reason(F.col("s"), F.col("n"))).collect())
    scored = spark.createDataFrame([(r, s, q) for r in (0, 3, 5, 9) for s in (1, 5) for q in (None, -2.0, 3.33335, 7.25, 11.0)], "r int, s int, q double")
    assert all(x[3] == scores.score_of(x.r, x.s, x.q) for x in scored.select("r", "s", "q", scores.queue_score(F.col("r"), F.col("s"), F.col("q"))).collect())


def test_metadata_order_and_story_text(spark):
    rows = [(1, 2, None, True, None, "s", "b"), (2, 3, 1.0, False, None, "s", "a"), (3, 2, 5.0, False, dt.datetime(2024, 1, 1), "s" * 600, "c"), (4, 2, 5.0, False, dt.datetime(2024, 1, 1), "s" * 900, "a"), (5, 2, 5.0, True, None, "", "z")]
    df = spark.createDataFrame(rows, "key int, specificity int, quality double, concrete boolean, published timestamp, snippet string, url string")
    assert [r.key for r in df.orderBy(*ranking.metadata_order()).collect()] == [2, 5, 4, 3, 1]
    docs = spark.createDataFrame([("d", "intro\n## One\nA claim\n\n![i](u)\nSources: https://x.org\n## Two\nTags: a, b")], "k string, text string")
    lines = drafts.lines(docs, "k", "text")
    told = drafts.story_text(drafts.sections(lines, "k", F.col("line").startswith("## ")), "k", F.col("line").startswith("## "))
    assert {(r.section, r.story) for r in told.collect()} == {(0, "intro"), (1, "A claim")}


@pytest.mark.parametrize("parts", [1, 5])
def test_ranges_equal_plain_windows(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["a", "b", None, "big", "big", "big"]), k, rng.choice([None, rng.random() * 10, 3.0])) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.k: round(r.s, 9) for r in ranges.running(df, ["g"], ["k"], {"s": F.col("v")}).collect()}
        medians = {r.g: r.m for r in ranges.exact_median(df, ["g"], "v", "m").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    for g in {r[0] for r in rows}:
        total, seen = 0.0, sorted(v for x, _, v in rows if x == g and v is not None)
        for _, k, v in (r for r in rows if r[0] == g):
            total += v or 0.0
            assert abs(got[k] - total) < 1e-6
        assert abs(medians[g] - (seen[(len(seen) - 1) // 2] + seen[len(seen) // 2]) / 2) < 1e-9


def test_image_cache(spark, tmp_path):
    path, day = str(tmp_path / "images"), dt.datetime(2024, 1, 1)
    assert state.read_images(spark, path).count() == 0
    hashes = values(spark, ["https://a.org/1", "https://a.org/2"], urls.url_hash)
    rows = [(hashes[0], "https://i.org/old.png", "p", day), (hashes[0], "https://i.org/new.png", "q", day + dt.timedelta(days=1)), (hashes[1], "no address", "p", day)]
    state.record_images(spark.createDataFrame(rows, state.IMAGES), path)
    state.record_images(spark.createDataFrame(rows[:1], state.IMAGES), path)
    df = spark.createDataFrame([("https://a.org/1", "own"), ("https://a.org/2", "own"), ("https://a.org/1", None)], "canonical string, image_url string")
    got = sorted((r.canonical, r.image_url, r.image_provider) for r in state.with_images(df, state.read_images(spark, path)).collect())
    assert got == [("https://a.org/1", "https://i.org/new.png", "q")] * 2 + [("https://a.org/2", "", "")]


def test_logs(spark):
    configure_logs("warning")
    assert logging.getLogger().level == logging.WARNING
    with pytest.raises(ValueError, match="loud"):
        configure_logs("loud")
