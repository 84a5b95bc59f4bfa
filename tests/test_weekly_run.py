"""Runs in one week: what an earlier one took isn't taken again, outputs appear together, failures are told."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import selection
from millrace.plans import ingestion
from millrace.plans.scalar_queries import articles
from millrace.plans.values import EngineConfig
from millrace.plans.weekly_run import Desk
from millrace.sources import commits

NOW = datetime(2024, 2, 1)


def assess(rows):
    return rows.withColumns({"relevance": (3 + F.length("title") % 3).cast("int"), "significance": (3 + F.length("body") % 3).cast("int"), "story": F.lit("development"), "novelty": F.lit("true")})


SEAMS = ingestion.Seams(assess)
CONFIG = EngineConfig(targets=(6, 6, 6, 6), run_limit=9, publisher_cap=3)


@pytest.fixture(scope="module")
def given(spark, sf):
    rows = articles(spark, sf).cache()
    return rows, ingestion.registry(rows)


def test_runs_of_a_week(spark, given, tmp_path):
    desk = Desk(spark, str(tmp_path / "desk"))
    assert desk.queue().count() == 0 and desk.audit()[1] == []
    one = desk.run(*given, NOW, CONFIG, SEAMS)
    first = desk.queue().collect()
    assert one.winners == len(first) == 9 and one.audit_error == "" and sum(one.outcomes.values()) == given[0].count()
    # the second run decides as select_all does with the week and the seen addresses that the first one left
    pool = ingestion.candidates(given[0].join(given[1], "source", "left").select("doc_id", *(c for c in [*given[0].columns, "source_region", "quality"] if c != "doc_id")), F.lit(NOW), CONFIG, desk.queue().select("url_hash"), SEAMS)
    want = {r.key for r in ingestion.select(pool, CONFIG, selection.week_state(desk.queue())).collect()}
    two = desk.run(*given, NOW, CONFIG, SEAMS)
    second = desk.queue().where("run = 2").collect()
    assert {r.key for r in second} == want and two.winners == len(second) > 0
    assert not {r.url for r in first} & {r.url for r in second} and not {r.title for r in first} & {r.title for r in second}
    both = first + second
    assert max(sum(r.publisher == p for r in both) for p in {r.publisher for r in both}) <= 3 and max(sum(r.region == g for r in both) for g in {r.region for r in both}) <= 24
    detail, lines = desk.audit()
    assert {r.run for r in detail.select("run").distinct().collect()} == {2} and detail.count() == given[0].count() and lines[0] == "## Articles by outcome"
    assert detail.where("outcome = 'selected'").count() == two.winners and desk.seen.rows().count() == one.winners + two.winners
    assert one.lines()[0] == f"run 1: 9 winners of {given[0].count()} articles"
    # nothing but repeats: a full week, and then another week, in which seen addresses stay out
    for _ in range(3):
        last = desk.run(*given, NOW, CONFIG, SEAMS)
    assert desk.queue().count() <= 24 and last.winners == 0
    later = desk.run(*given, datetime(2024, 2, 6), CONFIG, SEAMS)
    rows = desk.queue().collect()
    assert len({r.url for r in rows}) == len(rows) and later.run == 6


def test_an_audit_that_fails_is_told(spark, given, tmp_path):
    desk = Desk(spark, str(tmp_path / "desk"))
    desk.run(*given, NOW, CONFIG, SEAMS)

    def half(detail, detail_path, index_path):
        detail.write.json(detail_path)
        raise OSError("disk is full")

    told = desk.run(*given, NOW, CONFIG, SEAMS, half)
    detail, lines = desk.audit()
    assert told.audit_error == "OSError: disk is full" and told.lines()[-1] == "audit not written: OSError: disk is full"
    assert {r.run for r in detail.select("run").distinct().collect()} == {1} and len(lines) > 4  # the audit before, whole
    assert desk.queue().where("run = 2").count() == told.winners


def test_a_run_that_breaks_off(spark, given, tmp_path, monkeypatch):
    desk = Desk(spark, str(tmp_path / "desk"))
    first = desk.run(*given, NOW, CONFIG, SEAMS)
    with monkeypatch.context() as m:
        m.setattr(commits, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            desk.run(*given, NOW, CONFIG, SEAMS)
    assert desk.queue().count() == first.winners  # staged winners are nobody's
    with monkeypatch.context() as m:
        m.setattr(type(desk.seen), "upsert", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            desk.run(*given, NOW, CONFIG, SEAMS)
    after = desk.queue().count()
    assert after > first.winners and desk.seen.rows().count() == first.winners
    desk.run(*given, NOW, CONFIG, SEAMS)
    urls = [r.url for r in desk.queue().collect()]
    assert len(set(urls)) == len(urls)
