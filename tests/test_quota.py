"""Quotas carried by a stream: against one sorted pass, over deliveries, restarts and late rows."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.streaming import quota, state

TARGETS = {"a": 6, "b": 2, "z": 0}
START = datetime(2024, 1, 1)


def one_pass(rows, room, cap, used, known):
    """All rows in order, each admitted if it may be."""
    used, out, seen = dict(used), [], set(known)
    for at, number, publisher in sorted(rows):
        if len(out) < room and used.get(publisher, 0) < cap and (publisher, number) not in seen:
            used[publisher] = used.get(publisher, 0) + 1
            seen.add((publisher, number))
            out.append((at, number, publisher))
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 12), st.sampled_from("pqr")), max_size=40), st.integers(0, 6), st.integers(0, 3), st.dictionaries(st.sampled_from("pq"), st.integers(1, 2)), st.sets(st.tuples(st.sampled_from("pq"), st.integers(0, 12)), max_size=3))
def test_earliest(rows, room, cap, used, known):
    assert quota.earliest(iter(rows), room, cap, used, known) == one_pass(rows, room, cap, used, known)


def delivered(spark, folder, name, rows):
    spark.createDataFrame(rows, "id long, ts timestamp, region string, publisher string").coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def run(spark, source, folder):
    stream = spark.readStream.schema("id long, ts timestamp, region string, publisher string").parquet(f"{source}/*")
    found = quota.weekly_quota(stream, "ts", "id", F.col("region"), F.col("publisher"), TARGETS, 2)
    state.run_available(found, "append", folder)


def test_deliveries_restart_and_late_rows(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "q")
    day = lambda d, h=0: START + timedelta(days=d, hours=h)
    first = [(k, day(k % 3, k), "ab"[k % 2], "pqr"[k % 3]) for k in range(8)] + [(90, None, "a", "p"), (None, day(1), "a", "p"), (91, day(1), None, None), (92, day(1), "z", "p")]
    second = [(100 + k, day(0, k), "a", "stuv"[k % 4]) for k in range(9)] + [(0, day(0, 1), "a", "p")]
    delivered(spark, source, "1", first)
    run(spark, source, folder)
    delivered(spark, source, "2", second)  # earlier times than some admitted rows: what is admitted stays
    run(spark, source, folder)
    delivered(spark, source, "3", [(200, day(20), "a", "p")])  # two weeks later: the first one is closed
    run(spark, source, folder)
    delivered(spark, source, "4", [(300, day(2), "b", "late"), (301, day(21), "a", "p"), (302, day(21), "a", "p")])
    run(spark, source, folder)
    got = spark.read.parquet(f"{folder}/out")
    rows = spark.createDataFrame([(*r, 1) for r in first] + [(*r, 2) for r in second] + [(200, day(20), "a", "p", 3), (301, day(21), "a", "p", 4), (302, day(21), "a", "p", 4)], "id long, ts timestamp, region string, publisher string, d int")
    want = quota.admitted(rows, "ts", "id", F.col("region"), F.col("publisher"), TARGETS, 2, F.col("d"))
    assert sorted(map(tuple, got.where("kind = 'admitted'").select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    ended = {(r.monday, r.region): r.place for r in got.where("kind = 'closed'").collect()}
    count = {(r.monday, r.region): r.n for r in want.where("monday = '2024-01-01'").groupBy("monday", "region").agg(F.count("*").alias("n")).collect()}
    assert {k: v for k, v in ended.items() if v} == count and len(ended) == 4
    assert got.where("id = 300").count() == 0
