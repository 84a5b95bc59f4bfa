"""Keyed stores and commits: touched buckets alone, versions that stay, failures that leave no trace."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.sources import commits
from millrace.sources.keyed_store import KeyedStore, image_store

SCHEMA = "k string, n long, at timestamp"
AT = [datetime(2024, 1, d) for d in range(1, 10)]


@pytest.fixture
def store(spark, tmp_path):
    return KeyedStore(spark, str(tmp_path / "s"), SCHEMA, "k", "at", 8)


def files(store):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{store.place}/data") for f in fs if f.startswith("part-")}


def rows(spark, *given):
    return spark.createDataFrame([(*r, "more") for r in given], SCHEMA + ", other string")


def held(store, version=None):
    return {r.k: (r.n, r.at) for r in store.rows(version).collect()}


def test_upserts_touch_their_buckets_alone(spark, store):
    assert held(store) == {} and store.upsert(rows(spark)) == 0
    store.upsert(rows(spark, *((f"k{i}", i, AT[0]) for i in range(200)), (None, 1, AT[1])))
    before = files(store)
    _, first = commits.current(spark, store.place)
    assert len(first) == 8 and len(before) == 8
    assert store.upsert(rows(spark, ("k7", 70, AT[1]), ("k7", 71, AT[2]), ("new", 1, None))) == 2
    after = files(store)
    _, second = commits.current(spark, store.place)
    touched = {b for b in second if second[b] != first.get(b)}
    assert before.items() <= after.items() and len(after) - len(before) == len(touched) <= 2
    assert held(store)["k7"] == (71, AT[2]) and held(store)["new"] == (1, None) and len(held(store)) == 201
    assert held(store, 1)["k7"] == (7, AT[0]) and len(held(store, 1)) == 200


def test_order_decides_then_the_later_upsert(spark, store):
    store.upsert(rows(spark, ("a", 1, AT[5]), ("b", 1, AT[5]), ("c", 1, None), ("d", 1, AT[5]), ("d", 2, AT[5])))
    store.upsert(rows(spark, ("a", 2, AT[1]), ("b", 2, AT[5]), ("c", 2, None)))
    assert {k: n for k, (n, _) in held(store).items()} == {"a": 1, "b": 2, "c": 2, "d": 2}
    asked = spark.createDataFrame([("a",), ("nowhere",), (None,), ("a",)], "k string")
    assert [tuple(r)[:2] for r in store.get(asked).collect()] == [("a", 1)]


def test_a_failed_upsert_leaves_the_version_before(spark, store):
    store.upsert(rows(spark, ("a", 1, AT[0])))
    broken = rows(spark, ("a", 2, AT[1]), ("b", 3, AT[1])).withColumn("n", F.when(F.col("k") == "b", F.raise_error(F.lit("broken"))).otherwise(F.col("n")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        store.upsert(broken)
    assert held(store) == {"a": (1, AT[0])} and commits.versions(spark, store.place) == [1]
    store.upsert(rows(spark, ("a", 5, AT[2])))
    assert held(store) == {"a": (5, AT[2])}


def test_two_writers_of_one_version(spark, store):
    store.upsert(rows(spark, ("a", 1, AT[0])))
    with pytest.raises(Exception, match="(?i)exist"):
        commits.publish(spark, store.place, 0, {"0": ["elsewhere"]})
    assert held(store) == {"a": (1, AT[0])}


def test_one_hot_key(spark, store):
    many = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("n"), F.timestamp_seconds("id").alias("at"), F.lit("x").alias("other"))
    store.upsert(many)
    assert held(store)["hot"][0] == 19_999 and len(files(store)) == 1


def test_image_store(spark, tmp_path):
    images = image_store(spark, str(tmp_path / "i"))
    one = lambda url, at: spark.createDataFrame([("h", url, "p", at)], images.schema)
    images.upsert(one("https://a.org/1.png", AT[0]))
    images.upsert(one("https://a.org/2.png", AT[1]))
    assert [r.image_url for r in images.rows().collect()] == ["https://a.org/2.png"]
