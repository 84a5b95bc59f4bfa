import random
import re

import numpy as np
from helpers import SCHEMA, no_documents, odd_documents

from millrace.llm import decontaminate as D
from millrace.llm.queries import QUERIES

ITEMS = "item_id long, text string, doc_id string, containment int"


def shingles(text):
    ws = re.findall(r"\w+", (text or "").lower())
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute(docs, items, threshold=0.8):
    out = set()
    for k, t in docs:
        own = shingles(t)
        for i, q in items:
            s = shingles(q)
            if s and own and len(s & own) >= threshold * len(s):
                out.add((k, i, round(len(s & own) / len(s), 9), len(s)))
    return out


def found(df):
    return {(r.doc_id, r.item_id, round(r.containment, 9), r.item_shingles) for r in df.collect()}


def test_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 4, 5, 6, 9, 12, 13, 20, 36, 37, 68, 150, 400])]
    items += [(50, items[8][1]), (51, None), (52, "")]
    docs = []
    for k in range(150):
        ws = [word() for _ in range(rng.choice([0, 3, 40, 300, 4000]))]
        q = rng.choice(items)[1] or ""
        passage = q.split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            if passage:
                passage[rng.randrange(len(passage))] = "changed"
        at = rng.randint(0, len(ws))
        docs.append((k, " ".join([*ws[:at], *passage, *ws[at:]])))
    df = spark.createDataFrame([(k, t, None, None, None, None, None) for k, t in docs], SCHEMA)
    got = found(D.search(df, spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)))
    assert got == brute(docs, items)


def test_full_filter(spark, monkeypatch):
    """A filter that is too small lets more pass, and changes no result."""
    monkeypatch.setattr(D, "FILTER_BITS", D.PIECE_BITS)
    monkeypatch.setattr(D, "BITS_EACH", 1)
    items = [(i, f"one two three four five six seven {i}") for i in range(2_000)]
    df = odd_documents(spark, [t for _, t in items[:40]])
    got = {(k, i, c) for k, i, c, _ in found(D.search(df, spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS))) if c == 1}
    assert got == {(k, i, 1.0) for i, t in items[:40] for k in [r.doc_id for r in df.where(f"text = '{t}'").collect()]}


def test_filter_holds_what_was_added():
    rng = np.random.default_rng(4)
    keys, others = (rng.integers(0, 2**63, size=n).astype(np.uint64) * np.uint64(2) for n in (5_000, 100_000))
    made = D.Filter(1 << 20)
    made.add(keys)
    assert len(made.passing(keys)) == len(keys) and len(made.passing(others)) < 100


def test_items_of_several_partitions(spark):
    items = [(i, f"one two three four five six seven {i}") for i in range(8)]
    df = odd_documents(spark, [t for _, t in items])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(D.search(df, spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS))) == brute(rows, items)


def test_whole_tables(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert found(QUERIES["op8_decontaminate"](spark, sf)) == brute(docs, items)


def test_ids_of_other_types(spark):
    items = spark.createDataFrame([("i", "one two three four five six")], "item_id string, text string")
    docs = spark.createDataFrame([("d", "zero one two three four five six seven")], "doc_id string, text string")
    assert found(D.search(docs, items)) == {("d", "i", 1.0, 2)}


def test_empty_and_dropping(spark):
    items = spark.createDataFrame([(1, "word word word word word", "x", 1)], ITEMS)
    assert D.search(no_documents(spark), items).count() == 0 and D.search(odd_documents(spark), items.limit(0)).count() == 0
    kept = D.drop_contaminated(odd_documents(spark), items)
    assert kept.columns == odd_documents(spark).columns and kept.where("doc_id = 11").count() == 0 and kept.count() == odd_documents(spark).count() - 1
    assert D.drop_contaminated(odd_documents(spark), items.limit(0)).count() == odd_documents(spark).count()


def test_short_items_inside_long_documents(spark):
    items = [(1, "alpha"), (2, "Beta gamma"), (3, "one two three four"), (4, "gamma beta"), (5, "alpha"), (6, "one two three four five six"), (7, ""), (8, None)]
    docs = [(1, "zero one two three four five six seven alpha"), (2, "a beta, gamma! and more words than five of them"), (3, "alpha"), (4, "one two three"), (5, None), (6, "one two three x four beta x gamma alphabet")]
    df, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1, 1.0, 1), (1, 5, 1.0, 1), (1, 3, 1.0, 1), (1, 6, 1.0, 2), (2, 2, 1.0, 1), (3, 1, 1.0, 1), (3, 5, 1.0, 1)}
    rows = D.search(df, asked, short_items=True).collect()
    assert len(rows) == len(want) and {(r.doc_id, r.item_id, r.containment, r.item_shingles) for r in rows} == want
    assert {r.doc_id for r in D.drop_contaminated(df, asked).collect()} == {4, 5, 6}
