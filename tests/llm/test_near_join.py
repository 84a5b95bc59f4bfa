import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import near_join
from millrace.llm.components import components

SCHEMA = "doc_id long, text string, id string, bands int, n_chars long"


def brute(rows, threshold=0.8):
    sets = {}
    for k, text, *_ in rows:
        ws = re.findall(r"\w+", (text or "").lower())
        sets[k] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()
    ids = sorted(sets)
    links, root = defaultdict(set), {k: k for k in ids}
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a].add(b), links[b].add(a)
    for k in ids:
        if root[k] == k:
            todo = [k]
            while todo:
                x = todo.pop()
                root[x] = k
                todo += [y for y in links[x] if root[y] == y and y != k and y > k]
    return {k: (root[k], len(links[k])) for k in ids}


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_join.join(df).collect()}
    assert got == brute(rows)
    kept = near_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, (c, _) in got.items() if k == c)


def test_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text, "x", 1, r.n_chars) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(spark, rows)


def test_large_group_is_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_join, "SMALL_BYTES", 8 * 7 * 120)
    monkeypatch.setattr(near_join, "MEMBERS", 1)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(40):
        words = list(base)
        for at in rng.integers(0, 120, size=int(rng.integers(0, 5))):
            words[at] = f"v{rng.integers(1000)}"
        rows.append((k, " ".join(words), None, None, None))
    check(spark, rows + [(100 + k, rows[k][1].upper(), None, None, None) for k in range(0, 40, 3)])


def test_blocks_are_bounded_and_few(spark):
    cases = [(0, 0, 1), (40, 2, 1), (1 << 13, 100, 1), ((1 << 13) + 1, 100, 2), (40_000, 2, 1), (70_000, 1789, 9), (16 << 17, 10_000, 16), (16 << 21, 10**5, 16), ((16 << 21) + 1, 10**5, 17), (20_000_000, 100_000, 16), (200_000_000, 10**6, 96), (9_000_000, 3, 5)]
    rows = spark.createDataFrame([c[:2] for c in cases], "n long, members long")
    got = {(r.n, r.members): r.b for r in rows.withColumn("b", near_join.block_count(F.col("n"), F.col("members"))).collect()}
    assert got == {(n, m): b for n, m, b in cases}
    assert all(n * 8 <= b * near_join.BLOCK_BYTES for (n, _), b in got.items())


def test_compare_against_all_pairs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, size=int(rng.integers(1, 50)))).astype(np.uint64) for _ in range(60)]
    copies = rng.integers(1, 4, size=60)
    alike = lambda a, b: len(np.intersect1d(a, b)) >= 0.5 * len(np.union1d(a, b))
    for cut in (0, 25):
        sides = [slice(0, cut), slice(cut, 60)] if cut else [slice(0, 60)]
        blocks = [near_join._Block(sets[x], copies[x]) for x in sides]
        links, root = near_join.compare(blocks[0], blocks[-1], 0.5)
        pairs = [(i, j) for i in range(60) for j in range(60) if i != j and (not cut or (i < cut) != (j < cut)) and alike(sets[i], sets[j])]
        assert links.tolist() == [sum(copies[j] for i, j in pairs if i == k) for k in range(60)]
        want = list(range(60))
        for _ in range(60):
            for i, j in pairs:
                want[i] = want[j] = min(want[i], want[j])
        assert root.tolist() == want


def test_odd_rows(spark):
    check(spark, [(1, None, None, None, None), (2, "", None, None, None), (3, "***", None, None, None), (4, "one two", None, None, None), (5, "One, two!", None, None, None), (6, "one two three four five six", None, None, None), (7, "word " * 30_000, None, None, 0), (8, "word " * 29_000, None, None, 0)])
    nothing = near_join.join(spark.createDataFrame([], SCHEMA))
    assert nothing.columns == ["doc_id", "class_id", "copy_id", "n_links"] and nothing.count() == 0


def test_ids_of_other_types(spark):
    rows = [("b", "a b c d e f"), ("a", "a b c d e f g"), ("c", "a b c d e f")]
    for kind, make in (("string", str), ("int", lambda x: ord(x))):
        df = spark.createDataFrame([(make(k), t) for k, t in rows], f"doc_id {kind}, text string")
        got = {r.doc_id: (r.class_id, r.copy_id, r.n_links) for r in near_join.join(df, threshold=0.6).collect()}
        assert got == {make("a"): (make("a"), make("a"), 2), make("b"): (make("a"), make("b"), 2), make("c"): (make("a"), make("b"), 2)}


def test_null_id_stays(spark):
    df = spark.createDataFrame([(None, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None)], SCHEMA)
    assert near_join.keep_one(df).count() == 2


def test_bands_reach_the_recall():
    rows, bands = near_join.choose_bands()
    assert rows * bands <= near_join.FUNCTIONS and 1 - (1 - 0.8**rows) ** bands >= near_join.RECALL


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 3), (5, 4), (7, 7), (None, 3)], [(i, i + 1) for i in range(40)]])
def test_components(spark, links):
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    root = {}
    for a, b in sorted((min(x), max(x)) for x in links if None not in x):
        root.setdefault(a, a), root.setdefault(b, root[a])
        if root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    assert got == root


def test_very_long_texts_and_clashing_columns(spark):
    """Two texts of a million characters that differ in one word, under columns named like the operator's own."""
    words = [f"w{k % 9973}x{k % 7}" for k in range(150_000)]
    rows = [(1, " ".join(words), "c", 5, "b"), (2, " ".join([*words[:70_000], "other", *words[70_000:]]), "c", 5, "b"), (3, "z" * 1_000_000, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, comp string, copies int, bands string")
    assert {(r.doc_id, r.class_id, r.copy_id, r.n_links) for r in near_join.join(df).collect()} == {(1, 1, 1, 1), (2, 1, 2, 1), (3, 3, 3, 0)}
