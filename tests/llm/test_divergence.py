import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from helpers import no_documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import divergence as D
from millrace.llm import queries

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=3, top=200):
    """Every term of every group, dense."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        found = TERM.findall(text.translate(low))
        counts[lang, source].update(found), docs[lang].update(set(found))
    out = []
    for lang, source in counts:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def weights(groups):
            n = Counter({t: sum(counts[lang, g][t] for g in groups) for t in kept})
            total = sum(n.values())
            return {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        others = [s for x, s in counts if x == lang]
        p, q = weights([source]), weights(others)
        far = lambda a, b: (a - b) ** 2 // b
        pair = []
        for o in others:
            if o != source:
                w = weights([o])
                pair.append((o, sum(far(p[t], w[t]) for t in kept)))
        term = [(t, far(p[t], q[t])) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pair, None), ("term", term, top)):
            for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, term int, n string")
    return sorted(map(tuple, D.divergence(df, **more).collect()))


def made(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(400)] + ["ÄÖ", "É", "日本", "Straße"]
    return [(rng.choice(["en", "de", None, "xx"]), rng.choice(["s1", "s2", "é", None, "S2"]), " ".join(rng.choices(words, k=rng.randrange(40))).replace("wa", rng.choice(["WA", "wa", "w,a"]))) for _ in range(n)]


def test_against_brute_force(spark):
    rows = made(300) + [("en", "s1", None), ("only", "a", "rare words here"), ("only", "b", ""), ("fr", "s9", "un deux"), ("en", "big", "common " * 20_000 + "x" * 100_000)] + [("en", "hot", "Wab wac same passage")] * 200
    want = brute(rows)
    assert found(spark, rows) == want and {r[0] for r in want} == {"en", "de", "", "xx", "only"} | {r[0] for r in want if r[0] == "fr"}
    # a sketch in which nearly all falls together discards less and changes nothing
    assert found(spark, rows, bits=3) == want


def test_no_rows_and_no_terms(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", "a", "1 2"), ("en", "b", "")]) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert D.divergence(no_documents(spark), lang="id", source="score").count() == 0
    assert D.divergence(odd_documents(spark), lang="id", source="n_chars").where("part = 'pair'").count() > 20


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    rows = made(120, 8)
    monkeypatch.setattr(D, "BROADCAST_GROUPS", -1)
    monkeypatch.setattr(D, "HELD", 5)
    monkeypatch.setattr(D, "HELD_COUNTS", 7)
    assert found(spark, rows) == brute(rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([b"a", b"b"]), st.integers(0, 300), st.integers(1, 5)), max_size=200), st.integers(3, 9))
def test_sketch_never_underestimates(rows, bits):
    sketch, exact = np.zeros((D.DEPTH, 1 << bits), np.uint8), defaultdict(Counter)
    for lang, k, n in rows:
        D._add(sketch, lang, Counter({str(k).encode(): n}), bits)
        exact[lang][str(k).encode()] += n
    for lang, terms in exact.items():
        least = np.min([row[at] for row, at in zip(sketch, D.cells(lang, list(terms), bits), strict=True)], axis=0)
        assert all(e >= min(n, D.LEAST_DOCS) for e, n in zip(least, terms.values(), strict=True))


def test_discards_most_rare_terms():
    sketch, bits = np.zeros((D.DEPTH, 1 << 16), np.uint8), 16
    rare = Counter({f"r{k}".encode(): 1 for k in range(20_000)})
    D._add(sketch, b"en", rare, bits)
    bitmap = np.packbits(sketch >= D.LEAST_DOCS, axis=1)
    assert D.survives(bitmap, b"en", list(rare)).mean() < 0.01


def test_weights_beyond_a_long(spark):
    cases = [(0, 1, 1), (8_999_999_999, 9_000_000_000, 5), (9_000_000_000, 9_000_000_007, 3), (10**15, 3 * 10**15, 7), (5, 10**12, 10**6)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    got = {r.c: r.w for r in df.select("c", D.weight(F.col("c"), F.col("n"), F.col("v")).alias("w")).collect()}
    assert got == {c: 1 + 10**9 * (c + 1) // (n + v) for c, n, v in cases}


def test_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    cursor = con.execute(queries.ORACLES["op11_divergence"])
    names = [d[0] for d in cursor.description]
    got = queries.QUERIES["op11_divergence"](spark, "/root/testdata/sf0.001").select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())
