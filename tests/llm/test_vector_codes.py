import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries
from millrace.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, key string"


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain integers, one by one."""
    whole = lambda x: math.floor(x * 256) if abs(x) < 2**100 else int(x) * 256
    kept = [(i, [whole(x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = next((len(v) for i, v, _ in sorted(((r for r in kept if r[0] is not None)), key=lambda r: (r[0], len(r[1]))) if v and len(v) % parts == 0), 0)
    fit = [r for r in kept if size and len(r[1]) == size]
    first = {}
    for i, v, _ in sorted((r for r in fit if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(i, v)
    w = size // parts
    books = [[v[k * w : k * w + w] for v in list(first.values())[:entries]] for k in range(parts)] if size else []
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda p, book: min(range(len(book)), key=lambda e: (gap(p, book[e]), e))
    for _ in range(rounds):
        for k, book in enumerate(books):
            took = {}
            for _, v, _ in fit:
                took.setdefault(best(v[k * w : k * w + w], book), []).append(v[k * w : k * w + w])
            books[k] = [[sum(c) // len(took[e]) for c in zip(*took[e], strict=True)] if e in took else old for e, old in enumerate(book)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for i, v, lab in kept:
        if size and len(v) == size:
            won = [best(v[k * w : k * w + w], b) for k, b in enumerate(books)]
            err = sum(gap(v[k * w : k * w + w], b[won[k]]) for k, b in enumerate(books))
            out.append((i, "".join(f"{e:02x}" for e in won), err if err < 2**63 else None, lab))
        else:
            out.append((i, None, None, lab))
    total = {}
    for _, _, e, lab in out:
        if e is not None:
            total[lab] = total.get(lab, 0) + e
    return sorted(((i, c, e, total.get(lab), digest) for i, c, e, lab in out), key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1, "k") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in V.compress(df).collect()), key=repr)


def made(n, size=32, seed=5):
    rng = np.random.default_rng(seed)
    return [(int(i), np.float32(rng.normal(0, 0.1, size)).tolist(), int(i % 3) if i % 7 else None) for i in rng.permutation(n)]


def test_against_brute_force(spark):
    rows = made(150) + [(3, made(150)[0][1], 1)] * 3 + [(None, [0.25] * 32, 2), (1000, None, 1), (1001, [None] * 32, 1), (1002, [float("nan")] * 32, 1), (1003, [float("inf")] + [0.0] * 31, 1), (1004, [0.5] * 16, 5), (1005, [], 6), (1006, [-1e-9] * 32, 1)]
    assert found(spark, rows) == brute(rows)


def test_few_equal_and_huge(spark):
    same = [(k, [0.5] * 16, 1) for k in range(100)]
    assert found(spark, same) == brute(same)
    few = [(k, [float(k)] * 48, None) for k in range(5)]
    assert found(spark, few) == brute(few)
    huge = [(k, [float(np.float32(x)) for x in (1e30 * k, -3e38, 2.0**40, *[0.1] * 13)], k % 2) for k in range(70)]
    assert found(spark, huge) == brute(huge)
    assert found(spark, []) == [] and [r[1] for r in found(spark, [(1, [1.0] * 17, 1)])] == [None]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 8), st.integers(1, 20), st.sampled_from([3, 300, 70_000, 1 << 27]), st.integers(0, 1 << 30))
def test_screening_is_exact(width, n, scale, seed):
    rng = np.random.default_rng(seed)
    book = rng.integers(-scale, scale, (n, width))
    x = np.concatenate([rng.integers(-scale, scale, (50, width)), (book + book[::-1]) // 2])
    won, gap = V.nearest(x, book)
    full = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (won == full.argmin(axis=1)).all() and (gap == full.min(axis=1)).all()
    low, high = V.intervals(x, book)
    true = ((book * book).sum(axis=1)[None] - 2 * (x @ book.T)).astype(object)
    for a, t, b in zip(low.ravel(), true.ravel(), high.ravel(), strict=True):
        assert a <= int(t) <= b


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '/root/testdata/{folder}/embeddings.parquet'")
    cursor = con.execute(queries.ORACLES["op13_vector_codes"])
    names = [d[0] for d in cursor.description]
    got = queries.QUERIES["op13_vector_codes"](spark, f"/root/testdata/{folder}").select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())
