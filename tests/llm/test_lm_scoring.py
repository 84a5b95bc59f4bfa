import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import no_documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import lm_scoring as L

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOW)), None]


def brute(rows, order, weights):
    """The interpolated probabilities by recursion over counted n-grams, and the base score."""
    grams, words = Counter(), Counter()
    for i, text in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            seq = ["<s>", *tokens(text)]
            words.update(seq[1:])
            for n in range(1, order + 1):
                grams.update(tuple(seq[k - n : k]) for k in range(n, len(seq) + 1))
    total, kinds = sum(words.values()), len(words)

    def p(context, w):
        if not context:
            return (words[w] + 0.5) / (total + 0.5 * (kinds + 1))
        m = weights[len(context) - 1]
        return (grams[(*context, w)] + m * p(context[1:], w)) / (grams[context] + m)

    out = {}
    for i, text in rows:
        seq = ["<s>", *tokens(text)]
        score = sum(math.log10(p(tuple(seq[max(0, k - order + 1) : k]), seq[k])) for k in range(1, len(seq)))
        base = sum(math.log10(p((), w)) for w in seq[1:])
        out[i] = (i is not None and zlib.crc32(str(i).encode()) % 5 == 1, len(seq) - 1, sum(words[w] > 0 for w in seq[1:]), total, base, score)
    return out


def same(df, rows, order, weights):
    got, want = {r.doc_id: r for r in df.collect()}, brute(rows, order, weights)
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert tuple(got[i])[1:5] == w[:4] and got[i].base_score == pytest.approx(w[4], rel=1e-9, abs=1e-9) and got[i].score == pytest.approx(w[5], rel=1e-9, abs=1e-9), i


def documents(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_brute_force(spark, sf, order):
    weights = (20.0, 2.0, 1.0)[: order - 1]
    rows = documents(spark, sf)[:60] + [(-1, None), (-2, ""), (-3, " \t\x0b\r\n"), (-4, "ÀÉ àé A B \x00 x\x1fy"), (-5, "Zz " * 3000), (-6, "q" * 5000), (None, "no id but words")]
    df = spark.createDataFrame([(*r, 0.0, 1) for r in rows], "doc_id long, text string, score double, block int")
    same(L.score(df.repartition(3), order=order, weights=weights), rows, order, weights)


def test_small_blocks_ranges_and_pieces(spark, sf, monkeypatch):
    rows = documents(spark, sf)[:40] + [(-k, "the same copy of a passage that many hold") for k in range(1, 60)]
    monkeypatch.setattr(L, "RANGE_BYTES", 5000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(L.score(df), rows, L.ORDER, L.WEIGHTS)


def test_odd_rows(spark):
    got = L.score(odd_documents(spark)).collect()
    assert len(got) == odd_documents(spark).count() and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert L.score(no_documents(spark)).count() == 0
    with pytest.raises(ValueError, match="weight"):
        L.score(no_documents(spark), order=2)


def test_nothing_to_learn_from(spark):
    i = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 5 == 1)
    (r,) = L.score(spark.createDataFrame([(i, "a b")], "doc_id long, text string")).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\t\x0b\x1féZ\x00　", max_size=60), max_size=6), st.integers(1, 40))
def test_tokens(texts, piece):
    keep, L.PIECE = L.PIECE, piece
    try:
        found, begins = L.token_stream([t.encode() for t in texts])
    finally:
        L.PIECE = keep
    want = [tokens(t)[:-1] for t in texts]
    assert np.diff(begins).tolist() == [len(w) + 2 for w in want]
    seen = {}
    for k, ws in enumerate(want):
        mine = found[begins[k] : begins[k + 1]]
        assert mine[0] == L.START and mine[-1] == L.END
        for w, h in zip(ws, mine[1:-1].tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_probabilities_add_up(spark, sf):
    """After any context, the chances of all known words, the end and the unknown word are 1 together."""
    texts = [(t or "").encode() for _, t in documents(spark, sf)[:12]]
    found, begins = L.token_stream(texts)
    ids, places, counts = [], [], []
    for keys, at in L.gram_keys(found, begins, 3):
        known, number, times = np.unique(keys[at], return_inverse=True, return_counts=True)
        full = np.zeros(len(found), np.int32)
        full[at] = number
        ids.append(full), places.append(at), counts.append(times)
    start = ids[0][0]
    words = L.Words(int(counts[0].sum() - counts[0][start]), len(counts[0]) - 1)
    made = L.Automaton(words, L.WEIGHTS, ids, places, counts)
    arcs = {}
    for n in range(3):
        for at in places[n]:
            source = made.first[n - 1] + ids[n - 1][at - 1] if n else 0
            arcs[int(source), int(ids[0][at])] = (made.log[n][ids[n][at]], made.target[n][ids[n][at]])

    def walk(words, state):
        total = 0.0
        for w in words:
            while (state, w) not in arcs and state:
                total, state = total + made.back[state], int(made.fail[state])
            log, state = arcs.get((state, w), (made.unknown, 0))
            total, state = total + log, int(state)
        return total

    for state in [0, 1 + int(ids[0][5]), int(made.first[1] + ids[1][5]), int(made.first[1] + ids[1][700])]:
        assert sum(10 ** walk([w], state) for w in range(len(counts[0]) + 1) if w != start) == pytest.approx(1, rel=1e-9)
    # side by side, and one after another
    each = [walk(ids[0][a + 1 : b].tolist(), 1 + int(ids[0][a])) for a, b in zip(begins, begins[1:], strict=False)]
    assert made.walk(begins) == pytest.approx(each, rel=1e-9)


def test_better_than_words_alone(spark):
    """Held-out texts are likelier under the model than under single words, and a text likelier than its words shuffled."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    r = L.score(docs).where("held_out").selectExpr("sum(score) as s", "sum(base_score) as b", "avg(double(score > base_score)) as share").first()
    assert r.s > r.b and r.share > 0.75
