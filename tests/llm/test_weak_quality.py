import math
from collections import Counter

import numpy as np
import xxhash
from helpers import no_documents, odd_documents

from millrace.llm import weak_quality as Q
from millrace.llm.queries import QUERIES


def test_estimation_finds_known_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.8
    right = (0.95, 0.8, 0.7, 0.9)
    votes = np.stack([np.where(rng.random(len(good)) < p, good, ~good) for p in right], axis=1).astype(int)
    votes[rng.random(votes.shape) < 0.2] = Q.NONE
    patterns, counts = np.unique([Q.pattern_of(v) for v in votes.tolist()], return_counts=True)
    model = Q.estimate(dict(zip(patterns.tolist(), counts.tolist(), strict=True)), 4)
    assert abs(model.good - 0.8) < 0.03
    assert all(abs(model.accuracy(k) - p) < 0.03 for k, p in enumerate(right))
    posterior = np.array([model.posterior(Q.pattern_of(v)) for v in votes.tolist()])
    assert ((posterior >= 0.5) == good).mean() > 0.93


def test_pattern_round_trip():
    for p in range(3 ** len(Q.LABELLERS)):
        assert Q.pattern_of(Q.pattern_votes(p)) == p


def test_scorer_learns():
    rows = [("plain words in a row of text " + str(k), 1.0) for k in range(200)] + [("b@d$$ w%%rds!! " * 3 + str(k), 0.0) for k in range(200)]
    f = Q.fit_scorer(rows).function()
    assert f("words in a plain row") > 0.7 > 0.3 > f("w%%rds!! b@d$$") and 0 < f(None) < 1


def test_against_brute_force(spark, sf):
    """Expectation-maximisation and the scorer document by document, in plain sums, without patterns or arrays."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    repeated = docs.where("doc_id = 7").selectExpr("doc_id", "concat(text, ' ') as text")
    rows = [(r.doc_id, r.text) for r in docs.union(repeated).collect()]
    votes, labellers = [Q.votes(t) for _, t in rows], len(Q.LABELLERS)
    rate = [[sum(v[k] == x for v in votes) / len(votes) for x in range(3)] for k in range(labellers)]
    scaled = lambda xs: [x / sum(xs) for x in xs]
    chance = [[scaled([rate[k][0] * a + 0.01, rate[k][1] * b + 0.01, rate[k][2] + 0.01]) for k in range(labellers)] for a, b in ((1.6, 0.4), (0.4, 1.6))]
    good = 0.7
    odds_of = lambda v: math.log(good / (1 - good)) + sum(math.log(chance[1][k][x] / chance[0][k][x]) for k, x in enumerate(v))
    sure = lambda z: 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    for _ in range(300):
        q = [sure(odds_of(v)) for v in votes]
        chance = [[scaled([0.5 + sum(w for w, v in zip(weight, votes, strict=True) if v[k] == x) for x in range(3)]) for k in range(labellers)] for weight in ([1 - x for x in q], q)]
        good = min(0.99, max(0.01, sum(q) / len(q)))
    out = Q.quality(docs.union(repeated)).collect()
    want = {(k, "".join("-+."[x] for x in v)): sure(odds_of(v)) for (k, _), v in zip(rows, votes, strict=True)}
    assert len(out) == len(rows) and all(abs(want[r.doc_id, r.votes] - r.posterior) < 1e-6 for r in out)

    least = {}
    for k, t in rows:
        least[k] = min(t, least.get(k, t))
    weight, seen, bias = Counter(), Counter(), 0.0

    def features(text):
        words, x = text.split(), Counter()
        for w in words:
            x.update(Q.buckets(w))
        x[Q.SAME] += sum(a == b for a, b in zip(words, words[1:]))  # noqa: B905
        x[Q.AGAIN] += len(words) - len(set(words))
        return {b: n / max(1, len(words)) for b, n in x.items()}

    data = [(features(t), sure(odds_of(Q.votes(t)))) for _, t in sorted((xxhash.xxh3_64_intdigest(str(k)), t) for k, t in least.items())]
    for _ in range(4):
        for x, y in data:
            step = sure(bias + sum(weight[b] * n for b, n in x.items())) - y
            for b, n in x.items():
                seen[b] += (step * n) ** 2
                weight[b] -= 0.5 * step * n / math.sqrt(seen[b] + 1e-8)
            bias -= 0.02 * step
    scored = {(r.doc_id, r.votes, round(r.score, 4)) for r in out}
    told = {(k, "".join("-+."[x] for x in v), round(sure(bias + sum(weight[b] * n for b, n in features(t).items())), 4)) for (k, t), v in zip(rows, votes, strict=True)}
    assert len(scored ^ told) <= 4  # digits that round either way


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = Q.quality(docs).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert Q.quality(no_documents(spark)).count() == 0


def test_held_out_accuracy(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = {r.doc_id: r.predicted for r in QUERIES["op5_quality"](spark, sf).collect()}
    right = [out[k] == y for k, y in labels.items()]
    assert np.mean(right) > 0.85
    assert np.mean([out[k] for k, y in labels.items() if y == 1]) > 0.95


def test_columns_of_the_same_names(spark):
    df = spark.createDataFrame([(k, f"some words of text number {k} that go on", "x", 0.5, 1, "p") for k in range(30)], "doc_id long, text string, votes string, posterior double, predicted int, pattern string")
    rows = Q.quality(df).collect()
    assert len(rows) == 30 and all(0 <= r.score <= 1 and set(r.votes) <= set("-+.") for r in rows)
