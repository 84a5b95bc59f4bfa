"""Text quality from weak labels.

Heuristic labellers vote good, bad or nothing on each whole text. Over the counts of all
vote patterns, of which there are at most 3 to the number of labellers however many texts
there are, expectation-maximisation estimates each labeller's accuracies and the share of
good texts, with votes independent given the class. A pattern's posterior is the label of
its texts. A linear scorer over hashed words and word shapes is then fit to posteriors, on
at most ``SAMPLE`` documents (those of least hash of their id), and scores every text.

A text without words gets no votes but the one on length, and the scorer's bias. Null counts
as empty. Equal texts get equal results; with an empty table there is nothing to learn and
the result is empty; of several rows of one id the least text is learnt from; other columns
are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches
from millrace.llm.scratch import cut

SAMPLE = 6_000
BITS = 16
GOOD, BAD, NONE = 1, 0, 2
WORD_CACHE = 400_000


def votes(text: str | None) -> list[int]:
    """One vote by each of ``LABELLERS``."""
    text = text or ""
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, letters = len(words), sum(map(len, words))
    capitals = len(_CAPITAL.findall(text)) if text.isascii() else sum(map(str.isupper, text))
    symbols = len(_SYMBOL.findall(text))
    between = lambda x, good, bad, high=True: NONE if x is None else GOOD if (x <= good if high else x >= good) else BAD if (x >= bad if high else x <= bad) else NONE
    share = lambda a, b: a / b if b else None
    repeats = sum(map(str.__eq__, words, words[1:])) if n > 1 else 0
    triples = len(set(zip(words, words[1:], words[2:]))) if n > 20 else None  # noqa: B905
    short = share(sum(len(w) <= 3 for w in words), n if n >= 10 else 0)
    mean = share(letters, n)
    return [
        between(share(symbols, letters), 0.05, 0.08),
        between(share(capitals, letters), 0.15, 0.4),
        between(share(repeats, n), 0.01, 0.05),
        between(triples and triples / (n - 2), 0.97, 0.85, high=False),
        NONE if short is None else GOOD if 0.2 <= short <= 0.55 else BAD if short < 0.12 or short > 0.75 else NONE,
        between(share(sum(x.rstrip()[-1] in ".!?\"'”»)" for x in lines), len(lines)), 0.75, 0.3, high=False),
        NONE if mean is None else GOOD if 3 <= mean <= 8 else BAD if mean < 2.5 or mean > 10 else NONE,
        GOOD if n >= 50 else BAD if n < 5 else NONE,
    ]


_CAPITAL, _SYMBOL = re.compile("[A-Z]"), re.compile(r"[^\w\s]")
LABELLERS = ("symbols", "capitals", "repeated_words", "distinct_triples", "short_words", "line_ends", "word_length", "length")


def pattern_of(vote: list[int]) -> int:
    return sum(v * 3**k for k, v in enumerate(vote))


def pattern_votes(pattern: int, labellers: int = len(LABELLERS)) -> list[int]:
    return [pattern // 3**k % 3 for k in range(labellers)]


@dataclass(frozen=True)
class LabelModel:
    good: float
    #: For each labeller, the chances of votes bad, good and none on a bad and on a good text.
    chances: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]

    def posterior(self, pattern: int) -> float:
        odds = math.log(self.good / (1 - self.good))
        for v, (bad, good) in zip(pattern_votes(pattern, len(self.chances)), self.chances, strict=True):
            odds += math.log(good[v] / bad[v])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))

    def accuracy(self, k: int) -> float:
        """The chance that labeller ``k`` is right when it votes."""
        (bad0, bad1, _), (good0, good1, _) = self.chances[k]
        right, said = (1 - self.good) * bad0 + self.good * good1, (1 - self.good) * (bad0 + bad1) + self.good * (good0 + good1)
        return right / said


def estimate(counts: dict[int, int], labellers: int = len(LABELLERS), rounds: int = 300) -> LabelModel:
    """Expectation-maximisation over pattern counts, begun from labellers that are right four times of five."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    v = np.array([pattern_votes(p, labellers) for p in patterns]).reshape(len(patterns), labellers)
    one = np.stack([v == k for k in range(3)], axis=2).astype(float)
    rate = (one * n[:, None, None]).sum(axis=0) / max(n.sum(), 1)
    chances = np.stack([rate * [1.6, 0.4, 1], rate * [0.4, 1.6, 1]]) + 0.01
    chances /= chances.sum(axis=2, keepdims=True)
    good = 0.7
    for _ in range(rounds if len(patterns) else 0):
        odds = math.log(good / (1 - good)) + np.einsum("plv,lv->p", one, np.log(chances[1] / chances[0]))
        q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        for k, weight in ((1, n * q), (0, n * (1 - q))):
            chances[k] = np.einsum("p,plv->lv", weight, one) + 0.5
            chances[k] /= chances[k].sum(axis=1, keepdims=True)
        good = float(np.clip((n * q).sum() / n.sum(), 0.01, 0.99))
    return LabelModel(good, tuple((tuple(map(float, chances[0, k])), tuple(map(float, chances[1, k]))) for k in range(labellers)))


_LETTERS = str.maketrans({c: "a" for c in "bcdefghijklmnopqrstuvwxyz"} | {c: "A" for c in "BCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: "0" for c in "123456789"})
_RUNS = re.compile(r"(.)\1+")


def buckets(word: str) -> tuple[int, int]:
    """The hashed word and its hashed shape, in which runs of letters, capitals and digits are one."""
    return xxhash.xxh3_64_intdigest(word.lower()) >> (64 - BITS), xxhash.xxh3_64_intdigest("s" + _RUNS.sub(r"\1", word.translate(_LETTERS))) >> (64 - BITS)


#: Buckets that words share with: the word before again, and a word that the text had before.
SAME, AGAIN = 0, 1


def repeated(words: list[str]) -> tuple[int, int]:
    """How many words equal the one before, and how many the text has had before."""
    return sum(map(str.__eq__, words, words[1:])), len(words) - len(set(words))


class _Ids(dict):
    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value = buckets(word)
        return value


@dataclass(frozen=True)
class Scorer:
    """The chance that a text is good: bias plus the mean weight of its hashed words and shapes."""

    weights: np.ndarray
    bias: float

    def function(self) -> Callable[[str | None], float]:
        known = _Weights(self.weights)

        def score(text: str | None) -> float:
            words = (text or "").split()
            same, again = repeated(words)
            total = sum(map(known.__getitem__, words)) + same * self.weights[SAME] + again * self.weights[AGAIN]
            z = self.bias + (total / len(words) if words else 0.0)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


class _Weights(dict):
    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= WORD_CACHE:
            self.clear()
        a, b = buckets(word)
        self[word] = value = float(self.weights[a]) + float(self.weights[b])
        return value


def fit_scorer(rows: list[tuple[str | None, float]], passes: int = 4, rate: float = 0.5) -> Scorer:
    """Logistic regression by adaptive gradient steps on soft labels, in the order given."""
    ids, w, seen, bias = _Ids(), np.zeros(1 << BITS), np.full(1 << BITS, 1e-8), 0.0
    data = []
    for text, y in rows:
        words = (text or "").split()
        flat = np.array([i for word in words for i in ids[word]], np.int64)
        same, again = repeated(words)
        places, count = np.unique(np.concatenate([flat, [SAME, AGAIN]]).astype(np.int64), return_counts=True)
        count[places == SAME] += same - 1
        count[places == AGAIN] += again - 1
        data.append((places, count / max(1, len(words)), y))
    for _ in range(passes):
        for places, x, y in data:
            z = bias + float(w[places] @ x)
            step = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y
            grad = step * x
            seen[places] += grad * grad
            w[places] -= rate * grad / np.sqrt(seen[places])
            bias -= 0.02 * step
    return Scorer(w, bias)


def _vote_maker(key: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    return lambda batch: pa.RecordBatch.from_arrays([batch.column(0), pa.array([pattern_of(votes(t)) for t in batch.column(1).to_pylist()], pa.int32())], names=[key, "pattern"])


def _score_maker(model: LabelModel, scorer: Scorer, key: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    score, posterior = scorer.function(), {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        patterns = [pattern_of(votes(t)) for t in texts]
        for p in set(patterns) - posterior.keys():
            posterior[p] = model.posterior(p)
        scores = [score(t) for t in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(["".join("-+."[v] for v in pattern_votes(p)) for p in patterns]), pa.array([posterior[p] for p in patterns]), pa.array(scores), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
            names=[key, "votes", "posterior", "score", "predicted"],
        )

    return work


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, votes, posterior, score, predicted): the weak label of every text and the scorer's verdict."""
    kind = dict(docs.dtypes)[key]
    voted = cut(map_batches(docs.select(key, text), partial(_vote_maker, key), f"`{key}` {kind}, pattern int"))
    counts = {r["pattern"]: r["count"] for r in voted.groupBy("pattern").count().collect()}  # at most 3 ** labellers rows
    model = estimate(counts)
    below = math.ceil((1 << 24) * min(1.0, SAMPLE / max(1, sum(counts.values()))))
    chosen = voted.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(1 << 24)) < below)).select(key).distinct()
    # about SAMPLE ids at most, and one row of each
    rows = docs.select(key, text).join(F.broadcast(chosen), key).groupBy(key).agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias("__text")).collect()
    order = sorted((xxhash.xxh3_64_intdigest(str(r[key])), r["__text"], pattern_of(votes(r["__text"]))) for r in rows)
    scorer = fit_scorer([(t, model.posterior(p)) for _, t, p in order])
    return map_batches(docs.select(key, text), partial(_score_maker, model, scorer, key), f"`{key}` {kind}, votes string, posterior double, score double, predicted int")
