"""Toxicity by compression distance.

Two zstandard dictionaries are trained by the library: an ordinary one on the windows of
ordinary documents, and a toxic one on what tells toxic documents' windows from those, the
words that hold a telling n-gram (one that is far more frequent in toxic windows). Equal
windows count once in either set, so that copies of a document teach no more than one. A
text is cut at blanks into windows of about 40 bytes. Each window is compressed under the
ordinary dictionary and under the ordinary one extended by the toxic one; the difference of
the two lengths is its gain. A document's figure is the number of its windows whose gain
reaches a threshold, over a power of the number of all its windows; the document counts as
toxic where that reaches a second threshold. Both thresholds and the power are those of
best F1 on a third of the sample that the dictionaries haven't seen, with either kind
weighted by its share among all labels. The score is a fixed function of the figure that
rises with it and is ``THRESHOLD`` at the second threshold.

The model is fit on about ``TOXIC_DOCS`` and ``ORDINARY_DOCS`` labelled documents at most,
those of least hash of their id; everything is scored, whole, by batches without a shuffle.

Null and empty texts have no windows and score 0. Documents labelled twice count as toxic
if either says so; null labels are none; of several rows of one id the least text is learnt
from. Without labels of both kinds every score is the share of toxic ones, 0 without labels;
the same holds where no window of the calibration sample gains. Equal texts get equal
scores; an empty table gives an empty result; other columns are passed on as they are, and
one that has the name of a result gets an underscore at its end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches

TOXIC_DOCS, ORDINARY_DOCS = 1_500, 3_000
ORDINARY_BYTES, TOXIC_BYTES = 98_304, 2_048
#: Most bytes of windows that the library's trainer sees, spread evenly over the sample's.
TRAINED_BYTES = 4 << 20
WINDOW = 40
LEVEL = 13
#: Windows whose gain a task remembers before it starts afresh.
WINDOW_CACHE = 100_000
#: N-grams of words between blanks: sizes, least windows, least likelihood ratio, least times as frequent in toxic windows.
GRAMS, LEAST, EVIDENCE, TIMES = (4, 5, 6), 3, 30, 6
#: Of this many documents of the sample one calibrates and the others train.
PARTS = 3
#: Fixed value: what ends the entropy tables of a trained dictionary, the three offsets 1, 4 and 8; its content follows.
REPEATS = bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0])
#: A document is toxic from this score on.
THRESHOLD = 0.3
#: What calibration chooses from: the gain that a window has to reach, and the power of the number of windows.
GAINS, POWERS = (1, 2, 3, 4, 5), (0.0, 0.25, 0.5, 0.75, 1.0)


def words(text: str | None) -> list[bytes]:
    return text.lower().encode().split() if text else []


def windows(ws: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Runs of whole words of ``size`` bytes or just over, with blanks around each word; none is left out."""
    out, start, n = [], 0, 0
    for k, w in enumerate(ws, 1):
        n += len(w) + 1
        if n >= size:
            out.append(b" " + b" ".join(ws[start:k]) + b" ")
            start, n = k, 0
    if start < len(ws):
        out.append(b" " + b" ".join(ws[start:]) + b" ")
    return out


class _Grams(dict):
    """word -> the numbers of its distinct n-grams, of those between blanks; one number for each n-gram, the same for all words.

    With ``only`` it is the n-grams among these alone, so that words without any take next to no memory.
    """

    def __init__(self, numbers: dict[str, int], only: frozenset[int] | None = None):
        self.numbers, self.only = numbers, only

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        whole, numbers = f" {word.decode()} ", self.numbers
        found = {whole[i : i + n] for n in GRAMS for i in range(len(whole) - n + 1)}
        if self.only is None:
            value = tuple(numbers.setdefault(g, len(numbers)) for g in found)
        else:
            value = tuple(k for k in map(numbers.get, found) if k in self.only)
        self[word] = value
        return value


def telling_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The words of toxic windows, repeats included, that hold a telling n-gram, in blanks.

    An n-gram is telling if toxic windows hold it far more often than ordinary ones, by the
    likelihood ratio of the two frequencies.
    """
    share = (len(toxic) + 1) / (len(toxic) + len(ordinary) + 2)
    seen, usual, numbers = Counter(), Counter(), {}
    grams = _Grams(numbers)
    for window in toxic:
        seen.update({g for w in window.split() for g in grams[w]})
    grams = _Grams(numbers, frozenset(g for g, n in seen.items() if n >= LEAST))
    for window in ordinary:
        usual.update({g for w in window.split() for g in grams[w]})
    good = set()
    for g in grams.only:
        a, b = seen[g], usual[g]
        ratio = 2 * (a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0))
        if ratio >= EVIDENCE and a * (1 - share) >= TIMES * b * share:
            good.add(g)
    return [b" " + w + b" " for window in toxic for w in window.split() if not good.isdisjoint(grams[w])]


def _trained(size: int, samples: list[bytes], k: int, d: int = 8) -> bytes:
    """The content of a trained dictionary; of samples too few or too small to train on, the samples themselves."""
    try:
        made = zstandard.train_dictionary(size, samples, k=k, d=d, level=3).as_bytes()
        return made.partition(REPEATS)[2] or made
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class _Gains(dict):
    """window -> the difference of its two compressed lengths."""

    def __init__(self, plain: Callable[[bytes], bytes], both: Callable[[bytes], bytes]):
        self.plain, self.both = plain, both

    def __missing__(self, window: bytes) -> int:
        gain = len(self.plain(window)) - len(self.both(window))
        if len(window) < 4 * WINDOW:
            if len(self) >= WINDOW_CACHE:
                self.clear()
            self[window] = gain
        return gain


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def gains(self) -> Callable[[list[bytes]], np.ndarray]:
        """A function from windows to the bytes that the toxic dictionary saves in each."""

        def compressor(content: bytes) -> Callable[[bytes], bytes]:
            rule = zstandard.ZstdCompressionParameters.from_level(LEVEL, window_log=18, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=rule)
            return zstandard.ZstdCompressor(dict_data=made, compression_params=rule).compress

        known = _Gains(compressor(self.ordinary), compressor(self.toxic + self.ordinary))
        return lambda ws: np.array([known[w] for w in ws], np.float64)


def train(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Dictionaries:
    distinct = lambda side: sorted({w for ws in side for w in windows(ws)})
    odd, usual = distinct(toxic), distinct(ordinary)
    telling = telling_words(odd, usual)
    groups = [b"".join(usual[k : k + 10]) for k in range(0, len(usual), 10)]
    groups = groups[:: -(-sum(map(len, groups)) // TRAINED_BYTES) or 1]
    return Dictionaries(_trained(ORDINARY_BYTES, groups, 64), _trained(TOXIC_BYTES, telling, 24))


@dataclass(frozen=True)
class Rule:
    """The share of windows that gain ``gain`` bytes or more, taken over a power of their number, and where toxic begins."""

    gain: float
    power: float
    start: float

    def figure(self, gains: np.ndarray) -> float:
        return float((gains >= self.gain).sum() / max(1, len(gains)) ** self.power)

    def score(self, figure: float) -> float:
        return figure / (figure + self.start * (1 / THRESHOLD - 1))


def calibrate(gains: list[np.ndarray], toxic: np.ndarray, share: float) -> Rule | None:
    """The rule of best F1, with either kind weighted to its ``share``; None if no window gains anything."""
    weight = np.where(toxic, share / max(1, toxic.sum()), (1 - share) / max(1, (~toxic).sum()))
    best, found = 0.0, None
    for gain in GAINS:
        for power in POWERS:
            figure = np.array([Rule(gain, power, 1).figure(g) for g in gains])
            order = np.argsort(-figure, kind="stable")
            said, right = np.cumsum(weight[order]), np.cumsum((weight * toxic)[order])
            f1 = 2 * right / (said + share)
            # a threshold takes all documents of its figure
            last = np.append(figure[order][1:] < figure[order][:-1], True) & (figure[order] > 0)
            at = int(np.argmax(np.where(last, f1, -1)))
            if last.any() and f1[at] > best + 1e-9:
                best, found = float(f1[at]), Rule(gain, power, float(figure[order][at]))
    return found


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries | None
    rule: Rule | None
    prior: float

    def scorer(self) -> Callable[[list[str | None]], np.ndarray]:
        if self.dictionaries is None or self.rule is None:
            return lambda texts: np.full(len(texts), self.prior)
        gains, rule = self.dictionaries.gains(), self.rule

        def score(texts: list[str | None]) -> np.ndarray:
            figures = [rule.figure(gains(windows(words(t)))) for t in texts]
            # at the rule's start the score is the threshold itself, whatever division rounds to
            return np.array([max(THRESHOLD, rule.score(x)) if x >= rule.start else min(rule.score(x), np.nextafter(THRESHOLD, 0)) for x in figures], np.float64)

        return score


def fit(rows: list[tuple[int, str | None, int]], share: float) -> Model:
    """A model from (id, text, toxic); ``share`` is that of toxic ones among all labelled documents.

    The sample holds each kind by its own bound; calibration weighs it back to ``share``.
    """
    shared: dict[bytes, bytes] = {}
    said = [([shared.setdefault(w, w) for w in words(t)], y) for _, t, y in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or ""))]
    sides = [[ws for ws, y in said if y == kind] for kind in (1, 0)]
    if min(map(len, sides)) < 2:
        return Model(None, None, share)
    made = train(*([ws for n, ws in enumerate(side) if n % PARTS] for side in sides))
    gains = made.gains()
    asked = [(gains(windows(ws)), y) for side, y in zip(sides, (True, False), strict=True) for ws in side[::PARTS]]
    return Model(made, calibrate([g for g, _ in asked], np.array([y for _, y in asked]), share), share)


def held_out(key: str) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def among(kind: str, key: str, bound: int, total: int) -> Column:
    """Whether a row of a kind is in its sample: all of up to ``bound`` rows, else those of least hash, about ``bound``."""
    return F.expr(kind) & (F.pmod(F.xxhash64(key), F.lit(1 << 24)) < math.ceil((1 << 24) * min(1.0, bound / max(1, total))))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model from all labels that aren't held out, through bounded samples of either kind."""
    told = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("__y"))
    known = told.join(docs.select(key).distinct(), key, "left_semi")
    counts = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    chosen = known.where(among("__y = 1", key, TOXIC_DOCS, counts.get(1, 0)) | among("__y = 0", key, ORDINARY_DOCS, counts.get(0, 0)))
    # broadcast and rows: about the two bounds at most, as each id gives one row
    rows = docs.select(key, text).join(F.broadcast(chosen), key).groupBy(key, "__y").agg(F.min(text).alias("__text")).collect()
    total = sum(counts.values())
    return fit([(r[key], r["__text"], r["__y"]) for r in rows], counts.get(1, 0) / total if total else 0.0)


def score(docs: DataFrame, model: Model, text: str = "text", into: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with a score from 0 to 1 and whether it reaches ``THRESHOLD``."""
    place = docs.columns.index(text)
    for name in into:
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, _free(name, docs.columns))
    fields = ", ".join(f"`{c}` {kind}" for c, kind in docs.dtypes)
    return map_batches(docs, partial(_maker, model, place, into), f"{fields}, {into[0]} double, {into[1]} int")


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _maker(model: Model, place: int, into: tuple[str, str]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    scorer = model.scorer()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = scorer(batch.column(place).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], names=[*batch.schema.names, *into])

    return work


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns."""
    into = _free("__score", docs.columns), _free("__toxic", docs.columns)
    return score(docs, learn(docs, labels, key), into=into).where(F.col(into[1]) == 0).select(*docs.columns)
