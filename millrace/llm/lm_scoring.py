"""Texts scored by a smoothed n-gram model, through its weighted back-off automaton.

Only A-Z are lower-cased; words are runs without ASCII blanks, and an end, counted as a token,
follows the last one. An n-gram's probability given its context h of count c(h) is
(c(h w) + m P(w | shorter h)) / (c(h) + m), with a weight m of each order and the additively
smoothed words at the bottom, so all probabilities after any context add up to 1. As an
automaton: every context seen in training is a state, a seen n-gram an arc to the longest
seen context that ends it, and a state's failure arc leads to its next shorter context at the
price m / (c(h) + m). One walk from left to right carries the state and adds up logarithms.

The model is as large as the corpus, so no task holds it. Texts travel in blocks; a block asks
once for each n-gram that its texts hold, as sorted 64-bit hashes dealt by range, and tells
how often its training texts hold it; a range adds up what all blocks tell and answers them.
Each block then builds the part of the automaton that its texts can reach and walks it. A
range's questions are bounded by the ranges' number, which follows the size of all texts, and
a frequent n-gram is one question of each block.

Null and empty texts are one token, the end. Rows without an id take part in training. Rows
may repeat, each counts. Without any training text every probability is that of the unknown
word. An empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import slices
from millrace.llm.shingles import mix

#: Words of an n-gram, the weight m of each order from 2 on, and what is added to a word's count.
ORDER, WEIGHTS, ADDED = 3, (500.0, 10.0), 0.5
#: Bytes of text of a block, of all texts for each range of hashes, and that are hashed at once.
BLOCK_BYTES, RANGE_BYTES, PIECE = 16 << 20, 12 << 20, 1 << 20
#: Words that one walker reads; walkers go side by side.
STRIDE = 256

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BLANKS = b" \t\n\x0b\x0c\r"
_BLANK = np.isin(np.arange(256), list(_BLANKS))
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_OF_BYTE = np.where(_BLANK, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
_ODD = np.uint64(0xD6E8FEB86659FD93)
START, END = np.uint64(1), np.uint64(2)


class _Powers:
    """Powers of the base and of its inverse, as many as the longest piece needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, PIECE)
            made = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, _INVERSE)]
            if size > 4 * PIECE:
                return made[0], made[1]
            self.up, self.down = made
        return self.up, self.down


_powers = _Powers()


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first byte) of each word: differences of running sums of powers, a piece at a time."""
    data, at, n, found = data.translate(_LOWER), 0, len(data), []
    while at < n:
        end = n
        if n - at > PIECE:
            end = max(data.rfind(b, at, at + PIECE) for b in (bytes([c]) for c in _BLANKS)) + 1
            if not end:
                end = min((k + 1 for b in _BLANKS if (k := data.find(bytes([b]), at + PIECE)) >= 0), default=n)
        a = np.frombuffer(data, np.uint8, end - at, at)
        up, down = _powers(len(a))
        blank = _BLANK[a]
        edge = np.flatnonzero(np.diff(~blank, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[a] * up[: len(a)])])
        found.append((mix((sums[ends] - sums[starts]) * down[starts]), starts + at))
        at = end
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def token_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all texts, each with a start and an end around its words; where each text begins, and the end of all)."""
    hashes, sizes, group, held = [], [], [], 0

    def flush() -> None:
        lengths = np.fromiter(map(len, group), np.int64, len(group))
        found, places = word_hashes(b" ".join(group))
        begins = np.cumsum(lengths + 1) - lengths - 1
        hashes.append(found)
        sizes.append(np.diff(np.searchsorted(places, np.append(begins, np.iinfo(np.int64).max))))

    for text in texts:
        group.append(text)
        held += len(text)
        if held >= PIECE:
            flush()
            group, held = [], 0
    if group:
        flush()
    words = np.concatenate([*hashes, np.empty(0, np.uint64)])
    count = np.concatenate([*sizes, np.empty(0, np.int64)])
    begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(count + 2)])
    tokens = np.full(begins[-1], START, np.uint64)
    tokens[begins[1:] - 1] = END
    inner = np.ones(begins[-1], bool)
    inner[begins[:-1]] = inner[begins[1:] - 1] = False
    tokens[inner] = words
    return tokens, begins


def gram_keys(tokens: np.ndarray, begins: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to ``order``: (hashes of the n-grams that end at each place, the places where one does)."""
    inside = np.arange(len(tokens)) - np.repeat(begins[:-1], np.diff(begins))
    keys = mix(tokens * _ODD + np.uint64(1))
    for n in range(1, order + 1):
        if n > 1:
            keys = np.concatenate([keys[:1], mix(keys[:-1] * _ODD + mix(tokens[1:] + np.uint64(n)))])
        yield keys, np.flatnonzero(inside >= n - 1)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers by byte planes, each compressed alone: the even planes of hashes don't spoil the others."""
    pack = zstandard.ZstdCompressor(level=1).compress
    planes = [pack(p.tobytes()) for p in values.astype("<u8").view(np.uint8).reshape(-1, 8).T]
    return struct.pack("<8I", *map(len, planes)) + b"".join(planes)


def _unpack(blob: bytes) -> np.ndarray:
    unpack, at, planes = zstandard.ZstdDecompressor().decompress, 32, []
    for size in struct.unpack_from("<8I", blob):
        planes.append(np.frombuffer(unpack(blob[at : at + size]), np.uint8))
        at += size
    return np.stack(planes, axis=1).copy().view("<u8").ravel()


def _questions(keys: np.ndarray, counts: np.ndarray, ranges: int, first: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(range, packed keys, packed counts) for ascending distinct keys; ranges are numbered from ``first``."""
    of = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(of, prepend=np.uint64(1 << 63)))
    for a, b in zip(starts, np.append(starts[1:], len(keys))[: len(starts)], strict=True):
        yield first + int(of[a]), _pack(np.diff(keys[a:b], prepend=np.uint64(0))), _pack(counts[a:b])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        for piece in slices(batch):
            if size and size + piece.nbytes > BLOCK_BYTES:
                yield held
                held, size = [], 0
            held.append(piece)
            size += piece.nbytes
    if held:
        yield held


def _texts(block: list[pa.RecordBatch]) -> list[bytes]:
    return [t or b"" for piece in block for t in piece.column("text").cast(pa.binary()).to_pylist()]


def _flags(block: list[pa.RecordBatch]) -> np.ndarray:
    return np.concatenate([np.asarray(piece.column("held_out").to_pylist(), bool) for piece in block])


def _ipc(block: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, block[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        for piece in block:
            out.write_batch(piece)
    return sink.getvalue().to_pybytes()


def _words_told(ranges: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block of training texts: its words and ends, with counts, by range."""
    for block in _blocks(batches):
        tokens, begins = token_stream(_texts(block))
        tokens = np.delete(tokens, begins[:-1])
        keys, counts = np.unique(mix(tokens * _ODD + np.uint64(1)), return_counts=True)
        rows = list(_questions(keys, counts, ranges, 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["range", "keys", "counts"])


def _words_summed(group: pa.Table) -> pa.Table:
    keys = np.concatenate([np.cumsum(_unpack(k)) for k in group["keys"].to_pylist()])
    total = sum(int(_unpack(c).sum()) for c in group["counts"].to_pylist())
    return pa.table({"kinds": pa.array([len(np.unique(keys))], pa.int64()), "total": pa.array([total], pa.int64())})


def _blocked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, body): some megabytes of texts with their keys and flags."""
    from pyspark import TaskContext

    for k, block in enumerate(_blocks(batches)):
        number = (TaskContext.get().partitionId() << 32) + k
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([_ipc(block)], pa.binary())], names=["block", "body"])


def _asked(order: int, ranges: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: every n-gram that it holds, with its count in training texts, by order and range."""
    for batch in batches:
        for number, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = list(pa.ipc.open_stream(body))
            tokens, begins = token_stream(_texts(block))
            held_out = np.repeat(_flags(block), np.diff(begins))
            for n, (keys, places) in enumerate(gram_keys(tokens, begins, order)):
                out = held_out[places]
                trained, times = np.unique(keys[places[~out]], return_counts=True)
                known = np.union1d(trained, keys[places[out]])
                counts = np.zeros(len(known), np.int64)
                counts[np.searchsorted(known, trained)] = times
                for of, packed, told in _questions(known, counts, ranges, n * ranges):
                    yield pa.RecordBatch.from_arrays([pa.array([of], pa.int64()), pa.array([number], pa.int64()), pa.array([packed], pa.binary()), pa.array([told], pa.binary())], names=["range", "block", "keys", "counts"])


def _answered(group: pa.Table) -> pa.Table:
    """To each block that asked in this range: the sums over all blocks, in the order of its keys."""
    keys = [np.cumsum(_unpack(k)) for k in group["keys"].to_pylist()]
    counts = np.concatenate([_unpack(c) for c in group["counts"].to_pylist()]).astype(np.int64)
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, at, counts)
    ends = np.cumsum([len(k) for k in keys])
    told = [_pack(total[at[e - len(k) : e]]) for k, e in zip(keys, ends, strict=True)]
    return pa.table({"range": group["range"], "block": group["block"], "counts": pa.array(told, pa.binary())})


@dataclass(frozen=True)
class Words:
    """The training texts' tokens and distinct ones."""

    total: int
    kinds: int

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / (self.total + ADDED * (self.kinds + 1))


class Automaton:
    """States and arcs of the n-grams of one block.

    State 0 is the empty context; the contexts of each length follow, in the order of their
    hashes. ``ids[n]`` is the number of the (n+1)-gram that ends at a place of the token stream,
    so it is also the arc that a state of length n would take there; one not seen in training
    is no arc.
    """

    def __init__(self, words: Words, weights: tuple[float, ...], ids: list[np.ndarray], places: list[np.ndarray], counts: list[np.ndarray]):
        order = len(counts)
        self.ids, self.seen = ids, [c > 0 for c in counts]
        self.first = np.cumsum([1, *map(len, counts[:-1])]).tolist()  # the first state of each length
        size = self.first[-1]
        self.length = np.repeat(np.arange(order, dtype=np.int8), [1, *map(len, counts[:-1])])
        self.back, self.fail = np.zeros(size), np.zeros(size, np.int32)
        self.unknown = float(np.log10(words.probability(np.zeros(1)))[0])
        chance = words.probability(counts[0])
        self.log, self.target = [np.log10(chance)], [np.zeros(len(chance), np.int32)]
        for n in range(1, order):
            at, shorter, context = places[n], np.zeros(len(counts[n]), np.int32), np.zeros(len(counts[n]), np.int32)
            shorter[ids[n][at]], context[ids[n][at]] = ids[n - 1][at], ids[n - 1][at - 1]
            chance = (counts[n] + weights[n - 1] * chance[shorter]) / (counts[n - 1][context] + weights[n - 1])
            self.log.append(np.log10(chance))
            self.target.append(self.first[n - 1] + shorter)
        for n in range(order - 1):
            states = slice(self.first[n], self.first[n] + len(counts[n]))
            self.back[states] = np.log10(weights[n] / (counts[n] + weights[n]))
            self.fail[states] = self.target[n]
            self.target[n] = np.arange(states.start, states.stop, dtype=np.int32)

    def reached(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The state after the word at each place, ``depth`` places into its text: the longest context seen there."""
        state = np.zeros(len(at), np.int32)
        for n, first in enumerate(self.first[:-1]):
            here = np.flatnonzero(depth >= n)
            here = here[self.seen[n][self.ids[n][at[here]]]]
            state[here] = first + self.ids[n][at[here]]
        return state

    def walk(self, begins: np.ndarray) -> np.ndarray:
        """log10 of each text's probability; ``begins`` are the texts' places, and the end of all.

        All texts are walked side by side, long ones as strides of ``STRIDE`` words, each from
        the state that the words before it lead to.
        """
        words = np.diff(begins) - 1
        strides = -(-words // STRIDE)
        text = np.repeat(np.arange(len(words)), strides)
        skipped = (np.arange(len(text)) - np.repeat(np.cumsum(strides) - strides, strides)) * STRIDE
        left = np.minimum(words[text] - skipped, STRIDE)
        order = np.argsort(-left, kind="stable")
        text, skipped, left = text[order], skipped[order], left[order]
        at = begins[text] + skipped
        state, total = self.reached(at, skipped), np.zeros(len(text))
        for step in range(1, int(left.max(initial=0)) + 1):
            m = int(np.searchsorted(-left, -step, "right"))
            self._step(at[:m] + step, state[:m], total[:m])
        return np.bincount(text, total, minlength=len(words))

    def _step(self, place: np.ndarray, state: np.ndarray, total: np.ndarray) -> None:
        """Every walker reads the word at its place: back-off until its state has an arc, then along the arc."""
        length = self.length[state]
        for n in range(len(self.seen) - 1, -1, -1):
            here = np.flatnonzero(length == n)
            arc = self.ids[n][place[here]]
            has = self.seen[n][arc]
            go, arc = here[has], arc[has]
            total[go] += self.log[n][arc]
            state[go] = self.target[n][arc]
            length[go] = -1
            stay = here[~has]
            if n:
                total[stay] += self.back[state[stay]]
                state[stay] = self.fail[state[stay]]
                length[stay] = n - 1
            else:
                total[stay] += self.unknown


def _scored(words: Words, order: int, weights: tuple[float, ...], ranges: int, key: str, texts: pa.Table, answers: pa.Table) -> pa.Table:
    """One block's texts, scored by the counts that answer its questions."""
    out = []
    for body in texts["body"].to_pylist():
        block = list(pa.ipc.open_stream(body))
        tokens, begins = token_stream(_texts(block))
        told = dict(zip(answers["range"].to_pylist(), answers["counts"].to_pylist(), strict=True))
        ids, places, counts = [], [], []
        for n, (keys, at) in enumerate(gram_keys(tokens, begins, order)):
            known, number = np.unique(keys[at], return_inverse=True)
            full = np.zeros(len(tokens), np.int32)
            full[at] = number
            got = [_unpack(told[r]) for r in range(n * ranges, (n + 1) * ranges) if r in told]
            count = np.concatenate([*got, np.empty(0, np.uint64)]).astype(np.int64)
            if len(count) != len(known):
                raise RuntimeError("a block's answers don't fit its texts")
            ids.append(full), places.append(at), counts.append(count)
        automaton = Automaton(words, weights, ids, places, counts)
        first, scored = begins[:-1], np.ones(len(tokens), bool)
        scored[first] = False
        of = np.repeat(np.arange(len(first)), np.diff(begins))[scored]
        n_known = np.bincount(of, counts[0][ids[0][scored]] > 0, minlength=len(first)).astype(np.int64)
        base = np.bincount(of, automaton.log[0][ids[0][scored]], minlength=len(first))
        n = len(first)
        keyed = pa.chunked_array([piece.column("key") for piece in block])
        out.append(pa.table({key: keyed, "held_out": pa.array(_flags(block)), "n_tokens": pa.array(np.diff(begins) - 1), "n_known": pa.array(n_known), "train_tokens": pa.array([words.total] * n, pa.int64()), "base_score": pa.array(base), "score": pa.array(automaton.walk(begins))}))
    return pa.concat_tables(out)


def held_out(key: str):
    """Whether a row is kept from learning: crc32 of its id as text, modulo 5, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 1, F.lit(False))


def count_words(given: DataFrame, ranges: int) -> Words:
    """Tokens and distinct tokens of the training texts."""
    told = given.where("not held_out").select("held_out", "text").mapInArrow(partial(_words_told, ranges), "range long, keys binary, counts binary")
    r = told.groupBy("range").applyInArrow(_words_summed, "kinds long, total long").agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).first()
    return Words(r["total"] or 0, r["kinds"] or 0)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score) for all texts."""
    if len(weights) != order - 1:
        raise ValueError("every order from 2 on has a weight")
    given = docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    ranges = (given.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES + 1
    words = count_words(given, ranges)
    # dealt once, read twice: the plan reuses the exchange
    texts = given.mapInArrow(_blocked, "block long, body binary").repartition("block")
    asked = texts.mapInArrow(partial(_asked, order, ranges), "range long, block long, keys binary, counts binary")
    answers = asked.groupBy("range").applyInArrow(_answered, "range long, block long, counts binary")
    fields = f"`{key}` {dict(docs.dtypes)[key]}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(partial(_scored, words, order, weights, ranges, key), fields)
