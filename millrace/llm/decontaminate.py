"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by their number of distinct word shingles into classes
[2^k, 2^(k+1)). For each class that occurs, the shingles of a document, in order, are dealt
into blocks of 2^(k+1); any two neighbouring blocks form a window, so an item that stands
in a document lies within some window whose size is at most four times the item's. That
bounds the Jaccard similarity of item and window from below, however long the document is,
and the number of MinHash functions follows from it and the target recall. A window and an
item that agree in any one minimum are a candidate, which is verified exactly: the share of
the item's distinct shingles that the whole document holds.

All items are searched in one pass over the documents, where these lie, a few megabytes at
a time. The tasks get a Bloom filter of the items' minima, whose size follows their number
up to ``FILTER_BITS``; beyond that more windows pass it in vain, which costs time but
changes no result. Only documents with a window that passes are stored, with their shingles
and the minima that passed; these are joined with the items' minima, the distinct pairs of
document and item with the shingles of both, and the exact check is a column expression. No
item goes through the driver.

Null and empty texts hold nothing; items without words find nothing; items of fewer than
five words are one shingle of all their words, found wherever these stand in a row: with
``short_items``, as in the query and the pipeline, documents are also shingled by each
length that occurs below five and looked up exactly, else only where the document is no
longer than the item; equal
items are found each under its own id; equal documents give equal rows each; empty tables
give empty results; columns besides key and text are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches
from millrace.llm.scratch import cut
from millrace.llm.shingles import SHINGLE_WORDS, WordHashes, mix, shingle_hashes, shingle_set, words

THRESHOLD = 0.8
RECALL = 0.9999
#: Bits of the filter for each minimum, its most bits (32 MB), the bits that a minimum sets, and the bits of a piece that tasks send.
BITS_EACH, FILTER_BITS, PROBES, PIECE_BITS = 128, 1 << 28, 4, 1 << 16


def functions_needed(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """MinHash functions, one row a band, that find a contained item with the target recall.

    The smallest item of a class has half a block's shingles, a window two blocks':
    J >= t q / (w + q - t q) with q = w / 4, and 1 - (1 - J)^k >= recall.
    """
    j = threshold / (4 + 1 - threshold)
    return math.ceil(math.log(1 - recall) / math.log(1 - j))


def seeds_of(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minima(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The least hash under each function. A function is a multiplication by an odd number, after which high bits decide."""
    return np.array([(values * s).min() for s in seeds], np.uint64)


def window_starts(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the blocks of several texts' shingles begin, laid end to end, and each block's text."""
    count = -(-sizes // block)
    text = np.repeat(np.arange(len(sizes)), count)
    first = np.repeat(np.cumsum(count) - count, count)
    return np.repeat(np.cumsum(sizes) - sizes, count) + (np.arange(len(text)) - first) * block, text


def window_minima(values: np.ndarray, starts: np.ndarray, text: np.ndarray, seed: np.uint64) -> np.ndarray:
    """The least hash of each block and the next one of the same text, under one function."""
    least = np.minimum.reduceat(values * seed, starts)
    least[:-1] = np.where(text[:-1] == text[1:], np.minimum(least[:-1], least[1:]), least[:-1])
    return least


def probes(values: np.ndarray, kind: int, function: int) -> np.ndarray:
    """A 64-bit key for each minimum of a class (or a short length, negative) under a function."""
    salt = mix(np.array([(kind * 1_000_003 + function) & (2**64 - 1)], np.uint64))[0]
    return (values ^ salt) * np.uint64(0x9E3779B97F4A7C15)


class Filter:
    """A Bloom filter over probes; ``bits`` is a power of two, at least one piece."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.table = np.zeros(bits // 8, np.uint8)

    def _places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        for k in range(PROBES):
            yield ((keys if k == 0 else mix(keys + np.uint64(k))) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        for at in self._places(keys):
            np.bitwise_or.at(self.table, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def passing(self, keys: np.ndarray) -> np.ndarray:
        """The places of keys that may be among those added."""
        left = np.arange(len(keys))
        for k in range(PROBES):
            own = keys[left]
            at = ((own if k == 0 else mix(own + np.uint64(k))) >> self.shift).astype(np.int64)
            left = left[(self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        return left


def _item_maker(size: int, seeds: np.ndarray, short_items: bool) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    cache = WordHashes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds, keys, sets = [], [], []
        for text in batch.column(2).to_pylist():
            n = len(words(text))
            own = shingle_set(text, cache, size)
            if 0 < n < size and short_items:
                kinds.append(-n), keys.append(probes(own, -n, 0).view(np.int64))
            elif n:
                kind = 1 << int(len(own)).bit_length()
                kinds.append(kind), keys.append(np.concatenate([probes(minima(own, seeds[f : f + 1]), kind, f) for f in range(len(seeds))]).view(np.int64))
            else:
                kinds.append(None), keys.append([])
            sets.append(own.view(np.int64))
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kinds, pa.int64()), pa.array(keys, longs), pa.array(sets, longs)], names=["item_row", "item", "kind", "probes", "item_set"])

    return work


def _filter_pieces(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The pieces of a task's filter that aren't empty."""
    own = Filter(bits)
    for batch in batches:
        own.add(batch.column(0).to_numpy().view(np.uint64))
    yield _pieces({k: p for k, p in enumerate(own.table.reshape(-1, PIECE_BITS // 8)) if p.any()})


def _joined_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            piece = np.frombuffer(raw, np.uint8)
            whole[k] = whole[k] | piece if k in whole else piece
    yield _pieces(whole)


def _pieces(whole: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(whole), pa.int32()), pa.array([p.tobytes() for p in whole.values()], pa.binary())], names=["piece", "raw"])


def _filter_of(items: DataFrame, count: int) -> Filter:
    """The filter of all items' probes: made in the tasks, joined by pieces, ``FILTER_BITS`` at most on the driver."""
    bits = max(PIECE_BITS, min(FILTER_BITS, 1 << (count * BITS_EACH).bit_length()))
    made = items.select(F.explode("probes").alias("probe")).mapInArrow(partial(_filter_pieces, bits=bits), "piece int, raw binary")
    out = Filter(bits)
    table = out.table.reshape(-1, PIECE_BITS // 8)
    for r in made.repartition("piece").mapInArrow(_joined_pieces, "piece int, raw binary").collect():
        table[r["piece"]] |= np.frombuffer(r["raw"], np.uint8)
    return out


def _doc_maker(sent: Broadcast, kinds: list[int], seeds: np.ndarray, size: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    cache, known = WordHashes(), sent.value
    classes, lengths = [k for k in kinds if k > 0], [-k for k in kinds if k < 0]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).to_pylist()
        hashes = [shingle_hashes(t, cache, size) for t in texts] if classes else [np.empty(0, np.uint64)] * len(texts)
        full = np.array([n for n, h in enumerate(hashes) if len(h)], np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if len(full):
            values, counts = np.concatenate([hashes[n] for n in full]), np.array([len(hashes[n]) for n in full])
            for kind in classes:
                starts, text = window_starts(counts, kind)
                for f, seed in enumerate(seeds):
                    keys = probes(window_minima(values, starts, text, seed), kind, f)
                    hit = known.passing(keys)
                    found.append((full[text[hit]], keys[hit]))
        windowed = np.unique(np.concatenate([d for d, _ in found])) if found else np.empty(0, np.int64)
        for length in lengths:
            for n, t in enumerate(texts):
                keys = probes(shingle_hashes(t, cache, length), -length, 0)
                hit = known.passing(keys)
                found.append((np.full(len(hit), n), keys[hit]))
        owner = np.concatenate([d for d, _ in found]) if found else np.empty(0, np.int64)
        keys = np.concatenate([k for _, k in found]) if found else np.empty(0, np.uint64)
        order = np.argsort(owner, kind="stable")
        owner, keys = owner[order], keys[order]
        rows, first = np.unique(owner, return_index=True)
        hits = [np.unique(k).view(np.int64) for k in np.split(keys, first[1:])] if len(rows) else []
        deep = set(windowed.tolist())
        sets = [np.unique(hashes[n]).view(np.int64) if n in deep else np.empty(0, np.int64) for n in rows.tolist()]
        at, longs = pa.array(rows, pa.int64()), pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(sets, longs), pa.array(hits, longs)], names=["doc_row", "doc", "doc_set", "hits"])

    return work


def search(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE_WORDS, short_items: bool = False) -> DataFrame:
    """Rows (doc key, item key, containment, n_shingles of the item) for every containment of ``threshold`` or more."""
    spark, doc_kind, item_kind = docs.sparkSession, dict(docs.dtypes)[doc_key], dict(items.dtypes)[item_key]
    seeds, row = seeds_of(functions_needed(threshold, recall)), F.monotonically_increasing_id()
    asked = items.select(row.alias("item_row"), F.col(item_key).alias("item"), F.col(text).alias("text"))
    known = cut(map_batches(asked, partial(_item_maker, size, seeds, short_items), f"item_row long, item {item_kind}, kind long, probes array<long>, item_set array<long>")).where("kind is not null")
    counts = {r["kind"]: r["n"] for r in known.groupBy("kind").agg(F.sum(F.size("probes")).alias("n")).collect()}  # a row for each class
    sent = spark.sparkContext.broadcast(_filter_of(known, sum(counts.values())))  # FILTER_BITS at most
    read = docs.select(row.alias("doc_row"), F.col(doc_key).alias("doc"), F.col(text).alias("text"))
    hits = cut(map_batches(read, partial(_doc_maker, sent, sorted(counts), seeds, size), f"doc_row long, doc {doc_kind}, doc_set array<long>, hits array<long>"))

    minimum = known.select("item_row", F.explode("probes").alias("probe"))
    pairs = hits.select("doc_row", F.explode("hits").alias("probe")).join(minimum, "probe").select("doc_row", "item_row").distinct()
    both = pairs.join(hits.drop("hits"), "doc_row").join(known.select("item_row", "item", "kind", "item_set"), "item_row")
    held, n = F.size(F.array_intersect("item_set", "doc_set")), F.size("item_set")
    told = both.select("doc", "item", F.when(F.col("kind") < 0, n).otherwise(held).alias("held"), n.alias("n")).where(F.col("held") >= threshold * F.col("n"))
    return told.select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), (F.col("held") / F.col("n")).alias("containment"), F.col("n").cast("long").alias("item_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item, with all their columns.

    One anti-join by key; the flagged keys are few beside the documents but not bounded, so
    the join's kind is left to adaptive execution.
    """
    flagged = search(docs, items, key, threshold=threshold, short_items=True).select(key).distinct()
    return docs.join(flagged, key, "left_anti").select(*docs.columns)
