"""Similarity self-join on word n-grams by MinHash banding.

1. Each text becomes the set of its five-word shingles, a 128-bit fingerprint of that set,
   and one hash for each band of MinHash values. Rows per band and bands are chosen so that
   a pair at the threshold shares a band with the target recall.
2. Texts with equal sets are one class; only its representative (the least id) goes on.
3. Band hashes are shuffled with their representatives. Each bucket links its members to its
   least one, and the components of these links hold every candidate pair.
4. Each component's members are dealt into blocks of bounded bytes; every pair of blocks is
   one piece of work that verifies on full shingle sets all pairs that share a shingle and
   returns for each member the number of its links and the least member that it is tied to
   there. No pair is ever a row, and no component meets in one task. A component has at most
   ``PIECES`` blocks while these hold ``BLOCK_BYTES`` or less each, so a set is sent
   ``PIECES`` times at most until a component's sets exceed their product.
5. Components of what was verified are the near-copy groups.

A text without words has no shingles: it is like no other and stays alone. Null counts as
empty. Ties cannot arise: ids order them. Rows that share an id are one document under
several rows and get equal results. An empty table gives an empty result; columns besides
key and text are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches
from millrace.llm.components import components
from millrace.llm.decontaminate import seeds_of
from millrace.llm.scratch import cut
from millrace.llm.shingles import SHINGLE_WORDS, WordHashes, mix, set_fingerprint, shingle_set

THRESHOLD = 0.8
RECALL = 0.99999
#: Most MinHash functions of a signature.
FUNCTIONS = 160
#: Bytes of shingle sets in a block of a component: what is aimed at, and what none exceeds by more than chance.
SMALL_BYTES, BLOCK_BYTES = 64 << 10, 16 << 20
#: Most blocks of a component, as long as they stay below ``BLOCK_BYTES``, and the fewest members that are worth a block.
PIECES, MEMBERS = 16, 16


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, functions: int = FUNCTIONS) -> tuple[int, int]:
    """(rows per band, bands): the most selective bands that reach the recall at the threshold within the functions."""
    for rows in range(functions, 0, -1):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p)) if p > 0 else functions + 1
        if rows * bands <= functions:
            return rows, bands
    return 1, functions


def band_hashes(sets: list[np.ndarray], rows: int, bands: int) -> np.ndarray:
    """A 64-bit hash of each band for each (non-empty) set, as int64 [set, band]."""
    values, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = seeds_of(rows * bands)
    out = np.empty((len(sets), bands), np.uint64)
    for b in range(bands):
        total = np.full(len(sets), b + 1, np.uint64)
        for r in range(rows):
            total = mix(total + np.minimum.reduceat(values * seeds[b * rows + r], starts))
        out[:, b] = total
    return out.view(np.int64)


def signatures(docs: DataFrame, key: str, text: str, rows: int, bands: int, size: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (id, print, bands, size); print and bands are null for texts without words, size is that of the set."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        cache = WordHashes()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, cache, size) for t in batch.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            hashes = iter(band_hashes(full, rows, bands)) if full else iter(())
            prints = [set_fingerprint(s) if len(s) else None for s in sets]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary()), pa.array([next(hashes) if len(s) else None for s in sets], pa.list_(pa.int64())), pa.array([len(s) for s in sets], pa.int64())], names=["id", "print", "bands", "size"])

        return work

    return map_batches(docs.select(key, text), make, f"id {dict(docs.dtypes)[key]}, print binary, bands array<long>, size long")


class _Block:
    """Shingle sets of some members, laid end to end in ascending order of shingles."""

    def __init__(self, sets: list[np.ndarray], copies: np.ndarray):
        self.sets, self.copies = sets, copies
        self.sizes = np.array([len(s) for s in sets])
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]

    def linked(self, one: np.ndarray, threshold: float) -> np.ndarray:
        """The members whose Jaccard similarity with a set reaches the threshold; only those that share a shingle are looked at."""
        low, count = np.searchsorted(self.values, one, "left"), np.searchsorted(self.values, one, "right")
        count -= low
        hits = count > 0
        low, count = low[hits], count[hits]
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        shared = np.bincount(self.owner[at], minlength=len(self.sets))
        return np.flatnonzero(shared >= threshold * (len(one) + self.sizes - shared) - 1e-9)


def compare(left: _Block, right: _Block, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For the members of both blocks (of one, if they are the same): links, weighted by copies, and the least member tied to each.

    Memory follows the members, not their pairs: links are counted and joined as they are found.
    """
    same = left is right
    n, m = len(left.sets), len(right.sets)
    links, root, shift = np.zeros(n if same else n + m, np.int64), np.arange(n if same else n + m), 0 if same else n
    for i, one in enumerate(left.sets):
        near = right.linked(one, threshold)
        if same:
            near = near[near != i]
        if len(near):
            links[i] += right.copies[near].sum()
            if not same:
                links[shift + near] += left.copies[i]
            tied = np.unique(root[np.append(shift + near, i)])
            if len(tied) > 1:
                root[np.isin(root, tied)] = tied[0]
    return links, root


def _verify(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by (comp, one, two, own, id): a row of results for each member that has links there."""
    group: list[tuple] = []
    done: list[tuple] = []
    kind = None

    def close() -> None:
        if len(group) < 2:
            return
        one, two = group[0][1:3]
        sides = [[g for g in group if g[3] == own] for own in ((one,) if one == two else (one, two))]
        if not all(sides):
            return
        blocks = [_Block([np.frombuffer(g[6], np.uint64) for g in side], np.array([g[5] for g in side], np.int64)) for side in sides]
        links, root = compare(blocks[0], blocks[-1], threshold)
        members = [g[4] for side in sides for g in side]
        least: dict[int, object] = {}
        for place, r in enumerate(root.tolist()):
            least[r] = min(least.get(r, members[place]), members[place])
        done.extend((members[k], int(links[k]), least[int(root[k])]) for k in np.flatnonzero(links))

    def flush() -> pa.RecordBatch:
        ids, count, roots = zip(*done, strict=True)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(count, pa.int64()), pa.array(roots, kind)], names=["id", "links", "root"])

    for batch in batches:
        kind = batch.schema.field(4).type
        for row in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
            if group and row[:3] != group[0][:3]:
                close()
                group = []
            group.append(row)
        if len(done) > 10_000:
            yield flush()
    close()
    if done:
        yield flush()


def block_count(size: Column, members: Column) -> Column:
    """The number of blocks for a component of so many members, whose sets have ``size`` shingles together."""
    wanted = F.least(F.ceil(size * 8 / SMALL_BYTES), F.ceil(members / MEMBERS), F.lit(PIECES))
    return F.greatest(F.lit(1), wanted, F.ceil(size * 8 / BLOCK_BYTES)).cast("int")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row for each row of ``docs``: (key, class_id, copy_id, n_links).

    ``copy_id`` is the least key among documents of equal shingle sets, ``class_id`` the least
    key that is connected by links, ``n_links`` how many other documents are linked to this
    one directly, copies included.
    """
    rows, bands = choose_bands(threshold, recall)
    kind = dict(docs.dtypes)[key]
    signed = cut(signatures(docs, key, text, rows, bands, size))
    copies = signed.where("print is not null and id is not null").groupBy("print").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("size").alias("size"))
    classes = cut(copies)

    banded = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("bucket", "least")
    candidates = banded.join(buckets, "bucket").where("id <> least").select("id", "least").distinct()
    comp = components(candidates, "id", "least")
    placed = comp.select(F.col("node").alias("id"), F.col("root").alias("comp")).join(classes.select("id", "copies", "size"), "id")
    members = placed.join(placed.groupBy("comp").agg(block_count(F.sum("size"), F.count("*")).alias("blocks")), "comp").drop("size")

    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id is not null")
    chosen = texts.join(members, "id").select("comp", "blocks", "id", "copies", "text")
    sets = map_batches(chosen, partial(_set_maker, size), f"comp {kind}, blocks int, id {kind}, copies long, shingles binary")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = dealt.select("comp", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "id", "copies", "shingles")
    work = pairs.repartition("comp", "one", "two").sortWithinPartitions("comp", "one", "two", "id")
    verified = cut(work.mapInArrow(partial(_verify, threshold=threshold), f"id {kind}, links long, root {kind}"))

    count = verified.groupBy("id").agg(F.sum("links").alias("links"))
    near = components(verified.where("id <> root"), "id", "root")
    told = classes.select("print", F.col("id").alias("copy_id"), "copies").join(count.withColumnRenamed("id", "copy_id"), "copy_id", "left").join(near.select(F.col("node").alias("copy_id"), "root"), "copy_id", "left")
    found = told.select("print", "copy_id", F.coalesce("root", "copy_id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.select("id", "print").join(found, "print", "left").select(
        F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("copy_id", "id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def _set_maker(size: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    cache = WordHashes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, cache, size).tobytes() for t in batch.column(4).to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(sets, pa.binary())], names=["comp", "blocks", "id", "copies", "shingles"])

    return work


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those of a group of near copies that aren't its first; all columns are kept."""
    gone = join(docs, key, text, threshold).where(F.col(key) != F.col("class_id")).select(key).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)
