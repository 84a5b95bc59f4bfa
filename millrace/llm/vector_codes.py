"""Product codes of vectors: codebooks by rounds of nearest entries and floored means, all in exact integers.

Each component x becomes floor(256 * x) and each vector is cut into equal consecutive parts,
of which every position has a codebook of its own. The nearest entry of a part is found by
screening: one float32 matrix product gives every entry's score, an interval around it holds
the true one whatever the rounding, and all entries whose interval overlaps the best one are
evaluated again in int64; of equal distances the lower index wins. Entries begin as the parts
of the vectors of least ids; each round every task sends the sum and number of the parts that
an entry took, never the parts.

Vectors that are null or hold null or non-finite components are dropped. The dimension is
that of the vector of least id whose length is a positive multiple of the number of parts;
vectors of another length are kept, with null code and error, and so are all vectors where
none has such a length. Rows without an id are encoded but begin no entry; of an id's
repeated rows the least vector does. Fewer ids than entries give that many entries. Integers
beyond int64 are worked out one by one; an error or a sum of errors that no long holds is
null. Null labels are one label. An empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches, slices
from millrace.llm.scratch import cut

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Sums travel in digits of so many bits, so that no sum over tasks overflows.
DIGIT = 40
#: Half the distance from 1 to the next float32.
UNIT = 2.0**-24

Book = list[list[list[int]]]


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd, F.lit(False))


def integers(x: np.ndarray) -> np.ndarray:
    """floor(256 * x) as int64, or as Python integers where one is large."""
    if not x.size or np.abs(x).max() < 2.0**32:
        return np.floor(x.astype(np.float64) * SCALE).astype(np.int64)
    exact = lambda v: math.floor(v * SCALE) if abs(v) < 2.0**100 else int(v) * SCALE
    return np.array([exact(v) for v in x.ravel().tolist()], object).reshape(x.shape)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return (gap * gap).sum(axis=-1)


def intervals(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of |entry|^2 - 2 x.entry for every row and entry, from a float32 product.

    A float32 dot product of n terms, in any order and with inputs rounded, is off by at most
    g * |x| |entry| with g = (n + 2) u / (1 - (n + 2) u); the steps in float64 are off by a few
    units of 2^-53 of what they add.
    """
    n = x.shape[1] + 2
    g = n * UNIT / (1 - n * UNIT)
    product = (x.astype(np.float32) @ book.astype(np.float32).T).astype(np.float64)
    square = (book * book).sum(axis=1).astype(np.float64)
    lengths = np.sqrt((x * x).sum(axis=1).astype(np.float64))[:, None] * np.sqrt(square)[None, :] * (1 + 2.0**-48)
    radius = (2 * g * lengths + 2.0**-50 * (square[None, :] + 2 * (1 + g) * lengths)) * (1 + 2.0**-40)
    score = square[None, :] - 2 * product
    return score - radius, score + radius


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance to it) of each row; of equal ones the lower index."""
    most = int(np.abs(x).max(initial=0)) + int(np.abs(book).max(initial=0))
    if x.shape[1] * most * most >= 1 << 62 or x.shape[1] >= 1 << 20:
        all_of = np.stack([distances(x.astype(object), c.astype(object)) for c in book], axis=1)
        won = np.array([row.index(min(row)) for row in all_of.tolist()], np.int64).reshape(len(x))
        return won, all_of[np.arange(len(x)), won]
    low, high = intervals(x, book)
    open_ = low <= high.min(axis=1)[:, None]
    won = open_.argmax(axis=1)
    unsure = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(unsure):
        row, entry = np.nonzero(open_[unsure])
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        gap = distances(x[unsure[row]], book[entry])
        least = np.minimum.reduceat(gap, starts)
        won[unsure] = np.minimum.reduceat(np.where(gap == least[row], entry, len(book)), starts)
    return won, distances(x, book[won])


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` is a list of integers; ``size`` is the dimension, 0 if there is none."""

    entries: Book
    size: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(c) for part in self.entries for entry in part for c in entry).encode()).hexdigest()

    def arrays(self) -> list[np.ndarray]:
        small = all(abs(c) < 1 << 62 for part in self.entries for entry in part for c in entry)
        return [np.array(part, np.int64 if small else object) for part in self.entries]

    def assign(self) -> Callable[[pa.Array], tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        """A function from vectors of ``size`` to (parts, indexes by part, distances by part)."""
        books, width = self.arrays(), self.size // len(self.entries)

        def run(vectors: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
            x = integers(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), self.size))
            parts = [x[:, k * width : (k + 1) * width] for k in range(len(books))]
            found = [nearest(part, book) for part, book in zip(parts, books, strict=True)]
            return parts, np.stack([f[0] for f in found]), np.stack([f[1] for f in found])

        return run


def first_entries(rows: DataFrame, key: str, vector: str, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """Codebooks of the vectors of least ids. The driver sees ``entries`` vectors at most."""
    begin = rows.where(F.col(key).isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    one = begin.select(F.col(key).alias("key"), F.size(vector).alias("size")).orderBy("key", "size").limit(1).collect()
    if not one:
        return Codebooks([], 0)
    size = one[0]["size"]
    begin = begin.where(F.size(vector) == size).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    # broadcast: ``entries`` ids
    ids = begin.select("key").distinct().orderBy("key").limit(entries)
    found = begin.join(F.broadcast(ids), "key").groupBy("key").agg(F.min("vector").alias("vector")).orderBy("key").collect()
    vectors, width = [integers(np.array(r["vector"], np.float64)).tolist() for r in found], size // parts
    return Codebooks([[v[k * width : (k + 1) * width] for v in vectors] for k in range(parts)], size)


def _sums(books: Codebooks, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums: of each part and entry the number of parts and their sum by component, in digits."""
    assign, n_entries, width = books.assign(), len(books.entries[0]), books.size // len(books.entries)
    total = np.zeros((len(books.entries), n_entries, width + 1), object)
    for batch in batches:
        for piece in slices(batch):
            parts, won, _ = assign(piece.column(0))
            for k, part in enumerate(parts):
                order = np.argsort(won[k], kind="stable")
                starts = np.flatnonzero(np.diff(won[k][order], prepend=-1))
                at = won[k][order][starts]
                total[k, at, 0] += np.diff(starts, append=len(order)).astype(object)
                # sums of a batch stay within int64: integers of that kind are below 2^40
                total[k, at, 1:] += np.add.reduceat(part[order], starts, axis=0).astype(object)
    slots, places, digits = [], [], []
    for slot in np.flatnonzero(total):
        rest, place = total.ravel()[slot], 0
        sign = -1 if rest < 0 else 1
        rest = abs(rest)
        while rest:
            slots.append(slot), places.append(place), digits.append(sign * (rest & ((1 << DIGIT) - 1)))
            rest, place = rest >> DIGIT, place + 1
    yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(places, pa.int32()), pa.array(digits, pa.int64())], names=["slot", "place", "digit"])


def refined(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floored mean of the parts that it is nearest to; unused ones stay."""
    sums = vectors.mapInArrow(partial(_sums, books), "slot long, place int, digit long").groupBy("slot", "place").agg(F.sum("digit").alias("digit"))
    n_entries, width = len(books.entries[0]), books.size // len(books.entries)
    total: dict[int, int] = {}
    for r in sums.collect():  # as many rows as the codebooks have integers, times their digits
        total[r["slot"]] = total.get(r["slot"], 0) + (r["digit"] << (DIGIT * r["place"]))
    new: Book = []
    for k, part in enumerate(books.entries):
        new.append([])
        for e, old in enumerate(part):
            at = (k * n_entries + e) * (width + 1)
            count = total.get(at, 0)
            new[-1].append([total.get(at + 1 + c, 0) // count for c in range(width)] if count else old)
    return Codebooks(new, books.size)


def learn(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of all rows after ``rounds`` rounds."""
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    kept = rows.where(finite(vector))
    books = first_entries(kept, key, vector, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = refined(kept.where(F.size(vector) == books.size).select(vector), books)
    return books


def _encoder(books: Codebooks) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    assign = books.assign() if books.size else None
    hex_of = np.array([f"{e:02x}" for e in range(256)])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = batch.column(2)
        fits = np.array(vectors.value_lengths()) == books.size if assign else np.zeros(batch.num_rows, bool)
        codes, errors = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
        if fits.any():
            _, won, gaps = assign(vectors.filter(pa.array(fits)))
            codes[fits] = ["".join(row) for row in hex_of[won.T].tolist()]
            whole = [sum(row) for row in gaps.T.tolist()]
            errors[fits] = [e if e < 1 << 63 else None for e in whole]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes.tolist(), pa.string()), pa.array(errors.tolist(), pa.int64())], names=["key", "label", "code", "error"])

    return work


def encode(rows: DataFrame, books: Codebooks, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows (key, code, error, label_error, codebooks_sha256) for all vectors that aren't dropped.

    ``label_error`` sums errors in each task first, so a label that a third of all rows carry is
    a row of each task; the join back is by equality, whose hot labels adaptive execution splits.
    """
    kinds = dict(rows.dtypes)
    given = rows.where(finite(vector)).select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    coded = cut(map_batches(given, partial(_encoder, books), f"key {kinds[key]}, label {kinds[label]}, code string, error long"))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    told = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return told.select(F.col("key").alias(key), "code", "error", F.expr("try_cast(total as bigint)").alias("label_error"), F.lit(books.digest()).alias("codebooks_sha256"))


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """All vectors' codes under codebooks learnt from all of them."""
    return encode(rows, learn(rows, key, vector), key, vector, label)
