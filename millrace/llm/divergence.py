"""How far the word use of sources differs from one another and from their language.

Terms are runs of letters and of characters beyond ASCII, only A-Z lower-cased; a language
keeps the terms that at least ``LEAST_DOCS`` of its documents hold. First every task counts
its documents' distinct terms in a count-min sketch, whose counters stop at ``LEAST_DOCS``;
merged sketches never underestimate, so a term that any of its counters leaves below can't be
kept and is discarded before the shuffle. What survives is counted exactly by term string,
and the exact document frequencies decide.

Every group (language, source) and every language gives each kept term the integer weight
p = 1 + floor(1e9 * (count + 1) / (N + V)), and two weights differ by floor((p - q)^2 / q).
Pairs of sources are summed over all kept terms sparsely: what two groups share by a join on
the term, what one holds alone by its distinct weights, what neither holds by a product.

Null texts, languages and sources are ''. Texts without terms add nothing; a group without
kept terms has its pairs all the same, and a language without kept terms has pairs of value
0. Equal values are ranked by the item's bytes. Repeated rows count as documents of their
own. An empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import slices
from millrace.llm.scratch import cut, shared_folder
from millrace.llm.shingles import mix

LEAST_DOCS, TOP, UNIT = 3, 200, 1_000_000_000
#: Rows of the sketch; counters in each: one for so many bytes of text, within bounds that tasks and a broadcast can hold.
DEPTH, BYTES_A_CELL, LEAST_BITS, MOST_BITS = 4, 64, 14, 25
#: Counters that travel and merge together.
SEGMENT = 1 << 14
#: Distinct terms, and counts of terms by source, that a task holds before it sends or adds up what it has.
HELD, HELD_COUNTS = 600_000, 700_000
#: A document in a sum of documents and occurrences; a task holds fewer occurrences than that.
DOCUMENT = 1 << 32
#: Groups up to which their table is broadcast (some 100 bytes each); beyond, joins shuffle.
BROADCAST_GROUPS = 20_000

#: Bytes of terms in lower case, all others as blanks.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ROWS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERMS).split() if text else []


def cells(lang: bytes, found: list[bytes], bits: int) -> np.ndarray:
    """The counter of each term in every row of a sketch of 2^bits counters a row."""
    seed = xxhash.xxh3_64_intdigest(lang)
    h = np.fromiter((xxhash.xxh3_64_intdigest(t, seed) for t in found), np.uint64, len(found))
    return np.stack([(mix(h * _ROWS[j] + _ROWS[-1 - j]) >> np.uint64(64 - bits)).astype(np.int64) for j in range(DEPTH)])


def _add(sketch: np.ndarray, lang: bytes, documents: Counter, bits: int) -> None:
    """Adds documents by term; counters stop at ``LEAST_DOCS``, whatever falls together."""
    found = list(documents)
    amount = np.minimum(np.fromiter(documents.values(), np.int64, len(found)), LEAST_DOCS)
    for row, at in zip(sketch, cells(lang, found, bits), strict=True):
        order = np.argsort(at)
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        cell = at[order][starts]
        row[cell] = np.minimum(np.add.reduceat(amount[order], starts) + row[cell], LEAST_DOCS)


def _sketched(bits: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sketch of (lang, text), in compressed segments that hold anything."""
    sketch = np.zeros((DEPTH, 1 << bits), np.uint8)
    documents: dict[bytes, Counter] = {}
    for batch in batches:
        for piece in slices(batch):
            for lang, text in zip(*(c.cast(pa.binary()).to_pylist() for c in piece.columns), strict=True):
                documents.setdefault(lang, Counter()).update(set(terms(text)))
            if sum(map(len, documents.values())) > HELD:
                for lang, seen in documents.items():
                    _add(sketch, lang, seen, bits)
                documents.clear()
    for lang, seen in documents.items():
        _add(sketch, lang, seen, bits)
    pack = zstandard.ZstdCompressor(level=1).compress
    for j, row in enumerate(sketch.reshape(DEPTH, -1, min(SEGMENT, 1 << bits))):
        full = np.flatnonzero(row.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array([j] * len(full), pa.int32()), pa.array(full, pa.int32()), pa.array([pack(row[k].tobytes()) for k in full], pa.binary())], names=["row", "segment", "counters"])


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each segment's counters, as one bit each: whether it reaches ``LEAST_DOCS``. Holds one copy of a segment."""
    unpack, total = zstandard.ZstdDecompressor().decompress, {}
    for batch in batches:
        for j, k, counters in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            more = np.frombuffer(unpack(counters), np.uint8)
            total[j, k] = np.minimum(total[j, k] + more, LEAST_DOCS) if (j, k) in total else more
    yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in total], pa.int32()), pa.array([k for _, k in total], pa.int32()), pa.array([np.packbits(c >= LEAST_DOCS).tobytes() for c in total.values()], pa.binary())], names=["row", "segment", "bits"])


def possible(docs: DataFrame, bits: int) -> np.ndarray:
    """One bit for each counter, packed: whether a term there can be in ``LEAST_DOCS`` documents of its language.

    The driver sees the bits: 2^(bits - 3) bytes for each row of the sketch.
    """
    sent = docs.select("lang", "text").mapInArrow(partial(_sketched, bits), "row int, segment int, counters binary")
    found = sent.repartition("row", "segment").mapInArrow(_merged, "row int, segment int, bits binary").collect()
    out = np.zeros((DEPTH, (1 << bits) // 8), np.uint8)
    for r in found:
        part = np.frombuffer(r["bits"], np.uint8)
        at = r["segment"] * len(part)
        out[r["row"], at : at + len(part)] = part
    return out


def survives(bitmap: np.ndarray, lang: bytes, found: list[bytes]) -> np.ndarray:
    at = cells(lang, found, bitmap.shape[1].bit_length() + 2)
    return np.logical_and.reduce([(row[k >> 3] >> (7 - (k & 7)).astype(np.uint8)) & 1 for row, k in zip(bitmap, at, strict=True)]).astype(bool)


def _counted(bitmap, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs) of the terms that survive, summed within the task while it can hold them."""
    known: dict[bytes, dict[bytes, bool]] = {}
    groups: dict[tuple[bytes, bytes], dict[bytes, int]] = {}  # documents times 2^32, plus occurrences

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), both in groups.items():
            if both:
                keys = [pa.array([x] * len(both), pa.binary()).cast(pa.string()) for x in (lang, source)]
                told = np.fromiter(both.values(), np.int64, len(both))
                yield pa.RecordBatch.from_arrays([*keys, pa.array(list(both), pa.binary()).cast(pa.string()), pa.array(told & 0xFFFFFFFF), pa.array(told >> 32)], names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        for piece in slices(batch):
            rows = list(zip(*(c.cast(pa.binary()).to_pylist() for c in piece.columns), strict=True))
            rows = [(lang, source, Counter(terms(text))) for lang, source, text in rows]
            new: dict[bytes, set[bytes]] = {}
            if sum(map(len, known.values())) > HELD:
                known.clear()
            for lang, _, found in rows:
                good = known.setdefault(lang, {})
                new.setdefault(lang, set()).update(t for t in found if t not in good)
            for lang, unknown in new.items():
                asked = list(unknown)
                known[lang].update(zip(asked, survives(bitmap.value, lang, asked).tolist(), strict=True))
            for lang, source, found in rows:
                good = known[lang]
                both = groups.setdefault((lang, source), {})
                had = both.get
                for term, times in found.items():
                    before = had(term)
                    if before is not None:
                        both[term] = before + DOCUMENT + times
                    elif good[term]:
                        both[term] = DOCUMENT + times
            if sum(map(len, groups.values())) > HELD_COUNTS:
                yield from sent()
    yield from sent()


def kept_terms(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """Rows (lang, source, term, n, total, first): exact counts of all kept terms, stored in the shared folder.

    ``total`` is the term's count in the language; ``first`` marks one row of each term.
    """
    spark = docs.sparkSession
    if bits is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        bits = min(MOST_BITS, max(LEAST_BITS, (size // BYTES_A_CELL).bit_length()))
    bitmap = spark.sparkContext.broadcast(possible(docs, bits))
    rows = docs.select("lang", "source", "text").mapInArrow(partial(_counted, bitmap), "lang string, source string, term string, n long, docs long")
    # one shuffle: by language and term, which serves the counts by source as well as the sums over them
    counts = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    exact = counts.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("total"), F.sum("docs").over(of_term).alias("all_docs"), (F.min("source").over(of_term) == F.col("source")).alias("first"))
    folder = f"{shared_folder(spark)}/kept-terms-{uuid.uuid4().hex}"
    exact.where(F.col("all_docs") >= LEAST_DOCS).drop("all_docs").write.parquet(folder)
    return spark.read.schema("lang string, source string, term string, n long, total long, first boolean").parquet(folder)


def weight(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(1e9 * (count + 1) / (n + v)); in decimals only where the product may pass a long."""
    wide = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)"), (n + v).cast("decimal(19,0)"))
    return F.when(count < 9 * UNIT, F.call_function("div", F.lit(UNIT).cast("long") * (count + 1), n + v)).otherwise(wide) + 1


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, source, n, v, all_n, none): every group, its language's terms and counts, and its weight of a term it lacks."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("v"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0, ["n", "v"])
    langs = groups.groupBy("lang").agg(F.sum("v").alias("v"), F.sum("n").alias("all_n"))
    known = groups.drop("v").join(langs, "lang")
    return cut(known.withColumn("none", F.when(F.col("v") > 0, weight(F.lit(0), F.col("n"), F.col("v")))))


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", bits: int | None = None) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part ``pair`` has every other source of the language, part ``term`` the ``TOP`` terms that a
    group uses most beyond its language. ``bits`` sets the sketch's size, which no result depends on.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = kept_terms(docs, bits)
    groups = source_groups(docs, kept)
    sized = F.broadcast if groups.count() <= BROADCAST_GROUPS else (lambda df: df)
    known = kept.withColumnRenamed("n", "count").join(sized(groups), ["lang", "source"])
    weighed = known.select("lang", "source", "term", "none", weight(F.col("count"), F.col("n"), F.col("v")).alias("p"), weight(F.col("total"), F.col("all_n"), F.col("v")).alias("q"))
    return _pairs(weighed, groups, sized).unionByName(_terms(weighed))


def _terms(weighed: DataFrame) -> DataFrame:
    beyond = weighed.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return beyond.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def _pairs(weighed: DataFrame, groups: DataFrame, sized) -> DataFrame:
    a, b = (weighed.select("lang", "term", F.col("source").alias(f"{k}_source"), F.col("p").alias(f"{k}_p"), F.col("none").alias(f"{k}_none")) for k in "ab")
    pa_, pb, na, nb = (F.col(c) for c in ("a_p", "b_p", "a_none", "b_none"))
    both = a.join(b, ["lang", "term"]).where("a_source < b_source")

    def beyond(p: Column, q: Column, p0: Column, q0: Column) -> Column:
        """What a shared term adds to the sums that take either side alone."""
        return difference(p, q) - difference(p, q0) - difference(p0, q) + difference(p0, q0)

    shared = both.groupBy("lang", "a_source", "b_source").agg(F.sum(beyond(pa_, pb, na, nb)).alias("ab"), F.sum(beyond(pb, pa_, nb, na)).alias("ba"))
    other = sized(groups.select("lang", F.col("source").alias("b_source"), F.col("none").alias("b_none")))
    # a group's terms by weight: far fewer rows than terms
    levels = weighed.groupBy("lang", F.col("source").alias("a_source"), F.col("none").alias("a_none"), F.col("p").alias("a_p")).agg(F.count("*").alias("terms"))
    alone = levels.join(other, "lang").where("a_source <> b_source")
    alone = alone.groupBy("lang", "a_source", "b_source").agg(F.sum(F.col("terms") * (difference(pa_, nb) - difference(na, nb))).alias("ab"), F.sum(F.col("terms") * (difference(nb, pa_) - difference(nb, na))).alias("ba"))
    mine = groups.select("lang", F.col("source").alias("a_source"), "v", F.col("none").alias("a_none"))
    neither = mine.join(other, "lang").where("a_source <> b_source").select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.coalesce(F.col("v") * difference(na, nb), F.lit(0)).alias("value"))
    directed = F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.col("ab").alias("value")), F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item"), F.col("ba").alias("value"))))
    summed = shared.unionByName(alone).select("lang", directed.alias("d")).select("lang", "d.*").unionByName(neither).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
