"""Token counts by section, attributed through character offsets.

A whole document is encoded once. Token ids give byte lengths, whose running sums are the
tokens' byte spans, and the text's own bytes turn these into character spans: no offsets
are asked of the tokenizer. Spans of tokens and of sections are both in order, so their
interval join is one binary search for each token's two ends.

What lies between two sections belongs to the earlier one, what lies before the first to the
first, so every token is allocated and counts add up. A token that crosses a boundary is
allocated by ``rule``: ``first`` (to the section of its first character), ``last``, or
``most`` (to the section with most of its characters, the earliest of equals).

Null and empty texts have no tokens and one empty section. Empty sections have no tokens
under ``first`` and ``last`` unless a token starts or ends there. Equal texts get equal
counts; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches

RULES = ("first", "last", "most")
#: Fixed value: how byte-level vocabularies of this kind cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(vocabulary: str, pattern: str = PATTERN) -> tuple[Callable[[str], list[int]], np.ndarray]:
    """(text to ids, with special strings as ordinary text; each id's length in bytes)."""
    import tiktoken

    with open(vocabulary, "rb") as f:  # a vocabulary file on each machine, not a table
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, i in ranks.items():
        lengths[i] = len(piece)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, lengths


def spans(text: str, ids: list[int], lengths: np.ndarray) -> np.ndarray:
    """[token, (start, end)] in code points; tokens that share a character overlap there."""
    ends = np.cumsum(lengths[ids])
    if text.isascii():
        return np.stack([ends - lengths[ids], ends], axis=1)
    place = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
    return np.stack([place[ends - lengths[ids]], place[ends - 1] + 1], axis=1)


def line_starts(text: str) -> np.ndarray:
    """Where the text's lines start; a line feed belongs to the line that it ends."""
    starts, at = [0], text.find("\n")
    while at >= 0 and at + 1 < len(text):
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(starts)


def allocate(tokens: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary)."""
    if not len(tokens):
        return np.zeros(len(starts), np.int64), 0
    bounds = starts[1:]
    first, last = np.searchsorted(bounds, tokens[:, 0], "right"), np.searchsorted(bounds, tokens[:, 1] - 1, "right")
    crossing = np.flatnonzero(first != last)
    chosen = last.copy() if rule == "last" else first
    if rule == "most":
        for t in crossing.tolist():
            edges = np.concatenate([tokens[t, :1], bounds[first[t] : last[t]], tokens[t, 1:]])
            chosen[t] = first[t] + int(np.argmax(np.diff(edges)))
    return np.bincount(chosen, minlength=len(starts)), len(crossing)


def assembled(fields: list[str], between: str = "\n") -> tuple[Column, Column]:
    """(text, section starts) of documents whose sections are these columns, joined; null: empty."""
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    upto = [reduce(lambda a, b: a + b, [F.length(p) + len(between) for p in parts[:k]], F.lit(0)) for k in range(len(parts))]
    return F.concat_ws(between, *parts), F.array(*upto)


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", starts: str | None = None, rule: str = "most", pattern: str = PATTERN) -> DataFrame:
    """Rows (key, n_tokens, n_sections, section_tokens, n_crossing).

    ``starts`` names a column of ascending section starts, as from ``assembled``; without it,
    or where it is null or empty, sections are lines.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    given = docs.select(key, text, F.col(starts).cast("array<long>").alias("__starts")) if starts else docs.select(key, text)
    return map_batches(given, partial(_maker, vocabulary, pattern, rule, key), f"`{key}` {dict(docs.dtypes)[key]}, n_tokens long, n_sections long, section_tokens array<long>, n_crossing long")


def _maker(vocabulary: str, pattern: str, rule: str, key: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    encode, lengths = encoder(vocabulary, pattern)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        given = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(texts)
        counts, n_tokens, crossing = [], [], []
        for t, s in zip(texts, given, strict=True):
            ids = encode(t)
            count, crossed = allocate(spans(t, ids, lengths), np.array(s) if s else line_starts(t), rule)
            counts.append(count), n_tokens.append(len(ids)), crossing.append(crossed)
        ends = np.cumsum([0] + [len(c) for c in counts])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(counts), pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(np.diff(ends), pa.int64()), lists, pa.array(crossing, pa.int64())], names=[key, "n_tokens", "n_sections", "section_tokens", "n_crossing"])

    return work
