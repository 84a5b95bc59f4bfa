"""SentencePiece encoding and decoding over a trie of marked words.

A text is cut where no piece can cross: before a run of blanks, and around characters of no
longer piece, such as line feeds. The distinct units of a batch, with blanks marked, are
sorted, so that walking them in order is a depth-first traversal of their trie: for each
unit the forward states of the prefix it shares with the one before stand already.

The forward state of a prefix is, for unigram models, the best score and its last piece
(Viterbi). For models of merges, whose scores are ranks, the sum of scores doesn't give the
model's ids; there the state is the last piece of the prefix's own encoding. That piece is
the one suffix which the encoding before it can stand beside without a merge across, since
a row of pieces is an encoding exactly if each two neighbours are. Both kinds give the ids
of the public library for such models, byte fallback included.

Null and empty texts have no ids and decode to the empty text. A text's U+2581 counts as a
blank, as in the models themselves. Equal texts get equal ids; an empty table gives an empty
result; other columns are left alone. Models with a character map of their own are refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.batches import map_batches

MARK = "▁"
#: Units, characters of units, and neighbour pairs that a task remembers before it starts afresh.
UNIT_CACHE = 900_000
UNIT_CHARS = 16 << 20
PAIR_CACHE = 1_000_000


class PieceCodec:
    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int] | None, unknown: int, merges: bool, skip: frozenset[int] = frozenset(), dummy_prefix: bool = True):
        self.ids = {p: i for i, p in enumerate(pieces) if i not in skip}
        self.scores, self.byte_ids, self.unknown, self.merges, self.dummy = scores, byte_ids, unknown, merges, dummy_prefix
        #: Every ending of a piece, and whether it is a piece: a walk back from a prefix's end stops at the first string that is none.
        self.endings = {p[k:]: p[k:] in self.ids for p in self.ids for k in range(len(p))}
        self.floor = min((scores[i] for i in self.ids.values()), default=0.0) - 10
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with blanks inside are not supported")
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        self.cut = re.compile(f" *[^ {alone}]+| +|[{alone}]" if alone else " *[^ ]+| +")
        self.bytes_of = [p.replace(MARK, " ").encode() for p in pieces]
        for i in skip:
            self.bytes_of[i] = b""
        for value, i in enumerate(byte_ids or ()):
            self.bytes_of[i] = bytes([value])
        self.cache: dict[str, bytes] = {}
        self.held = 0
        self.codes: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    @classmethod
    def load(cls, model_file: str) -> PieceCodec:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_file, "rb") as f:  # a vocabulary file on each machine, not a table
            model.ParseFromString(f.read())
        rule, kind = model.normalizer_spec, model.trainer_spec.model_type
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces or kind not in (1, 2):
            raise ValueError("only unigram and merge models that keep the text as it is are supported")
        by_type: dict[int, list[int]] = {}
        for i, p in enumerate(model.pieces):
            by_type.setdefault(p.type, []).append(i)
        raw = sorted((int(model.pieces[i].piece[3:5], 16), i) for i in by_type.get(6, ()))
        skip = frozenset(i for t in (2, 3, 5, 6) for i in by_type.get(t, ()))
        return cls([p.piece for p in model.pieces], [p.score for p in model.pieces], [i for _, i in raw] if len(raw) == 256 else None, model.trainer_spec.unk_id, kind == 2, skip, rule.add_dummy_prefix)

    def units(self, text: str) -> list[str]:
        """The text's units, blanks unmarked."""
        if not text:
            return []
        return self.cut.findall((" " if self.dummy else "") + text.replace(MARK, " "))

    def encode_units(self, units: set[str]) -> None:
        """Fills the cache for distinct units by one depth-first walk of their trie."""
        word, last, back, best = "", [None], [0], [0.0]
        extend = self._extend_merges if self.merges else self._extend_scores
        for unit in sorted(units):
            marked = unit.replace(" ", MARK)
            same = 0
            for a, b in zip(word, marked):  # noqa: B905
                if a != b:
                    break
                same += 1
            del last[same + 1 :], back[same + 1 :], best[same + 1 :]
            word = marked
            extend(word, same, last, back, best)
            out, i = [], len(marked)
            while i:
                out.append(self.coded(last[i]))
                i = back[i]
            out.reverse()
            self.cache[unit] = b"".join(out)

    def coded(self, piece: str) -> bytes:
        """A piece's ids as int32 bytes: its own, or those of its bytes, or the unknown one."""
        found = self.codes.get(piece)
        if found is None:
            found = self.codes[piece] = np.array(self._piece_ids(piece), np.int32).tobytes()
        return found

    def _piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        return [self.byte_ids[b] for b in piece.encode()] if self.byte_ids else [self.unknown]

    def _extend_scores(self, word: str, start: int, last: list, back: list, best: list) -> None:
        """Forward states of the word's prefixes from ``start`` on, by best sums of scores."""
        for i in range(start + 1, len(word) + 1):
            k = self.ids.get(word[i - 1])
            top, at = best[i - 1] + (self.floor if k is None else self.scores[k]), i - 1
            for j in range(i - 2, -1, -1):
                whole = self.endings.get(word[j:i])
                if whole is None:
                    break
                if whole and (score := best[j] + self.scores[self.ids[word[j:i]]]) > top:
                    top, at = score, j
            last.append(word[at:i]), back.append(at), best.append(top)

    def _extend_merges(self, word: str, start: int, last: list, back: list, best: list) -> None:
        """The same by the one last piece that no merge would join across."""
        endings, pairs = self.endings.get, self.pairs
        for i in range(start + 1, len(word) + 1):
            j = i - 1
            while j >= 0:
                piece = word[j:i]
                whole = endings(piece)
                if whole or j == i - 1:
                    before = last[j]
                    good = pairs.get((before, piece))
                    if good is None:
                        good = self._beside(before, piece)
                    if good:
                        last.append(piece), back.append(j), best.append(0.0)
                        break
                elif whole is None:
                    raise AssertionError("a prefix has no encoding")
                j -= 1
            else:
                raise AssertionError("a prefix has no encoding")

    def _beside(self, before: str | None, piece: str) -> bool:
        """Whether two pieces, the first of which may be none, are their joined text's encoding."""
        if len(self.pairs) >= PAIR_CACHE:
            self.pairs.clear()
        parts = [p for p in (before, piece) if p]
        good = self.pairs[before, piece] = self.merged("".join(parts)) == parts
        return good

    def merged(self, word: str) -> list[str]:
        """The encoding of a short word by the definition: of all neighbours that join to a piece, the best first, the leftmost of equals."""
        parts = list(word)
        while True:
            top, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (top is None or self.scores[i] > top):
                    top, at = self.scores[i], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as int32, where each text's ids end)."""
        cut = [self.units(t or "") for t in texts]
        new = {u for us in cut for u in us if u not in self.cache}
        more = sum(map(len, new))
        if len(self.cache) + len(new) > UNIT_CACHE or self.held + more > UNIT_CHARS:
            self.cache.clear(), self.codes.clear()
            new = {u for us in cut for u in us}
            self.held, more = 0, sum(map(len, new))
        self.held += more
        self.encode_units(new)
        parts = [b"".join(map(self.cache.__getitem__, us)) for us in cut]
        return np.frombuffer(b"".join(parts), np.int32), np.cumsum([0] + [len(p) // 4 for p in parts])

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace")
        return raw[1:] if self.dummy and raw[:1] == " " else raw


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    return PieceCodec.load(model_file)


def encode_documents(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_ids, ids, decoded_sha256, round_trip): every whole text's ids, and what they decode to.

    ``round_trip`` tells whether that is the text itself (null: empty; U+2581 as a blank).
    """

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        own = codec(model_file)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, ends = own.encode_batch(texts)
            said = [own.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            sha = [hashlib.sha256(s.encode()).hexdigest() for s in said]
            same = [s == t.replace(MARK, " ") for s, t in zip(said, texts, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends), pa.int64()), lists, pa.array(sha), pa.array(same)], names=[key, "n_ids", "ids", "decoded_sha256", "round_trip"])

        return work

    return map_batches(docs.select(key, text), make, f"`{key}` {dict(docs.dtypes)[key]}, n_ids long, ids array<int>, decoded_sha256 string, round_trip boolean")
