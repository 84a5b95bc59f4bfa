import random

import sentencepiece
from helpers import ODD, no_documents, odd_documents

from millrace.llm.piece_codec import MARK, PieceCodec, encode_documents
from millrace.llm.vocabularies import vocabulary

FILE = vocabulary("piece_bpe_32k.model")
TEXTS = [t for t in ODD if t is not None and len(t) < 1000] + [" ", "a", " a", "a  b", "a\nb\n", "  x   y ", "e\u0301", "\u200b</s><s>", f"{MARK}a{MARK}{MARK}b", "=====----####", "aaaaaaaaaaaaaaaaaaaaaaa", "tab\t\ttab\r\n"]


def test_ids_equal_the_library(spark, sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=FILE)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    codec = PieceCodec.load(FILE)
    ids, ends = codec.encode_batch(texts)
    for k, t in enumerate(texts):
        own = ids[ends[k] : ends[k + 1]].tolist()
        assert own == sp.encode(t) and codec.decode(own) == sp.decode(own) == t.replace(MARK, " ")


def test_unigram_scores_are_maximal():
    pieces = ["<unk>", MARK, "a", "b", "ab", MARK + "a", "ba", "aba", MARK + "ab"]
    scores = [0, -3.0, -2.0, -2.5, -3.5, -4.0, -2.2, -5.5, -6.0]
    codec = PieceCodec(pieces, scores, None, 0, False, frozenset([0]))
    rng = random.Random(1)

    def best(word):
        top = {0: 0.0}
        for i in range(1, len(word) + 1):
            top[i] = max(top[j] + (scores[codec.ids[word[j:i]]] if word[j:i] in codec.ids else codec.floor if i - j == 1 else -1e9) for j in range(i))
        return top[len(word)]

    for _ in range(100):
        t = "".join(rng.choices("ab ab x", k=rng.randint(1, 12)))
        ids = codec.encode(t)
        want = sum(best(u.replace(" ", MARK)) for u in codec.units(t))
        got = sum(scores[i] if i else codec.floor for i in ids)
        assert abs(got - want) < 1e-9


def test_unigram_ids_equal_the_library(spark, sf, tmp_path):
    """A unigram model put together from stated pieces and scores, not trained, in the library's own format."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    rng = random.Random(12)
    words = " ".join(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()).split()[:20_000]
    parts = sorted({w[a : a + n] for w in rng.sample(words, 1500) for a in range(len(w)) for n in (1, 2, 3, 4)} | {MARK + w[:n] for w in rng.sample(words, 500) for n in (1, 3, 5)})
    parts = [p for p in parts if p.isalpha() or p[0] == MARK]
    for fallback in (False, True):
        model = proto.ModelProto()
        model.trainer_spec.model_type, model.trainer_spec.byte_fallback, model.trainer_spec.unk_id = 1, fallback, 0
        model.normalizer_spec.name, model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.add_dummy_prefix = "identity", False, True
        kinds = [("<unk>", 2), ("<s>", 3), ("</s>", 3), *((f"<0x{b:02X}>", 6) for b in range(256 if fallback else 0)), (MARK, 1), *((p, 1) for p in parts if p != MARK)]
        for piece, kind in kinds:
            row = model.pieces.add()
            row.piece, row.type, row.score = piece, kind, 0.0 if kind != 1 else -rng.uniform(2, 12)
        path = tmp_path / f"unigram{fallback}.model"
        path.write_bytes(model.SerializeToString())
        sp, codec = sentencepiece.SentencePieceProcessor(model_file=str(path)), PieceCodec.load(str(path))
        texts = [t for t in TEXTS if t.strip()] + [" ".join(words[k : k + 25]) for k in range(0, 10_000, 25)]
        for t in texts:
            want, got = sp.encode(t), codec.encode(t)
            if got != want:  # the library joins unknown characters to one id, and equal sums may be split either way
                total = lambda ids: sum(model.pieces[i].score if model.pieces[i].type == 1 else codec.floor for i in ids)
                squeeze = lambda ids: [i for k, i in enumerate(ids) if i or not k or ids[k - 1]]
                assert squeeze(got) == squeeze(want) or abs(total(got) - total(want)) < 1e-4, t
            assert not fallback or codec.decode(got) == t.replace(MARK, " ")


def test_cache_limits_change_nothing(monkeypatch):
    from millrace.llm import piece_codec

    whole = [PieceCodec.load(FILE).encode(t) for t in TEXTS]
    monkeypatch.setattr(piece_codec, "UNIT_CACHE", 3)
    monkeypatch.setattr(piece_codec, "PAIR_CACHE", 5)
    small = PieceCodec.load(FILE)
    assert [small.encode(t) for t in TEXTS] == whole
    monkeypatch.setattr(piece_codec, "UNIT_CACHE", 10**6)
    monkeypatch.setattr(piece_codec, "UNIT_CHARS", 20)
    small = PieceCodec.load(FILE)
    assert [small.encode(t) for t in TEXTS] == whole and small.held <= max(20, *map(len, TEXTS)) + 2


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = encode_documents(docs, FILE).collect()
    assert len(rows) == docs.count() and all(r.round_trip and r.n_ids == len(r.ids) for r in rows)
    assert {r.doc_id: r.n_ids for r in rows}[0] == 0
    assert encode_documents(no_documents(spark), FILE).count() == 0
