import base64

import numpy as np
import pytest
import tiktoken
from helpers import ODD, no_documents, odd_documents
from pyspark.sql import functions as F

from millrace.llm import token_counts as K
from millrace.llm.vocabularies import vocabulary

FILE = vocabulary("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=K.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(plain, text, starts, rule):
    """Each token's characters one by one."""
    owner, at = [], 0
    sections = [int(np.searchsorted(starts[1:], c, "right")) for c in range(len(text))]
    of_byte = [k for k, c in enumerate(text) for _ in c.encode()]
    for i in plain.encode_ordinary(text):
        n = len(plain.decode_single_token_bytes(i))
        chars = range(of_byte[at], of_byte[at + n - 1] + 1)
        at += n
        mine = [sections[c] for c in chars]
        owner.append(mine[0] if rule == "first" else mine[-1] if rule == "last" else max(sorted(set(mine)), key=mine.count))
    return [owner.count(k) for k in range(len(starts))]


@pytest.mark.parametrize("rule", K.RULES)
def test_against_brute_force(spark, plain, rule):
    texts = [t for t in ODD if t is None or len(t) < 1000] + ["a\n\n\nb  \n  c\n", "\n", "line one\r\nline two", "🙂🙂\n🙂"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in K.token_counts(df, FILE, rule=rule).collect():
        t = texts[r.doc_id] or ""
        starts = np.array([0] + [k + 1 for k, c in enumerate(t) if c == "\n" and k + 1 < len(t)])
        assert r.section_tokens == brute(plain, t, starts, rule) and sum(r.section_tokens) == r.n_tokens == len(plain.encode_ordinary(t)) and r.n_sections == len(starts)


def test_given_sections(spark, plain):
    df = spark.createDataFrame([(1, "head", "some body"), (2, None, ""), (3, "é", "xy")], "doc_id long, a string, b string")
    text, starts = K.assembled(["a", "b"])
    rows = K.token_counts(df.select("doc_id", text.alias("text"), starts.alias("s")), FILE, starts="s").collect()
    assert [r.n_sections for r in rows] == [2, 2, 2] and all(sum(r.section_tokens) == r.n_tokens for r in rows)


def test_odd_rows(spark, plain):
    rows = {r.doc_id: r for r in K.token_counts(odd_documents(spark), FILE).collect()}
    assert len(rows) == len(ODD) + 1 and rows[0].section_tokens == [0] and rows[11].n_tokens == len(plain.encode_ordinary(ODD[11]))
    assert K.token_counts(no_documents(spark), FILE).count() == 0
    with pytest.raises(ValueError, match="rule"):
        K.token_counts(odd_documents(spark), FILE, rule="other")


def test_spans_cover_the_text(plain):
    encode, lengths = K.encoder(FILE)
    for t in ODD[1:10]:
        s = K.spans(t, encode(t), lengths)
        assert not len(s) or (s[0, 0] == 0 and s[-1, 1] == len(t) and (s[1:, 0] <= s[:-1, 1]).all())
