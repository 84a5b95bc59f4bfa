import hashlib
import random
import re

import pytest
from helpers import no_documents, odd_documents

from millrace.llm import secret_scan as S
from millrace.llm.queries import QUERIES
from millrace.llm.scratch import shared_folder

KEY = "AKIA" + "ABCDEFGHIJ0123456789"
TEXTS = [
    'password = "abcdefghijkl" and token: short', "secret=token: abcdefghijklmnop", "API_KEY:'0123456789abcdef0'", "pasſwd=abcdefghijklm ToKen=abcdefghijklm", f"{KEY} {KEY[:17]} AKIAAKIA{KEY}", "0123456789abcdef0123456789ABCDEF deadbeefdeadbeef g00000000000000000",
    "é🙂 token=éabcdefghijklm token=abcdefghijklm", "secret secret = = abcdefghijklmn", "apikey  :  abcdefghijklmno\napi_key\n=abcdefghijklmno", "token=" + "a" * 100_000,
]


def brute(text):
    """The rules as they are stated, every match first and the check after."""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.IGNORECASE | re.ASCII):
        if len(m.group(2)) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    kinds = ("assign", "access", "hex")
    return [sum(k == i for _, k, _ in found) for i in range(3)], ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found))


def check(rows, texts):
    for r in rows:
        counts, spans = brute(texts[r.doc_id] or "")
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))


def test_against_brute_force(spark):
    rng = random.Random(3)
    pieces = ["token", "secret", "api", "_", "key", "=", ":", " ", '"', "'", "abcdef012345", "AKIA", "QWERTYUIOP12", "deadbeef", "é", "\n", "-", "password"]
    texts = dict(enumerate([*TEXTS, *("".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(400))]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = S.scan_paths(df, "doc_id").collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op10_secret_scan"](spark, sf)
    assert out.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    rows = out.collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_ledger_scans_only_what_is_new(spark):
    first = spark.createDataFrame([(1, TEXTS[0]), (2, TEXTS[0]), (3, TEXTS[2])], "doc_id long, text string")
    later = spark.createDataFrame([(4, TEXTS[0]), (5, TEXTS[4]), (6, TEXTS[4])], "doc_id long, text string")
    ledger = S.unseen_findings(first).cache()
    assert ledger.count() == 2
    new = S.unseen_findings(later, ledger)
    assert [r.blob for r in new.collect()] == [hashlib.sha256(TEXTS[4].encode()).hexdigest()]
    rows = S.scan_paths(later, "doc_id", ledger).collect()
    assert len(rows) == 3
    check(rows, {4: TEXTS[0], 5: TEXTS[4], 6: TEXTS[4]})
    other = S.RULES[:1]
    assert S.rule_version(other) != S.rule_version() and S.unseen_findings(first, ledger, other).count() == 2


def test_stored_ledger_over_versions_and_rules(spark, tmp_path, monkeypatch):
    """Three versions of a history, two rule versions, and a later run on the same folder; every pair is scanned once."""
    scanned = []
    whole = S.scan_blobs
    monkeypatch.setattr(S, "scan_blobs", lambda blobs, rules=S.RULES: scanned.append(sorted(r.blob for r in blobs.select("blob").collect())) or whole(blobs, rules))
    blob = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    versions = [[("a", TEXTS[0]), ("b", TEXTS[0]), ("c", None)], [("a", TEXTS[2]), ("b", TEXTS[0]), ("d", "")], [("a", TEXTS[0]), ("d", TEXTS[4]), (None, TEXTS[4])]]
    frames = [spark.createDataFrame(v, "path string, text string") for v in versions]
    folder, known = str(tmp_path / "ledger"), set()
    for k, (frame, rows) in enumerate(zip(frames, versions, strict=True)):
        S.Ledger(spark, folder).update(frame)
        fresh = {blob(t) for _, t in rows} - known
        assert scanned[k] == sorted(fresh)
        known |= fresh
    ledger = S.Ledger(spark, folder)
    ledger.update(frames[2])
    ledger.update(frames[0], S.RULES[:1])
    assert scanned[3:] == [[], sorted({blob(t) for _, t in versions[0]})]
    for frame, rows in zip(frames, versions, strict=True):
        got = ledger.findings(frame, "path").collect()
        assert sorted((r.path or "", r.blob) for r in got) == sorted((p or "", blob(t)) for p, t in rows)
        for r in got:
            text = next(t for _, t in rows if blob(t) == r.blob)
            counts, spans = brute(text or "")
            assert [r.n_assign, r.n_access, r.n_hex] == counts and r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert ledger.rows().count() == len(known) and ledger.rows(S.RULES[:1]).count() == 2


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_redaction(spark):
    df = odd_documents(spark, [TEXTS[0], "x token=abcdef0123456789abcdef y " + KEY, TEXTS[6]])
    out = S.redact(df)
    assert out.columns == df.columns and out.count() == df.count()
    n = df.count() - 4
    got = {r.doc_id: r for r in out.collect()}
    assert got[n].text == "[SECRET]\" and token: short" or got[n].text.startswith("[SECRET]")
    assert got[n + 1].text == "x [SECRET] y [SECRET]" and got[n + 1].n_chars == len(got[n + 1].text)
    assert got[0].text is None and got[10].text == "x" * 200_000
    assert S.scan_paths(out, "doc_id").where("spans <> ''").count() == 0


def test_odd_rows(spark):
    df = odd_documents(spark)
    assert S.scan_paths(df, "doc_id").count() == df.count()
    assert S.scan_paths(no_documents(spark), "doc_id").count() == 0 and S.redact(no_documents(spark)).count() == 0
