import random
import zlib

import numpy as np
from helpers import SCHEMA, no_documents, odd_documents

from millrace.llm import toxicity as X
from millrace.llm.queries import QUERIES


def made(n, seed=3):
    rng = random.Random(seed)
    parts = ["ka", "mo", "lin", "ter", "sa", "ve", "dor", "un"]
    docs = []
    for k in range(n):
        ws = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 120))]
        toxic = int(k % 8 == 0)
        for _ in range(4 * toxic):
            ws.insert(rng.randrange(len(ws)), "zrax" + rng.choice(parts))
        docs.append((k, " ".join(ws), toxic))
    return docs


def test_held_out_accuracy():
    docs = made(1200)
    learn = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2]
    test = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 4 == 2]
    model = X.fit(learn, np.mean([d[2] for d in learn]))
    found = model.scorer()([d[1] for d in test]) >= X.THRESHOLD
    right = np.array([d[2] for d in test]) == 1
    assert (found & right).sum() >= 0.9 * right.sum() and (found & ~right).sum() <= 0.05 * (~right).sum()


def test_windows_hold_every_word():
    ws = X.words("a bb  ccc\n" * 100 + "Ü")
    assert b"".join(X.windows(ws, 17)).split() == ws and X.windows([]) == []


def test_labels_ids_and_order_are_no_input(spark):
    docs = made(300)
    model = X.fit(docs, 0.125)
    again = X.fit(docs[::-1], 0.125)
    texts = [d[1] for d in docs[:40]]
    assert np.allclose(model.scorer()(texts), again.scorer()(texts))


def test_odd_rows_and_the_held_out_rule(spark):
    docs = odd_documents(spark, [d[1] for d in made(200)])
    labels = spark.createDataFrame([(k, int(k % 8 == 6)) for k in range(250)] + [(3, None), (None, 1), (14, 0)], "doc_id long, toxic int")
    model = X.learn(docs, labels)
    out = X.score(docs, model, into=("__s", "__p")).select("doc_id", X.held_out("doc_id").alias("h"), "__s", "__p").collect()
    assert len(out) == docs.count() and all(0 <= r["__s"] <= 1 and r["__p"] == int(r["__s"] >= 0.3) for r in out)
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    same = [r["__s"] for r in out if r.doc_id in (7, 8)]
    assert same[0] == same[1]
    kept = X.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["__p"] == 0 for r in out)


def test_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in X.score(odd_documents(spark).drop("score"), X.learn(odd_documents(spark), labels)).select("score").collect()} == {0.0}
    assert X.drop_toxic(no_documents(spark), labels).count() == 0
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert X.drop_toxic(odd_documents(spark), one).columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_query(spark, sf):
    out = QUERIES["op2_toxicity"](spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
