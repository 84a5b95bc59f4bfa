import re

import corpus_pipeline
from test_decontaminate import brute as contained
from test_near_join import brute as near
from test_secret_scan import brute as secrets

from millrace.llm import toxicity
from millrace.llm.piece_codec import PieceCodec
from millrace.llm.queries import QUERIES
from millrace.llm.vocabularies import vocabulary


def test_stages_against_brute_force(spark, sf, tmp_path):
    """Each stage on what its predecessor kept, written and read again."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before) and (k == 4 or out.columns == columns)
        if name == "toxicity":
            model = toxicity.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            ids = sorted(before)
            scores = model.scorer()([before[i].text for i in ids])
            assert set(after) == {i for i, s in zip(ids, scores, strict=True) if s < toxicity.THRESHOLD}
        elif name == "ngram_jaccard_join":
            groups = near([(r.doc_id, r.text) for r in before.values()])
            assert set(after) == {i for i, (c, _) in groups.items() if c == i}
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert set(after) == set(before) - {d for d, *_ in contained([(r.doc_id, r.text) for r in before.values()], items)}
        elif name == "secret_scans":
            assert set(after) == set(before)
            for i, r in after.items():
                assert secrets(r.text)[1] == "" and r.n_chars == len(r.text)
                assert (r.text != before[i].text) == bool(secrets(before[i].text)[1]) or re.search("eyJ|-----BEGIN", before[i].text)
        else:
            codec = PieceCodec.load(vocabulary("piece_bpe_32k.model"))
            assert set(after) == set(before) and all(r.ids == codec.encode(before[i].text) and r.round_trip for i, r in after.items())
        docs, before = out, after
    whole = {r.doc_id: r.ids for r in QUERIES["pipeline"](spark, sf).collect()}
    assert whole == {i: r.ids for i, r in before.items()}


def test_empty_tables(spark, tmp_path):
    """No documents, no labels and no benchmark items: every stage passes, and nothing comes out."""
    made = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, schema in made.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
