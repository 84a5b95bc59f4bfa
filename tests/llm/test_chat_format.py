import hashlib
import json
import os

import duckdb
import pytest
from helpers import ODD
from pyspark.sql import functions as F

from millrace.llm import chat_format as C
from millrace.llm.queries import ORACLES, QUERIES

LAYOUTS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, "messages", [("user", "a"), ("assistant", "b")]),
    ({"id": 5, "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, "share_id", [("user", "a"), ("assistant", "")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "response": "r", "system": "s"}, "system_prompt", [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "response": "r", "system": None}, "system_prompt", [("user", "p"), ("assistant", "r")]),
    ({"question": 1, "answer": 2.5}, "question", [("user", "1"), ("assistant", "2.5")]),
]


def test_layouts(spark):
    rows = [(str(k), json.dumps(r), "x") for k, (r, _, _) in enumerate(LAYOUTS)]
    turns = C.canonical_turns(spark.createDataFrame(rows, "key string, record string, layout string"), "record", "key").orderBy("conv_id", "place").collect()
    for k, (_, layout, want) in enumerate(LAYOUTS):
        own = [t for t in turns if t.conv_id == str(k)]
        assert {t.layout for t in own} == {layout} and [(t.role, t.text) for t in own] == want


def test_fingerprint_is_of_paths_alone(spark):
    records = ['{"a":1,"b":[{"c":"x"}]}', '{"b":[{"c":2},{"c":null}],"a":"y"}', '{"a":1,"b":[{"d":1}]}', '[1]', "no json", None, "{}"]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in records], "r string").select(C.fingerprint(F.col("r"))).collect()]
    assert got[0] == got[1] != got[2] and got[3] is got[4] is got[5] is None and got[6]


def test_unknown_layouts_are_told(spark):
    df = spark.createDataFrame([("1", '{"what": 1}'), ("2", None)], "key string, record string")
    assert [(t.conv_id, t.layout) for t in C.canonical_turns(df, "record", "key").orderBy("conv_id").collect()] == [("1", None), ("2", None)]


def test_other_fields_and_parts(spark):
    """Records that differ from a layout in what doesn't matter keep their text."""
    cases = [
        ({"messages": [{"role": "user", "content": "a", "name": "n"}, {"role": "assistant", "content": "b"}]}, "messages", [("user", "a"), ("assistant", "b")], ["messages[].name"]),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a "}, {"type": "image", "url": "u"}, {"type": "text", "text": "b"}]}]}, "messages", [("user", 'a {"type":"image","url":"u"}b')], ["messages[].content[].text", "messages[].content[].type", "messages[].content[].url"]),
        ({"messages": [{"role": "user", "content": [{"text": "a"}]}, {"role": "assistant", "content": "b", "x": {"y": 1}}], "system": "s"}, "messages", [("system", "s"), ("user", "a"), ("assistant", "b")], ["messages[].x", "messages[].x.y"]),
        ({"prompt": "p", "completion": "c", "source": "web"}, "prompt", [("user", "p"), ("assistant", "c")], ["source"]),
        ({"id": 9, "question": "q", "context": "k", "answer": "a", "text": "t"}, "question", [("user", "k\n\nq"), ("assistant", "a")], ["text"]),
        ({"conversations": [{"value": "v"}], "a b": 1, "c`:<d>": [[{"e": 2}]]}, "share", [("", "v")], None),
    ]
    rows = [(str(k), json.dumps(r, separators=(",", ":"))) for k, (r, *_) in enumerate(cases)]
    turns = C.canonical_turns(spark.createDataFrame(rows, "key string, record string"), "record", "key").orderBy("conv_id", "place").collect()
    for k, (_, layout, want, unmapped) in enumerate(cases):
        own = [t for t in turns if t.conv_id == str(k)]
        assert {t.layout for t in own} == {layout} and [(t.role, t.text) for t in own] == want
        assert unmapped is None or all(t.unmapped == unmapped and t.record is None for t in own)


def test_records_of_no_layout_are_kept_whole(spark):
    texts = ['{"what": 1}', None, "no json", "[1]", "{}", '{"messages": "a text"}', '{"messages": ["a", "b"]}', '{"messages": null}', '{"prompt": "p", "messages": []}', '{"prompt": "p"}']
    fine = ['{"messages": []}', '{"messages": [{"role": "user", "content": "a"}]}']
    df = spark.createDataFrame([(str(k), t, "x") for k, t in enumerate([*texts, *fine])], "key string, record string, fingerprint string")
    turns = C.canonical_turns(df, "record", "key").cache()
    kept = {r.key: r for r in C.unknown_records(turns).collect()}
    assert {k: r.record for k, r in kept.items()} == {str(k): t for k, t in enumerate(texts)}
    assert all((kept[str(k)].fingerprint is None) == (t in (None, "no json", "[1]")) for k, t in enumerate(texts))
    assert [(r.conv_id, r.formatted) for r in C.format_conversations(turns).select("conv_id", "formatted").collect()] == [("11", "<|turn|>user<|text|>a<|end|>")]


def test_records_without_a_key(spark):
    records = ['{"id": 4, "messages": [{"role": "user", "content": "a"}]}', '{"prompt": "p", "response": "r"}', '{"conv_id": null, "turn": 1, "role": "user", "text": "t"}']
    got = C.format_conversations(C.canonical_turns(spark.createDataFrame([(r,) for r in records], "record string"), "record")).collect()
    assert {r.conv_id for r in got} == {"4", "sha256:" + hashlib.sha256(records[1].encode()).hexdigest(), None}


def test_escape_round_trip(spark):
    texts = [t for t in ODD if t is not None] + list(C.CONTROL) + ["".join(C.CONTROL) * 2, "<<s>>[[INST]]", "<\\s>", "\\\\<s>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u"))
    for r in df.collect():
        assert r.u == r.t and not any(c in r.e for c in C.CONTROL)


def test_formatted_reads_back(spark):
    rows = [(str(k % 5), k, "assistant" if k % 2 else "user", t) for k, t in enumerate(ODD * 2)] + [("9", 0, None, "x"), ("9", 0, "assistant", "tie"), ("9", 0, "assistant", "tie")]
    turns = spark.createDataFrame(rows, "conv_id string, place long, role string, text string").na.fill("")
    read = C.format_conversations(turns).select("conv_id", C.read_back(F.col("formatted")).alias("t"), C.masked_text(F.col("formatted"), F.col("loss_mask")).alias("m"), F.length("formatted").alias("n"))
    for r in read.collect():
        own = sorted((p, role or "", t or "") for c, p, role, t in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.t] == [(role, t) for _, role, t in own]
        assert r.m == "".join(t for _, role, t in own if role == "assistant")


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    path = f"{sf}/conversations.parquet"
    con.execute(f"create view conversations as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    cursor = con.execute(ORACLES["op1_chat_format"])
    names = [d[0] for d in cursor.description]
    want = {r[0]: dict(zip(names, r, strict=True)) for r in cursor.fetchall()}
    got = {r.conv_id: r.asDict() for r in QUERIES["op1_chat_format"](spark, sf).collect()}
    assert got == want
    text = "</s>[INST] ok [/INST]"
    assert got[-7]["n_turns"] == 2 and got[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[-7]["loss_chars"] == len(text)


@pytest.mark.parametrize("layout", [m.name for m in C.MAPPINGS])
def test_mappings_differ(layout):
    prints = [m.fingerprint for m in C.MAPPINGS]
    assert len(set(prints)) == len(prints)


def test_empty(spark):
    nothing = C.canonical_turns(spark.createDataFrame([], "key string, record string"), "record", "key")
    assert C.format_conversations(nothing).count() == 0
