"""Chat formatting: fingerprints, layouts, the template's round trip and the query."""
import hashlib
import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trafficwatch.llm import chat_format as cf
from trafficwatch.llm.base import table

TURNS = "conv_id long, turn long, role string, text string"

RECORDS = [
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": None}, {"content": "a", "role": "assistant"}]},
     "messages", [("system", "s"), ("user", ""), ("assistant", "a")]),
    ({"messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]},
     "conversations", [("user", "q"), ("assistant", "a"), ("tool", "t")]),
    ({"id": 7, "conversations": [{"from": "gpt", "value": "a"}]}, "conversations", [("assistant", "a")]),
    ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"completion": "c", "prompt": "p", "system": "s"}, "prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"prompt": None, "response": 5}, "prompt_response", [("user", ""), ("assistant", "5")]),
    ({"instruction": "i", "input": "more", "output": "o"}, "instruction", [("user", "i\n\nmore"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"text": "unknown"}, None, None), ([1, 2], None, None), ("plain", None, None), ({"messages": "text"}, None, None),
]


def records(spark, values):
    rows = [(i, None if v is None else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, json string").select("id", F.parse_json("json").alias("record"))


def test_layouts_are_chosen_by_fingerprint(spark):
    found = cf.canonical_turns(records(spark, [r for r, _, _ in RECORDS] + [None])).orderBy("id").collect()
    for row, (_, layout, turns) in zip(found, RECORDS):
        assert row.layout == layout
        assert (None if row.turns is None else [tuple(t) for t in row.turns]) == turns
    assert (found[-1].layout, found[-1].turns) == (None, None) and len(found) == len(RECORDS) + 1


def test_fingerprints_hash_paths_not_values(spark):
    same = [{"a": 1, "b": [{"c": "x"}]}, {"b": [{"c": None}, {"c": 2.5}], "a": "DECIMAL"}, {"a": None, "b": [{"c": True}]}]
    other = [{"a": 1, "b": [{"d": "x"}]}, {"a": 1, "b": {"c": "x"}}, {"a": {"c": 1}, "b": [{"c": 1}]}]
    prints = [r[0] for r in records(spark, same + other).orderBy("id").select(cf.fingerprint("record")).collect()]
    assert len(set(prints[:3])) == 1 and len(set(prints)) == 4
    paths = records(spark, same).select(cf.field_paths("record").alias("p")).first().p
    assert prints[0] == hashlib.sha256(paths.encode()).hexdigest() and paths == "OBJECT<a: *, b: ARRAY<OBJECT<c: *>>>"


def test_a_new_layout_is_a_declaration(spark):
    mine = cf.Layout("qa", ('{"q": "", "a": {"text": ""}}',), fields=(("user", "$.q", False), ("assistant", "$.a.text", False)))
    row = cf.canonical_turns(records(spark, [{"q": "?", "a": {"text": "!"}}]), layouts=(*cf.LAYOUTS, mine)).first()
    assert row.layout == "qa" and [tuple(t) for t in row.turns] == [("user", "?"), ("assistant", "!")]


ODD = ["", "\n", "<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|", "<\\\\|x|>", "<|nl|>", "<", "|", "<|", "a\n\n", "<<|", "\\<|", "é😀<|"]


def test_the_template_is_reversible(spark):
    turns = [[(a, b), (b, a), ("assistant", a + b)] for a in ODD for b in ODD] + [[]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(turns)], "id long, turns array<struct<role:string,text:string>>")
    out = df.select("id", "turns", cf.formatted_text(F.col("turns")).alias("formatted")) \
        .select("*", cf.read_turns(F.col("formatted")).alias("back")).collect()
    for r in out:
        assert r.back == r.turns, r.formatted
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(r.turns)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("<|\\\nnl>a"), st.text("<|\\\nim_end>")), max_size=4), min_size=1, max_size=20))
def test_any_text_is_reversible(spark, turns):
    df = spark.createDataFrame([(t,) for t in turns], "turns array<struct<role:string,text:string>>")
    assert df.where(~cf.read_turns(cf.formatted_text(F.col("turns"))).eqNullSafe(F.col("turns"))).count() == 0


def plain_report(rows):
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows] + [(-1, k, r, cf.TRAP[1]) for k, r in enumerate(("user", "assistant"))]
    by = {}
    for c, *turn in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())):
        by.setdefault(c, []).append(turn[1:])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = []
    for c, turns in by.items():
        learned = "".join(x for r, x in turns if r == "assistant")
        found.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(learned), sha(learned)))
    return sorted(found, key=str)


def test_report_equals_the_plain_version(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>"), (2, 2, "assistant", "z"), (2, 0, "system", None), (2, 1, "user", "é😀"),
            (3, 0, None, "no role"), (4, None, "user", "no turn"), (4, 0, "assistant", None), (None, 0, "user", "no id"),
            (5, 0, "user", "tie"), (5, 0, "assistant", "tie"), (5, 0, "assistant", "tie"), (6, 0, "user\nassistant", "role with a break"),
            (6, 1, "tool", "x"), (7, 0, "assistant", "long " * 200_000), (8, 0, "user", ""), (8, 1, "assistant", "")]
    rows += [(9, i, ("user", "assistant")[i % 2], f"{i}<|") for i in range(500)]
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    df = df.withColumns({c: F.lit("clash") for c in ("record", "layout", "turns", "formatted", "all", "content", "__record", "__shape")})
    found = cf.chat_report(df).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == plain_report(rows)
    assert {r.layout for r in found} == {"messages", "prompt", "instruction"}
    assert [r.conv_id for r in cf.chat_report(df.limit(0)).collect()] == [-1]


def test_records_keep_their_other_columns(spark):
    df = records(spark, [{"prompt": "p", "completion": "c"}]).withColumn("layout_of", F.lit(1)).withColumn(
        "whole_record", F.lit("clash")).withColumn("record_shape", F.lit(2)).withColumnRenamed("record", "turn.s")
    row = cf.format_chats(df, "turn.s").first()
    assert row.asDict() == {"id": 0, "layout_of": 1, "whole_record": "clash", "record_shape": 2, "layout": "prompt", "loss_mask": [False, True],
                            "formatted": "<|im_start|>user\np<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"}


def test_plan_is_native(spark):
    plan = cf.chat_report(table(spark, SF_SMALL, "conversations"))._jdf.queryExecution().toString()
    for word in ("Python", "Pandas", "Arrow", "MapPartitions"):
        assert word not in plan


def test_query_on_the_whole_table(spark):
    df = table(spark, SF_SMALL, "conversations")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert sorted((tuple(r)[:5] for r in cf.chat_report(df).collect()), key=str) == plain_report(rows)


@pytest.mark.parametrize("text", ODD)
def test_escape_hides_every_mark(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(cf.escape(F.col("t")).alias("e")).select("e", cf.unescape(F.col("e")).alias("u")).first()
    assert "<|" not in row.e and row.u == text
