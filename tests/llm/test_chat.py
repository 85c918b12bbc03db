import json
import random

import pytest
from pyspark.sql import functions as F

from brindle.llm import chat

HARD = ["", "%", "%25", "%3C", "<|end|>\n", "<|role|>user\nx", "</s>[INST] ok [/INST]", "a\nb", "é😀", "%5B[<", "\\ \"'"]


def formatted(spark, records):
    rows = spark.createDataFrame(list(enumerate(records)), "id bigint, record string")
    out = chat.format_turns(chat.canonical_turns(rows))
    return {
        r.id: r
        for r in out.select(
            "*",
            chat.parse_formatted(F.col("formatted")).alias("back"),
            chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"),
        ).collect()
    }


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"prompt": "a", "completion": "b"},
        {"instruction": "a", "input": "", "output": "b"},
        {"output": "b", "instruction": "a"},
        {"instruction": "a", "input": "more", "output": "b"},
    ]
    got = formatted(spark, [json.dumps(r) for r in records])
    turns = {i: [tuple(t) for t in r.turns] for i, r in got.items()}
    assert all(turns[i] == [("user", "a"), ("assistant", "b")] for i in range(5))
    assert turns[5][0] == ("user", "a\n\nmore")
    assert [got[i].layout for i in range(6)] == [
        "messages", "conversations", "prompt", "instruction", "plain instruction", "instruction"
    ]
    assert got[3].fingerprint == got[5].fingerprint != got[4].fingerprint


def test_unknown_records_have_no_turns(spark):
    got = formatted(spark, ['{"x": 1}', "no json", None, '{"messages": [{"a": "b"}]}', '{"prompt": "a"}', "[1]", ""])
    assert all(r.layout is None and r.turns is None and r.formatted is None for r in got.values())
    assert got[2].fingerprint is None and got[0].fingerprint == got[1].fingerprint


def test_further_fields_and_empty_lists(spark):
    records = [
        {"id": 7, "messages": [{"role": "user", "content": "a", "name": "x"}, {"role": "assistant", "content": None}], "meta": {"a": [1]}},
        {"messages": [], "id": 1},
        {"prompt": "a", "completion": "b", "source": "c"},
        {"prompt": {"a": 1}, "completion": "b"},
        {"instruction": "a", "input": None, "output": "b"},
        {"conversations": [{"from": "tool", "value": "x"}], "prompt": None},
    ]
    got = formatted(spark, [json.dumps(r) for r in records])
    assert [got[i].layout for i in range(6)] == ["messages", "messages", "prompt", "prompt", "plain instruction", "conversations"]
    assert [tuple(t) for t in got[0].turns] == [("user", "a"), ("assistant", "")]
    assert got[1].turns == [] and got[1].formatted == "" and got[1].back == [] and got[1].learnt == ""
    assert got[3].turns[0].text == '{"a":1}' and [tuple(t) for t in got[5].turns] == [("tool", "x")]


def test_records_of_one_table_differ_from_row_to_row(spark):
    rows = [(k, t, r, f"{k} {t}") for k in range(40) for t, r in enumerate(["user", "assistant", "user", "human"][: 1 + k % 4])]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    records = chat.records_of_turns(frame, mixed=True)
    out = chat.canonical_turns(records)
    got = out.collect()
    assert {r.layout for r in got} == {"messages", "conversations", "prompt"}
    assert len({r.fingerprint for r in got}) == 3
    for r in got:
        assert [tuple(t) for t in r.turns] == [x[2:] for x in rows if x[0] == r.conv_id]
    assert "xxhash64" in out._jdf.queryExecution().optimizedPlan().toString()
    as_json = chat.canonical_turns(records.select("conv_id", F.to_json("record").alias("record"))).collect()
    assert {(r.conv_id, r.layout, r.fingerprint, str(r.turns)) for r in as_json} == {(r.conv_id, r.layout, r.fingerprint, str(r.turns)) for r in got}


def test_empty_table_and_columns_that_clash(spark):
    none = spark.createDataFrame([], "conv_id bigint, record string")
    assert chat.format_turns(chat.canonical_turns(none)).collect() == []
    rows = spark.createDataFrame([(1, '{"prompt": "a", "completion": "b"}', 5, "p", "old")], "id int, record string, v int, _parts string, layout string")
    [r] = chat.format_turns(chat.canonical_turns(rows)).collect()
    assert (r.v, r["_parts"], r.layout) == (5, "p", "prompt")


def test_formatting_is_reversible_and_the_mask_holds_assistant_texts(spark):
    draw = random.Random(6)
    records = []
    for _ in range(200):
        turns = [
            {"role": draw.choice(["user", "assistant", "system", "a\nb%<"]), "content": "".join(draw.choices(HARD, k=3))}
            for _ in range(draw.randrange(1, 6))
        ]
        records.append(turns)
    got = formatted(spark, [json.dumps({"messages": t}) for t in records])
    for i, turns in enumerate(records):
        assert [(t.role, t.text) for t in got[i].back] == [(t["role"], t["content"]) for t in turns]
        assert got[i].learnt == "".join(t["content"] for t in turns if t["role"] == "assistant")
        assert got[i].formatted.count("<|role|>") == got[i].formatted.count("<|end|>\n") == len(turns)


@pytest.mark.parametrize("seed", [1, 2])
def test_records_of_turns_have_one_order(spark, seed):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, None, None, None),
            (2, 0, "user", None), (None, 0, "user", "x")]
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.canonical_turns(chat.records_of_turns(frame)).collect()}
    assert got == {
        1: [("user", "a"), ("assistant", "b"), ("assistant", "b")],
        2: [("", ""), ("user", "")],
        None: [("user", "x")],
    }
    assert chat.records_of_turns(frame.limit(0)).collect() == []


def test_very_long_turns_are_whole(spark):
    rows = spark.sql("select 1L as conv_id, 0L as turn, 'assistant' as role, repeat('a', 21000000) as text")
    out = chat.format_turns(chat.canonical_turns(chat.records_of_turns(rows)))
    [r] = out.select("layout", F.size("turns").alias("n"), F.length("formatted").alias("chars")).collect()
    assert tuple(r) == ("messages", 1, 21_000_000 + len("<|role|>assistant\n<|end|>\n"))
    made = rows.select(F.to_json(F.struct(F.array(F.struct(F.col("text").alias("content"), "role")).alias("messages"))).alias("record"))
    [r] = chat.canonical_turns(made).select("layout", F.length(F.col("turns")[0]["text"]).alias("chars")).collect()
    assert tuple(r) == ("messages", 21_000_000)


def test_typed_records_are_read_like_json(spark):
    rows = spark.sql("select named_struct('prompt', 'a', 'completion', 'b') as record")
    typed = chat.canonical_turns(rows).drop("record").collect()
    assert typed == chat.canonical_turns(rows.select(F.to_json("record").alias("record"))).drop("record").collect()
    assert typed[0].layout == "prompt" and [tuple(t) for t in typed[0].turns] == [("user", "a"), ("assistant", "b")]
