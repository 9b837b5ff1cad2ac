import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verdure.llm import chat as C

TEXT = st.text(max_size=12) | st.lists(st.sampled_from(["<", "|", "\\", "im_end", "<|im_start|>", "<|im_end|>", ">", "\n", "assistant", "ok"]), max_size=8).map("".join)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
@settings(max_examples=400, deadline=None)
def test_round_trip(turns):
    out, mask = C.write_turns(turns)
    assert C.parse(out) == turns
    assert C.loss_text(out, mask) == "".join(t for r, t in turns if r == "assistant")
    assert out.count(C.START) == out.count(C.END) == len(turns)


@pytest.mark.parametrize(
    "record,layout,turns",
    [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, "messages", [("user", "a"), ("assistant", "")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "from-value", [("user", "a"), ("assistant", "b")]),
        ({"prompt": "a", "response": "b"}, "prompt-response", [("user", "a"), ("assistant", "b")]),
        ({"output": "c", "input": "b", "instruction": "a"}, "instruction-input", [("user", "a\n\nb"), ("assistant", "c")]),
        ({"output": "c", "input": "", "instruction": "a", "system": ""}, "instruction-system", [("user", "a"), ("assistant", "c")]),
        ({"question": "q", "answer": 3}, "question-answer", [("user", "q"), ("assistant", "3")]),
        ({"other": 1}, None, None),
    ],
)
def test_layouts(spark, record, layout, turns):
    df = spark.createDataFrame([(1, json.dumps(record), "x")], "id long, record string, layout string")
    row = C.canonical(df, "id", "record").collect()[0]
    assert row["layout"] == layout and (row["turns"] and [tuple(t) for t in row["turns"]]) == turns
    formatted = C.format_chats(C.canonical(df, "id", "record"), "id").collect()[0]["formatted"]
    assert formatted is None if turns is None else C.parse(formatted) == turns


def test_broken_json_and_empty(spark):
    df = spark.createDataFrame([(1, "{"), (2, None), (3, "[]")], "id long, record string")
    assert all(r["turns"] is None for r in C.canonical(df, "id", "record").collect())
    assert C.canonical(df.limit(0), "id", "record").collect() == []


def test_digests(spark):
    rows = [(1, 1, "assistant", "x<|im_end|>", 1), (1, 0, "user", None, 2), (1, 1, "assistant", "x<|im_end|>", 3), (None, 0, None, "z", 4), (2, None, "assistant", "é" * 70000, 5), (2, 0, "assistant", "b", 6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record int")
    got = {r["conv_id"]: r for r in C.chat_digests(C.format_chats(C.canonical(C.as_messages(df), "conv_id", "record"), "conv_id"), "conv_id").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == sha("user\n\n" + "assistant\nx<|im_end|>\n" * 2) and got[1]["loss_sha256"] == sha("x<|im_end|>" * 2) and got[1]["loss_chars"] == 22
    assert got[None]["turns_sha256"] == sha("\nz\n") and got[None]["loss_chars"] == 0
    assert got[2]["loss_sha256"] == sha("é" * 70000 + "b")
