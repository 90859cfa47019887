from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rateflow.llm import chat_format as chat
from rateflow.llm.oracle import ORACLE_SQL
from rateflow.llm.queries import REGISTRY

PIECES = st.lists(
    st.one_of(st.sampled_from([*chat.CONTROL, chat.START, chat.END, "\\", "\n", "<", "[", "|"]), st.text()),
    max_size=12,
).map("".join)


@given(PIECES)
def test_escape_round_trip_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c.lower() in escaped.lower() for c in chat.CONTROL)


@given(PIECES, PIECES)
def test_turn_round_trip(role, text):
    formatted, start, end = chat.format_turn(role, text)
    assert chat.read_turn(formatted) == (role, text)
    assert chat.unescape(formatted[start:end]) == (text if role == "assistant" else "")


def test_query_matches_sql(spark, duck, same_rows, sf_dir):
    name = "op8_chat_formatting"
    same_rows(REGISTRY[name](spark, sf_dir), duck.sql(ORACLE_SQL[name]))


@pytest.mark.parametrize(
    ("record", "turns"),
    [
        ({"role": "human", "text": None}, [("user", "")]),
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
         [("user", "a"), ("assistant", "b")]),
        ({"system": "s", "conversations": [{"from": "gpt", "value": "b"}]},
         [("system", "s"), ("assistant", "b")]),
        ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
        ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
        ({"data": {"turns": [{"text": "t", "role": "tool"}]}}, [("tool", "t")]),
        ({"other": 1}, None),
        ({}, None),
    ],
)
def test_layouts(record, turns):
    assert chat.canonical_turns(record, chat.LAYOUTS) == turns


def test_fingerprint_ignores_field_order_and_list_length():
    one = {"messages": [{"role": "a", "content": "b"}]}
    other = {"messages": [{"content": "b", "role": "a"}] * 3}
    assert chat.fingerprint(chat.field_paths(one)) == chat.fingerprint(chat.field_paths(other))


def test_heterogeneous_records_and_digests(spark):
    records = [
        (1, 0, json.dumps({"prompt": "p", "response": "</s> r"})),
        (2, 0, json.dumps({"role": "user", "text": "a"})),
        (2, 1, json.dumps({"role": "assistant", "text": "<|im_end|>\\"})),
        (2, 1, json.dumps({"role": "assistant", "text": "<|im_end|>\\"})),
        (3, 0, "no json"), (4, 0, None), (5, 0, json.dumps({"unknown": []})),
        (None, None, json.dumps({"role": "system", "text": None})),
    ]
    df = spark.createDataFrame(records, "conv_id LONG, turn LONG, record STRING")
    formatted = chat.format_records(df.selectExpr("*", "1 AS part", "'x' AS layout"))
    assert {r["conv_id"] for r in formatted.where("formatted IS NULL").collect()} == {3, 4, 5}
    found = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert set(found) == {1, 2, None}
    expected = "user\na\n" + "assistant\n<|im_end|>\\\n" * 2
    assert found[2]["turns_sha256"] == hashlib.sha256(expected.encode()).hexdigest()
    assert (found[2]["n_turns"], found[2]["loss_chars"]) == (3, 22)
    assert found[1]["loss_sha256"] == hashlib.sha256(b"</s> r").hexdigest()


def test_long_text_nulls_and_empty_table(spark):
    schema = "conv_id LONG, turn LONG, role STRING, text STRING"
    rows = [(1, 0, None, None), (1, 1, "assistant", "<s>" * 100_000)]
    made = chat.read_back(chat.format_records(chat.turn_records(spark.createDataFrame(rows, schema))))
    assert made.first()["loss_chars"] == 300_000
    none = chat.turn_records(spark.createDataFrame([], schema))
    assert chat.read_back(chat.format_records(none)).count() == 0
