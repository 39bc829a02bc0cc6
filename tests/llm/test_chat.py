"""Linked tool calls against a plain recount, and arguments that must not end a job."""

import json
import zlib
from collections import Counter

import pytest

from gleanwork.llm import chat
from gleanwork.llm.queries import QUERIES

ITEMS = "conv bigint, turn bigint, kind string, role string, text string, call_id string, name string, arguments string, after array<string>"


def recount(turns):
    """(faults, links that an order must keep) of one conversation, from (turn, role, text)."""
    calls, results, needs = [], [], {}
    for turn, role, text in turns:
        conv_turn = turn[1]
        odd = zlib.crc32(f"{turn[0]}-{conv_turn}".encode()) % 16
        name = lambda by: f"{turn[0]}-{conv_turn + by}"
        if role == "user":
            own = name(-2) if odd == 3 and conv_turn >= 2 else name(0)
            calls.append((conv_turn, own, odd, text))
            needs[conv_turn] = [name(0)] if odd == 5 else [f"{turn[0]}-none"] if odd == 6 else [name(2)] if odd == 7 else [name(-2)] if conv_turn >= 2 else []
        elif role == "assistant":
            results.append((conv_turn, name(0) + "-lost" if odd == 4 else name(-1)))
            needs[conv_turn] = []
    first = {}
    for turn, own, _, _ in calls:
        first.setdefault(own, turn)
    faults = Counter()
    for turn, own, odd, text in calls:
        faults["bad_arguments"] += odd in (0, 1) or not text and odd != 2
        faults["unknown_tool"] += odd == 2
        faults["repeated_call"] += first[own] != turn
        faults["unanswered"] += first[own] == turn and all(r != own for _, r in results)
    for turn, own in results:
        faults["orphan_result"] += own not in first
        needs[turn] = [own] if own in first else []
    unknown = {t for t, n in needs.items() if any(x not in first for x in n)}
    selfish = {t for t, n in needs.items() if any(first.get(x) == t for x in n)}
    waits = {t: {first[x] for x in n if x in first and first[x] != t} for t, n in needs.items()}
    stuck = set(waits)
    while free := {t for t in stuck if not waits[t] & stuck}:
        stuck -= free
    faults["circular"] = len(selfish | stuck)
    faults["unknown_dependency"] = len(unknown - stuck)
    return {k: v for k, v in faults.items() if v}


def test_chat_query_against_a_recount(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    turns = {}
    for r in rows:
        turns.setdefault(r.conv_id, []).append(((r.conv_id, r.turn), r.role, r.text))
    got = {r.conv_id: r for r in QUERIES["op3_chat_formatting"](spark, sf_dir).collect()}
    assert set(got) == set(turns)
    seen = Counter()
    for conv, held in turns.items():
        faults = {f.fault: f.n for f in got[conv].faults}
        assert faults == recount(held), conv
        seen.update(faults)
        messages = json.loads(got[conv].chat)["messages"]
        assert len(messages) == len(held)
        assert Counter(m["content"] for m in messages if m["role"] == "tool") == Counter(t or "" for _, role, t in held if role == "assistant")
        if "circular" not in faults:  # results follow their calls
            called = set()
            for m in messages:
                if "tool_call" in m:
                    called.add(m["tool_call"]["id"])
                elif m["role"] == "tool":
                    assert m["tool_call_id"] in called or faults.get("orphan_result")
    assert {"bad_arguments", "unknown_tool", "repeated_call", "unanswered", "orphan_result", "circular", "unknown_dependency"} <= set(seen)


def test_null_turns_and_repeated_ids_in_one_turn(spark):
    def item(conv, turn, kind, call_id, arguments="{}"):
        return (conv, turn, kind, None, "t", call_id, "f", arguments, None)

    rows = [item(1, None, "call", "a"), item(1, 3, "result", "a"), item(2, 1, "call", "a"), item(2, 1, "call", "a"), item(2, 2, "result", "a"),
            item(3, 1, "note", "a")]
    got = {r.conv: r for r in chat.format_chats(spark.createDataFrame(rows, ITEMS), {"f": {}}).collect()}
    assert got[1].faults == {} and got[2].faults == {"repeated_call": 1} and got[3].faults == {"bad_role": 1}
    long = [item(9, i, "call" if i % 2 == 0 else "result", str(i // 2)) for i in range(20000)]
    made = chat.format_chats(spark.createDataFrame(long, ITEMS), {"f": {}}).first()
    assert made.faults == {} and len(json.loads(made.chat)["messages"]) == len(long)


@pytest.mark.parametrize("text, rule, wrong", [
    ('{"x":"5"}', {"minimum": 3}, False), ('{"x":2}', {"minimum": 3}, True), ('{"x":7}', {"minLength": 3}, False), ('{"x":"ab"}', {"minLength": 3}, True),
    ('{"x":null}', {"type": ["string", "null"]}, False), ('{"x":1}', {"type": ["string", "null"]}, True), ('{"x":true}', {"enum": [1]}, True),
    ('{"x":[1,"a"]}', {"items": {"type": "integer"}}, True), ('{"x":{"y":{"z":1}}}', {"properties": {"y": {"required": ["w"]}}}, True),
    ('{"x":{"y":1}}', {"type": "object"}, False), ('{"x":{"y":1}}', {"type": "object", "additionalProperties": False}, True),
    ('{"x":1e999}', {}, True), ('{"x":NaN}', {}, True), ('{"x":"\\ud800"}', {}, True), ('{"x":"\\ud83d\\ude00"}', {}, False),
    ('{"x":' + "[" * 200000 + "]" * 200000 + "}", {}, True), ('{"x":true}', {"type": "number"}, True), ('{"x":9}', {"type": "odd"}, False),
])
def test_arguments(text, rule, wrong):
    value, fault = chat.check_arguments(text, {"properties": {"x": rule}, "required": ["x"]})
    assert (fault == "bad_arguments") == wrong
    chat.canonical(value).encode()
