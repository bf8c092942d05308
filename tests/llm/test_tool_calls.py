"""Calls and results."""

import json

from vitrine.llm.tool_calls import CALLS, RESULTS, calls_and_results, canonical, link, references, violations

SCHEMA = {
    "type": "object", "required": ["city"], "additionalProperties": False,
    "properties": {"city": {"type": "string"}, "days": {"type": "integer"}, "unit": {"enum": ["c", "f"]}, "tags": {"type": "array", "items": {"type": "string"}}},
}


def test_values_and_schemas():
    assert canonical({"b": 1, "a": [True, None, "é\n"]}) == '{"a":[true,null,"é\\n"],"b":1}'
    assert violations({"city": "x", "days": 3, "unit": "c", "tags": ["a"]}, SCHEMA) == []
    assert violations({"days": True, "unit": "k", "tags": [1], "z": 0}, SCHEMA) == [
        "$.city: missing", "$.days: not integer", "$.tags[0]: not string", "$.unit: not in enum", "$.z: unknown"
    ]
    assert violations([], SCHEMA) == ["$: not object"] and violations({"city": {"$ref": "c1"}}, SCHEMA) == []
    assert references({"a": {"$ref": "x"}, "b": [{"$ref": "y"}, {"$ref": 1}, {"$ref": "z", "k": 0}]}) == ["x", "y"]


def linked(spark, calls, results, schemas=(("weather", json.dumps(SCHEMA)),)):
    rows = link(
        spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS),
        spark.createDataFrame(list(schemas), "name string, schema string"),
    )
    return sorted(rows.collect(), key=str)


def call(conv, turn, call_id, refs=(), name="weather", arguments='{"city":"x"}', position=0):
    return conv, turn, position, call_id, name, arguments, list(refs)


def test_links_states_and_json(spark):
    calls = [call(1, 1, "a"), call(1, 2, "a"), call(1, 3, "b", arguments='{"city":1}'), call(2, 1, "a", name="none"),
             call(None, 1, "a"), call(1, 4, None), call(1, 1, "a"), call(3, 1, "x", arguments="null")]
    results = [(1, 2, "a", "sunny"), (1, 9, "a", "late"), (1, 5, "c", "lost"), (None, 2, "a", "here"), (1, 3, None, "nobody's"), (1, 2, "a", "sunny")]
    rows = linked(spark, calls, results)
    state = {(r.conv_id, r.turn, r.call_id): r.status for r in rows}
    assert state == {
        (1, 1, "a"): "linked", (1, 2, "a"): "repeated", (1, 3, "b"): "unanswered", (2, 1, "a"): "unanswered", (None, 1, "a"): "linked",
        (1, 4, None): "unanswered", (3, 1, "x"): "unanswered", (1, 5, "c"): "orphan", (1, 3, None): "orphan",
    }
    by = {(r.conv_id, r.turn, r.call_id): r for r in rows}
    assert by[1, 1, "a"].json == '{"call":{"arguments":{"city":"x"},"id":"a","name":"weather"},"result":"sunny"}'
    assert by[1, 3, "b"].errors == ["$.city: not string"] and by[2, 1, "a"].errors == ["unknown tool"]
    assert by[3, 1, "x"].errors == ["$: not object"] and by[1, 5, "c"].json == '{"content":"lost","role":"tool","tool_call_id":"c"}'


def test_every_result_has_a_row(spark):
    calls = [call(1, 1, "a"), call(1, 2, "a"), call(1, 3, None)]
    results = [(1, 2, "a", "one"), (1, 9, "a", "two"), (1, 9, "a", "two"), (1, 4, "c", "x"), (1, 5, "c", "y"),
               (1, 6, None, "n"), (1, 6, None, "m"), (None, 6, None, "k"), (None, None, None, "l")]
    rows = linked(spark, calls, results)
    told = sorted((r.status, json.loads(r.json).get("content") or json.loads(r.json).get("result") or "") for r in rows)
    assert told == [("linked", "one"), ("linked", "two"), ("linked", "two"), *(("orphan", c) for c in "klmnxy"),
                    ("repeated", ""), ("unanswered", "")]


def test_order(spark):
    calls = [
        call(1, 1, "a", ["b"]), call(1, 3, "b", ["d"]), call(1, 2, "c", ["a"]), call(1, 5, "d"), call(1, 6, "e", ["a"]), call(1, 7, "f", ["zz"]),
        call(2, 1, "p", ["q"]), call(2, 2, "q", ["p"]), call(2, 3, "r", ["p"]), call(2, 4, "s"), call(3, 1, "self", ["self"]),
    ]
    rows = linked(spark, calls, [])
    place = {r.call_id: (r.after_turn, r.after_steps) for r in rows if r.status != "circular"}
    assert {r.call_id for r in rows if r.status == "circular"} == {"p", "q", "r", "self"}
    by_id = {c[3]: c for c in calls}
    key = lambda c: (*place[c], by_id[c][1])
    for c in calls:
        for needed in c[6]:
            if c[3] in place and needed in place:
                assert key(needed) < key(c[3])
    assert place["e"] == (6, 0) and place["f"] == (7, 0)


def test_messages_with_calls(spark):
    told = json.dumps({"tool_calls": [{"id": "k", "name": "weather", "arguments": '{"city": "é"}'}, {"id": 5}, {"id": "m", "name": "n", "arguments": {"a": {"$ref": "k"}}}]})
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", told), (1, 2, "tool", '{"tool_call_id": "k", "content": {"b": 1}}'),
            (1, 3, "tool", "not json"), (1, 4, "assistant", "the word tool_calls"), (1, 5, None, None), (None, 6, "tool", None)]
    calls, results = calls_and_results(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert [(r.call_id, r.position, r.arguments, r.refs) for r in calls.orderBy("position").collect()] == [
        ("k", 0, '{"city":"é"}', []), ("m", 2, '{"a":{"$ref":"k"}}', ["k"])
    ]
    assert [(r.call_id, r.content) for r in results.collect()] == [("k", '{"b":1}')]


def test_nothing(spark):
    assert linked(spark, [], []) == []
