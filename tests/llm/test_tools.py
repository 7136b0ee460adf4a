"""Tool-call linking, and the queries that SQL can express."""

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import compare, duck  # noqa: E402
from riskspark.llm import toolcalls  # noqa: E402
from riskspark.llm.queries import ORACLES, QUERIES  # noqa: E402

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after array<string>, status string"
RESULTS = "conv_id long, call_id string, turn long, content string, json string"
TOOLS = "name string, field string, kind string, required boolean, least double, most double"
FIELDS = [("f", "a", "string", True, 1.0, 5.0), ("f", "n", "integer", False, 0.0, 9.0), ("f", "x", "number", False, None, None),
          ("f", "l", "array", False, None, None), ("g", "o", "object", False, None, None)]


def linked(spark, calls, results=()):
    calls = spark.createDataFrame([(*c, "s") for c in calls], CALLS)
    results = spark.createDataFrame([(*r, "j") for r in results], RESULTS)
    return toolcalls.link(calls, results, spark.createDataFrame(FIELDS, TOOLS)).collect()


def test_links_and_statuses(spark):
    rows = linked(
        spark,
        [(1, "a", 1, "f", '{"a":"x"}', None), (1, "a", 5, "f", '{"a":"y"}', []), (1, "b", 2, "f", '{"a":"x"}', ["zz"]), (1, None, 3, "f", "{}", None), (2, "a", 1, "f", None, None)],
        [(1, "a", 2, "r"), (1, "a", 4, "again"), (1, "q", 6, None), (None, "a", 1, "r")])
    got = sorted((r.conv_id or 0, r.call_id or "", r.turn or 0, r.result_turn or 0, r.status, "; ".join(r.errors)) for r in rows)
    assert got == sorted([
        (1, "a", 1, 2, "linked", ""), (1, "a", 5, 0, "repeated call", ""), (1, "b", 2, 0, "no result", "waits for unknown zz"), (1, "", 3, 0, "no identifier", ""),
        (2, "a", 1, 0, "no result", "no JSON object"), (1, "a", 0, 4, "repeated result", ""), (1, "q", 0, 6, "no call", ""), (0, "a", 0, 1, "no identifier", "")])


@pytest.mark.parametrize("arguments,errors", [
    ('{"a":"abc"}', ""), ('{"a":"abcdef"}', "a: out of range"), ("{}", "a: required"), ('{"a":1}', "a: not string"), ('{"a":"b","n":1.5}', "n: not integer"),
    ('{"a":"b","n":10}', "n: out of range"), ('{"a":"b","x":3}', ""), ('{"a":"b","x":3.25}', ""), ('{"a":"b","z":1}', "z: unknown"), ('{"a":"b","l":[1]}', ""),
    ('{"a":"b","l":{}}', "l: not array"), ("[1]", "no JSON object"), ("no", "no JSON object"), ("", "no JSON object"), (None, "no JSON object"), ('{"a":null}', "a: not string")])
def test_schema(spark, arguments, errors):
    (row,) = linked(spark, [(1, "a", 1, "f", arguments, None)])
    assert "; ".join(row.errors) == errors


def test_canonical_json(spark):
    (row,) = linked(spark, [(1, "a", 1, "g", '{ "o" : {"z": 1, "b": [true, null, {"y":"é\\n","x":2}]} }', None)], [(1, "a", 2, 'say "hi"\n')])
    assert row.json == '{"arguments":{"o":{"b":[true,null,{"x":2,"y":"é\\n"}],"z":1}},"call_id":"a","name":"g","result":"say \\"hi\\"\\n","valid":true}'
    assert json.loads(row.json)["valid"] is True


def test_order_is_topological(spark):
    after = {"a": ["c"], "b": ["a"], "c": ["e"], "d": [], "e": ["d"], "f": ["b", "e"], "g": ["h"], "h": ["g"], "i": ["h", "a"], "j": ["a", "zz"]}
    rows = linked(spark, [(1, k, n, "g", "{}", v) for n, (k, v) in enumerate(after.items())])
    assert {r.call_id for r in rows if r.status == "ring"} == {"g", "h", "i"}
    place = {r.call_id: (r.order_turn, r.order_step, r.turn) for r in rows if r.status != "ring"}
    assert all(place[w] < place[k] for k, v in after.items() if k in place for w in v if w in place)
    assert place["d"] == (3, 0, 3) and set(place) == set("abcdefj")


def test_long_chain_against_its_turns(spark):
    rows = linked(spark, [(1, str(n), n, "g", "{}", [str(n + 1)]) for n in range(6)])
    place = {int(r.call_id): (r.order_turn, r.order_step) for r in rows}
    assert sorted(place, key=place.get) == [5, 4, 3, 2, 1, 0]


def test_empty_tables(spark):
    assert linked(spark, []) == []
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert toolcalls.format_conversations(turns).count() == 0
    odd = spark.createDataFrame([(None, 0, "user", "x"), (1, None, "user", "x"), (1, 0, None, "x"), (1, 0, "user", None), (1, 1, "assistant", None), (1, 1, "assistant", "b")], turns.schema)
    assert sorted(r.status for r in toolcalls.format_conversations(odd).collect()) == ["linked", "no identifier", "no identifier", "repeated result"]


def test_very_long_and_very_deep(spark):
    """Texts beyond the parser's length, and brackets deeper than anything may recurse, give rows."""
    deep, wide = '{"o":' + "[" * 1000 + "]" * 1000 + "}", '{"o":{"b":' + "[" * 150 + "]" * 150 + ',"a":"[[[{\\""}}'
    long = '{"a":"' + "x" * 25_000_000 + '"}'
    calls = [(1, "deep", 1, "g", deep, None), (1, "wide", 2, "g", wide, None), (1, "open", 3, "g", "[" * 5000, None), (1, "odd", 4, "g", "]" * 900 + "[" * 900, None),
             (1, "escaped", 5, "g", '{"o":{"x":"' + "\\\\" * 40000 + '"}}', None)]
    rows = {r.call_id: r for r in linked(spark, calls, [(1, "wide", 9, "r")])}
    assert {k: "; ".join(r.errors) for k, r in rows.items()} == {"deep": "arguments nested too deep", "wide": "", "open": "no JSON object", "odd": "no JSON object", "escaped": ""}
    assert json.loads(rows["deep"].json)["arguments"] == deep
    assert rows["wide"].json.startswith('{"arguments":{"o":{"a":"[[[{\\"","b":[[[')
    (row,) = linked(spark, [(1, "a", 1, "f", long, None)], [(1, "a", 2, "y" * 25_000_000)])
    assert row.errors == ["arguments too long"] and row.status == "linked"
    assert row.json.startswith('{"arguments":"{\\"a\\":\\"xx') and len(row.json) > 50_000_000


def test_very_long_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    turns = spark.createDataFrame([(1, 0, "system", "a\n" * 12_500_000), (1, 1, "user", "hi"), (1, 2, "assistant", "z" * 25_000_000)], schema)
    rows = toolcalls.whole_conversations(turns).selectExpr("status", "length(json) as n").collect()
    assert sorted(r.status for r in rows) == ["context", "linked"] and all(r.n > 25_000_000 for r in rows)


def test_blocks_wait_for_the_request_after(spark):
    turns = [(1, t, "user", "x\ny" if t in (1, 3, 9) else "x") for t in (1, 3, 5, 7, 9)] + [(2, 0, "user", "x\ny"), (2, 4, "user", "x")]
    rows = toolcalls.whole_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.turn): (r.order_turn, r.order_step) for r in rows} == {
        (1, 1): (5, 2), (1, 3): (5, 1), (1, 5): (5, 0), (1, 7): (7, 0), (1, 9): (9, 0), (2, 0): (0, 0), (2, 4): (4, 0)}


def test_every_turn_is_in_a_row(spark):
    turns = spark.createDataFrame([(1, 0, "system", 'be "kind"'), (1, 1, "user", "hi"), (1, 2, "assistant", "ho"), (1, 3, None, None), (2, 0, "user", "x"), (None, 0, "tool", "t")],
                                  "conv_id long, turn long, role string, text string")
    rows = toolcalls.whole_conversations(turns).collect()
    assert sum((r.turn is not None) + (r.result_turn is not None) for r in rows) == 6
    assert sorted((r.conv_id or 0, r.turn, r.order_turn, r.order_step, r.json) for r in rows if r.status == "context") == [
        (0, 0, 0, 0, '{"content":"t","role":"tool"}'), (1, 0, 0, 0, '{"content":"be \\"kind\\"","role":"system"}'), (1, 3, 3, 0, '{"content":""}')]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir) is None
