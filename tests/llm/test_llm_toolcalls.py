"""Tool-call linking: order of chains and cycles, argument checks, canonical JSON, odd rows."""

import json
import random

from lantern.llm import toolcalls as t

CALLS = "conv_id long, turn long, id string, name string, arguments string, after string, level int, _args string"
RESULTS = "conv_id long, turn long, id string, content string, answer int"
SCHEMA = {
    "required": ["q"],
    "additionalProperties": False,
    "properties": {
        "q": {"type": "string", "enum": ["a", "b"]},
        "n": {"type": "integer", "minimum": 1, "maximum": 5},
        "x": {"type": "number"},
        "o": {"type": "object"},
        "l": {"type": "array"},
        "f": {"type": "boolean"},
    },
}


def linked(spark, calls, results, schemas=(("find", json.dumps(SCHEMA)),)):
    frame = spark.createDataFrame([(*c, 9, "z") for c in calls], CALLS)
    answers = spark.createDataFrame([(*r, 1) for r in results], RESULTS)
    tools = spark.createDataFrame(list(schemas), "name string, schema string")
    return t.link(frame, answers, tools).collect()


def test_levels_of_a_forest(spark):
    draw = random.Random(3)
    after = {f"c{i}": (f"c{draw.randrange(max(0, i - 3), i)}" if i and draw.random() < 0.95 else None) for i in range(400)}
    want = {}
    for name, up in after.items():
        want[name] = want[up] + 1 if up else 0
    after |= {"x0": "x1", "x1": "x2", "x2": "x0", "behind": "x1", "self": "self", "lost": "nobody"}
    want |= {"x0": None, "x1": None, "x2": None, "behind": None, "self": None, "lost": 0}
    rows = list(after.items())
    draw.shuffle(rows)
    got = t.levels(spark.createDataFrame(rows, "id string, after string")).collect()
    assert {r.id: r.level for r in got} == want and len(got) == len(want)


def test_argument_checks(spark):
    cases = {
        '{"q":"a"}': "",
        '{"n":2,"q":"b","x":1}': "",
        '{"x":1.5,"q":"a","o":{"z":1,"a":[]},"l":[1],"f":true}': "",
        '{"n":2}': "missing q",
        '{"q":"c"}': "not allowed: q",
        '{"q":1}': "not string: q",
        '{"q":"a","n":"2"}': "not integer: n",
        '{"q":"a","n":2.5}': "not integer: n",
        '{"q":"a","n":9,"zz":1}': "too large: n; unexpected zz",
        '{"q":"a","n":0}': "too small: n",
        '{"q":"a","f":0,"l":{},"o":[]}': "not array: l; not boolean: f; not object: o",
        '{"q":null}': "not string: q",
        "[1]": "arguments are not an object",
        "{": "arguments are not JSON",
    }
    calls = [(1, i, f"c{i}", "find", text, None) for i, text in enumerate(cases)] + [(1, 99, "u", "other", "{}", None), (1, 98, "v", "find", None, None)]
    got = {r.id: r for r in linked(spark, calls, [])}
    assert [got[f"c{i}"].errors for i in range(len(cases))] == list(cases.values())
    assert got["u"].errors == "unknown tool" and got["v"].errors == "arguments are not JSON"
    for i, text in enumerate(cases):
        made = json.loads(got[f"c{i}"].canonical)
        if text == "{":
            assert made["raw"] == "{"
            continue
        plain = json.dumps(made, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert made["arguments"] == json.loads(text) and got[f"c{i}"].canonical == plain


def test_statuses_and_odd_rows(spark):
    long_text = "é\"\\\n" * 50_000
    calls = [
        (1, 0, "a", "find", '{"q":"a"}', None),
        (1, 2, "b", "find", '{"q":"a"}', "a"),
        (1, 2, "b", "find", '{"q":"a"}', "a"),
        (1, 4, "c", "find", '{"q":"a"}', "b"),
        (2, 5, "d", "find", json.dumps({"q": long_text}), "a"),
        (2, 6, None, "find", '{"q":"a"}', "a"),
        (None, None, "e", None, None, "e"),
    ]
    results = [(1, 1, "a", "one"), (1, 3, "a", "late"), (1, 3, "b", None), (2, 1, "d", long_text), (3, 1, "lost", "x"), (3, 0, "lost", "y"), (3, 0, None, "z")]
    rows = linked(spark, calls, results)
    got = {r.id: r for r in rows}
    assert len(rows) == 8 and sum(r.id == "b" for r in rows) == 2
    assert [(got[k].level, got[k].status, got[k].n_results) for k in "abcd"] == [
        (0, "linked", 2), (1, "linked", 1), (2, "missing result", 0), (1, "early result", 1),
    ]
    assert json.loads(got["a"].canonical)["result"] == "one" and json.loads(got["d"].canonical)["result"] == long_text
    assert got["e"].status == "cycle" and got[None].status == "missing result" and got[None].level == 0
    assert (got["lost"].status, got["lost"].result_turn, got["lost"].n_results) == ("orphan result", 0, 2)


def test_empty_tables(spark):
    assert linked(spark, [], []) == []
    assert [r.status for r in linked(spark, [], [(1, 1, "a", "x")], [])] == ["orphan result"]
