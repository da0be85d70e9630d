import json

from ripplelog.llm import chat as C

SCHEMAS = {
    "add": {"x": {"type": "integer", "required": True, "minimum": 0, "maximum": 9}, "note": {"type": "string", "maxLength": 3}},
    "go": {"fast": {"type": "boolean"}, "speed": {"type": "number", "required": True}},
}
FIELDS = "conv long, turn long, role string, call_id string, tool string, arguments string, after string, content string, json string, extra string"


def linked(spark, rows):
    full = [tuple(r) + (None,) * (8 - len(r)) + ("clash", "x") for r in rows]
    return C.link_tool_calls(spark.createDataFrame(full, FIELDS), SCHEMAS).collect()


def test_links_duplicates_and_orphans(spark):
    got = linked(spark, [
        (1, 0, "user", None, None, None, None, "hi"),
        (1, 1, "call", "a", "add", '{"x": 1}'),
        (1, 5, "result", "a", None, None, None, "late"),
        (1, 3, "result", "a", None, None, None, "first"),
        (1, 4, "call", "a", "add", '{"x": 2}'),
        (2, 1, "result", "a", None, None, None, "elsewhere"),
        (2, 2, "call", "b", "go", '{"speed": 1.5}'),
        (2, 0, "call", "c", "go", '{"speed": 1}', "b"),
    ])
    by = {(r.conv, r.status, r.call_id): r for r in got}
    assert len(got) == 7 and by[1, "linked", "a"].copies == 2
    again = sorted((r.turn, r.level, r.copies, r.json) for r in got if r.status == "duplicate")
    assert again == [
        (4, None, 1, '{"arguments":{"x":2},"call_id":"a","role":"call","tool":"add"}'),
        (5, None, 1, '{"call_id":"a","content":"late","role":"result"}'),
    ]
    assert json.loads(by[1, "linked", "a"].json)["result"] == "first"
    assert by[2, "orphan", "a"].json == '{"call_id":"a","content":"elsewhere","role":"result"}'
    # c is called before b by turn, but after it by order
    assert [(r.call_id, r.level) for r in sorted((r for r in got if r.status == "unanswered"), key=lambda r: (r.level, r.turn))] == [("b", 0), ("c", 1)]


def test_every_call_and_result_is_told_once(spark):
    """Equal rows, and a hot identifier: copies of all rows add up to the calls and results."""
    rows = [(1, 0, "call", "a", "go", '{"speed":1}')] * 4 + [(1, 0, "result", "a", None, None, None, None)] * 3
    rows += [(2, i % 7, "call", "hot", "go", '{"speed":"x"}', None if i % 2 else "hot") for i in range(300)]
    rows += [(3, i, "result", "none", None, None, None, "r") for i in range(2)]
    got = linked(spark, rows)
    told = lambda conv, status, call: sum(r.copies for r in got if (r.conv, r.status, '"role":"call"' in r.json) == (conv, status, call))
    assert told(1, "linked", True) == 4 and told(1, "duplicate", True) == 3 and told(1, "duplicate", False) == 2
    assert told(2, "unanswered", True) == 300 and told(2, "duplicate", True) == 299
    assert len([r for r in got if r.conv == 2]) == 1 + 14 and told(3, "orphan", False) == 2
    assert {tuple(r.errors) for r in got if r.conv == 2 and r.status == "duplicate"} == {("speed: not number",)}


def test_arguments_are_validated(spark):
    cases = {
        '{"x": 3, "note": "abc"}': [],
        '{"x": 3.0}': ["x: not integer"],
        '{"x": "3"}': ["x: not integer"],
        '{"x": null}': ["x: missing"],
        '{"x": 10, "note": "abcd", "z": 1}': ["note: maxLength", "x: maximum", "z: unknown"],
        '{"x": -1}': ["x: minimum"],
        "[1]": ["arguments: not an object"],
        "{x": ["arguments: not an object"],
        "": ["arguments: not an object"],
        None: ["arguments: not an object"],
    }
    got = linked(spark, [(1, i, "call", str(i), "add", a) for i, a in enumerate(cases)] + [(1, 99, "call", "y", "fly", "{}"), (1, 98, "call", "z", None, "{}")])
    by = {r.call_id: r.errors for r in got}
    assert [by[str(i)] for i in range(len(cases))] == list(cases.values())
    assert by["y"] == ["tool: unknown fly"] and by["z"] == ["tool: missing"]
    got = linked(spark, [(1, 0, "call", "a", "go", '{"speed": 2, "fast": true}'), (1, 1, "call", "b", "go", '{"speed": "2", "fast": 1}')])
    assert {r.call_id: r.errors for r in got} == {"a": [], "b": ["fast: not boolean", "speed: not number"]}


def test_json_is_canonical(spark):
    got = linked(spark, [
        (1, 0, "call", "a", "add", ' { "note" : "é\\n" , "x":1 } '),
        (1, 1, "call", "b", "add", '{"x":1,"note":"é\\n"}'),
    ])
    text = {r.call_id: r.json for r in got}
    assert text["a"] == text["b"].replace('"b"', '"a"') == '{"arguments":{"note":"é\\n","x":1},"call_id":"a","role":"call","tool":"add"}'


def test_levels_of_long_chains_forks_and_cycles(spark):
    rows = [(1, i, "call", f"n{i}", "go", '{"speed":1}', f"n{i - 1}" if i else None) for i in range(200)]
    rows += [(2, i, "call", f"k{i}", "go", '{"speed":1}', "hub") for i in range(50)] + [(2, 99, "call", "hub", "go", '{"speed":1}')]
    rows += [(3, 0, "call", "p", "go", '{"speed":1}', "q"), (3, 1, "call", "q", "go", '{"speed":1}', "p"), (3, 2, "call", "r", "go", '{"speed":1}', "q")]
    rows += [(4, 0, "call", "s", "go", '{"speed":1}', "nowhere"), (4, 1, "call", "t", "go", '{"speed":1}', "t")]
    got = {(r.conv, r.call_id): (r.level, r.errors) for r in linked(spark, rows)}
    assert all(got[1, f"n{i}"] == (i, []) for i in range(200))
    assert got[2, "hub"] == (0, []) and all(got[2, f"k{i}"] == (1, []) for i in range(50))
    assert all(got[3, c] == (None, ["after: cycle"]) for c in "pqr")
    assert got[4, "s"] == (0, ["after: unknown"]) and got[4, "t"] == (None, ["after: cycle"])


def test_odd_rows(spark):
    long = "x" * 100_000
    rows = [
        (None, 0, "call", "a", "go", '{"speed":1}'),
        (None, 1, "result", "a", None, None, None, "r"),
        (1, None, "call", None, "go", '{"speed":1}'),
        (1, None, "call", None, "go", '{"speed":1}'),
        (1, 0, None, None, None, None, None, long),
        (1, 0, "user", None, None, None, None, ""),
        (1, 0, "user", None, None, None, None, ""),
    ]
    got = linked(spark, rows)
    assert sorted(r.status for r in got) == ["message"] * 3 + ["orphan"] + ["unanswered"] * 3
    assert linked(spark, rows[:0]) == []
