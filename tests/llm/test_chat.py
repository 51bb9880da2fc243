import json

from hourly_star.llm import chat

SCHEMAS = {**chat.SCHEMAS, "add": {"type": "object", "required": ["a", "b"], "properties": {
    "a": {"type": "integer"}, "b": {"type": "number", "maximum": 10}, "tags": {"type": "array", "items": {"type": "string"}}}}}


def call(id_, name="add", after=None, **arguments):
    return {"id": id_, "name": name, "arguments": arguments, **({"after": after} if after else {})}


def calls(*several, content=None):
    return json.dumps({"tool_calls": list(several), "content": content})


def result(id_, content="done"):
    return json.dumps({"tool_call_id": id_, "content": content})


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", 0) for r in rows],
                                  "conv_id long, turn long, role string, text string, kind string, position int")
    return sorted(chat.formatted(spark, frame, SCHEMAS).collect(), key=lambda r: (r.conv_id or -1, r.position))


def test_results_come_after_calls_and_calls_after_what_they_wait_for(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "tool", result("x")), (1, 2, "assistant", calls(
        call("y", after="x", a=2, b=1), call("x", a=1, b=1.5), content="let me see")), (1, 3, "tool", result("y", {"z": 1, "a": 2}))]
    got = run(spark, rows)
    assert [(r.position, r.kind, r.call_id, r.status) for r in got] == [
        (0, "message", None, "ok"), (1, "message", None, "ok"), (2, "call", "x", "ok"), (3, "result", "x", "ok"),
        (4, "call", "y", "ok"), (5, "result", "y", "ok")]
    assert got[2].line == '{"role":"assistant","tool_calls":[{"arguments":{"a":1,"b":1.5},"id":"x","name":"add"}]}'
    assert got[5].line == '{"content":{"a":2,"z":1},"role":"tool","tool_call_id":"y"}'


def test_statuses(spark):
    rows = [(2, 0, "a", calls(call("p", a=1, b=11), call("q", a="1", b=1), call("r", "none"), call("s", a=True, b=1),
                              call("t", a=1, b=2, tags=["x", 3]), call("u", a=1, b=1), call("u", a=2, b=2))),
            *[(2, 1, "tool", result(i)) for i in "pqrstu"], (2, 2, "tool", result("u")), (2, 3, "tool", result("lost")),
            (3, 0, "a", calls(call("a", after="b", a=1, b=1), call("b", after="a", a=1, b=1), call("c", a=1, b=1)))]
    got = run(spark, rows)
    assert [r.status for r in got if r.conv_id == 2 and r.kind == "call"].count("invalid") == 5
    assert [r.status for r in got if r.call_id == "u"] == ["ok", "ok", "repeated", "repeated"] or sorted(
        r.status for r in got if r.call_id == "u") == ["ok", "ok", "repeated", "repeated"]
    assert [r.status for r in got if r.call_id == "lost"] == ["orphan"]
    assert [(r.call_id, r.status) for r in got if r.conv_id == 3] == [("a", "cycle"), ("b", "cycle"), ("c", "unanswered")]


def test_long_chain_against_its_turns(spark):
    n = 40
    rows = [(1, n - i, "a", calls(call(f"c{i}", after=f"c{i - 1}" if i else None, a=i, b=1))) for i in range(n)]
    rows += [(1, 0, "tool", result(f"c{i}")) for i in range(n)]
    got = run(spark, rows)
    assert [r.call_id for r in got] == [f"c{i}" for i in range(n) for _ in "cr"]
    assert [r.kind for r in got] == ["call", "result"] * n


def test_plain_turns_nulls_and_copies(spark):
    rows = [(1, 0, "user", "Hi"), (1, 1, "assistant", "Hello 😀".encode("utf-16", "surrogatepass").decode("utf-16")),
            (1, 2, "user", None), (1, 3, "assistant", ""), (None, None, None, None), (None, None, None, None),
            (4, 5, "assistant", "nobody asked"), (5, 0, "user", '{"broken": '), (5, None, "user", "x" * 300_000),
            (6, 0, "user", "twice"), (6, 0, "user", "twice"), (7, 0, "user", '{"tool_calls": [1, {"id": NaN}]}')]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert [(r.call_id, r.status) for r in got if r.conv_id == 1] == [("0", "ok"), ("0", "ok"), ("2", "invalid"), ("2", "ok")]
    assert [r.position for r in got if r.conv_id is None] == [0, 1]
    assert [r.status for r in got if r.conv_id == 4] == ["orphan"]
    assert sorted(r.status for r in got if r.conv_id == 6) == ["repeated", "unanswered"]
    for r in got:
        assert r.line == chat.canonical(json.loads(r.line))
    assert run(spark, []) == []
