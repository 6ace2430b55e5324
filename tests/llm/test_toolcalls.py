"""Tool-call linking: chains, schemas, canonical JSON, odd rows."""

import json
import random

from tideline.llm.toolcalls import Param, Tool, levels, link_calls

TOOLS = [Tool("search", (Param("query", "string"), Param("limit", "integer", False, 1, 50))),
         Tool("plot", (Param("xs", "array"), Param("style", "object", False), Param("grid", "boolean", False),
                       Param("scale", "number", False)))]
CALLS = "conv long, seq long, call_id string, name string, arguments string, after string, status string"
RESULTS = "conv long, seq long, call_id string, content string, record int"


def test_arguments_and_records(spark):
    cases = [
        ("search", '{"query": "a", "limit": 3}', None, {"limit": 3, "query": "a"}),
        ("search", '{"limit": 0, "query": "é\\n\\""}', "range:limit", {"limit": 0, "query": "é\n\""}),
        ("search", '{"limit": 3}', "missing:query", {"limit": 3}),
        ("search", '{"query": null}', "missing:query", {"query": None}),
        ("search", '{"query": 5}', "type:query", {"query": 5}),
        ("search", '{"query": "a", "limit": "3"}', "type:limit", {"limit": "3", "query": "a"}),
        ("search", '{"query": "a", "zz": 1, "b": 2}', "unknown:b", {"b": 2, "query": "a", "zz": 1}),
        ("search", "not json", "not_an_object", "not json"), ("search", None, "not_an_object", None),
        ("search", "[1]", "not_an_object", [1]), ("search", "", "not_an_object", ""),
        ("fly", "{}", "no_such_tool", {}), (None, "{}", "no_such_tool", {}),
        ("plot", '{"xs": [1, {"b": 1, "a": 2}], "style": {"c": 1}, "grid": true, "scale": 2.5}', None,
         {"grid": True, "scale": 2.5, "style": {"c": 1}, "xs": [1, {"a": 2, "b": 1}]}),
        ("search", json.dumps({"query": "x" * 200_000}), None, {"query": "x" * 200_000}),
    ]
    calls = spark.createDataFrame([(1, i, f"c{i}", n, a, None, "x") for i, (n, a, _, _) in enumerate(cases)], CALLS)
    results = spark.createDataFrame([(1, 9, "c0", "done", 1), (1, 5, "c0", "first", 1), (1, 6, "zz", "lost", 1),
                                     (None, 1, "c1", "n", 1), (1, 1, None, "n", 1), (2, 1, "c1", "other conv", 1)], RESULTS)
    got = {(r.conv, r.call_id): r for r in link_calls(calls, results, TOOLS).collect()}
    assert len(got) == len(cases) + 2
    for i, (name, _, error, args) in enumerate(cases):
        r = got[1, f"c{i}"]
        assert r.error == error, (i, r.error)
        want = {"after": None, "arguments": args, "id": f"c{i}", "name": name, "result": "first" if i == 0 else None}
        assert r.record == json.dumps(want, ensure_ascii=False, separators=(",", ":")), i
        assert r.status == ("linked" if i == 0 else "unanswered")
    assert got[1, "c0"].n_results == 2
    assert got[1, "zz"].status == got[2, "c1"].status == "orphan" and got[1, "zz"].level is None


def test_levels_of_forests_cycles_and_dangling(spark):
    rnd = random.Random(2)
    after = {(0, f"n{i}"): f"n{i - 1}" if i else None for i in range(130)}  # a long chain
    for i in range(200):
        after[1, f"n{i}"] = rnd.choice([None, "gone", *[f"n{j}" for j in rnd.sample(range(200), 3)]])
    after[2, "self"] = "self"

    def brute(conv, x):
        seen, d = set(), 0
        while True:
            if x in seen:
                return None, "cycle"
            seen.add(x)
            up = after[conv, x]
            if up is None or (conv, up) not in after:
                return d, "ok" if d or up is None else "dangling"
            x, d = up, d + 1

    df = spark.createDataFrame([(c, i, a) for (c, i), a in after.items()], "conv long, call_id string, after string")
    got = {(r.conv, r.call_id): (r.level, r.chain) for r in levels(df).collect()}
    assert got == {k: brute(*k) for k in after}


def test_repeated_calls_and_empty_tables(spark):
    calls = spark.createDataFrame([(1, 2, "a", "fly", "{}", None, ""), (1, 1, "a", "search", '{"query":"q"}', None, ""),
                                   (1, 1, "a", "search", '{"query":"q"}', None, "")], CALLS)
    none = spark.createDataFrame([], RESULTS)
    [r] = link_calls(calls, none, TOOLS).collect()
    assert (r.name, r.n_calls, r.seq, r.error) == ("search", 3, 1, None)
    assert link_calls(calls.limit(0), none, TOOLS).collect() == []
