from __future__ import annotations

import json

from moodstream.llm.chat import link_tool_calls, op4

SCHEMAS = {"add": {"a": ("number", True), "b": ("integer", True), "note": ("string", False)}, "list": {"of": ("array", True)}}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, level string, at int"
RESULTS = "conv_id long, turn long, call_id string, content string, valid int"


def run(llm, calls, results):
    made = link_tool_calls(llm.createDataFrame([(*c, "x", 1) for c in calls], CALLS), llm.createDataFrame([(*r, 3) for r in results], RESULTS), SCHEMAS)
    return {(r.conv_id, r.call_id, r.turn): r for r in made.collect()}


def test_order_links_and_errors(llm):
    got = run(llm, [
        (1, 0, "c", "add", '{"b": 2, "a": 1.5}', ["a", "b"]), (1, 1, "a", "list", '{"of": [1]}', []), (1, 2, "b", "add", '{"a": "x", "q": 1}', ["a"]),
        (1, 3, "d", "nope", "not json", ["zz"]), (2, 0, "x", "list", '{"of": []}', ["y"]), (2, 1, "y", "list", '{"of": []}', ["x"]),
        (2, 2, "y", "list", '{"of": [2]}', None), (None, 0, "n", "list", '{"of": []}', None), (3, 0, None, None, None, None),
    ], [(1, 5, "a", "second"), (1, 4, "a", "first"), (1, 6, "c", "é\n\"q\""), (9, 0, "lost", "r"), (None, 1, "n", "r")])
    assert [got[1, c, t].level for c, t in (("a", 1), ("d", 3), ("b", 2), ("c", 0))] == [0, 0, 1, 2]
    assert [got[1, c, t].position for c, t in (("a", 1), ("d", 3), ("b", 2), ("c", 0))] == [0, 1, 2, 3]
    assert got[1, "a", 1].n_results == 2 and got[1, "a", 1].valid
    assert json.loads(got[1, "a", 1].record)["content"] == "first"
    assert got[1, "c", 0].record == '{"arguments":{"a":1.5,"b":2},"call_id":"c","content":"é\\n\\"q\\"","name":"add","turn":0}'
    assert got[1, "b", 2].errors == ["a is not number", "missing b", "no result", "unexpected q"]
    assert got[1, "d", 3].errors == ["arguments are not an object", "no result", "unknown need", "unknown tool"]
    assert "cyclic need" in got[2, "x", 0].errors and got[2, "x", 0].level is None and "cyclic need" in got[2, "y", 1].errors
    assert got[2, "y", 2].errors == ["repeated id"]
    assert got[9, "lost", 0].errors == ["result without a call"]
    assert got[None, "n", 0].errors == ["no id"] and got[None, "n", 1].errors == ["result without a call"]
    assert len(got) == 11


def test_equal_rows_are_one_call_and_ties_have_an_order(llm):
    calls = [(1, 0, "a", "list", '{"of": []}', []), (1, 0, "a", "list", '{"of": []}', []), (1, 0, "a", "list", '{"of": [2]}', [])]
    results = [(1, 1, "a", "r")]
    tables = []
    for flip in (False, True):
        rows = llm.createDataFrame([(*c, "x", 1) for c in (calls[::-1] if flip else calls)], CALLS)
        made = link_tool_calls(rows, llm.createDataFrame([(*r, 3) for r in results], RESULTS), SCHEMAS).collect()
        tables.append(sorted((r.position, tuple(r.errors), r.n_results, r.record) for r in made))
    assert tables[0] == tables[1]
    kept = [r for r in tables[0] if r[1] == ()]
    first = '"of":[2]' in kept[0][3]  # different calls of one turn: the least hash is the first
    assert len(kept) == (1 if first else 2) and all(r[2] == 1 for r in kept)
    assert [r[1] for r in tables[0] if r[1]] == [("repeated id",)] * (2 if first else 1)


def test_many_conversations(llm):
    """A chain of calls in every conversation, one without a result, against the rules applied by hand."""
    n = 300
    calls = [(c, t, f"k{t}", "list", f'{{"of": [{c}, {t}]}}', [f"k{t - 1}"] if t else []) for c in range(n) for t in range(c % 9 + 1)]
    results = [(c, 100 + t, i, f"{c}/{t}") for c, t, i, *_ in calls if (c + t) % 4]
    got = run(llm, calls, results)
    assert len(got) == len(calls)
    for c, t, i, *_ in calls:
        r = got[c, i, t]
        assert (r.level, r.position) == (t, t)
        assert json.loads(r.record)["arguments"] == {"of": [c, t]}
        assert (r.errors, r.n_results, json.loads(r.record)["content"]) == (([], 1, f"{c}/{t}") if (c + t) % 4 else (["no result"], 0, None))


def test_empty_tables(llm):
    assert run(llm, [], []) == {}


def test_registered_query(llm):
    folder = "/root/testdata/sf0.01"
    turns = llm.read.parquet(f"{folder}/conversations.parquet").collect()
    rows = op4(llm, folder).collect()
    users = {(r["conv_id"], r["turn"]): r["text"] for r in turns if r["role"] == "user"}
    answers = {(r["conv_id"], r["turn"] - 1): r["text"] for r in turns if r["role"] == "assistant"}
    others = sum(r["role"] not in ("user", "assistant") for r in turns)
    assert len(rows) == len(users) + sum(k not in users for k in answers) + others
    for r in rows:
        if r.name is None:
            continue
        k, text = (r.turn - r.turn % 2) // 2, users[r.conv_id, r.turn]
        record = json.loads(r.record)
        assert record["content"] == answers.get((r.conv_id, r.turn)) and r.record == json.dumps(record, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
        assert record["arguments"].get("query") == (text if len(text) % 11 else None)
        known = k == 0 or (r.conv_id, r.turn % 2 + 2 * (k // 2)) in users
        wrong = ("missing query" in r.errors) == (len(text) % 11 == 0) and ("unknown need" in r.errors) == (not known)
        assert wrong and r.valid == (r.errors == "")
