"""Chats: rows of one turn, odd links, long conversations, levels against a search of the graph."""

import json
import random

import pytest
from pyspark.sql import functions as F

from proxysift.llm import tool_calls as tc

COLUMNS = "conv_id bigint, turn bigint, role string, content string, tool_calls string, tool_call_id string"


@pytest.fixture(scope="module")
def schemas(spark):
    return spark.createDataFrame([("g", None, None, None)], "name string, field string, type string, required boolean")


def call(name, after=None, tool="g"):
    return {"id": name, "name": tool, "arguments": {}, "after": after}


def levels(links):
    """Longest chains by search; None for what is on a circle or after one."""
    known = {}

    def level(i, path):
        if i in path:
            return None
        if i not in known:
            before = [level(j, path | {i}) for j in links[i]]
            known[i] = None if None in before else 1 + max(before, default=-1)
        return known[i]

    # Circles make what is found inside them depend on where the search begins.
    found = []
    for i in range(len(links)):
        known.clear()
        found.append(level(i, frozenset()))
    return found


def test_levels_equal_a_search(spark):
    chance = random.Random(5)
    graphs = [[[1], [2], [3], []], [[0]], [[]], [[1], [0], [1]], [[3], [0], [1], []], [[2], [], [1], [0, 2]]]
    for _ in range(150):
        n = chance.randint(1, 7)
        graphs.append([sorted({chance.randrange(n) for _ in range(chance.choice([0, 0, 1, 1, 2]))}) for _ in range(n)])
    rows = spark.createDataFrame([(i, links) for i, links in enumerate(graphs)], "i int, links array<array<int>>")
    found = rows.select("i", tc.levels_of(F.col("links")).alias("levels")).collect()
    assert {r.i: [None if x < 0 else x for x in r.levels] for r in found} == {i: levels(links) for i, links in enumerate(graphs)}


def test_rows_of_one_turn_keep_their_own_calls(spark, schemas):
    rows = [
        (1, 0, "assistant", "a", json.dumps([call("x")]), None), (1, 0, "assistant", "b", json.dumps([call("y", ["x"]), call("z", "y")]), None),
        (1, 0, "assistant", "c", None, None), (1, 0, "tool", "R", None, "y"), (1, 0, "tool", "R", None, "y"),
        (2, 5, "assistant", "a", json.dumps([call("x", 7), call(None)]), None), (2, 5, "assistant", "a", json.dumps([call("x", 7), call(None)]), None),
    ]
    messages = spark.createDataFrame(rows, COLUMNS).withColumns({
        name: F.lit("own") for name in ("row", "place", "level", "status", "call", "said", "line", "_conv", "nth", "before")
    })
    chats = {r.conv_id: r for r in tc.format_chats(messages, schemas).collect()}
    assert (chats[1].n_messages, chats[1].n_calls, chats[1].n_ok, chats[1].n_lost) == (3, 3, 1, 0)
    told = {m["content"]: [(c["id"], c["level"], c["status"], c["result"]) for c in m.get("tool_calls", [])] for m in json.loads(chats[1].chat)["messages"]}
    assert told == {"a": [("x", 0, "no_result", None)], "b": [("y", 1, "ok", "R"), ("z", 2, "no_result", None)], "c": []}
    assert [c["status"] for m in json.loads(chats[2].chat)["messages"] for c in m["tool_calls"]] == ["bad_links", "repeated"]


def test_long_results_and_texts(spark, schemas):
    text = 'quote " back \\ line\n tab\t ünï \U0001f600 ' * 20_000
    rows = [(None, None, "assistant", text, json.dumps([call("x")]), None), (None, 3, "tool", text, None, "x")]
    (chat,) = tc.format_chats(spark.createDataFrame(rows, COLUMNS), schemas).collect()
    (message,) = json.loads(chat.chat)["messages"]
    assert message["content"] == text and message["tool_calls"][0]["result"] == text and message["turn"] is None


@pytest.mark.parametrize("forward", [False, True])
def test_a_conversation_of_5000_calls(spark, schemas, forward):
    """One chain, each link to the call before or to the one after."""
    n = 5000
    rows = [
        (1, i, "assistant", "m", json.dumps([call(f"c{i}", [f"c{i + 1 if forward else i - 1}"])]), None) for i in range(n)
    ]
    (chat,) = tc.format_chats(spark.createDataFrame(rows, COLUMNS), schemas).collect()
    found = [m["tool_calls"][0]["level"] for m in json.loads(chat.chat)["messages"]]
    assert found == (list(range(n))[::-1] if forward else list(range(n)))


def test_the_plan_does_not_grow_with_chains(spark, schemas):
    rows = spark.createDataFrame([(1, 0, "assistant", "m", json.dumps([call("a", ["b"]), call("b")]), None)], COLUMNS)
    text = tc.format_chats(rows, schemas)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") < 20 and "EvalPython" not in text
