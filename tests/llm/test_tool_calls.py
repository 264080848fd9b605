"""Tool calls: inputs that are no good JSON, broken schemas, needs in any order, long chains, empty tables."""

import json
import random

import pytest

from marketlake.llm import tool_calls as T

CALLS = "conv_id long, call_id string, seq long, name string, arguments string, needs array<string>"
NUMBERS = {"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": ["string", "null"]}, "z": True, "w": False}}


def linked(spark, calls, schemas, results=()):
    table = spark.createDataFrame(calls, CALLS).repartition(3)
    results = spark.createDataFrame(list(results), "conv_id long, call_id string, content string")
    return {(r["conv_id"], r["call_id"]): r for r in T.link_calls(table, results, spark.createDataFrame(schemas, "name string, schema string")).collect()}


ODD = {
    '{"x": 1e999}': "arguments: holds a number out of range",
    '{"x": NaN}': "arguments: holds NaN",
    '{"x": -Infinity}': "arguments: holds -Infinity",
    "[" * 100_000: f"arguments: is nested more than {T.MAX_DEPTH} levels deep",
    "[" * 101 + "]" * 101: f"arguments: is nested more than {T.MAX_DEPTH} levels deep",
    '{"y": "\\ud800"}': "arguments: holds a lone surrogate",
    '{"x": 1, "x": 2}': "arguments: repeats a key",
    '{"x": 1.0, "y": null, "z": [1.50, 2e3, 1e300]}': None,
    '{"x": 1.5}': "$.x: not of type integer",
    '{"y": 1}': "$.y: not of type string or null",
    '{"w": 1}': "$.w: not allowed",
    '{"y": "[[[[\\"{{{{"}': None,
    "{": "arguments are not JSON",
    "": "arguments are not JSON",
}


def test_odd_arguments(spark):
    calls = [(1, f"c{k:02d}", k, "f", text, []) for k, text in enumerate(ODD)]
    got = linked(spark, calls, [("f", json.dumps(NUMBERS))])
    assert [got[1, f"c{k:02d}"]["error"] for k in range(len(ODD))] == list(ODD.values())
    links = [json.loads(got[1, f"c{k:02d}"]["link_json"])["arguments"] for k in range(len(ODD))]
    assert links[0] is None and links[7] == {"x": 1, "y": None, "z": [1.5, 2000, 1e300]} and '"x":1,' in got[1, "c07"]["link_json"]


@pytest.mark.parametrize("schema", ["{", "[1]", '{"type": "strange"}', '{"properties": {"x": 5}}', '{"required": 3}', '{"enum": {}}', '{"a": 1, "a": 2}', "[" * 5000])
def test_broken_schemas_are_errors_of_their_calls(spark, schema):
    got = linked(spark, [(1, "a", 0, "bad", '{"x": 1}', []), (1, "b", 1, "good", '{"x": 1}', [])], [("bad", schema), ("good", "true")])
    assert got[1, "a"]["error"].startswith("schema: ") and not got[1, "a"]["valid"] and got[1, "b"]["valid"]


def plain_levels(needs):
    level, changed = {c: 0 for c, n in needs.items() if not n}, True
    while changed:
        changed = False
        for c, own in needs.items():
            if c not in level and own and all(n in level for n in own):
                level[c] = 1 + max(level[n] for n in own)
                changed = True
    return level


@pytest.mark.parametrize("seed", [1, 2])
def test_needs_in_any_order(spark, seed):
    """Chains, forks, circles, what hangs behind them, unknown calls and calls that need themselves."""
    rng = random.Random(seed)
    calls = []
    for conv in range(4):
        names = [f"n{k}" for k in range(60)]
        rng.shuffle(names)
        for k, name in enumerate(names):
            own = [names[k - 1]] if k % 20 and rng.random() < 0.8 else rng.sample(names[:k], min(k, rng.randrange(3)))
            if rng.random() < 0.04 * conv:
                own = [*own, rng.choice(["unknown", name, rng.choice(names)])]
            calls.append((conv, name, rng.randrange(100), "f", "{}", own))
    got = linked(spark, calls, [("f", "true")])
    for conv in range(4):
        own = {c[1]: c for c in calls if c[0] == conv}
        needs = {name: c[5] for name, c in own.items()}
        if all(n in own and own[n][2] < c[2] for c in own.values() for n in c[5]):
            continue
        level = plain_levels(needs)
        order = sorted(own, key=lambda c: (level.get(c, 2**31 - 1), own[c][2], c))
        assert [c for c, _ in sorted(((c, got[conv, c]["position"]) for c in own), key=lambda x: x[1])] == order
        assert {c for c in own if got[conv, c]["error"]} == own.keys() - level.keys()


def test_a_chain_of_many_forward_needs_takes_few_rounds(spark, monkeypatch):
    rounds, kept = [], T.stored

    def counted(df, name, *rest):
        rounds.append(name)
        return kept(df, name, *rest)

    monkeypatch.setattr(T, "stored", counted)
    size = 3000
    calls = [(1, f"c{k:05d}", k, "f", "{}", [f"c{k + 1:05d}"] if k < size - 1 else []) for k in range(size)]
    got = linked(spark, calls, [("f", "true")])
    assert [got[1, f"c{k:05d}"]["position"] for k in range(size)] == list(range(size))[::-1]
    assert rounds.count("waiting") <= 16


def test_empty_tables(spark):
    assert linked(spark, [], []) == {}
    assert linked(spark, [], [("f", "true")], [(1, "a", "x")])[1, "a"]["error"] == "no call"
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string, name string, level int")
    calls, results = T.conversation_calls(turns)
    assert T.link_calls(calls, results, T.schema_table(spark, T.CONVERSATION_SCHEMAS)).count() == 0
