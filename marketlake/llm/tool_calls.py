"""Tool calls of conversations: linked to results, ordered by what they need, validated and written as canonical JSON.

Calls and results meet in a hash join on conversation and call id. A conversation whose calls only need earlier calls is
ordered by place; only for the others are levels worked out, chains by pointer jumping. Positions are taken in bins, so a
conversation of any length is split. Arguments are validated against each tool's JSON schema (type, properties, required,
additionalProperties, items, enum); canonical JSON has sorted keys, no spaces and plain Unicode, and whole numbers no fraction.

Cases: calls or results that repeat an id count once, the smallest by content. A result without a call is a row without
position. A call that needs an unknown call, or is part of or behind a cycle, has no level: it comes after the others and
is not valid. Null or broken arguments (no JSON, NaN or numbers out of range, a key twice, lone surrogates, more than MAX_DEPTH
levels), a tool without a schema, or with a broken one, are not valid; broken arguments are null in the link. Null ids link with nothing and are
dropped. Empty tables give an empty result; extra columns are dropped.
"""

from __future__ import annotations

import functools
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.ranks import ranked
from marketlake.llm.scratch import stored

MAX_BROADCAST_SCHEMAS = 10_000
TURNS_A_BIN = 4096
CONVERSATION_SCHEMAS = {
    "answer": {
        "type": "object",
        "properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}, "after": {"type": "string"}},
        "required": ["prompt", "turn"],
        "additionalProperties": False,
    },
    "instruct": {"type": "object", "properties": {"instructions": {"type": "string"}}, "required": ["instructions"], "additionalProperties": False},
}
_TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}
#: Arguments nested deeper are an error, as are schemas; readers of the canonical text need no deep stack.
MAX_DEPTH = 100
#: Whole numbers up to this size have one form, with or without a fraction of zero.
_WHOLE = 2.0**53


class Broken(ValueError):
    """What is wrong with arguments or a schema."""


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _unique(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise Broken("repeats a key")
    return out


def _number(text: str):
    value = float(text)
    if math.isinf(value):
        raise Broken("holds a number out of range")
    return int(value) if value == int(value) and abs(value) <= _WHOLE else value


def _constant(text: str):
    raise Broken(f"holds {text}")


def strict_json(text: str):
    """The value of a JSON text: no NaN or infinity, no key twice, no lone surrogate, at most MAX_DEPTH levels.

    1.0 and 1 are the same number, written 1; other fractions take Python's shortest form.
    """
    depth = deepest = 0
    for mark in re.findall(r'"(?:[^"\\]|\\.)*"|[\[\]{}]', text, re.DOTALL) if text.count("[") + text.count("{") > MAX_DEPTH else ():
        depth += 1 if mark in "[{" else -1 if mark in "]}" else 0
        deepest = max(deepest, depth)
    if deepest > MAX_DEPTH:
        raise Broken(f"is nested more than {MAX_DEPTH} levels deep")
    try:
        value = json.loads(text, object_pairs_hook=_unique, parse_float=_number, parse_constant=_constant)
        canonical(value).encode()
    except Broken:
        raise
    except UnicodeEncodeError:
        raise Broken("holds a lone surrogate") from None
    except (ValueError, RecursionError):
        raise Broken("is not JSON") from None
    return value


def mismatch(value, schema, path: str = "$") -> str | None:
    """The first way in which `value` fails `schema`, or None. A schema may be true (all fit) or false (none does), and its
    type a list; one that is none of this, or has parts of another kind, raises Broken."""
    if isinstance(schema, bool):
        return None if schema else f"{path}: not allowed"
    if not isinstance(schema, dict):
        raise Broken("has a part that is neither an object nor true or false")
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    known, required, enum = schema.get("properties", {}), schema.get("required", []), schema.get("enum")
    parts_fit = isinstance(kinds, list) and isinstance(known, dict) and isinstance(required, list) and (enum is None or isinstance(enum, list))
    if not parts_fit or not all(isinstance(k, str) for k in (*kinds, *required)) or not {*kinds} <= {*_TYPES, "integer", "number"}:
        raise Broken("has a part of another kind")
    if kinds and not any(_is(value, kind) for kind in kinds):
        return f"{path}: not of type {' or '.join(kinds)}"
    if enum is not None and canonical(value) not in {canonical(e) for e in enum}:
        return f"{path}: not in enum"
    if isinstance(value, dict):
        other = schema.get("additionalProperties", True)
        for key in sorted(required):
            if key not in value:
                return f"{path}: misses {key}"
        for key in sorted(value):
            if key not in known and other is False:
                return f"{path}: unknown {key}"
            if found := mismatch(value[key], known.get(key, other), f"{path}.{key}"):
                return found
    if isinstance(value, list) and "items" in schema:
        for k, item in enumerate(value):
            if found := mismatch(item, schema["items"], f"{path}[{k}]"):
                return found
    return None


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or value == int(value))
    return isinstance(value, _TYPES[kind])


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of (conv_id, turn, role, text): a user's turn asks for an answer, after the one two turns before,
    a system's turn gives instructions; an assistant's turn is the result of the turn before it."""
    turns = conversations.where("conv_id is not null and turn is not null").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("text").alias("body"))
    name = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    asked = turns.where("role = 'user'").select("conv_id", (F.col("turn") + 2).alias("turn"), name(F.col("turn")).alias("after")).distinct()
    calls = turns.where("role in ('user', 'system')").join(asked, ["conv_id", "turn"], "left")
    after = F.when(F.col("role") == "user", F.col("after"))
    arguments = F.when(F.col("role") == "user", F.to_json(F.struct(F.col("body").alias("prompt"), "turn", after.alias("after")))).otherwise(
        F.to_json(F.struct(F.col("body").alias("instructions")))
    )
    calls = calls.select(
        "conv_id",
        name(F.col("turn")).alias("call_id"),
        F.col("turn").alias("seq"),
        F.when(F.col("role") == "user", "answer").otherwise("instruct").alias("name"),
        arguments.alias("arguments"),
        F.when(after.isNotNull(), F.array(after)).otherwise(F.array().cast("array<string>")).alias("needs"),
    )
    results = turns.where("role = 'assistant'").select("conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("body").alias("content"))
    return calls, results


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 where every need is of an earlier call; else one more than the needs' levels, or null."""
    ids = calls.select("conv_id", F.col("call_id").alias("need"), F.col("seq").alias("need_seq"))
    needs = calls.select("conv_id", "call_id", "seq", F.explode("needs").alias("need")).join(ids, ["conv_id", "need"], "left")
    odd = stored(needs.where("need_seq is null or need_seq >= seq").select("conv_id").distinct(), "odd-conversations")
    plain = calls.join(odd, "conv_id", "left_anti").select("conv_id", "call_id", F.lit(0).cast("int").alias("level"))
    if odd.isEmpty():
        return plain
    nodes = stored(calls.join(odd, "conv_id").select("conv_id", "call_id", "needs"), "calls-out-of-order")
    levels = _out_of_order(nodes)
    stuck = nodes.join(levels, ["conv_id", "call_id"], "left_anti").select("conv_id", "call_id", F.lit(None).cast("int").alias("level"))
    return plain.union(levels).union(stuck)


def _out_of_order(nodes: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls whose needs can be ordered: the longest way to a call without needs.

    An edge leads from a call to one it needs. In a round, edges to calls with a known level take it, calls of which all
    edges have one get theirs, and an edge to a call with a single open edge and no other takes that edge's end, its length
    added: a chain halves its length in a round, so a chain of n calls takes about log2(n) rounds. An edge longer than
    there are calls runs in a circle, and is dropped with its call. Only the newest levels are joined.
    """
    key = ["conv_id", "call_id"]
    most = nodes.count()
    edges = nodes.select(*key, F.explode(F.array_distinct("needs")).alias("need"))
    known = nodes.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("known"))
    edges = edges.join(known, ["conv_id", "need"], "left").select(*key, "need", F.lit(1).alias("length"), F.lit(None).cast("int").alias("base"), F.col("known").isNull().alias("lost"))
    edges = stored(edges, "needs")
    new = stored(nodes.join(edges.select(*key).distinct(), key, "left_anti").select(*key, F.lit(0).cast("int").alias("level")), "levels")
    done, before = [new], None
    while True:
        level = new.select("conv_id", F.col("call_id").alias("need"), "level")
        met = edges.where("base is null").join(level, ["conv_id", "need"], "left").withColumn("base", (F.col("level") + F.col("length")).cast("int")).drop("level")
        met = stored(met.select(*edges.columns).union(edges.where("base is not null")), "needs")
        calls = met.groupBy(*key).agg(F.count("*").alias("n"), F.count("base").alias("n_met"), F.max("base").alias("level"), F.max("lost").alias("lost"))
        calls = stored(calls, "waiting")
        new = stored(calls.where("n = n_met").select(*key, "level"), "levels")
        done.append(new)
        open_ = met.join(calls.where("n > n_met and not lost").select(*key, "n"), key)
        single = open_.where("n = 1").select("conv_id", F.col("call_id").alias("need"), F.col("need").alias("further"), F.col("length").alias("more"))
        jumped = open_.drop("n").join(single, ["conv_id", "need"], "left")
        further = F.col("more").isNotNull() & F.col("base").isNull()
        length = F.when(further, F.col("length") + F.col("more")).otherwise(F.col("length"))
        jumped = jumped.select(*key, F.when(further, F.col("further")).otherwise(F.col("need")).alias("need"), length.alias("length"), "base", (F.col("lost") | (length > most)).alias("lost"))
        edges = stored(jumped, "needs")
        state = edges.agg(F.count("*"), F.sum("length"), F.count("base")).first()
        if state[0] == 0 or (state == before and new.isEmpty()):
            break
        before = state
    return functools.reduce(DataFrame.union, done).select(*key, "level")


def _serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parsed: dict[str, dict] = {}
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            error, value = None, None
            if r["position"] is None:
                error = "no call"
            elif r["level"] is None:
                error = "needs an unknown call or itself"
            else:
                try:
                    value = strict_json(r["arguments"]) if r["arguments"] is not None else None
                except Broken as broken:
                    error = "arguments are not JSON" if str(broken) == "is not JSON" else f"arguments: {broken}"
                if error is None and r["schema"] is None:
                    error = "no schema"
                if error is None:
                    try:
                        if r["schema"] not in parsed:
                            parsed[r["schema"]] = strict_json(r["schema"])
                        error = mismatch(value, parsed[r["schema"]])
                    except Broken as broken:
                        error = f"schema: {broken}"
            link = {"arguments": value, "call_id": r["call_id"], "name": r["name"], "needs": r["needs"] or [], "result": r["content"]}
            out.append((error is None, error, canonical(link)))
        valid, errors, links = zip(*out, strict=True) if out else ([], [], [])
        columns = [batch.column(k) for k in range(5)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(list(valid), pa.bool_()), pa.array(list(errors), pa.string()), pa.array(list(links), pa.string())],
            ["conv_id", "call_id", "name", "position", "has_result", "valid", "error", "link_json"],
        )


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and per result without one, from calls (conv_id, call_id, seq, name, arguments, needs), results
    (conv_id, call_id, content) and schemas (name, schema)."""
    key = ["conv_id", "call_id"]
    first = F.min(F.struct("seq", "name", "arguments", "needs")).alias("c")
    calls = calls.dropna(subset=key).groupBy(*key).agg(first).select(*key, "c.*")
    calls = stored(calls.withColumn("needs", F.coalesce("needs", F.array().cast("array<string>"))), "calls")
    placed = calls.join(_levels(calls), key)
    late = F.coalesce("level", F.lit(2**31 - 1))
    placed = ranked(placed.withColumn("late", late), ["conv_id"], F.struct(late.alias("late"), F.floor(F.coalesce("seq", F.lit(0)) / TURNS_A_BIN).alias("part")), ["late", "seq", "call_id"], "position")
    results = results.dropna(subset=key).groupBy(*key).agg(F.min("content").alias("content"), F.lit(True).alias("has_result"))
    linked = placed.join(results, key, "full")
    schemas = schemas.groupBy("name").agg(F.min("schema").alias("schema"))
    if schemas.count() <= MAX_BROADCAST_SCHEMAS:
        schemas = F.broadcast(schemas)
    linked = linked.join(schemas, "name", "left")
    columns = ["conv_id", "call_id", "name", "position", F.coalesce("has_result", F.lit(False)).alias("has_result"), "level", "arguments", "needs", "content", "schema"]
    conv = dict(calls.dtypes)["conv_id"]
    return linked.select(*columns).mapInArrow(_serialise, f"conv_id {conv}, call_id string, name string, position long, has_result boolean, valid boolean, error string, link_json string")


def schema_table(spark: SparkSession, schemas: dict[str, dict]) -> DataFrame:
    return spark.createDataFrame([(name, json.dumps(s)) for name, s in schemas.items()], "name string, schema string")
