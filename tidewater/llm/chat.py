"""Tool calls of conversations linked to their results, in canonical JSON.

An assistant turn may hold a JSON object with ``tool_calls``: a list of {"id", "name",
"arguments", "after"}; a tool turn is a JSON object {"tool_call_id", "content"}. Calls of
one message are put in topological order of ``after`` (ties keep their place in the
message), calls and results meet in a hash join by conversation and identifier, and
arguments are validated against the tool's schema. Each call becomes one row with its
canonical JSON: keys sorted, no white space, characters outside ASCII as they are.

``status`` is the first of these that holds: ``malformed`` (no id, no name, or arguments
that aren't an object), ``duplicate id`` (an earlier call of the conversation has it),
``cycle`` (``after`` leads back to the call), ``unknown tool``, ``invalid: ...`` (what is
wrong with the arguments), ``unknown dependency`` (``after`` names no call of this message
or an earlier one), ``no result``, ``ok``. A result nobody asked for, or given before its
call, has status ``orphan``. Of several results of one call the earliest counts, ties by
content.

An assistant turn that begins like such an object but is not valid JSON (cut off, ``NaN`` or
``Infinity``, a number beyond a double, a lone surrogate) is one ``malformed`` call without an
identifier; a tool turn of that kind gives no row.

Turns with null or empty text, or that hold no such JSON, are ordinary messages and give
no rows; rows without conversation or turn are ignored; equal rows count once. An empty
table gives an empty result, and further columns are ignored.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

#: Tools of the derived conversations and the schemas of their arguments.
TOOLS = {
    "count_words": {"required": ["text"], "properties": {"text": {"type": "string", "minLength": 1}, "lower": {"type": "boolean"}}},
    "store_line": {
        "required": ["line", "text"],
        "properties": {"line": {"type": "integer", "minimum": 0}, "text": {"type": "string"}, "lang": {"type": "string", "enum": ["de", "en", "es", "fr"]}},
    },
}

_SCHEMA = (
    "conv_id long, turn long, kind string, place int, call_id string, name string, arguments string, problem string, after array<string>, content string"
)
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int32(), *[pa.string()] * 4, pa.list_(pa.string()), pa.string()]
_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def fault(value, schema: dict, at: str = "") -> str | None:
    """First thing wrong with ``value``, properties in order of their names; None if it is valid."""
    kind = schema.get("type", "object")
    if not isinstance(value, _TYPES[kind]) or (kind in ("integer", "number") and isinstance(value, bool)):
        return f"{at or 'arguments'} is not {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at} not allowed"
    if "minimum" in schema and value < schema["minimum"]:
        return f"{at} too small"
    if "minLength" in schema and len(value) < schema["minLength"]:
        return f"{at} too short"
    if kind == "object" and ("properties" in schema or "required" in schema):
        known = schema.get("properties", {})
        for name in sorted({*schema.get("required", []), *value}):
            path = f"{at}.{name}" if at else name
            if name not in value:
                return f"{path} missing"
            if name not in known:
                return f"{path} unknown"
            if found := fault(value[name], known[name], path):
                return found
    if kind == "array" and "items" in schema:
        for k, item in enumerate(value):
            if found := fault(item, schema["items"], f"{at}[{k}]"):
                return found
    return None


def ordered(calls: list[dict]) -> tuple[list[int], set[int]]:
    """Topological order of a message's calls, and those on or behind a cycle, which come last."""
    place = {}
    for k, call in enumerate(calls):
        place.setdefault(call["id"], k)
    waits = [{place[a] for a in call["after"] if a in place} for call in calls]
    then: list[list[int]] = [[] for _ in calls]
    for k, before in enumerate(waits):
        for b in before:
            then[b].append(k)
    import heapq

    ready = [k for k, before in enumerate(waits) if not before]
    out, left = [], [len(b) for b in waits]
    while ready:
        k = heapq.heappop(ready)
        out.append(k)
        for t in then[k]:
            left[t] -= 1
            if not left[t]:
                heapq.heappush(ready, t)
    stuck = set(range(len(calls))) - set(out)
    return out + sorted(stuck), stuck


def _calls(text: str) -> list[dict]:
    found = _json(text).get("tool_calls")
    out = []
    for raw in found if isinstance(found, list) else []:
        raw = raw if isinstance(raw, dict) else {}
        after = raw.get("after")
        out.append({
            "id": raw["id"] if isinstance(raw.get("id"), str) else None, "name": raw["name"] if isinstance(raw.get("name"), str) else None,
            "arguments": raw.get("arguments"), "after": [a for a in after if isinstance(a, str)] if isinstance(after, list) else [],
        })
    return out


def _json(text: str | None) -> dict:
    if not text or not text.lstrip().startswith("{"):
        return {}
    try:
        found = json.loads(text)
        canonical(found).encode("utf-8")  # no lone surrogates, no NaN and no number beyond a double
    except (ValueError, RecursionError):
        return {}
    return found if isinstance(found, dict) else {}


def _message(conv: int, turn: int, role: str | None, text: str | None, tools: dict) -> list[tuple]:
    if role == "tool":
        found = _json(text)
        call = found.get("tool_call_id")
        if not isinstance(call, str):
            return []
        content = found.get("content")
        return [(conv, turn, "result", 0, call, None, None, None, None, content if isinstance(content, str) else canonical(content))]
    if role != "assistant":
        return []
    calls = _calls(text) if text and "tool_calls" in text else []
    if not calls and text and text.lstrip().startswith("{") and '"tool_calls"' in text and not _json(text):
        return [(conv, turn, "call", 0, None, None, "null", "malformed", [], None)]
    order, stuck = ordered(calls)
    rows = []
    for place, k in enumerate(order):
        call = calls[k]
        bad = None
        if not call["id"] or not call["name"] or not isinstance(call["arguments"], dict):
            bad = "malformed"
        elif k in stuck:
            bad = "cycle"
        elif call["name"] not in tools:
            bad = "unknown tool"
        elif found := fault(call["arguments"], tools[call["name"]]):
            bad = f"invalid: {found}"
        rows.append((conv, turn, "call", place, call["id"], call["name"], canonical(call["arguments"]), bad, call["after"], None))
    return rows


def parsed(messages: DataFrame, tools: dict) -> DataFrame:
    """Calls, ordered and validated, and results of all messages, each in its own row."""

    def work(batches):
        for batch in batches:
            rows = [r for m in zip(*(c.to_pylist() for c in batch.columns)) for r in _message(*m, tools)]
            columns = zip(*rows) if rows else [[]] * len(_KINDS)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS)], names=[f.split()[0] for f in _SCHEMA.split(", ")])

    plain = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return plain.distinct().mapInArrow(work, _SCHEMA)


def linked(messages: DataFrame, tools: dict) -> DataFrame:
    """(conv_id, turn, place, call_id, status, json): one row for each call and orphan result.
    (turn, place) is a topological order of a conversation's calls."""
    rows = written(parsed(messages, tools), "chat-parsed")
    key = ["conv_id", "call_id"]
    calls = rows.where("kind = 'call'").withColumn("seen", F.row_number().over(Window.partitionBy(*key).orderBy("turn", "place", "arguments")))
    first = calls.where("seen = 1 AND call_id IS NOT NULL").select(*key, F.col("turn").alias("asked"))
    results = rows.where("kind = 'result'").select(*key, F.struct("turn", "content").alias("r"))
    met = results.join(first.hint("shuffle_hash"), key, "left")
    given = met.where(F.col("r.turn") > F.col("asked")).groupBy(*key).agg(F.min("r").alias("r"))
    orphans = met.where(F.coalesce(F.col("r.turn") <= F.col("asked"), F.lit(True))).select(
        "conv_id", "r.turn", F.lit(0).alias("place"), "call_id", F.lit("orphan").alias("status"), F.col("r.content").alias("json")
    )
    # what a call waits for must have been asked in its message or an earlier one
    waits = calls.select(*key, "turn", "place", F.explode(F.array_distinct("after")).alias("before"))
    lost = (
        waits.join(first.select("conv_id", F.col("call_id").alias("before"), "asked").hint("shuffle_hash"), ["conv_id", "before"], "left")
        .where(F.coalesce(F.col("asked") > F.col("turn"), F.lit(True))).select("conv_id", "turn", "place").distinct().withColumn("lost", F.lit(True))
    )
    full = calls.join(given.hint("shuffle_hash"), key, "left").join(lost, ["conv_id", "turn", "place"], "left")
    status = (
        F.when(F.col("problem") == "malformed", F.col("problem")).when(F.col("seen") > 1, "duplicate id")
        .when(F.col("problem").isNotNull(), F.col("problem")).when(F.col("lost"), "unknown dependency").when(F.col("r").isNull(), "no result").otherwise("ok")
    )
    text = F.when(F.col("seen") == 1, F.col("r.content"))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    parts = [
        F.concat(F.lit('{"arguments":'), "arguments"),
        F.when(F.col("call_id").isNotNull(), F.concat(F.lit('"id":'), quoted(F.col("call_id")))),
        F.when(F.col("name").isNotNull(), F.concat(F.lit('"name":'), quoted(F.col("name")))),
        F.when(text.isNotNull(), F.concat(F.lit('"result":'), quoted(text))),
    ]
    return full.select("conv_id", "turn", "place", "call_id", status.alias("status"), F.concat(F.concat_ws(",", *parts), F.lit("}")).alias("json")).unionByName(orphans)


def derived(conversations: DataFrame) -> DataFrame:
    """Messages with tool traffic made of plain conversations, as these hold none.

    Every assistant turn asks for one call per line of its whole text: lines at even places
    are counted, others stored; each waits for the line behind it, so the order turns
    round. Calls and the results of even lines get turns 2n and 2n + 1 of turn n. Some places
    depart from that, so that every status occurs: a call that waits for itself, for nothing
    there is, has no name, the id of the call before, or a tool that nobody knows, and a
    result that nobody asked for.
    """
    said = conversations.where("role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines")
    )
    said = said.withColumnRenamed("turn", "said_at").withColumn("odd", F.pmod(F.xxhash64("conv_id", "said_at"), F.lit(12)))
    name = lambda k: F.concat(F.lit("c"), F.col("said_at").cast("string"), F.lit("-"), k.cast("string"))

    def call(line: Column, k: Column) -> Column:
        departs = lambda kind: (F.col("odd") == kind) & (k == F.size("lines") - 1)
        tool = F.when(k % 2 == 0, "count_words").otherwise("store_line")
        waits = F.when(k + 1 < F.size("lines"), F.array(name(k + 1)))
        return F.struct(
            F.when(departs(1), name(F.greatest(k - 1, F.lit(0)))).otherwise(name(k)).alias("id"),
            F.when(departs(2), F.lit(None)).when(departs(3), "translate").otherwise(tool).alias("name"),
            F.struct(F.when(k % 2 == 1, k).alias("line"), line.alias("text")).alias("arguments"),
            F.when(departs(4), F.array(name(k))).when(departs(5), F.array(F.lit("c-none"))).otherwise(waits).alias("after"),
        )

    asked = said.select("conv_id", (2 * F.col("said_at")).alias("turn"), F.lit("assistant").alias("role"), F.to_json(F.struct(F.transform("lines", call).alias("tool_calls"))).alias("text"))
    each = said.select("conv_id", "said_at", "odd", F.posexplode("lines").alias("k", "line")).where("k % 2 = 0")
    wanted = F.when((F.col("odd") == 6) & (F.col("k") == 0), F.concat(F.lit("x"), name(F.col("k")))).otherwise(name(F.col("k")))
    answers = each.select(
        "conv_id", (2 * F.col("said_at") + 1).alias("turn"), F.lit("tool").alias("role"),
        F.to_json(F.struct(wanted.alias("tool_call_id"), F.length("line").cast("string").alias("content"))).alias("text"),
    )
    return asked.unionByName(answers)
