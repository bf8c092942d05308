"""Chat formatting with tool calls: calls and results linked, ordered, validated and written as canonical JSON.

A call is a message of the assistant with ``tool_calls``, a result one with the
id of its call.  Calls and results are joined by conversation and id.  An
argument of the form {"$ref": id} makes a call depend on the result of another.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import stored

CALLS = "conv_id long, turn long, position int, call_id string, name string, arguments string, refs array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"
_TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def canonical(value) -> str:
    """JSON with sorted keys, without blanks, in plain Unicode."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def references(value) -> list[str]:
    """Ids that occur as {"$ref": id} anywhere in a value."""
    found, stack = set(), [value]
    while stack:
        item = stack.pop()
        if isinstance(item, dict):
            if isinstance(item.get("$ref"), str) and len(item) == 1:
                found.add(item["$ref"])
            stack.extend(item.values())
        elif isinstance(item, list):
            stack.extend(item)
    return sorted(found)


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """What in a value goes against a JSON schema (type, required, properties, additionalProperties, enum, items)."""
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(_TYPES.get(kind, lambda v: True)(value) for kind in kinds):
            return [f"{path}: not {'/'.join(kinds)}"]
    out = [] if "enum" not in schema or value in schema["enum"] else [f"{path}: not in enum"]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                out += violations(value[name], known[name], f"{path}.{name}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{name}: unknown")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for n, item in enumerate(value):
            out += violations(item, schema["items"], f"{path}[{n}]")
    return out


def _parsed(text: str | None):
    try:
        return json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None


def calls_and_results(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The calls and results in messages (conv_id, turn, role, text) whose text is such JSON; others have none.

    An assistant's message is {"tool_calls": [{"id", "name", "arguments"}]}, a
    tool's {"tool_call_id", "content"}.
    """

    def calls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                message = _parsed(text)
                listed = message.get("tool_calls") if isinstance(message, dict) else None
                for n, call in enumerate(listed if isinstance(listed, list) else ()):
                    if isinstance(call, dict) and isinstance(call.get("id"), str):
                        arguments = call.get("arguments")
                        arguments = _parsed(arguments) if isinstance(arguments, str) else arguments
                        row = conv, turn, n, call["id"], str(call.get("name") or ""), canonical(arguments)
                        rows.append((*row, references(arguments)))
            yield _batch(rows, CALLS)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                message = _parsed(text)
                if isinstance(message, dict) and isinstance(message.get("tool_call_id"), str):
                    content = message.get("content")
                    content = content if isinstance(content, str) else canonical(content)
                    rows.append((conv, turn, message["tool_call_id"], content))
            yield _batch(rows, RESULTS)

    chosen = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return (
        chosen.filter("role = 'assistant' AND text LIKE '%tool_calls%'").drop("role").mapInArrow(calls, CALLS),
        chosen.filter("role = 'tool'").drop("role").mapInArrow(results, RESULTS),
    )


_ARROW_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split(" ") for field in ddl.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW_TYPES[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names)
    )


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and result of it, with place in the order, verdict and canonical JSON, and one per orphan result.

    ``calls`` has the columns CALLS, ``results`` RESULTS, ``schemas`` name and
    schema (JSON text).  Returns conv_id, call_id, turn, status, after_turn,
    after_steps, errors and json:

    * status is ``linked``, ``unanswered``, ``repeated`` (a later call with the
      id of an earlier one, which keeps the result) or ``orphan`` (a result
      without a call).  A call with several results has a row for each, so that
      every row of ``results`` has its own, those without an id as well.
    * Rows of a conversation are in topological order by (after_turn,
      after_steps, turn, position): after_turn is the latest turn of the call
      and of all it depends on, after_steps the steps to wait there.  Calls in
      or behind a circle of dependencies have the status ``circular`` and keep
      their own turn.
    * errors lists what in the arguments goes against the schema of that name; a
      call without a known schema has the error ``unknown tool``.

    A null id links with nothing; a null conv_id is a conversation of its own.
    References to ids that aren't called are ignored.  Empty tables give an
    empty result.
    """
    held = stored(calls.distinct(), "calls")
    first = held.filter("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "position")).alias("first"))
    first = stored(first, "first-calls")
    answers = results.select("conv_id", "turn", "call_id", "content", F.lit(True).alias("here"))
    ordered = _ordered(held, first)
    same = "{0}.conv_id <=> {1}.conv_id AND {0}.call_id = {1}.call_id".format
    repeated = "f.first IS NOT NULL AND NOT (f.first.turn <=> c.turn AND f.first.position <=> c.position)"
    marked = (
        held.alias("c")
        .join(first.alias("f"), F.expr(same("c", "f")), "left")
        .select("c.*", F.expr(repeated).alias("repeated"))
    )
    rows = (
        marked.alias("c")
        .join(answers.alias("r"), F.expr(same("c", "r") + " AND NOT c.repeated"), "left")
        .join(ordered.alias("o"), F.expr(same("c", "o")), "left")
        .join(schemas.dropDuplicates(["name"]).alias("s"), F.expr("c.name = s.name"), "left")
    )
    found = rows.select(
        "c.conv_id",
        "c.call_id",
        "c.turn",
        "c.position",
        "c.name",
        "c.arguments",
        "r.content",
        F.when(F.col("c.repeated"), "repeated")
        .when(F.col("o.circular"), "circular")
        .when(F.expr("r.here IS NULL"), "unanswered")
        .otherwise("linked")
        .alias("status"),
        F.coalesce("o.after_turn", "c.turn").alias("after_turn"),
        F.coalesce("o.after_steps", F.lit(0)).alias("after_steps"),
        "s.schema",
    )
    orphans = answers.alias("r").join(first.alias("f"), F.expr(same("r", "f")), "left_anti").select(
        "conv_id",
        "call_id",
        "turn",
        F.lit(0).alias("position"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"),
        "content",
        F.lit("orphan").alias("status"),
        F.col("turn").alias("after_turn"),
        F.lit(0).alias("after_steps"),
        F.lit(None).cast("string").alias("schema"),
    )
    return found.unionByName(orphans).mapInArrow(_written, _LINKED)


_LINKED = (
    "conv_id long, call_id string, turn long, position int, status string, after_turn long, after_steps int, "
    "errors array<string>, json string"
)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            errors, message = [], {"content": r["content"], "role": "tool", "tool_call_id": r["call_id"]}
            if r["status"] != "orphan":
                arguments = _parsed(r["arguments"])
                schema = _parsed(r["schema"])
                errors = violations(arguments, schema) if isinstance(schema, dict) else ["unknown tool"]
                call = {"arguments": arguments, "id": r["call_id"], "name": r["name"]}
                message = {"call": call, "result": r["content"]}
            rows.append(
                (r["conv_id"], r["call_id"], r["turn"], r["position"], r["status"], r["after_turn"], r["after_steps"])
                + (errors, canonical(message))
            )
        yield _batch(rows, _LINKED)


def _ordered(calls: DataFrame, first: DataFrame) -> DataFrame:
    """after_turn, after_steps and circular for calls that depend on a call that isn't in an earlier turn.

    A call after everything it depends on is in order already, so only the
    others and what depends on them are moved, step by step until all are in
    place.  A path without a circle takes each such backward dependency of its
    conversation once at most; one that takes more is in or behind a circle.
    """
    same = "{0}.conv_id <=> {1}.conv_id AND {0}.call_id = {1}.call_id".format
    place = "struct({} AS circular, {} AS after_turn, {} AS after_steps, {} AS backward)".format
    needs = (
        calls.filter("call_id IS NOT NULL")
        .select("conv_id", "call_id", "turn", F.explode("refs").alias("needed"))
        .alias("c")
        .join(first.alias("f"), F.expr("c.conv_id <=> f.conv_id AND c.needed = f.call_id"))
        .selectExpr("c.conv_id", "c.call_id", "c.turn", "c.needed", "f.first.turn AS needed_turn")
        .distinct()
    )
    needs = stored(needs, "needs")
    backward = needs.filter("needed_turn >= turn")
    limits = stored(backward.groupBy("conv_id").agg(F.count(F.lit(1)).alias("limit")), "limits")
    places = (
        backward.withColumn("place", F.expr(place("0", "needed_turn", "1L", "1L")))
        .groupBy("conv_id", "call_id")
        .agg(F.max("place").alias("place"))
    )
    places = stored(places, "places")
    while True:
        moved = (
            needs.alias("n")
            .join(limits.alias("l"), F.expr("n.conv_id <=> l.conv_id"))
            .join(places.alias("p"), F.expr("n.conv_id <=> p.conv_id AND n.needed = p.call_id"))
            .withColumn("backward", F.expr("p.place.backward + CAST(n.needed_turn >= n.turn AS BIGINT)"))
            .filter("p.place.circular = 1 OR p.place.after_turn >= n.turn")
            .withColumn(
                "moved",
                F.expr(
                    f"CASE WHEN p.place.circular = 1 OR backward > l.limit THEN {place('1', '0L', '0L', '0L')} "
                    f"ELSE {place('0', 'p.place.after_turn', 'p.place.after_steps + 1', 'backward')} END"
                ),
            )
            .selectExpr("n.conv_id", "n.call_id", "moved AS place")
        )
        further = stored(
            places.unionByName(moved).groupBy("conv_id", "call_id").agg(F.max("place").alias("place")), "places"
        )
        changed = further.alias("a").join(
            places.alias("b"), F.expr(same("a", "b") + " AND a.place = b.place"), "left_anti"
        )
        if changed.isEmpty():
            break
        places = further
    known = F.col("place.circular") == 0
    return places.select(
        "conv_id",
        "call_id",
        F.when(known, F.col("place.after_turn")).alias("after_turn"),
        F.when(known, F.col("place.after_steps").cast("int")).alias("after_steps"),
        (~known).alias("circular"),
    )
