"""Tool calls of conversations: linked to their results, put in order, validated and written as canonical JSON.

Calls and results meet in a hash join on conversation and call id. A call may refer to the result of another
of its conversation by an argument ``{"$ref": id}``; it then comes after it. A call's level is the longest
chain of references below it. Chains of calls with one reference each are shortened by doubling their pointers, so
that their rounds grow with the logarithm of their length; what is left are calls with several references, taken in
rounds of those whose references all have a level. Calls on a cycle, or that lead to a missing call, have none. Calls come by level and turn, each before its
result. Arguments are checked against the tool's schema. Every call and result is a row of its own, so a
conversation of any length is never gathered.

Defined cases: of several calls or results of one id the first counts (least turn, then least text) and the
others are kept with status ``repeated``; a result without a call is ``orphan``; arguments that are null or
not a JSON object (NaN, infinite numbers and values nested deeper than ``DEPTH`` are no JSON here) fail validation
and are written as null; halves of surrogate pairs are written as escapes; of a key that occurs twice the last counts; rows with a null conversation or id link to nothing; turns of any role but
user and assistant, also of none, are messages of their own that link to nothing; empty tables give no rows;
columns beyond those named are left out.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fields, need_columns, stored

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}
#: Levels of nesting that arguments may have.
DEPTH = 200

_HALVES = re.compile("[\ud800-\udfff]")


def plain(text: str) -> str:
    """Halves of surrogate pairs, which no table can hold, as escapes."""
    return _HALVES.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: Any) -> str:
    """JSON with sorted keys, no spaces, and characters as they are."""
    return plain(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def is_kind(value: Any, kind: str) -> bool:
    """Whether a value has a type by name; 1.0 is an integer, True is no number."""
    if isinstance(value, bool) and kind in ("integer", "number"):
        return False
    return isinstance(value, KINDS.get(kind, object)) or kind == "integer" and isinstance(value, float) and value.is_integer()


def faults(value: Any, schema: dict | bool, at: str = "$") -> list[str]:
    """What in ``value`` breaks the schema (type, enum, minimum, required, properties, items, additionalProperties).

    A type may be a list of types; a schema of true allows all, of false nothing.
    """
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: not allowed"]
    kind = schema.get("type")
    kinds = [kind] if isinstance(kind, str) else kind or []
    if kinds and not any(is_kind(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and canonical(value) not in [canonical(v) for v in schema["enum"]]:
        out.append(f"{at}: not allowed")
    if "minimum" in schema and is_kind(value, "number") and value < schema["minimum"]:
        out.append(f"{at}: too small")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
            elif not schema.get("additionalProperties", True):
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += faults(v, schema["items"], f"{at}[{i}]")
    return out


def references(value: Any) -> Iterator[str]:
    """Ids that arguments refer to."""
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            yield value["$ref"]
        else:
            for v in value.values():
                yield from references(v)
    elif isinstance(value, list):
        for v in value:
            yield from references(v)


def _finite(text: str) -> float:
    number = float(text)
    if not math.isfinite(number):
        raise ValueError(text)
    return number


def _refused(name: str) -> None:
    raise ValueError(name)


def loaded(text: str | None) -> Any:
    """The value of a JSON text, None if it is none or nested too deep."""
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_refused) if text is not None else None
    except (ValueError, RecursionError):
        return None
    level = [value]
    for _ in range(DEPTH):
        level = [v for x in level if isinstance(x, (dict, list)) for v in (x.values() if isinstance(x, dict) else x)]
        if not level:
            return value
    return None


def _checked(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Calls with their canonical JSON, faults and references."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, wrong, refs = [], [], []
            for call_id, name, text in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                arguments = loaded(text)
                if not isinstance(arguments, dict):
                    problems = ["$: not an object"]
                elif name not in schemas:
                    problems = ["unknown tool"]
                else:
                    problems = faults(arguments, schemas[name])
                bodies.append(canonical({"arguments": arguments, "id": call_id, "name": name, "type": "call"}))
                wrong.append(plain("; ".join(problems)))
                refs.append(sorted({plain(r) for r in references(arguments)}))
            yield pa.record_batch({**{k: batch.column(i) for i, k in enumerate(("conv_id", "turn", "call_id"))}, "json": pa.array(bodies, pa.string()), "faults": pa.array(wrong, pa.string()), "refs": pa.array(refs, pa.list_(pa.string()))})

    kinds = dict(calls.dtypes)
    return calls.mapInArrow(check, fields(conv_id=kinds["conv_id"], turn=kinds["turn"], call_id="string", json="string", faults="string", refs="array<string>"))


def _written(results: DataFrame) -> DataFrame:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [canonical({"content": c, "id": i, "type": "result"}) for i, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.record_batch({**{k: batch.column(i) for i, k in enumerate(("conv_id", "turn", "call_id"))}, "json": pa.array(bodies, pa.string())})

    kinds = dict(results.dtypes)
    return results.mapInArrow(write, fields(conv_id=kinds["conv_id"], turn=kinds["turn"], call_id="string", json="string"))


def _first(rows: DataFrame) -> DataFrame:
    """Marks the first row of each conversation and id."""
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    # Rows that link to nothing are spread.
    w = Window.partitionBy("conv_id", "call_id", F.when(~known, F.xxhash64("turn", "json"))).orderBy("turn", "json")
    return rows.withColumn("first", known & (F.row_number().over(w) == 1))


def chains(calls: DataFrame) -> tuple[DataFrame, int]:
    """Where the chain of each call with one reference ends, and how many steps away; and the rounds it took.

    ``conv_id``, ``call_id``, ``end`` (a call with no or several references, or a missing one) and ``steps``. Chains that run
    into a cycle have no end and are left out.
    """
    pointers = stored(calls.where(F.size("refs") == 1).select("conv_id", "call_id", F.col("refs")[0].alias("end"), F.lit(1).cast("long").alias("steps"), F.lit(True).alias("open")))
    longest = pointers.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    rounds = 0
    # After so many doublings, whoever still runs has passed some call twice.
    while 1 << rounds <= longest:
        ahead = pointers.select(F.col("conv_id").alias("of"), F.col("call_id").alias("via"), F.col("end").alias("to"), F.col("steps").alias("more"))
        met = pointers.where("open").join(ahead, F.expr("conv_id = of AND end = via"), "left")
        moved = met.select("conv_id", "call_id", F.coalesce("to", "end").alias("end"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("via").isNotNull().alias("open"))
        pointers = stored(moved.union(pointers.where("NOT open")))
        rounds += 1
        if pointers.where("open").isEmpty():
            break
    return pointers.where("NOT open").drop("open"), rounds


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id``, ``call_id`` and ``level`` of all calls (``refs`` lists the ids they refer to) that can be ordered."""
    ends, _ = chains(calls)
    level = F.lit(0).cast("long").alias("level")
    known = calls.where(F.size("refs") == 0).select("conv_id", "call_id", level)
    links = calls.where(F.size("refs") > 1).select("conv_id", "call_id", F.size("refs").alias("n"), F.explode("refs").alias("ref"))
    tail = ends.select(F.col("conv_id").alias("of"), F.col("call_id").alias("via"), "end", "steps")
    waiting = stored(links.join(tail, F.expr("conv_id = of AND ref = via"), "left").select("conv_id", "call_id", "n", F.coalesce("end", "ref").alias("end"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")))
    found = stored(known)
    parts = [found]
    while not waiting.isEmpty():
        base = found.select(F.col("conv_id").alias("of"), F.col("call_id").alias("via"), "level")
        # A link that has met its level keeps it; only levels new in the last round are looked up.
        met = waiting.join(base, F.expr("conv_id = of AND end = via"), "left")
        if "below" not in waiting.columns:
            met = met.withColumn("below", F.col("level") + F.col("steps"))
        else:
            met = met.withColumn("below", F.coalesce("below", F.col("level") + F.col("steps")))
        met = stored(met.select("conv_id", "call_id", "n", "end", "steps", "below"))
        found = stored(met.groupBy("conv_id", "call_id", "n").agg(F.count("below").alias("met"), F.max("below").alias("level")).where("met = n").select("conv_id", "call_id", "level"))
        if found.isEmpty():
            break
        parts.append(found)
        waiting = stored(met.join(found.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti"))
    for part in parts[1:]:
        known = known.union(part)
    base = known.select(F.col("conv_id").alias("of"), F.col("call_id").alias("via"), "level")
    along = ends.join(base, F.expr("conv_id = of AND end = via")).select("conv_id", "call_id", (F.col("level") + F.col("steps")).alias("level"))
    return known.union(along).withColumn("level", F.col("level").cast("int"))


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Calls (``conv_id``, ``turn``, ``call_id``, ``name``, ``arguments``) and results (``content`` instead of the last two) in order.

    ``conv_id``, ``turn``, ``kind`` (call or result), ``call_id``, ``level``, ``call_turn`` (order by level,
    call_turn and kind), ``status``, ``faults`` and ``json``. A call is ``ok``, ``invalid``, ``unanswered``,
    ``unordered`` or ``repeated``, a result ``ok``, ``orphan`` or ``repeated``.
    """
    checked = stored(_first(_checked(need_columns(calls, ["conv_id", "turn", "call_id", "name", "arguments"]), schemas)))
    written = _first(_written(need_columns(results, ["conv_id", "turn", "call_id", "content"])))
    firsts = checked.where("first")
    placed = levels(firsts.select("conv_id", "call_id", "refs"))
    answered = written.where("first").select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_id"), F.lit(True).alias("answered"))
    ordered = placed.select(F.col("conv_id").alias("p_conv"), F.col("call_id").alias("p_id"), "level")
    from_call = checked.join(ordered, F.expr("first AND conv_id = p_conv AND call_id = p_id"), "left").join(answered, F.expr("first AND conv_id = r_conv AND call_id = r_id"), "left")
    status = F.when(~F.col("first"), "repeated").when(F.col("faults") != "", "invalid").when(F.col("level").isNull(), "unordered").when(F.col("answered").isNull(), "unanswered").otherwise("ok")
    calls_out = from_call.select("conv_id", "turn", F.lit("call").alias("kind"), "call_id", "level", F.col("turn").alias("call_turn"), status.alias("status"), "faults", "json")
    called = firsts.select(F.col("conv_id").alias("c_conv"), F.col("call_id").alias("c_id"), F.col("turn").alias("call_turn"))
    with_call = called.join(ordered, F.expr("c_conv = p_conv AND c_id = p_id"), "left")
    from_result = written.join(with_call, F.expr("conv_id = c_conv AND call_id = c_id"), "left")
    status = F.when(F.col("c_id").isNull(), "orphan").when(~F.col("first"), "repeated").otherwise("ok")
    results_out = from_result.select("conv_id", "turn", F.lit("result").alias("kind"), "call_id", "level", "call_turn", status.alias("status"), F.lit("").alias("faults"), "json")
    return calls_out.union(results_out)


#: The tool of :func:`as_calls`.
REPLY = {"reply": {"type": "object", "required": ["turn", "words"], "additionalProperties": False, "properties": {"turn": {"type": "integer", "minimum": 0}, "words": {"type": "integer", "minimum": 1}, "text": {"type": "string"}, "after": {"type": "string"}}}}


def as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of a conversation as calls and results: each user turn calls ``reply``, an assistant turn answers the turn before it.

    Counting every second turn, the n-th call refers to the result of the n/2-th.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")

    def named(turn: Column) -> Column:
        return F.concat(F.lit("call-"), turn.cast("string"))

    turn = F.col("turn")
    place, parity = F.floor(turn / 2), F.pmod(turn, F.lit(2))
    words = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0))
    before = F.when(place > 0, F.struct(named(2 * F.floor(place / 2) + parity).alias("$ref")))
    arguments = F.to_json(F.struct("turn", words.alias("words"), "text", before.alias("after")))
    calls = rows.where("role = 'user'").select("conv_id", "turn", named(turn).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"))
    results = rows.where("role = 'assistant'").select("conv_id", "turn", named(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def messages(conversations: DataFrame) -> DataFrame:
    """The turns that :func:`as_calls` leaves out, in the columns of :func:`linked`: kind ``message``, without id and level."""
    others = conversations.where(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))).select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [canonical({"content": c, "role": r, "type": "message"}) for r, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.record_batch({"conv_id": batch.column(0), "turn": batch.column(1), "json": pa.array(bodies, pa.string())})

    written = others.mapInArrow(write, fields(conv_id=dict(others.dtypes)["conv_id"], turn="long", json="string"))
    none = F.lit(None)
    return written.select("conv_id", "turn", F.lit("message").alias("kind"), none.cast("string").alias("call_id"), none.cast("int").alias("level"), F.col("turn").alias("call_turn"), F.lit("ok").alias("status"), F.lit("").alias("faults"), "json")


def turns(conversations: DataFrame) -> DataFrame:
    """Every turn of ``conversations`` as one row: a call, a result or a message."""
    calls, results = as_calls(conversations)
    return linked(calls, results, REPLY).union(messages(conversations))
