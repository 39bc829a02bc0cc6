"""Chat formatting with linked tool calls.

Messages, calls and results are rows. A result is joined to the call it names by (conversation, call id), a
hash join of narrow rows; calls and results that find no partner are reported, not lost. Inside a conversation
items are put in topological order: what a call depends on (`after`) and the call of a result come first, the
turn decides where there is a choice. Arguments are validated against the tool's schema, and the conversation is
written as canonical JSON: sorted keys, no blanks, no escapes but those that JSON asks for.

A conversation is one row of the result, so its items meet in one place; nothing larger than one conversation
does. Only the narrow columns are joined, and the group of a conversation is collected once.

Defined results
---------------
* A message without a role, or with an unknown one, is kept and reported as `bad_role`.
* A call without an id cannot be answered; a call id used twice in a conversation answers with its first call
  (smallest turn, ties as below) and reports the others as `repeated_call`. Of several results for a call all are linked.
* A result without a call is an `orphan_result`; a call without a result is `unanswered`.
* Arguments that are no JSON object, lack a required name, have an unknown name or break a rule of the schema (type,
  enum, bounds, lengths, items, nested properties) are `bad_arguments`, and so are numbers beyond the range of
  doubles, half surrogates and nesting too deep to be written; a tool without a schema is `unknown_tool`. Null
  arguments are an empty object.
* Items in a circle of dependencies, or depending on an unknown call, are reported as `circular` or
  `unknown_dependency` and ordered by turn.
* Null texts are empty, null conversation ids are one conversation, repeated rows stay. Null turns come first.
  Equal turns are ordered by kind, role and text. An unknown kind is a message. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant", "tool")
# JSON schema type names and the Python types of parsed JSON.
TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}

# Brackets from which on a text is tried for nesting too deep to be written again.
DEEP = 100


def _is(value: object, name: str) -> bool:
    """Whether a parsed value has the JSON type of that name; unknown names are any type."""
    if isinstance(value, bool):
        return name == "boolean" or name not in TYPES
    return isinstance(value, TYPES.get(name, object))


def fits(value: object, rule: object) -> bool:
    """Whether a value keeps a schema. As in JSON Schema, a bound speaks about values of its own type only."""
    if not isinstance(rule, Mapping):
        return rule is not False
    names = rule.get("type", ())
    names = [names] if isinstance(names, str) else names
    if names and not any(_is(value, n) for n in names):
        return False
    if "enum" in rule and canonical(value) not in map(canonical, rule["enum"]):
        return False
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return rule.get("minimum", value) <= value <= rule.get("maximum", value)
    if isinstance(value, str):
        return rule.get("minLength", 0) <= len(value) <= rule.get("maxLength", len(value))
    if isinstance(value, list):
        return all(fits(x, rule.get("items", True)) for x in value)
    if isinstance(value, dict):
        known, more = rule.get("properties", {}), rule.get("additionalProperties", True)
        return all(n in value for n in rule.get("required", ())) and all(fits(x, known.get(n, more)) for n, x in value.items())
    return True


def check_arguments(arguments: str | None, schema: Mapping | None) -> tuple[object, str | None]:
    """(parsed arguments, what is wrong with them). Arguments that cannot be written as JSON again stay text."""
    try:
        value = json.loads(arguments, parse_constant=_refuse, parse_float=_finite) if arguments is not None else {}
        if arguments and ("\\u" in arguments or arguments.count("[") + arguments.count("{") > DEEP):
            canonical(value).encode()  # half surrogates, and nesting beyond what can be written
    except (ValueError, RecursionError):
        return arguments, "bad_arguments"
    if schema is None:
        return value, "unknown_tool"
    # A call's own arguments are named in the schema, all of them.
    if not isinstance(value, dict) or not fits(value, {**schema, "additionalProperties": False}):
        return value, "bad_arguments"
    return value, None


def _refuse(constant: str) -> object:
    raise ValueError(f"{constant} is not JSON")


def _finite(number: str) -> float:
    value = float(number)
    if math.isinf(value):
        raise ValueError(f"{number} is too large")
    return value


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def ordered(items: list[dict], first: dict[str, int]) -> tuple[list[int], dict[int, str]]:
    """(order of the items, faults): dependencies first, then turn; `first` maps a call id to its item."""
    waits: dict[int, int] = {}
    follow: dict[int, list[int]] = {}
    faults: dict[int, str] = {}
    for i, item in enumerate(items):
        needs = list(item["after"] or ())
        if item["kind"] == "result" and item["call_id"] in first:
            needs.append(item["call_id"])
        count = 0
        for call in set(needs):
            if call in first and first[call] != i:
                follow.setdefault(first[call], []).append(i)
                count += 1
            elif call not in first:
                faults[i] = "unknown_dependency"
            else:
                faults[i] = "circular"
        waits[i] = count
    ready = [i for i in range(len(items)) if not waits[i]]
    heapq.heapify(ready)  # items are numbered by turn
    order: list[int] = []
    while ready:
        i = heapq.heappop(ready)
        order.append(i)
        for j in follow.get(i, ()):
            waits[j] -= 1
            if not waits[j]:
                heapq.heappush(ready, j)
    left = sorted(set(range(len(items))).difference(order))
    faults.update((i, "circular") for i in left)
    return order + left, faults


def format_conversation(items: list[dict], schemas: Mapping[str, Mapping]) -> tuple[str, dict[str, int]]:
    """(canonical JSON, counts of faults) of one conversation's items, sorted by turn."""
    faults: dict[str, int] = {}

    def fault(name: str) -> None:
        faults[name] = faults.get(name, 0) + 1

    first = {x["call_id"]: i for i, x in reversed(list(enumerate(items))) if x["kind"] == "call" and x["call_id"] is not None}
    order, broken = ordered(items, first)
    for name in broken.values():
        fault(name)
    out = []
    for i in order:
        x = items[i]
        if x["kind"] == "call":
            value, wrong = check_arguments(x["arguments"], schemas.get(x["name"]))
            if wrong:
                fault(wrong)
            if x["call_id"] is not None and first[x["call_id"]] != i:
                fault("repeated_call")
            elif not x["n_results"]:
                fault("unanswered")
            shown = {"role": "assistant", "tool_call": {"id": x["call_id"], "name": x["name"], "arguments": value}}
        elif x["kind"] == "result":
            if not x["has_call"]:
                fault("orphan_result")
            shown = {"role": "tool", "tool_call_id": x["call_id"], "content": x["text"] or ""}
        else:
            if x["role"] not in ROLES:
                fault("bad_role")
            shown = {"role": x["role"], "content": x["text"] or ""}
        out.append(shown)
    return canonical({"messages": out}), faults


def _format(schemas: Mapping[str, Mapping], id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("conv"))
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [format_conversation(x, schemas) for x in part.column(part.schema.get_field_index("items")).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, 256), pa.array([m[0] for m in made], pa.string()),
                    pa.array([sorted(m[1].items()) for m in made], pa.map_(pa.string(), pa.int64()))], ["conv", "chat", "faults"])

    return run


def link(items: DataFrame) -> DataFrame:
    """Items with has_call (whether a result's call is there) and n_results (of a call).

    `items` has conv, turn, kind ('message', 'call' or 'result'), role, text, call_id, name, arguments, after.
    """
    none, no = F.lit(0).cast("bigint").alias("n_results"), F.lit(False).alias("has_call")
    plain = items.where("kind not in ('call', 'result') or kind is null or call_id is null").select(*items.columns, no, none)
    called = items.where("kind = 'call' and call_id is not null")
    answered = items.where("kind = 'result' and call_id is not null")
    # One row per call id and per result id: the joins have a unique side, so a hot id stays linear.
    ids = called.groupBy("conv", "call_id").agg(F.lit(True).alias("found"))
    counts = answered.groupBy("conv", "call_id").agg(F.count("*").alias("found"))
    ids, counts = (x.select(F.col("conv").alias("c"), F.col("call_id").alias("k"), "found") for x in (ids, counts))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("k"))
    results = answered.join(ids, same, "left").select(*items.columns, F.coalesce("found", F.lit(False)).alias("has_call"), none)
    calls = called.join(counts, same, "left").select(*items.columns, no, F.coalesce("found", F.lit(0)).alias("n_results"))
    return plain.unionAll(results).unionAll(calls)


def format_chats(items: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row per conversation: conv, chat (canonical JSON), faults (map of counts)."""
    columns = ("turn", "kind", "role", "text", "call_id", "name", "arguments", "after")
    linked_items = link(items.select("conv", *columns))
    packed = linked_items.select("conv", F.struct(*columns, "has_call", "n_results").alias("item"))
    grouped = packed.groupBy("conv").agg(F.array_sort(F.collect_list("item")).alias("items"))
    kind = items.schema["conv"].dataType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    made = grouped.mapInArrow(_format(schemas, arrow), f"conv {kind.simpleString()}, chat string, faults map<string,bigint>")
    return made
