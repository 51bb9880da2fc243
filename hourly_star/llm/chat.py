"""Chat formatting: tool calls linked to results, ordered, validated and written as canonical JSON.

Contract. Input is (conv_id, turn, role, text). A text that is a JSON object
speaks for itself: `{"tool_calls": [{"id", "name", "arguments", "after"}],
"content"}` makes calls, `{"tool_call_id", "content"}` a result. Any other
user turn is a call of the tool `reply` with the text and turn as arguments,
identified by its turn, after the call of the user turn two turns before, and
any other assistant turn is the result of the call of the turn before it; all
else are plain messages. One event is returned for each of them:

* `position`: place in the conversation, from 0. Events stay in the order of
  turns, but a result comes after its call and a call after the result of the
  call it names in `after`.
* `status`: `ok`; `invalid` (arguments break the tool's schema, or the tool is
  unknown); `repeated` (a later call of the same identifier, or a later result
  of a call); `orphan` (a result whose call is not there); `unanswered`;
  `cycle` (calls that wait for each other; they keep the order of turns).
* `line`: the event as canonical JSON (sorted keys, no spaces, UTF-8).

Null texts are empty; null turns come first; null conversations and roles are
values like any other; equal rows give as many events (all but one of their
calls are `repeated`). An empty table gives an empty result; further columns
are ignored.

Calls and results meet in hash joins on (conversation, identifier), which are
different for each call. How far a chain of calls holds back another is found
by pointer doubling, in as many joins as the logarithm of the longest chain.
Positions are running counts over ranges, so no conversation, however long, is
gathered in one task.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourly_star.llm.common import Scratch, bucketed_join, map_rows, running_total, table

SCHEMAS = {"reply": {
    "type": "object", "required": ["text", "turn"], "additionalProperties": False,
    "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}}
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value) -> str:
    """Sorted keys, no spaces, UTF-8; code points that UTF-8 cannot hold stay escaped."""
    text = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return text if _encodes(text) else json.dumps(value, sort_keys=True, separators=(",", ":"))


def _encodes(text: str) -> bool:
    try:
        text.encode()
    except UnicodeEncodeError:
        return False
    return True


def _name(value) -> str:
    text = str(value)
    return text if _encodes(text) else text.encode("ascii", "backslashreplace").decode()


def _no_number(text: str) -> None:
    raise ValueError(f"{text} is not JSON")


def fits(value, schema: dict) -> bool:
    """Whether a value keeps to the parts of JSON Schema that tools use here."""
    kind = schema.get("type")
    if kind in ("integer", "number"):
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value):
            return False
        if kind == "integer" and value != int(value):
            return False
    elif kind and not isinstance(value, _TYPES[kind]):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        return False
    if isinstance(value, (int, float)) and not isinstance(value, bool) and not (
            schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf)):
        return False
    if isinstance(value, list) and "items" in schema:
        return all(fits(v, schema["items"]) for v in value)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", [])):
            return False
        if schema.get("additionalProperties") is False and any(k not in known for k in value):
            return False
        return all(fits(v, known[k]) for k, v in value.items() if k in known)
    return True


def _object(text: str) -> dict:
    if text[:1] == "{":
        try:
            value = json.loads(text, parse_constant=_no_number)
        except (ValueError, RecursionError):
            return {}
        return value if isinstance(value, dict) else {}
    return {}


def events_of(turn: int | None, role: str | None, text: str | None, schemas: dict) -> list[tuple]:
    """(kind, call_id, after, valid, line) of one row."""
    text = text or ""
    said = _object(text)
    calls, answers = said.get("tool_calls"), said.get("tool_call_id")
    if isinstance(calls, list):
        rows = [] if said.get("content") is None else [
            ("message", None, None, True, canonical({"role": role, "content": said["content"]}))]
        for call in (c for c in calls if isinstance(c, dict)):
            id_, name, arguments = _name(call.get("id")), call.get("name"), call.get("arguments")
            after = None if call.get("after") is None else _name(call["after"])
            valid = isinstance(name, str) and name in schemas and fits(arguments, schemas[name])
            rows.append(("call", id_, after, valid, _call_line(role, id_, name, arguments)))
        return rows
    if answers is not None:
        return [("result", _name(answers), None, True, _result_line(_name(answers), said.get("content")))]
    if role == "user" and turn is not None:
        arguments = {"text": text, "turn": turn}
        return [("call", str(turn), str(turn - 2), fits(arguments, schemas["reply"]),
                 _call_line(role, str(turn), "reply", arguments))]
    if role == "assistant" and turn is not None:
        return [("result", str(turn - 1), None, True, _result_line(str(turn - 1), text))]
    return [("message", None, None, True, canonical({"role": role, "content": text}))]


def _call_line(role, id_, name, arguments) -> str:
    return canonical({"role": role, "tool_calls": [{"id": id_, "name": name, "arguments": arguments}]})


def _result_line(id_, content) -> str:
    return canonical({"role": "tool", "tool_call_id": id_, "content": content})


def _events(messages: DataFrame, schemas: dict) -> DataFrame:
    schema = ("conv_id long, turn long, role string, kind string, call_id string, after string, "
              "valid boolean, line string, mark long, part int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(conv, turn, role, *event, number, i)
                    for conv, turn, role, text, number in zip(*(c.to_pylist() for c in batch.columns))
                    for i, event in enumerate(events_of(turn, role, text, schemas))]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(),
                     pa.string(), pa.int64(), pa.int32()]
            columns = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                             [f.split()[0] for f in schema.split(", ")])

    return map_rows(messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.col("text").cast("string"), F.monotonically_increasing_id().alias("number")), schema, run)


def _held_back(scratch: Scratch, calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, effective, depth, cycle) from (conv_id, call_id, after, own).

    `effective` is the greatest `own` on the way to the first call of the chain.
    """
    known = calls.select("conv_id", F.col("call_id").alias("after")).withColumn("_there", F.lit(True))
    state = scratch.keep(bucketed_join(calls, known, ["conv_id", "after"], "left").select(
        "conv_id", "call_id", F.when(F.col("_there"), F.col("after")).alias("next"),
        F.col("own").alias("effective"), F.col("_there").isNotNull().cast("long").alias("depth")))
    count = state.count()
    for _ in range(max(1, count).bit_length() + 1):
        if state.where("next IS NOT NULL").isEmpty():
            break
        ahead = state.select("conv_id", F.col("call_id").alias("next"), F.col("next").alias("_next"),
                             F.col("effective").alias("_effective"), F.col("depth").alias("_depth"))
        state = scratch.keep(bucketed_join(state, ahead, ["conv_id", "next"], "left").select(
            "conv_id", "call_id", F.col("_next").alias("next"),
            F.greatest("effective", F.coalesce("_effective", "effective")).alias("effective"),
            F.least(F.col("depth") + F.coalesce("_depth", F.lit(0)), F.lit(count)).alias("depth")))
    return state.withColumn("cycle", F.col("next").isNotNull()).drop("next")


def formatted(spark: SparkSession, messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row for each event; see the head of the module."""
    scratch = Scratch(spark, "chat")
    events = scratch.keep(_events(messages, schemas))
    # all steps move the narrow columns; lines join their events at the end
    narrow = events.drop("role", "line").withColumn("one", F.lit(1))
    placed = running_total(scratch, narrow, ["conv_id"], ["turn", "mark", "part"], "one", "own").drop("one")
    key = ["conv_id", "call_id"]
    # the first call of an identifier, and the first result of a call
    firsts = placed.where("call_id IS NOT NULL").groupBy("kind", *key).agg(F.min("own").alias("first"))
    calls = scratch.keep(bucketed_join(
        placed.where("kind = 'call'"), firsts.where("kind = 'call'").drop("kind"), key).where("own = first")
        .select(*key, "after", "own"))
    answered = firsts.where("kind = 'result'").select(*key, F.col("first").alias("answer"))
    answers = scratch.keep(bucketed_join(calls.select(*key), answered, key, "left"))
    # a call waits for the result of the call before it
    waits = answers.select("conv_id", F.col("call_id").alias("after"), F.col("answer").alias("_before"))
    chain = bucketed_join(calls, waits, ["conv_id", "after"], "left").withColumn(
        "own", F.greatest("own", F.coalesce("_before", "own"))).drop("_before")
    held = _held_back(scratch, chain)
    facts = scratch.keep(bucketed_join(bucketed_join(held, answers, key), calls.select(
        *key, F.col("own").alias("first_call")), key))
    linked = bucketed_join(placed, facts, key, "left")
    call, result, there = F.col("kind") == "call", F.col("kind") == "result", F.col("first_call").isNotNull()
    status = (F.when(result & ~there, "orphan")
              .when(call & (F.col("own") != F.col("first_call")), "repeated")
              .when(result & (F.col("own") != F.col("answer")), "repeated")
              .when(~F.col("valid"), "invalid")
              .when(call & F.col("cycle"), "cycle")
              .when(call & F.col("answer").isNull(), "unanswered").otherwise("ok"))
    ordered = linked.select(
        "conv_id", "turn", "kind", "call_id", "mark", "part", "own", status.alias("status"),
        F.when(there & ~F.col("cycle"), F.greatest("own", "effective")).otherwise(F.col("own")).alias("time"),
        F.when(there & ~F.col("cycle"), 2 * F.col("depth") + result.cast("long")).otherwise(0).alias("level"),
        F.lit(1).alias("one"))
    numbered = running_total(scratch, ordered, ["conv_id"], ["time", "level", "own"], "one", "position")
    return numbered.join(events.select("mark", "part", "role", "line"), ["mark", "part"]).select(
        "conv_id", "position", "turn", "role", "kind", "call_id", "status", "line")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(spark, table(spark, sf_dir, "conversations"))


QUERIES = {"op6_chat": op6_chat}
ORACLES = {}
