"""Tool-call linking in conversations.

Messages are read for calls and results, calls and results are hash-joined by conversation and call identifier, ordered
so that a call follows everything it refers to, checked against the tools' schemas, and written as canonical JSON.

Where calls and results come from:
* an assistant message that is JSON with `tool_calls`, or that holds <tool_call>...</tool_call> blocks: its calls;
* a `tool` message that is JSON with `tool_call_id`, or any message with <tool_response>...</tool_response>: results;
* plain prose: a user message is a call of the tool `reply`, named turn-<n>, and an assistant message is the result of
  the call of the turn before it. System messages are neither.

A call refers to others by `depends_on`, or by strings "$<identifier>" in its arguments. Order within a conversation is
by turn; a call that refers to a later one moves behind it. Calls that refer to each other in a circle, or to such calls,
keep their turn and get the error `cycle`.

Defined cases: NULL text is empty prose, NULL conversations are one conversation, NULL turns come first (prose
without a turn has no identifier and is left out); ids of conversations and turns are whole numbers; unknown
roles give nothing; JSON that cannot be read is prose; of several calls or results with one identifier the first by turn
counts and the numbers are reported (so repeated rows change nothing but these); an empty table gives no rows. Records
stand one per call, never one per conversation, so a conversation may have any length.

With `each`, as the query takes it, no call and no result is only counted. The n-th call of an identifier is linked to its
n-th result, and what is left over stands as a row of its own with that identifier. Calls without an identifier are named
#1, #2, ... in the order of turn and place; a result without one answers the oldest of them that is open, or is an orphan
#lost-1, ... They are paired block by block of turns. References mean the first call of an identifier. Prose without a turn goes
by the identifier turn-null, so the n-th question of a conversation is linked to the n-th reply; a block that is no JSON, in
a message with good ones, is a call with the error `json`, or a result, with its text and without an identifier.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freightlane.llm.common import text_of, written

REPLY = "reply"
SCHEMAS: dict[str, dict] = {
    REPLY: {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1}},
        "required": ["text"],
        "additionalProperties": False,
    }
}
#: Turns of a conversation that one task numbers.
BLOCK_TURNS = 64
CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)
RESPONSE = re.compile(r"<tool_response>(.*?)</tool_response>", re.S)
EVENTS = "conv long, turn long, at int, kind string, call_id string, name string, body string, errors string, refers array<string>"

# --- JSON -----------------------------------------------------------------------------------------------


def canonical(value: Any) -> str:
    """JSON with sorted keys, no white space, no escapes but the needed ones, and whole numbers without a fraction."""
    return json.dumps(_plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _plain(value: Any) -> Any:
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
        return int(value)
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def loads(text: str) -> Any:
    """The JSON value of a text; None if it has none, or has numbers that JSON does not know."""

    def refused(name: str) -> None:
        raise ValueError(name)

    try:
        return json.loads(text, parse_constant=refused)
    except (ValueError, RecursionError):
        return None


KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


#: What invalid() checks, and keywords that say nothing about a value.
KEYWORDS = frozenset(
    "type enum const minLength maxLength minItems maxItems pattern minimum maximum items required properties additionalProperties"
    " title description default examples format deprecated readOnly writeOnly $schema $id $comment".split()
)


def refuse_unknown(schema: Any, path: str = "$") -> None:
    """Raises ValueError for a schema that invalid() would check in part only."""
    if not isinstance(schema, dict):
        raise ValueError(f"{path}: a schema must be an object here")
    if unknown := sorted(set(schema) - KEYWORDS):
        raise ValueError(f"{path}: keywords that are not checked: {', '.join(unknown)}")
    kinds = schema.get("type", [])
    if not set([kinds] if isinstance(kinds, str) else kinds) <= {*KINDS, "integer", "number"}:
        raise ValueError(f"{path}: type {kinds}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{path}: additionalProperties must be true or false here")
    for k, v in schema.get("properties", {}).items():
        refuse_unknown(v, f"{path}.{k}")
    if "items" in schema:
        refuse_unknown(schema["items"], f"{path}[]")


def invalid(value: Any, schema: dict, path: str = "$") -> list[str]:
    """What a value has against a schema: type, enum, const, lengths, bounds, pattern, required, properties, items."""
    found: list[str] = []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{path}: type"]
    if "enum" in schema and value not in schema["enum"] or "const" in schema and value != schema["const"]:
        found.append(f"{path}: enum")
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if not schema.get(low, 0) <= len(value) <= schema.get(high, len(value)):
            found.append(f"{path}: length")
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        found.append(f"{path}: pattern")
    if _is(value, "number") and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        found.append(f"{path}: range")
    if isinstance(value, list) and "items" in schema:
        found += [e for i, v in enumerate(value) for e in invalid(v, schema["items"], f"{path}[{i}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{path}.{k}: required" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties", True) is False:
            found += [f"{path}.{k}: unknown" for k in sorted(value) if k not in known]
        found += [e for k in sorted(value) if k in known for e in invalid(value[k], known[k], f"{path}.{k}")]
    return found


def _is(value: Any, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or isinstance(value, float) and (kind == "number" or value.is_integer())
        return whole and not isinstance(value, bool)
    return isinstance(value, KINDS[kind])


# --- messages to events ---------------------------------------------------------------------------------


def references(value: Any) -> set[str]:
    """Identifiers that a value names as "$<identifier>"."""
    if isinstance(value, str):
        return {value[1:]} if value.startswith("$") and len(value) > 1 else set()
    if isinstance(value, dict):
        value = list(value.values())
    return set().union(*map(references, value)) if isinstance(value, list) else set()


def events_of(turn: int | None, role: str | None, text: str, schemas: dict[str, dict], each: bool = False) -> Iterator[tuple]:
    """(kind, call id, name, canonical body, errors, references) of each call and result in a message.

    With `each` broken blocks beside good ones and prose without a turn are events too.
    """
    calls, results, broken = _structured(role, text)
    for call in calls:
        inner = call.get("function") if isinstance(call.get("function"), dict) else call
        name, arguments = inner.get("name"), inner.get("arguments", {})
        arguments = loads(arguments) if isinstance(arguments, str) else arguments
        refers = references(arguments) | {str(x) for x in call.get("depends_on") or [] if x is not None}
        yield "call", _text(call.get("id")), _text(name), canonical(arguments), _checked(_text(name), arguments, schemas), sorted(refers)
    for result in results:
        yield "result", _text(result.get("tool_call_id")), None, canonical(result.get("content")), "", []
    if calls or results:
        for kind, raw in broken if each else []:
            yield kind, "", "" if kind == "call" else None, canonical(raw), "json" if kind == "call" else "", []
        return
    if turn is None and not each:
        return
    if role == "user":
        arguments = {"text": text}
        yield "call", "turn-null" if turn is None else f"turn-{turn}", REPLY, canonical(arguments), _checked(REPLY, arguments, schemas), []
    elif role == "assistant":
        yield "result", "turn-null" if turn is None else f"turn-{turn - 1}", None, canonical(text), "", []


def _structured(role: str | None, text: str) -> tuple[list[dict], list[dict], list[tuple[str, str]]]:
    """The calls and results of a message, and (kind, text) of its blocks that are no JSON objects."""
    value = loads(text) if text.lstrip()[:1] == "{" else None
    if isinstance(value, dict) and isinstance(value.get("tool_calls"), list) and role == "assistant":
        return [c for c in value["tool_calls"] if isinstance(c, dict)], [], []
    if isinstance(value, dict) and "tool_call_id" in value:
        return [], [value], []
    found: dict[str, list[dict]] = {"call": [], "result": []}
    broken = []
    for kind, pattern, tag in (("call", CALL, "<tool_call>"), ("result", RESPONSE, "<tool_response>")):
        if tag in text and (kind == "result" or role == "assistant"):
            for block in pattern.findall(text):
                read = loads(block)
                if isinstance(read, dict):
                    found[kind].append(read)
                else:
                    broken.append((kind, block))
    return found["call"], found["result"], broken


def _text(value: Any) -> str:
    return value if isinstance(value, str) else "" if value is None else canonical(value)


def _checked(name: str, arguments: Any, schemas: dict[str, dict]) -> str:
    if name not in schemas:
        return "unknown tool"
    return ",".join(invalid(arguments, schemas[name]))


def events(
    messages: DataFrame,
    schemas: dict[str, dict],
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    each: bool = False,
) -> DataFrame:
    rows = messages.select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"),
        text_of(text).alias("text"),
    )

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in EVENTS.split(", ")]
        for frame in frames:
            out = []
            for c, t, r, x in zip(*[frame[n].astype(object).where(frame[n].notna(), None) for n in ("conv", "turn", "role", "text")], strict=True):
                c, t = None if c is None else int(c), None if t is None else int(t)
                out += [(c, t, i, *event) for i, event in enumerate(events_of(t, r, x or "", schemas, each))]
            made = pd.DataFrame(out, columns=names)
            yield made.astype({"conv": "Int64", "turn": "Int64"})

    return rows.mapInPandas(read, EVENTS)


# --- linking --------------------------------------------------------------------------------------------


def _named(bare: DataFrame, block_turns: int) -> DataFrame:
    """The events without identifiers with names: calls in order, results after the oldest call that is open.

    A result is lost if there are more results than calls up to it, as never before. Sums and their maxima are
    taken block by block of turns, and those of the blocks before are added, so no task needs a whole conversation.
    """
    step = F.when(F.col("kind") == "result", 1).otherwise(-1).cast("long")
    bare = bare.withColumns({"block": F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 62))), "step": step})
    order = Window.partitionBy("conv", "block").orderBy("turn", "at", "kind", "body")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    bare = bare.withColumn("surplus", F.sum("step").over(so_far)).withColumn("most", F.max("surplus").over(so_far))
    bare = bare.withColumns({"calls": F.count_if(F.col("step") == -1).over(so_far), "results": F.count_if(F.col("step") == 1).over(so_far)})
    bare = written(bare, "bare")
    ends = [F.sum("step").alias("step"), F.max("most").alias("most"), *[F.max(c).alias(c) for c in ("calls", "results")]]
    blocks = bare.groupBy("conv", "block").agg(*ends)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    blocks = blocks.withColumns({"b_step": first("step"), "b_calls": first("calls"), "b_results": first("results")})
    lost = F.greatest(F.lit(0), F.max(F.col("b_step") + F.col("most")).over(earlier))
    blocks = blocks.select(F.col("conv").alias("b_conv"), F.col("block").alias("b_block"), "b_calls", "b_results", "b_step", lost.alias("b_lost"))
    rows = bare.join(blocks, F.expr("conv <=> b_conv AND block = b_block")).withColumn("lost", F.greatest("b_lost", F.col("b_step") + F.col("most")))
    rows = rows.withColumn("before", F.coalesce(F.lag("lost").over(order), "b_lost"))
    nth = F.when(F.col("kind") == "call", F.col("b_calls") + F.col("calls")).otherwise(F.col("b_results") + F.col("results"))
    name = F.when(F.col("kind") == "call", F.concat(F.lit("#"), nth)).when(F.col("lost") > F.col("before"), F.concat(F.lit("#lost-"), "lost"))
    return rows.withColumn("call_id", F.coalesce(name, F.concat(F.lit("#"), nth - F.col("lost")))).select(*[c.split()[0] for c in EVENTS.split(", ")])


def _numbered(found: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The events with `key`, the same for a call and the result that belongs to it and else unique, how many calls and
    results their identifier has, and names for those without one."""
    bare = _named(found.filter("call_id = ''"), block_turns)
    both = Window.partitionBy("conv", "call_id", "bare")
    counts = {f"n_{k}s": F.count(F.when(F.col("kind") == k, 1)).over(both) for k in ("call", "result")}
    rows = found.filter("call_id <> ''").withColumn("bare", F.lit(False)).unionByName(bare.withColumn("bare", F.lit(True)))
    rows = rows.withColumns({**counts, "nth": F.row_number().over(Window.partitionBy("conv", "call_id", "bare", "kind").orderBy("turn", "at", "body"))})
    # No identifier that a message gives ends like this.
    key = F.when(F.col("bare"), F.concat("call_id", F.lit("\0"))).when(F.col("nth") == 1, F.col("call_id"))
    return rows.withColumn("key", F.coalesce(key, F.concat("call_id", F.lit("\0"), "nth"))).drop("bare", "nth")


def linked(found: DataFrame, each: bool = False, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per identifier of a conversation: the first call, the first result, how many of each, and the status.

    With `each` one row per pair or single one; `call_id` is unique then, and `shown` is the identifier.
    """
    named = _numbered(found, block_turns) if each else found.withColumn("key", F.col("call_id"))
    counts = ["n_calls", "n_results"] if each else []
    firsts = lambda kind, body: (
        named.filter(F.col("kind") == kind)
        .groupBy("conv", "key")
        .agg(F.count(F.lit(1)).alias(f"n_{kind}s"), F.min(F.struct(*body, F.col("call_id").alias("shown"), *counts)).alias(kind))
        .withColumnsRenamed({"conv": f"{kind}_conv", "key": f"{kind}_call_id"})
    )
    calls = firsts("call", ["turn", "at", "name", "body", "errors", "refers"])
    results = firsts("result", ["turn", "at", "body"])
    joined = calls.join(results, F.expr("call_conv <=> result_conv AND call_call_id = result_call_id"), "full_outer")
    number = lambda n: F.coalesce(f"call.{n}", f"result.{n}") if each else F.coalesce(n, F.lit(0))
    status = F.when(F.col("call").isNull(), "orphan").when(F.col("result").isNull(), "unanswered").otherwise("linked")
    return joined.select(
        F.coalesce("call_conv", "result_conv").alias("conv"),
        F.coalesce("call_call_id", "result_call_id").alias("call_id"),
        F.coalesce("call.shown", "result.shown").alias("shown"),
        F.col("call.name").alias("name"),
        F.coalesce("call.turn", "result.turn").alias("turn"),
        F.coalesce("call.at", "result.at").alias("at"),
        F.col("call.turn").alias("call_turn"),
        F.col("result.turn").alias("result_turn"),
        status.alias("status"),
        number("n_calls").alias("n_calls"),
        number("n_results").alias("n_results"),
        F.col("call.errors").alias("errors"),
        F.col("call.refers").alias("refers"),
        F.col("call.body").alias("arguments"),
        F.col("result.body").alias("result"),
    )


#: A reference that stands before the call that makes it, in the order of turns.
EARLIER = "(from_turn, from_at, `from`) < (turn, at, `to`)"
RANKS = "conv long, call_id string, place long, cyclic boolean"


def _of(edges: DataFrame, calls: DataFrame, end: str, how: str) -> DataFrame:
    """The references whose `from` or `to` is (left_semi) or is not (left_anti) one of the calls (conv, call_id)."""
    known = calls.select(F.col("conv").alias("k_conv"), F.col("call_id").alias("k_id"))
    return edges.join(known, F.expr(f"conv <=> k_conv AND `{end}` = k_id"), how)


def ranks(links: DataFrame) -> DataFrame:
    """conv, call_id, place and cyclic of the calls that refer to later ones, and of those that refer to such calls.

    All others keep the order of turns. These are taken level by level: a call whose references are all placed is
    placed behind them. What is never free stands in a circle or refers to one. The number of rounds is the depth of
    such references, none if every reference stands before its call.
    """
    calls = links.filter("status <> 'orphan'").select("conv", "call_id", F.coalesce("turn", F.lit(0)).alias("turn"), "at", "refers")
    pairs = calls.filter("size(refers) > 0").select("conv", F.col("call_id").alias("to"), "turn", "at", F.explode("refers").alias("from"))
    named = calls.select(F.col("conv").alias("c"), F.col("call_id").alias("id"), F.col("turn").alias("from_turn"), F.col("at").alias("from_at"))
    edges = pairs.join(named, F.expr("conv <=> c AND `from` = id")).drop("c", "id")
    edges = written(edges.distinct(), "references")
    to = ("conv", F.col("to").alias("call_id"))

    rest = written(edges.filter(f"NOT {EARLIER}").select(*to).distinct(), "late")
    if rest.isEmpty():
        return links.sparkSession.createDataFrame([], RANKS)
    while not (more := written(_of(_of(edges, rest, "from", "left_semi"), rest, "to", "left_anti").select(*to).distinct(), "late")).isEmpty():
        rest = written(rest.unionByName(more), "late")

    placed = links.sparkSession.createDataFrame([], "conv long, call_id string, place long")
    while True:
        own = _of(edges, rest, "to", "left_semi")
        blocked = written(_of(own, rest, "from", "left_semi").select(*to).distinct(), "blocked")
        known = placed.select(F.col("conv").alias("p_conv"), F.col("call_id").alias("p_id"), "place")
        free = _of(own, blocked, "to", "left_anti").join(known, F.expr("conv <=> p_conv AND `from` = p_id"), "left")
        behind = F.coalesce("place", "from_turn") + F.when(F.expr(EARLIER), 0).otherwise(1)
        new = free.withColumn("behind", behind).groupBy(*to).agg(F.greatest(F.max("turn"), F.max("behind")).alias("place"))
        new = written(new, "free")
        if new.isEmpty():
            break
        placed, rest = written(placed.unionByName(new), "placed"), blocked
    circles = rest.select("conv", "call_id", F.lit(None).cast("long").alias("place"), F.lit(True).alias("cyclic"))
    return placed.withColumn("cyclic", F.lit(False)).unionByName(circles)


def transcripts(
    messages: DataFrame,
    schemas: dict[str, dict] | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_turns: int = BLOCK_TURNS,
    each: bool = False,
) -> DataFrame:
    """One row per call or orphan result: conversation, call_id, name, turns, status, counts, errors, position, record.

    position is the place in the conversation's order, gapless from 0 on. Blocks of turns are numbered apart and put one
    after the other, so no task needs a whole conversation. Schemas with keywords that are not checked are refused.
    """
    for name, schema in (schemas or {}).items():
        refuse_unknown(schema, name)
    # Every message is parsed once.
    found = written(events(messages, schemas if schemas is not None else SCHEMAS, conv, turn, role, text, each), "events")
    links = written(linked(found, each, block_turns), "links")
    moved = ranks(links).withColumnsRenamed({"conv": "r_conv", "call_id": "r_id"})
    rows = links.join(moved, F.expr("conv <=> r_conv AND call_id = r_id"), "left").withColumns({
        "place": F.when(F.coalesce("cyclic", F.lit(False)), F.col("turn")).otherwise(F.coalesce("place", "turn", F.lit(0))),
        "errors": F.concat_ws(",", F.when(F.col("errors") != "", F.col("errors")), F.when(F.col("cyclic"), "cycle")),
    })
    rows = rows.withColumn("block", F.floor(F.coalesce("place", F.lit(0)) / block_turns))
    rows = written(rows.drop("r_conv", "r_id", "refers"), "ordered")
    within = Window.partitionBy("conv", "block").orderBy("place", "turn", "at", "call_id", "status")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(
        F.col("conv").alias("o_conv"), F.col("block").alias("o_block"), "first"
    )
    numbered = rows.withColumn("nth", F.row_number().over(within) - 1).join(offsets, F.expr("conv <=> o_conv AND block = o_block"))
    string = lambda c: F.when(F.col(c).isNull(), "null").otherwise(F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)"))
    parts = {
        "arguments": F.coalesce("arguments", F.lit("null")),
        "call_id": string("shown"),
        "conversation": F.coalesce(F.col("conv").cast("string"), F.lit("null")),
        "errors": string("errors"),
        "name": string("name"),
        "position": F.col("position").cast("string"),
        "result": F.coalesce("result", F.lit("null")),
        "status": string("status"),
    }
    fields = [x for i, (k, v) in enumerate(parts.items()) for x in (F.lit(f'{"," if i else "{"}"{k}":'), v)]
    return numbered.withColumn("position", F.col("first") + F.col("nth")).select(
        F.col("conv").alias(conv),
        F.col("shown").alias("call_id"),
        "name",
        "call_turn",
        "result_turn",
        "status",
        "n_calls",
        "n_results",
        "errors",
        "position",
        F.concat(*fields, F.lit("}")).alias("record"),
    )
