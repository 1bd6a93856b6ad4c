"""Chat formatting: tool calls linked with their results, ordered, validated, and written as canonical JSON.

Calls and results meet in a hash join on (conversation, identifier). A call may refer to other ones (``after``); its level is
the length of the longest chain of references from it, so that ordering by level is topological. Calls with one
reference jump along their chains in doubling steps, to a call without references or with several; only the latter
are levelled one after the other, in rounds of joins. Calls on a cycle or behind one have no level. Arguments are parsed and
checked against the tool's schema, and each call with its result becomes one line of canonical JSON (sorted keys, no
blanks, plain UTF-8). No conversation is gathered anywhere, so a long one can't fill a task.

Status of a call: ``ok``; ``missing`` without a result; ``duplicate`` if an earlier call of the conversation has its
identifier (those keep their own turn and arguments, take the identifier's level and get no result); ``cyclic``, at level 0;
wrong arguments come with their errors, whatever the status. Arguments that aren't JSON, nest too deep for the parser, or
hold numbers that aren't finite stay as text; lone surrogates stay escaped. Types and patterns that a schema has wrong are
errors of the arguments. Odd input: references to unknown calls don't count; calls of a null conversation are linked with nothing;
calls without an identifier are ``missing``, each for itself, at level 0; null arguments are invalid; a tool without schema takes any arguments; of
results with one identifier the first by turn counts; results without a call are dropped; repeated rows of a call are
duplicates; an empty table gives an empty table; other columns of the input don't matter.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import dropped, map_texts, written

_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "number": (int, float), "integer": int}


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """Violations of a JSON schema (type, enum, properties, required, additionalProperties, items, lengths, bounds, pattern)."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(isinstance(value, _KINDS.get(k, ())) and not (isinstance(value, bool) and k in ("number", "integer")) for k in kinds):
        return [f"{at}: not of type {'/'.join(map(str, kinds))}"]
    out = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at}: not one of the choices")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k, v in value.items():
            if k in known:
                out += schema_errors(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unexpected")
    elif isinstance(value, list) and "items" in schema:
        out += [e for k, v in enumerate(value) for e in schema_errors(v, schema["items"], f"{at}[{k}]")]
    elif isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            out.append(f"{at}: length")
        try:
            if "pattern" in schema and not re.search(schema["pattern"], value):
                out.append(f"{at}: pattern")
        except re.error:
            out.append(f"{at}: the schema's pattern is none")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if not schema.get("minimum", value) <= value <= schema.get("maximum", value):
            out.append(f"{at}: bounds")
    return out


def canonical(value) -> str:
    out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", out)


def _finite(text: str) -> float:
    if math.isinf(x := float(text)):
        raise ValueError(text)
    return x


def _no_number(text: str):
    raise ValueError(text)


def checked(arguments: str | None, schema: dict) -> tuple[object, list[str]]:
    """(value, errors) of a call's arguments; text that can't be read stays text."""
    try:
        value = json.loads(arguments, parse_float=_finite, parse_constant=_no_number)
        canonical(value)
        return value, schema_errors(value, schema)
    except (TypeError, ValueError):
        return arguments, ["$: not JSON"]
    except RecursionError:
        return arguments, ["$: nested too deep"]


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of ``calls`` (conv_id, call_id, after), unique by identifier; null: on a cycle or behind one."""
    key = ["conv_id", "call_id"]
    edges = calls.select(*key, F.explode(F.array_distinct("after")).alias("needs"))
    known = calls.select("conv_id", F.col("call_id").alias("needs"))
    edges = written(edges.join(known, ["conv_id", "needs"], "left_semi"), "references")
    several = edges.groupBy(*key).agg(F.count("*").alias("n"), F.first("needs").alias("needs"))
    # each call points to the end of its chain as far as it is known: distance, and whether the chain ends there
    found = calls.select(*key).join(several, key, "left")
    ends = (F.coalesce("n", F.lit(0)) != 1).alias("ends")
    chains = written(found.select(*key, F.when(F.col("n") == 1, F.col("needs")).otherwise(F.col("call_id")).alias("at"), F.when(F.col("n") == 1, 1).otherwise(0).cast("long").alias("far"), ends), "chains")
    reach, most = 1, chains.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0  # no chain is longer than its conversation
    while reach <= most and not chains.where("not ends").isEmpty():
        ahead = chains.select("conv_id", F.col("call_id").alias("at"), F.col("at").alias("_at"), F.col("far").alias("_far"), F.col("ends").alias("_ends"))
        step = chains.where("not ends").join(ahead, ["conv_id", "at"]).select(*key, F.col("_at").alias("at"), (F.col("far") + F.col("_far")).alias("far"), F.col("_ends").alias("ends"))
        new = written(step.unionByName(chains.where("ends")), "chains")
        dropped(chains)
        chains, reach = new, 2 * reach
    # calls with several references, once the ends of the chains from them all have a level
    knots = several.where("n > 1").select(*key)
    ahead = chains.select("conv_id", F.col("call_id").alias("needs"), "at", "far", "ends")
    waits = written(edges.join(knots, key, "left_semi").join(ahead, ["conv_id", "needs"]).select(*key, "at", F.col("far") + 1, "ends").toDF(*key, "at", "far", "ends"), "waits")
    done = written(calls.select(*key).join(edges.select(*key).distinct(), key, "left_anti").withColumn("level", F.lit(0).cast("long")), "levels")
    while not waits.isEmpty():
        met = waits.join(done.select("conv_id", F.col("call_id").alias("at"), "level"), ["conv_id", "at"], "left")
        ready = met.groupBy(*key).agg(F.count_if(F.col("level").isNull() | ~F.col("ends")).alias("open"), F.max(F.col("level") + F.col("far")).alias("level")).where("open = 0")
        new = written(ready.select(*key, "level"), "levels")
        if new.isEmpty():
            break
        left = written(waits.join(new, key, "left_anti"), "waits")
        both = written(done.unionByName(new), "levels")
        dropped(waits, done, new)
        waits, done = left, both
    out = chains.join(done.select("conv_id", F.col("call_id").alias("at"), "level"), ["conv_id", "at"], "left")
    return out.select(*key, F.when(F.col("ends"), F.col("level") + F.col("far")).cast("int").alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` (conv_id, call_id, turn, name, arguments, after) with ``results`` (conv_id, call_id, turn, content).

    Returns (conv_id, call_id, turn, level, result_turn, status, errors, json); order by (level, turn, call_id)."""
    same = ["conv_id", "call_id", "turn", "name", "arguments", "after"]
    unlike = calls.groupBy(*same).agg(F.count("*").alias("times"))
    fields = F.struct(*same[2:])
    first = unlike.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(fields).alias("c"))
    least = first.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_id"), F.col("c").alias("_c"))
    marked = unlike.join(least, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("call_id") == F.col("_id")), "left").withColumn("first", fields.eqNullSafe(F.col("_c"))).drop("_conv", "_id", "_c")
    answer = results.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    known = marked.join(answer.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    known = known.join(levels(first.select("conv_id", "call_id", "c.after")), ["conv_id", "call_id"], "left")
    # equal rows were counted, and are rows again; only the first row of an identifier has a result
    rows = known.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).withColumn("first", F.col("first") & (F.col("time") == 1))
    status = F.when(F.col("call_id").isNull(), "missing").when(~F.col("first"), "duplicate").when(F.col("conv_id").isNotNull() & F.col("level").isNull(), "cyclic").when(F.col("r").isNull(), "missing").otherwise("ok")
    rows = rows.select(
        "arguments", "name", "conv_id", "call_id", "turn", F.coalesce("level", F.lit(0)).alias("level"),
        F.when(F.col("first"), F.col("r.turn")).alias("result_turn"), status.alias("status"), F.when(F.col("first"), F.col("r.content")).alias("content"),
    )

    def run(_, arguments, names, convs, ids, turns, level, result_turns, statuses, contents):
        errors, lines = [], []
        for a, name, id_, content in zip(arguments, names, ids, contents):
            value, wrong = checked(a, schemas.get(name, {}))
            errors.append(wrong)
            lines.append(canonical({"arguments": value, "id": id_, "name": name, "result": content}))
        return {"conv_id": convs, "call_id": ids, "turn": turns, "level": level, "result_turn": result_turns, "status": statuses, "errors": errors, "json": lines}

    return map_texts(rows, rows.columns, run, "conv_id long, call_id string, turn long, level int, result_turn long, status string, errors array<string>, json string")


#: Schema of the one tool of plain transcripts: the model is called with a prompt, and may refer to its previous call.
REPLY = {"reply": {"type": "object", "properties": {"prompt": {"type": "string", "minLength": 1}, "previous": {"type": "string"}}, "required": ["prompt"], "additionalProperties": False}}


def from_transcript(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a transcript (conv_id, turn, role, text): a user's turn calls ``reply``, the assistant's next turn is its result."""
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    user = conversations.where("role = 'user'")
    previous = F.when(F.col("turn") >= 2, name(F.col("turn") - 2))
    calls = user.select(
        "conv_id", name(F.col("turn")).alias("call_id"), "turn", F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), previous.alias("previous"))).alias("arguments"), F.when(previous.isNull(), F.array().cast("array<string>")).otherwise(F.array(previous)).alias("after"),
    )
    results = conversations.where("role = 'assistant'").select("conv_id", name(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def query(spark, sf_dir):
    return link_calls(*from_transcript(spark.read.parquet(f"{sf_dir}/conversations.parquet")), REPLY).drop("errors")


#: Of plain transcripts: a user's turn is named by its place, so that its reference is the user's turn before; identifiers are unique.
ORACLE = """
WITH RECURSIVE u AS (SELECT conv_id, turn, text, conv_id || '-' || turn AS call_id FROM conversations WHERE role = 'user'),
l(conv_id, turn, level) AS (
  SELECT conv_id, turn, 0 FROM u WHERE NOT EXISTS (SELECT 1 FROM u p WHERE p.conv_id = u.conv_id AND p.turn = u.turn - 2 AND u.turn >= 2)
  UNION ALL SELECT u.conv_id, u.turn, l.level + 1 FROM l JOIN u ON u.conv_id = l.conv_id AND u.turn = l.turn + 2)
SELECT u.conv_id, u.call_id, CAST(u.turn AS BIGINT) AS turn, l.level, CAST(a.turn AS BIGINT) AS result_turn, CASE WHEN a.turn IS NULL THEN 'missing' ELSE 'ok' END AS status,
  '{"arguments":{' || CASE WHEN u.turn >= 2 THEN '"previous":"' || u.conv_id || '-' || (u.turn - 2) || '",' ELSE '' END || '"prompt":' || CAST(to_json(u.text) AS VARCHAR) || '},"id":"' || u.call_id
  || '","name":"reply","result":' || coalesce(CAST(to_json(a.text) AS VARCHAR), 'null') || '}' AS json
FROM u JOIN l USING (conv_id, turn) LEFT JOIN conversations a ON a.role = 'assistant' AND a.conv_id = u.conv_id AND a.turn = u.turn + 1
"""
