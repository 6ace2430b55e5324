"""Tool-call linking and canonical JSON, in DataFrame operations (operator 9).

Calls and results are hash-joined by conversation and identifier. A call may
name one other call whose result it uses (``after``); a call's ``level`` is
its distance from the start of that chain, so ordering a conversation by
(level, seq) puts every call after the one it needs. Levels are found by
pointer doubling: each round joins every open call with the call its pointer
names, which halves the chains; no conversation is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.scratch import Scratch


class Param(NamedTuple):
    """A parameter of a tool; ``kind`` is string, integer, number, boolean, array or object."""

    name: str
    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None


class Tool(NamedTuple):
    name: str
    params: tuple[Param, ...]


_KINDS = {"string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
          "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}


def canonical(json: Column) -> Column:
    """Keys sorted at every depth, no white space; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def _path(name: str) -> str:
    return "$['" + name + "']"


def argument_error(arguments: Column, params: Sequence[Param]) -> Column:
    """What is wrong with a call's arguments, or null: ``not_an_object``, ``missing:x``, ``type:x``, ``range:x``, ``unknown:x``."""
    v = F.try_parse_json(arguments)
    checks = [F.when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "not_an_object")]
    for p in params:
        got = F.try_variant_get(v, _path(p.name), "variant")
        kind = F.schema_of_variant(got)
        gone = got.isNull() | (kind == "VOID")
        if p.required:
            checks.append(F.when(gone, f"missing:{p.name}"))
        checks.append(F.when(~gone & ~kind.rlike(_KINDS[p.kind]), f"type:{p.name}"))
        if p.least is not None or p.most is not None:
            x = F.try_variant_get(v, _path(p.name), "double")
            low = F.lit(False) if p.least is None else x < p.least
            high = F.lit(False) if p.most is None else x > p.most
            checks.append(F.when(low | high, f"range:{p.name}"))
    extra = F.array_min(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(p.name) for p in params]).cast("array<string>")))
    checks.append(F.when(extra.isNotNull(), F.concat(F.lit("unknown:"), extra)))
    return F.coalesce(*checks)


def call_error(name: Column, arguments: Column, tools: Sequence[Tool]) -> Column:
    """``argument_error`` by the tool's schema; ``no_such_tool`` for other names."""
    found = F.lit("no_such_tool")
    for t in tools:
        found = F.when(name == t.name, argument_error(arguments, t.params)).otherwise(found)
    return found


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level, chain) of unique calls (conv, call_id, after).

    ``chain`` is ``ok``, ``dangling`` (the call names a call that isn't there;
    level 0), or ``cycle`` (it never reaches a start; level null).
    """
    keep = Scratch(calls.sparkSession, "levels").keep
    ids = calls.select("conv", F.col("call_id").alias("ptr"), F.lit(True).alias("there"))
    named = calls.where("after is not null").select("conv", "call_id", F.col("after").alias("ptr"))
    start = (named.join(ids, ["conv", "ptr"], "left")
             .select("conv", "call_id", F.when(F.col("there"), F.col("ptr")).alias("ptr"),
                     F.when(F.col("there"), 1).otherwise(0).cast("long").alias("dist"),
                     F.when(F.col("there"), "ok").otherwise("dangling").alias("chain")))
    roots = calls.where("after is null").select("conv", "call_id", F.lit(None).cast("string").alias("ptr"),
                                                F.lit(0).cast("long").alias("dist"), F.lit("ok").alias("chain"))
    state = keep(start.unionAll(roots))
    longest = state.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    reach = 1  # a pointer spans so many calls
    while reach <= longest and state.where("ptr is not null").limit(1).count():
        far = state.select("conv", F.col("call_id").alias("ptr"), F.col("ptr").alias("next"), F.col("dist").alias("more"))
        moved = (state.where("ptr is not null").join(far, ["conv", "ptr"])
                 .select("conv", "call_id", F.col("next").alias("ptr"), (F.col("dist") + F.col("more")).alias("dist"), "chain"))
        state = keep(state.where("ptr is null").unionAll(moved))
        reach *= 2
    return state.select("conv", "call_id", F.when(F.col("ptr").isNull(), F.col("dist")).alias("level"),
                        F.when(F.col("ptr").isNotNull(), "cycle").otherwise(F.col("chain")).alias("chain"))


def quoted(c: Column) -> Column:
    """A string as JSON, ``null`` if null."""
    one = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})  # {"v":...}
    return F.substring(one, 6, F.length(one) - 6)


def record() -> Column:
    """The linked call as one canonical JSON object, keys in sorted order."""
    args = F.coalesce(canonical(F.col("arguments")), quoted(F.col("arguments")))
    return F.concat(F.lit('{"after":'), quoted(F.col("after")), F.lit(',"arguments":'), args,
                    F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), quoted(F.col("name")),
                    F.lit(',"result":'), quoted(F.col("content")), F.lit("}"))


def link_calls(calls: DataFrame, results: DataFrame, tools: Sequence[Tool]) -> DataFrame:
    """One row per call, linked with its result, ordered, checked and serialised.

    ``calls`` has (conv, seq, call_id, name, arguments, after), ``results``
    (conv, seq, call_id, content); other columns are ignored. Returns conv,
    call_id, seq, level, chain, name, error (of the arguments, null if valid),
    n_calls and n_results (rows of that identifier), status, record.

    status is ``linked``, ``unanswered`` (no result) or ``orphan`` (a result
    whose identifier no call has; level, name and seq of the call are null).
    Of rows that share an identifier the least by (seq, content) counts. Rows
    with a null conversation or identifier are dropped, as nothing can name
    them. ``record`` is canonical JSON: sorted keys, no white space, nulls
    written; arguments that aren't JSON are kept as a string.
    """
    c = (calls.where("conv is not null and call_id is not null").groupBy("conv", "call_id")
         .agg(F.min(F.struct("seq", "name", "arguments", "after")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
         .select("conv", "call_id", "c.*", "n_calls"))
    r = (results.where("conv is not null and call_id is not null").groupBy("conv", "call_id")
         .agg(F.min(F.struct(F.col("seq").alias("result_seq"), "content")).alias("r"), F.count(F.lit(1)).alias("n_results"))
         .select("conv", "call_id", "r.*", "n_results"))
    both = (c.join(levels(c.select("conv", "call_id", "after")), ["conv", "call_id"])
            .join(r, ["conv", "call_id"], "full"))
    error = F.when(F.col("n_calls").isNotNull(), call_error(F.col("name"), F.col("arguments"), tools))
    status = (F.when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("linked"))
    both = both.withColumns({"error": error, "status": status})
    return both.select("conv", "call_id", "seq", "level", "chain", "name", "error",
                       F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
                       F.coalesce("n_results", F.lit(0)).alias("n_results"), "status", record().alias("record"))
