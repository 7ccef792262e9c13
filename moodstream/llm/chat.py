"""Chat formatting: tool calls linked to their results, ordered, validated and serialised. Built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import global_index, materialise

#: Schema types and the variant types that satisfy them.
_TYPES = {
    "string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\([0-9]+,0\\))$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$", "array": "^ARRAY<.*", "object": "^OBJECT<.*",
}
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted messages on arguments (JSON text) that do not fit the tool's schema.

    ``schemas`` maps a tool to its parameters, each a type and whether it is required.
    """
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False))
    given = F.coalesce(F.map_keys(F.from_json(arguments, "map<string,string>")), F.array().cast("array<string>"))
    checks: list[Column] = [F.when(~F.coalesce(name.isin(*schemas), F.lit(False)), F.lit("unknown tool")), F.when(~is_object, F.lit("arguments are not an object"))]
    unknown = F.array().cast("array<string>")
    for tool, parameters in schemas.items():
        here = (name == tool) & is_object
        for parameter, (kind, required) in parameters.items():
            found = F.schema_of_variant(F.try_variant_get(parsed, f"$['{parameter}']", "variant"))
            present = F.array_contains(given, parameter)
            if required:
                checks.append(F.when(here & ~present, F.lit(f"missing {parameter}")))
            checks.append(F.when(here & present & ~F.coalesce(found.rlike(_TYPES[kind]), F.lit(False)), F.lit(f"{parameter} is not {kind}")))
        extra = F.transform(F.array_except(given, F.array(*[F.lit(p) for p in parameters])), lambda k: F.concat(F.lit("unexpected "), k))
        unknown = F.when(here, extra).otherwise(unknown)
    return F.array_sort(F.concat(F.array_compact(F.array(*checks)), unknown))


def topological_levels(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Level of every node: 0 without needs, else one above its highest need; null inside and behind cycles.

    ``nodes`` has ``node``, ``edges`` has ``node`` and ``need``; needs that are no nodes must be left out. A
    round settles all nodes whose needs are settled, so the rounds are as many as the longest chain.
    """
    needy = edges.select("node").distinct()
    settled = materialise(nodes.join(needy, "node", "left_anti").select("node", F.lit(0).alias("level")), "levels")
    while True:
        reached = edges.join(settled.select(F.col("node").alias("need"), "level"), "need", "left")
        ready = reached.groupBy("node").agg(F.count("*").alias("all"), F.count("level").alias("known"), (F.max("level") + 1).alias("level"))
        fresh = materialise(ready.where("all = known").select("node", "level").join(settled, "node", "left_anti"), "levels")
        if fresh.isEmpty():
            return nodes.join(settled, "node", "left").select("node", "level")
        settled = materialise(settled.unionByName(fresh), "levels")


def further_results(results: DataFrame) -> DataFrame:
    """The results of each conversation and identifier but the first by turn and content, equal ones as often as they come."""
    named = results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id", "turn", "content").agg(F.count("*").alias("same"))
    first = named.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("first"))
    more = F.col("same") - F.struct("turn", "content").eqNullSafe(F.col("first")).cast("long")
    left = named.join(first, ["conv_id", "call_id"]).withColumn("more", more).where("more > 0")
    return left.select("conv_id", "turn", "call_id", "content", F.explode(F.sequence(F.lit(1).cast("long"), "more")).alias("copy")).drop("copy")


def link_tool_calls(
    calls: DataFrame, results: DataFrame, schemas: Schemas, context: DataFrame | None = None, repeats: bool = False,
) -> DataFrame:
    """One row per tool call, in topological order within its conversation, with its result and a canonical record.

    ``calls`` has ``conv_id``, ``turn``, ``call_id``, ``name``, ``arguments`` (JSON text) and ``needs`` (ids of
    calls of the same conversation); ``results`` has ``conv_id``, ``turn``, ``call_id`` and ``content``. Other
    columns are ignored. The output has the call's keys, ``level`` (null in or behind a cycle), ``position`` (gapless from
    0 in each conversation, by level with nulls last, turn and id), ``n_results``, ``valid``, ``errors`` and
    ``record``: JSON with sorted keys and without spare white space.

    Results are hash-joined by conversation and identifier; the first by turn is used. Results without a call give
    a row of their own with the error "result without a call". Calls with a null conversation or id link with
    nothing. Of different calls under one id the first by turn keeps the links; the others are marked
    "repeated id" and stay. Rows that are equal in all columns are one call stored several times: each copy keeps
    the links and gives a row. Needs that name no call are marked "unknown need", and cycles "cyclic need".

    With ``repeats`` every further result of an identifier gives a row with the error "repeated result". Each row
    of ``context`` (``conv_id``, ``turn``, ``role``, ``content``) gives one too: it is valid unless its role is
    null ("no role"), and its record has ``content``, ``role`` and ``turn``. Both stand behind the conversation's other rows.
    Rows with equal turn and id go by role, then by a hash of content, name and arguments, so that positions
    do not depend on the order of the input.
    """
    keyed = calls.select(
        "conv_id", "turn", "call_id", "name", "arguments", F.coalesce("needs", F.array().cast("array<string>")).alias("needs")
    )
    firsts = keyed.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", F.xxhash64("name", "arguments", "needs").alias("h"))).alias("first"), F.count("*").alias("same")
    )
    answered = results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("n_results")
    )
    matched = materialise(firsts.join(answered, ["conv_id", "call_id"], "full"), "matched")
    node = F.struct("conv_id", "call_id")
    nodes = matched.where("first is not null").select(node.alias("node"))
    needs = keyed.join(matched.where("first is not null").select("conv_id", "call_id", "first"), ["conv_id", "call_id"]).where(
        F.col("turn").eqNullSafe(F.col("first.turn")) & (F.xxhash64("name", "arguments", "needs") == F.col("first.h"))
    )
    wanted = needs.select(node.alias("node"), F.explode(F.array_distinct("needs")).alias("n"), "conv_id").select("node", F.struct("conv_id", F.col("n").alias("call_id")).alias("need"))
    wanted = wanted.distinct()
    known = materialise(wanted.join(nodes.select(F.col("node").alias("need"), F.lit(True).alias("known")), "need", "left"), "needs")
    levels = topological_levels(known.where("known").select("node", "need"), nodes).select("node.conv_id", "node.call_id", "level", F.lit(True).alias("linked"))
    lacking = known.where("known is null").select("node.conv_id", "node.call_id", F.lit(True).alias("lacking")).distinct()
    facts = matched.join(levels, ["conv_id", "call_id"], "left").join(lacking, ["conv_id", "call_id"], "left")
    rows = keyed.join(facts, ["conv_id", "call_id"], "left")
    owner = F.coalesce(F.col("turn").eqNullSafe(F.col("first.turn")) & (F.xxhash64("name", "arguments", "needs") == F.col("first.h")), F.lit(False))
    own = [
        F.when(F.col("linked") & ~owner, F.lit("repeated id")), F.when(F.col("linked").isNull(), F.lit("no id")),
        F.when(F.col("lacking") & owner, F.lit("unknown need")), F.when(F.col("linked") & F.col("level").isNull() & owner, F.lit("cyclic need")),
        F.when(owner & F.col("n_results").isNull(), F.lit("no result")),
    ]
    linked = rows.select(
        "conv_id", "turn", "call_id", "name", "arguments", F.when(owner, F.col("level")).alias("level"),
        F.when(owner, F.col("result.content")).alias("content"), F.when(owner, F.coalesce("n_results", F.lit(0))).otherwise(0).cast("long").alias("n_results"),
        F.array_sort(F.concat(F.array_compact(F.array(*own)), argument_errors(F.col("name"), F.col("arguments"), schemas))).alias("errors"),
    )
    orphans = matched.where("first is null").select(
        "conv_id", F.col("result.turn").alias("turn"), "call_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("int").alias("level"), F.col("result.content").alias("content"), "n_results", F.array(F.lit("result without a call")).alias("errors"),
    )
    lone = results.where("conv_id is null or call_id is null").select(
        "conv_id", "turn", "call_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("int").alias("level"), "content", F.lit(1).cast("long").alias("n_results"), F.array(F.lit("result without a call")).alias("errors"),
    )
    everything = linked.unionByName(orphans).unionByName(lone).withColumn("behind", F.lit(0)).withColumn("role", F.lit(None).cast("string"))
    # Neither a call nor the result in use: no name, arguments or level.
    plain = [F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("int").alias("level")]
    if repeats:
        everything = everything.unionByName(further_results(results).select(
            "conv_id", "turn", "call_id", *plain, "content", F.lit(1).cast("long").alias("n_results"), F.array(F.lit("repeated result")).alias("errors"),
            F.lit(1).alias("behind"), F.lit(None).cast("string").alias("role"),
        ))
    if context is not None:
        everything = everything.unionByName(context.select(
            "conv_id", "turn", F.lit(None).cast("string").alias("call_id"), *plain, "content", F.lit(0).cast("long").alias("n_results"),
            F.array_compact(F.array(F.when(F.col("role").isNull(), F.lit("no role")))).alias("errors"), F.lit(2).alias("behind"), "role",
        ))
    everything = everything.withColumn("late", F.col("level").isNull()).withColumn("tie", F.xxhash64("content", "name", "arguments"))
    indexed = global_index(everything, ["conv_id", "late", "level", "behind", "turn", "call_id", "role", "tie"], "at")
    start = indexed.groupBy("conv_id").agg(F.min("at").alias("start")).withColumnRenamed("conv_id", "c")
    placed = indexed.join(start, F.col("conv_id").eqNullSafe(F.col("c")))
    parsed = F.try_parse_json("arguments")
    # Keys in alphabetical order; variants keep theirs sorted. Arguments that are no JSON stay text.
    record = F.to_json(
        F.struct(
            F.coalesce(parsed, F.to_variant_object(F.struct(F.col("arguments").alias("text")))).alias("arguments"), F.col("call_id"), F.col("content"), F.col("name"), F.col("turn"),
        ),
        {"ignoreNullFields": "false"},
    )
    told = F.to_json(F.struct("content", "role", "turn"), {"ignoreNullFields": "false"})
    record = F.when(F.col("behind") == 2, told).otherwise(record)
    return placed.select(
        "conv_id", "turn", "call_id", "name", "level", (F.col("at") - F.col("start")).alias("position"), "n_results",
        (F.size("errors") == 0).alias("valid"), "errors", record.alias("record"),
    )


TOOLS: Schemas = {
    "search": {"limit": ("integer", True), "query": ("string", True)},
    "lookup": {"limit": ("integer", False), "query": ("string", True)},
    "summarise": {"query": ("string", True)},
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls from user turns and results from assistant turns of a plain conversation table.

    A user turn asks one of three tools; every seventh length gives its limit as text and every eleventh leaves
    out the query. The k-th user turn needs the result of the turn at half its place. An assistant turn answers the turn
    before it.
    """
    place = F.floor((F.col("turn") - F.col("turn") % 2) / 2)
    size = F.length(F.coalesce("text", F.lit("")))
    query = F.when(size % 11 != 0, F.coalesce("text", F.lit("")))
    limit_number = F.when(size % 7 != 0, size % 50)
    as_number = F.to_json(F.struct(limit_number.alias("limit"), query.alias("query")))
    as_text = F.to_json(F.struct(F.concat(F.lit(""), (size % 50).cast("string")).alias("limit"), query.alias("query")))
    need = F.concat(F.lit("c"), (F.col("turn") % 2 + 2 * F.floor(place / 2)).cast("string"))
    calls = turns.where("role = 'user'").select(
        "conv_id", "turn", F.concat(F.lit("c"), F.col("turn").cast("string")).alias("call_id"),
        F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (place % 3 + 1).cast("int")).alias("name"),
        F.when(size % 7 == 0, as_text).otherwise(as_number).alias("arguments"),
        F.when(place > 0, F.array(need)).otherwise(F.array().cast("array<string>")).alias("needs"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


def other_turns(turns: DataFrame) -> DataFrame:
    """Turns that are neither user's nor assistant's, those without a role too."""
    other = ~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))
    return turns.where(other).select("conv_id", "turn", "role", F.col("text").alias("content"))


def op4(spark, sf_dir: str) -> DataFrame:
    """All conversations as linked tool calls, with every other turn and every further result in rows of their own."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    calls, results = conversation_calls(turns)
    out = link_tool_calls(calls, results, TOOLS, context=other_turns(turns), repeats=True)
    return out.withColumn("errors", F.array_join("errors", "; "))
