"""Chat formatting: tool calls linked with their results, in order, validated, as canonical JSON.

Calls and results meet in an equi-join on the call's identifier. The order is topological: a call has
the level of its longest chain of calls that it follows, found round by round, where a round solves the
calls all of whose predecessors are solved. Arguments are parsed as variants and held against schemas;
canonical JSON has its keys sorted and no white space. Built-in functions alone do all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import drop_staged, stage

# Names of a schema's types, and what a variant of that type is called.
TYPES = """CASE want WHEN 'string' THEN kind = 'STRING' WHEN 'boolean' THEN kind = 'BOOLEAN'
    WHEN 'integer' THEN kind = 'BIGINT' OR kind LIKE 'DECIMAL(%,0)'
    WHEN 'number' THEN kind IN ('BIGINT', 'DOUBLE', 'FLOAT') OR kind LIKE 'DECIMAL(%'
    WHEN 'array' THEN kind LIKE 'ARRAY<%' WHEN 'object' THEN kind LIKE 'OBJECT<%' ELSE false END"""


def call_levels(calls: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """call_id and level of every call; null for calls that wait for each other.

    ``calls`` has call_id (unique) and after, the ids it follows; ids that no call has are passed
    over, as are nulls. One round for each level, each a join of what is left with what the last
    round solved; rounds are written to the shared folder.
    """
    ids = calls.select("call_id")
    waits = calls.select("call_id", F.explode(F.array_distinct("after")).alias("after")).where("after is not null")
    left = stage(waits.join(ids.select(F.col("call_id").alias("after")), "after", "left_semi"), "waits")
    solved = stage(ids.join(left.select("call_id").distinct(), "call_id", "left_anti").select("call_id", F.lit(0).alias("level")), "level")
    levels, level = [solved], 0
    while not left.isEmpty() and not solved.isEmpty() and level != max_rounds:
        level += 1
        rest = stage(left.join(solved.select(F.col("call_id").alias("after")), "after", "left_anti"), "waits")
        free = left.select("call_id").distinct().join(rest.select("call_id").distinct(), "call_id", "left_anti")
        solved = stage(free.select("call_id", F.lit(level).alias("level")), "level")
        drop_staged(left)
        left = rest
        levels.append(solved)
    known = levels[0]
    for more in levels[1:]:
        known = known.union(more)
    return ids.join(known, "call_id", "left")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call, and one for each result that belongs to no call.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (ids it follows).
    ``results``: call_id, content. ``schemas``: name, argument, type, required; types are string,
    boolean, integer, number, array and object. Other columns are not read.

    Returns conv_id, level, turn, call_id, status, violations, json. Order by conv_id, level, turn and
    call_id for a topological order; :func:`other_turns` gives the rest of a chat. status is ``ok``, ``no_result``, ``invalid`` (arguments break the
    schema or are no JSON object), ``unknown_tool``, ``cycle`` or ``no_call``. A call without an id is
    left out, as is a result without one. Of calls with one id the first by conv_id, turn, name and
    arguments counts, and of results the least content. A null argument counts as missing.
    """
    one = (
        calls.where("call_id is not null").groupBy("call_id")
        .agg(F.min(F.struct("conv_id", "turn", "name", "arguments", "after")).alias("c")).select("call_id", "c.*")
    )
    one = stage(one, "calls")
    answers = results.where("call_id is not null").groupBy("call_id").agg(
        F.min("content").alias("content"), F.lit(True).alias("answered")
    )
    rules = schemas.where("name is not null and argument is not null").groupBy("name").agg(
        F.sort_array(F.collect_set(F.struct("argument", F.col("type").alias("want"), F.coalesce("required", F.lit(False)).alias("required")))).alias("rules")
    )
    rows = (
        one.join(call_levels(one), "call_id").join(rules, "name", "left").join(answers, "call_id", "full")
        .withColumn("called", F.col("conv_id").isNotNull() | F.col("turn").isNotNull() | F.col("name").isNotNull() | F.col("arguments").isNotNull() | F.col("level").isNotNull())
    )
    # A one-element explode parses each text once.
    parsed = rows.withColumn("args", F.explode(F.array(F.expr("try_parse_json(arguments)"))))
    parsed = parsed.withColumn("is_object", F.expr("coalesce(schema_of_variant(args) LIKE 'OBJECT<%', false)"))
    # The fields of an object and what they are; null fields are missing ones.
    parsed = parsed.withColumn("given", F.expr("CASE WHEN is_object THEN try_cast(args AS map<string, variant>) ELSE map() END"))
    parsed = parsed.withColumn(
        "kinds", F.expr("transform(map_entries(given), e -> struct(e.key AS name, schema_of_variant(e.value) AS kind))")
    )
    parsed = parsed.withColumn("kinds", F.expr("map_from_entries(filter(kinds, k -> k.kind <> 'VOID'))"))
    check = f"""CASE WHEN args IS NULL OR NOT is_object THEN array('arguments: no JSON object')
        WHEN rules IS NULL THEN array() ELSE array_sort(concat(
            transform(filter(rules, r -> r.required AND NOT map_contains_key(kinds, r.argument)), r -> concat(r.argument, ': missing')),
            transform(filter(rules, r -> map_contains_key(kinds, r.argument) AND NOT
                ({TYPES.replace('want', 'r.want').replace('kind', 'element_at(kinds, r.argument)')})), r -> concat(r.argument, ': not ', r.want)),
            transform(array_except(map_keys(kinds), transform(rules, r -> r.argument)), a -> concat(a, ': unknown'))))
        END"""
    checked = parsed.withColumn("violations", F.expr(check))
    status = (
        F.when(~F.col("called"), "no_call").when(F.col("level").isNull(), "cycle")
        .when(F.col("rules").isNull(), "unknown_tool").when(F.size("violations") > 0, "invalid")
        .when(F.col("answered").isNull(), "no_result").otherwise("ok")
    )
    checked = checked.withColumn("status", status)
    text = F.expr("""to_json(to_variant_object(named_struct('arguments', args, 'call_id', call_id, 'level', level, 'name', name,
        'result', content, 'status', status)))""")
    none = F.array().cast("array<string>")
    return checked.select(
        "conv_id", "level", "turn", "call_id", "status",
        F.array_join(F.when(F.col("called"), F.col("violations")).otherwise(none), "; ").alias("violations"), text.alias("json"),
    )


def other_turns(turns: DataFrame) -> DataFrame:
    """Turns that neither call a tool nor answer one, as rows like those of :func:`link_tool_calls`.

    ``turns``: conv_id, turn, role, text. status is ``turn``, the JSON has content, role and turn; level and
    call_id are null. Every row gives one row, whatever is null in it.
    """
    text = F.expr("to_json(to_variant_object(named_struct('content', text, 'role', role, 'turn', turn)))")
    return turns.select(
        "conv_id", F.lit(None).cast("int").alias("level"), "turn", F.lit(None).cast("string").alias("call_id"),
        F.lit("turn").alias("status"), F.lit("").alias("violations"), text.alias("json"),
    )
