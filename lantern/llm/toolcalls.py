"""Tool calls of conversations, linked with their results, ordered, validated and written canonically
(operator 2). Only joins, groupings and built-in functions; arguments are VARIANT values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.session import durable

SCHEMA_DDL = (
    "required array<string>, additionalProperties boolean, properties map<string, "
    "struct<type: string, enum: array<string>, minimum: double, maximum: double>>"
)

# schemas are broadcast up to this many tools; beyond, they are joined by name
BROADCAST_TOOLS = 10_000


def levels(calls: DataFrame) -> DataFrame:
    """``id`` and ``level`` of each call: how many calls come before it by way of ``after``.

    ``calls`` has each id once. Every round doubles how far a call looks back, so a chain of n calls takes
    log2(n) rounds, each one hash join on the id; the rounds start from files in the shared folder. A
    call after an unknown id begins anew at level 0. Calls on a cycle, or after one, have a null level:
    they are those still looking back when they have passed more calls than there are.
    """
    known = calls.select(F.col("id").alias("known"))
    state = durable(
        calls.join(known, calls["after"] == known["known"], "left").select(
            "id", F.col("known").alias("up"), F.when(F.col("known").isNull(), 0).otherwise(1).cast("bigint").alias("level")
        )
    )
    count = state.count()
    reach = 1
    while reach <= count and not state.where("up IS NOT NULL").isEmpty():
        above = state.select(F.col("id").alias("aid"), F.col("up").alias("aup"), F.col("level").alias("alevel"))
        state = durable(
            state.join(above, state["up"] == above["aid"], "left").select(
                "id",
                F.col("aup").alias("up"),
                F.when(F.col("up").isNull(), F.col("level")).otherwise(F.col("level") + F.col("alevel")).alias("level"),
            )
        )
        reach *= 2
    return state.select("id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


KIND = (
    "CASE WHEN schema_of_variant(e.value) = 'STRING' THEN 'string' WHEN schema_of_variant(e.value) = 'BOOLEAN' THEN 'boolean' "
    "WHEN schema_of_variant(e.value) = 'BIGINT' THEN 'integer' WHEN schema_of_variant(e.value) = 'VOID' THEN 'null' "
    "WHEN schema_of_variant(e.value) LIKE 'ARRAY%' THEN 'array' WHEN schema_of_variant(e.value) LIKE 'OBJECT%' THEN 'object' "
    "ELSE 'number' END"
)
ERRORS = f"""
CASE
  WHEN _schema IS NULL THEN array('unknown tool')
  WHEN _args IS NULL THEN array('arguments are not JSON')
  WHEN _map IS NULL THEN array('arguments are not an object')
  ELSE array_sort(concat(
    transform(filter(coalesce(_schema.required, array()), r -> NOT map_contains_key(_map, r)), r -> concat('missing ', r)),
    flatten(transform(map_entries(_map), e -> transform(array(try_element_at(_schema.properties, e.key)), p -> CASE
      WHEN p IS NULL THEN IF(_schema.additionalProperties = false, concat('unexpected ', e.key), NULL)
      WHEN p.type IS NOT NULL AND NOT (p.type = {KIND} OR p.type = 'number' AND {KIND} = 'integer') THEN concat('not ', p.type, ': ', e.key)
      WHEN p.enum IS NOT NULL AND NOT coalesce(array_contains(p.enum, try_variant_get(e.value, '$', 'string')), false)
        THEN concat('not allowed: ', e.key)
      WHEN try_variant_get(e.value, '$', 'double') < p.minimum THEN concat('too small: ', e.key)
      WHEN try_variant_get(e.value, '$', 'double') > p.maximum THEN concat('too large: ', e.key)
    END)))
  ))
END
"""


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and one per id that has results but no call.

    ``calls``: conv_id, turn, id, name, arguments (JSON text), after (id of the call whose result it uses,
    or null). ``results``: conv_id, turn, id, content. ``schemas``: name, schema (JSON schema with
    properties, required, additionalProperties, type, enum, minimum, maximum).

    Result: conv_id, id, turn, name, ``level`` (sorting by level, turn puts each call after those it
    depends on), ``status`` (linked, missing result, early result, cycle, orphan result), ``result_turn``,
    ``n_results``, ``errors`` (of the arguments, joined by "; ", empty if valid) and ``canonical``: JSON
    without spaces whose keys are sorted at every depth. Of several results the earliest counts (then the
    least text). A null id links with nothing; repeated calls stay, each with the level of its first turn;
    texts of any length and tables without rows are fine; extra columns are left out.
    """
    calls = calls.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "id", "name", "arguments", "after")
    # counted in each task first, so the joined side has each id once, however often a result repeats
    answers = (
        results.where("id IS NOT NULL")
        .groupBy(F.col("id").alias("rid"))
        .agg(
            F.min(F.struct(F.col("turn").cast("bigint").alias("turn"), "content", "conv_id")).alias("answer"),
            F.count(F.lit(1)).alias("n_results"),
        )
    )
    first = calls.where("id IS NOT NULL").groupBy("id").agg(F.min_by("after", F.struct("turn", "after")).alias("after"))
    depth = levels(first).select(F.col("id").alias("lid"), "level")
    tools = schemas.groupBy(F.col("name").alias("tool")).agg(F.min("schema").alias("text"))
    tools = tools.select("tool", F.from_json("text", SCHEMA_DDL).alias("_schema"))
    if tools.count() <= BROADCAST_TOOLS:
        tools = F.broadcast(tools)
    joined = (
        calls.join(answers.hint("shuffle_hash"), calls["id"] == answers["rid"], "left")
        .join(depth.hint("shuffle_hash"), F.col("id") == F.col("lid"), "left")
        .join(tools, F.col("name") == F.col("tool"), "left")
        .withColumn("_args", F.try_parse_json("arguments"))
        .withColumn("_map", F.expr("IF(schema_of_variant(_args) LIKE 'OBJECT%', try_variant_get(_args, '$', 'map<string,variant>'), NULL)"))
    )
    alone = F.col("id").isNull()
    linked = joined.select(
        "conv_id",
        "id",
        "turn",
        "name",
        F.when(alone, F.lit(0)).otherwise(F.col("level")).cast("bigint").alias("level"),
        F.when(~alone & F.col("level").isNull(), "cycle")
        .when(F.col("rid").isNull(), "missing result")
        .when(F.col("answer.turn") <= F.col("turn"), "early result")
        .otherwise("linked")
        .alias("status"),
        F.col("answer.turn").alias("result_turn"),
        F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        F.expr(f"array_join({ERRORS}, '; ')").alias("errors"),
        F.expr(
            "to_json(named_struct('arguments', _args, 'id', id, 'name', name, 'raw', IF(_args IS NULL, arguments, NULL), "
            "'result', answer.content))"
        ).alias("canonical"),
    )
    orphans = answers.join(first.select(F.col("id").alias("called")), F.col("rid") == F.col("called"), "left_anti").select(
        F.col("answer.conv_id").alias("conv_id"),
        F.col("rid").alias("id"),
        F.lit(None).cast("bigint").alias("turn"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("bigint").alias("level"),
        F.lit("orphan result").alias("status"),
        F.col("answer.turn").alias("result_turn"),
        "n_results",
        F.lit("").alias("errors"),
        F.expr("to_json(named_struct('id', rid, 'result', answer.content))").alias("canonical"),
    )
    return linked.unionByName(orphans)


SCHEMAS = {
    "search": '{"required":["query"],"additionalProperties":false,"properties":{"query":{"type":"string"},"limit":{"type":"integer","minimum":1,"maximum":20}}}',
    "translate": '{"required":["text","target"],"properties":{"text":{"type":"string"},"target":{"type":"string","enum":["de","en","fr"]}}}',
    "count": '{"required":["text","words"],"additionalProperties":false,"properties":{"text":{"type":"string"},"words":{"type":"boolean"}}}',
}


def talk_calls(talks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the turns of ``conversations`` stand for them: each user turn asks a tool that
    its length picks, after the call of the user turn before it; each assistant turn answers the turn
    before."""
    size = F.length(F.coalesce("text", F.lit("")))
    name = lambda back: F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), F.col("turn") - back)
    calls = talks.where("role = 'user'").select(
        "conv_id",
        "turn",
        name(0).alias("id"),
        F.element_at(F.array(F.lit("search"), F.lit("translate"), F.lit("count"), F.lit("weather")), (size % 4 + 1).cast("int")).alias("name"),
        F.when(size % 4 == 0, F.to_json(F.struct(F.col("text").alias("query"), (size % 25).alias("limit"))))
        .when(size % 4 == 1, F.to_json(F.struct(F.col("text"), F.element_at(F.array(*map(F.lit, ("fr", "en", "xx"))), (size % 3 + 1).cast("int")).alias("target"))))
        .when(size % 4 == 2, F.to_json(F.struct(F.col("text"), F.col("turn").alias("lines"))))
        .otherwise(F.lit("{")).alias("arguments"),
        name(2).alias("after"),
    )
    results = talks.where("role = 'assistant'").select("conv_id", "turn", name(1).alias("id"), F.col("text").alias("content"))
    return calls, results


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tool calls that ``conversations`` stands for, linked, checked and in canonical form; sorted so
    that within a conversation every call follows those it depends on."""
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    calls, results = talk_calls(talks)
    schemas = spark.createDataFrame(list(SCHEMAS.items()), "name string, schema string")
    return link(calls, results, schemas).orderBy("conv_id", F.col("level").asc_nulls_last(), "turn", "id")


OP2_SQL = """
WITH talks AS (SELECT conv_id, turn, role, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM conversations),
users AS (
    SELECT *, conv_id || '_' || turn AS k, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain
    FROM talks WHERE role = 'user'
), calls AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS level FROM users
), answers AS (
    SELECT conv_id, turn, t, conv_id || '_' || (turn - 1) AS k FROM talks WHERE role = 'assistant'
), linked AS (
    SELECT c.*, a.turn AS result_turn, a.t AS result FROM calls c LEFT JOIN answers a USING (k)
)
SELECT conv_id, 'call_' || k AS id, turn, ['search', 'translate', 'count', 'weather'][n % 4 + 1] AS name, level,
    CASE WHEN result_turn IS NULL THEN 'missing result' ELSE 'linked' END AS status, result_turn,
    (result_turn IS NOT NULL)::BIGINT AS n_results,
    CASE n % 4
        WHEN 0 THEN CASE WHEN n % 25 < 1 THEN 'too small: limit' WHEN n % 25 > 20 THEN 'too large: limit' ELSE '' END
        WHEN 1 THEN CASE WHEN n % 3 = 2 THEN 'not allowed: target' ELSE '' END
        WHEN 2 THEN 'missing words; unexpected lines' ELSE 'unknown tool' END AS errors,
    '{' || CASE n % 4
        WHEN 0 THEN '"arguments":{"limit":' || n % 25 || ',"query":' || to_json(t)::VARCHAR || '},'
        WHEN 1 THEN '"arguments":{"target":"' || ['fr', 'en', 'xx'][n % 3 + 1] || '","text":' || to_json(t)::VARCHAR || '},'
        WHEN 2 THEN '"arguments":{"lines":' || turn || ',"text":' || to_json(t)::VARCHAR || '},' ELSE '' END
        || '"id":"call_' || k || '","name":"' || ['search', 'translate', 'count', 'weather'][n % 4 + 1] || '"'
        || CASE WHEN n % 4 = 3 THEN ',"raw":"{"' ELSE '' END
        || CASE WHEN result_turn IS NULL THEN '' ELSE ',"result":' || to_json(result)::VARCHAR END || '}' AS canonical
FROM linked
UNION ALL
SELECT conv_id, 'call_' || k, NULL, NULL, NULL, 'orphan result', turn, 1, '', '{"id":"call_' || k || '","result":' || to_json(t)::VARCHAR || '}'
FROM answers WHERE k NOT IN (SELECT k FROM users)
"""
