"""Chat formatting with tools: calls meet results, are ordered, checked and written as canonical JSON.

1. Calls and results are reduced to one for each identifier and hash-joined on it.
2. Order. The level of a call is the longest chain of calls it depends on. Each call follows one of the calls it needs, at first the latest by
   turn; the lengths of these paths are found by doubling, in rounds that grow with the logarithm of a conversation's calls. A call one
   of whose needs has a longer path follows that one instead, until none does. No more than one row for each call is kept. What
   lies on or behind a cycle has no end of its path and no level.
3. Arguments are checked against the schema of the called function: JSON, required and known fields, types.
4. Each pair becomes one line of JSON with sorted keys and no white space, at every depth.

All steps are DataFrame expressions. A conversation is never gathered in one row or task.

Defined results: of calls (or results) with one identifier the first by turn and text stays, and their number
is given; calls without an identifier stay unlinked; results without a call come out as rows without a name;
arguments that are null, empty or no JSON object are an error and appear as null; other columns are not read;
empty inputs give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.staging import settled

#: Function -> field -> (JSON type, required)
Schemas = dict[str, dict[str, tuple[str, bool]]]
#: Longer than any path.
ENDLESS = 1 << 40
JSON_TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"], "object": ["OBJECT"], "array": ["ARRAY"], "null": ["VOID"]}


def problems(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments of a call, in the order of the schema; empty if nothing."""
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    found = F.array(F.lit("unknown function"))
    for function, fields in schemas.items():
        checks = [F.filter(F.transform(F.array_except(keys, F.array(*map(F.lit, fields))), lambda k: F.concat(F.lit("unknown field "), k)), lambda _: F.lit(True))]
        for field, (kind, required) in fields.items():
            actual = F.schema_of_variant(F.try_variant_get(value, f"$['{field}']", "variant"))
            fits = F.lit(False)
            for start in JSON_TYPES[kind]:
                fits = fits | actual.startswith(start)
            wrong = F.when(actual.isNull(), F.lit(f"missing field {field}") if required else F.lit(None)).when(~fits, f"field {field} is not {kind}")
            checks.append(F.when(wrong.isNotNull(), F.array(wrong)).otherwise(F.array().cast("array<string>")))
        found = F.when(name == function, F.concat(*checks)).otherwise(found)
    return F.when(value.isNull() | keys.isNull(), F.array(F.lit("arguments are not a JSON object"))).otherwise(found)


def _followed(chosen: DataFrame, longest: int) -> DataFrame:
    """``conv_id, call_id, to, level``: the length of the path of ``to`` from each call; ENDLESS if it runs into a cycle."""
    known = F.col("level") == ENDLESS
    paths = chosen.select("conv_id", "call_id", F.when(known, F.lit(None)).otherwise(F.col("to")).alias("next"), F.when(known, F.lit(ENDLESS)).otherwise(F.lit(1)).cast("long").alias("steps"))
    for _ in range(longest.bit_length() + 1):
        ahead = paths.select("conv_id", F.col("call_id").alias("next"), F.col("next").alias("after"), F.col("steps").alias("more"))
        ahead = paths.where("next is not null").join(ahead, ["conv_id", "next"], "left")
        ahead = ahead.select("conv_id", "call_id", F.col("after").alias("next"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        paths = settled(paths.where("next is null").unionByName(ahead), "tool-paths")
        if paths.where("next is not null").isEmpty():
            break
    level = F.when(F.col("next").isNotNull() | (F.col("steps") >= ENDLESS), F.lit(ENDLESS)).otherwise(F.col("steps"))
    return chosen.drop("level").join(paths.select("conv_id", "call_id", level.alias("level")), ["conv_id", "call_id"])


def levels(edges: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of the calls that need others: the longest chain below them, or -1 on and behind cycles.

    ``edges``: ``conv_id, call_id, needs, needs_turn``, one for each need. Conversations leave once no call of theirs has a longer
    chain than the one it follows; each time round, the calls with right levels reach at least one level higher.
    """
    key = ["conv_id", "call_id"]
    edges = settled(edges.select(*key, "needs", "needs_turn"), "tool-edges")
    chosen = edges.groupBy(*key).agg(F.max(F.struct("needs_turn", "needs"))["needs"].alias("to")).withColumn("level", F.lit(0).cast("long"))
    chosen, placed = settled(chosen, "tool-chosen"), []
    while True:
        longest = chosen.groupBy("conv_id").count().agg(F.max("count")).first()[0]
        found = settled(_followed(chosen, longest or 0), "tool-followed")
        below = found.select("conv_id", F.col("call_id").alias("needs"), F.col("level").alias("below"))
        best = edges.join(below, ["conv_id", "needs"], "left").groupBy(*key).agg(F.max(F.struct(F.coalesce("below", F.lit(0)).alias("below"), "needs")).alias("best"))
        better = (F.col("level") < ENDLESS) & (F.col("best.below") >= F.col("level"))
        found = settled(found.join(best, key).select(*key, F.when(better, F.col("best.needs")).otherwise(F.col("to")).alias("to"), "level", better.alias("better")), "tool-checked")
        changed = found.where("better").select("conv_id").distinct()
        placed.append(found.join(changed, "conv_id", "left_anti").select(*key, F.when(F.col("level") < ENDLESS, F.col("level")).otherwise(-1).alias("level")))
        if changed.isEmpty():
            return reduce(DataFrame.union, placed)
        chosen = settled(found.join(changed, "conv_id", "left_semi").drop("better"), "tool-chosen")


def linked(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row for each call, and for each result without one.

    ``calls``: ``conv_id, call_id, turn, name, arguments, needs`` (array of call ids); ``results``: ``conv_id, call_id, turn, content``.
    Gives ``conv_id, call_id, name, turn, level, result_turn, n_calls, n_results, problems, status, json``; ``level, turn, call_id`` is
    a topological order of a conversation's calls.
    """
    key = ["conv_id", "call_id"]
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one = calls.where(named).groupBy(*key).agg(F.min(F.struct("turn", "arguments", "name", "needs")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
    one = one.select(*key, "c.turn", "c.name", "c.arguments", F.coalesce("c.needs", F.array().cast("array<string>")).alias("needs"), "n_calls")
    one = settled(one, "tool-calls")
    answer = results.where(named).groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results"))
    answer = answer.select(*key, F.col("r.turn").alias("result_turn"), "r.content", "n_results")

    # Dependencies that exist; those on nothing known are a problem of the call, not an edge.
    edges = one.select(*key, F.explode(F.array_distinct("needs")).alias("needs"))
    target = one.select("conv_id", F.col("call_id").alias("needs"), F.col("turn").alias("needs_turn"))
    edges = settled(edges.join(target, ["conv_id", "needs"], "left"), "tool-needs")
    lost = edges.where("needs_turn is null").groupBy(*key).agg(F.count(F.lit(1)).alias("n_lost"))
    place = levels(edges.where("needs_turn is not null"))

    pairs = one.join(answer.hint("shuffle_hash"), key, "full_outer").join(place, key, "left").join(lost, key, "left")
    loose = calls.where(~named).select(*key, "turn", "name", "arguments", F.lit(1).cast("long").alias("n_calls"))
    alone = results.where(~named).select(*key, F.col("turn").alias("result_turn"), "content", F.lit(1).cast("long").alias("n_results"))
    pairs = pairs.drop("needs").unionByName(loose, allowMissingColumns=True).unionByName(alone, allowMissingColumns=True)

    # Nothing was called where there are only results.
    is_call = F.col("n_calls").isNotNull()
    wrong = F.when(is_call, problems(F.col("name"), F.col("arguments"), schemas))
    wrong = F.when(F.col("n_lost") > 0, F.array_append(wrong, F.lit("unknown dependency"))).otherwise(wrong)
    wrong = F.when(F.col("level") < 0, F.array_append(wrong, F.lit("cyclic dependency"))).otherwise(wrong)
    status = F.when(~is_call, "no call").when(F.size("problems") > 0, "invalid").when(F.col("n_results").isNull(), "no result").otherwise("linked")
    found = pairs.withColumn("problems", wrong).withColumn("status", status)
    value = F.when(F.json_object_keys("arguments").isNotNull(), F.try_parse_json("arguments"))
    line = F.to_json(F.struct(value.alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result"), "status"), {"ignoreNullFields": "false"})
    level = F.when(is_call, F.when(F.col("level") >= 0, F.col("level")).when(F.col("level").isNull(), 0))
    return found.select(*key, "name", "turn", level.cast("long").alias("level"), "result_turn", "n_calls", "n_results", "problems", "status", line.alias("json"))


def chat_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations ``conv_id, turn, role, text``.

    A system turn calls ``setup``, a user turn calls ``answer``, which needs the setup of turn 0 and the previous question, where there are
    any; the turn after a call, if it is the assistant's, is its result.
    """
    ident = lambda turn: F.concat(F.lit("turn-"), turn.cast("string"))
    asked = turns.where("role in ('system', 'user')")
    is_setup = F.col("role") == "system"
    arguments = F.when(is_setup, F.to_json(F.struct(F.col("text").alias("instructions")))).otherwise(
        F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn"))))
    known = asked.select("conv_id", "turn").distinct()
    back = F.explode(F.array(F.col("turn") - 1, F.col("turn") - 2, F.lit(0).cast("long")))
    needs = asked.where(~is_setup).select("conv_id", "turn", back.alias("to")).where("to >= 0 and to < turn").distinct()
    needs = needs.join(known.withColumnRenamed("turn", "to"), ["conv_id", "to"], "left_semi")
    needs = needs.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_set(ident(F.col("to")))).alias("needs"))  # three at most
    calls = asked.select("conv_id", ident(F.col("turn")).alias("call_id"), "turn", F.when(is_setup, "setup").otherwise("answer").alias("name"), arguments.alias("arguments"))
    calls = calls.join(needs, ["conv_id", "turn"], "left").select("conv_id", "call_id", "turn", "name", "arguments", "needs")
    results = turns.where("role = 'assistant'").select("conv_id", ident(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


CHAT_SCHEMAS: Schemas = {"setup": {"instructions": ("string", True)}, "answer": {"prompt": ("string", True), "turn": ("integer", True)}}
