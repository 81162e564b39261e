"""Recursion as levels of a table: calls are split into sub-calls level by level, the last level is asked, and answers
are joined upwards. The number of Spark jobs depends on the depth, not on the number of calls."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.operators.calls import lm_map


def leaf_model(model: Column, second: str | None, default: str) -> dict[str, Column]:
    """Who answers a leaf, and who is reported: a second model answers in spite of the one asked for."""
    return {"answers": F.lit(second) if second else F.coalesce(model, F.lit(default)), "reported": F.coalesce(model, F.lit(second or default))}


def recurse(
    calls: DataFrame,
    split: Callable[[Column], Column],
    max_depth: int,
    key: str = "call_id",
    prompt: str = "prompt",
    **call: Any,
) -> DataFrame:
    """call_id, parent_call_id, depth, prompt, response, error and sub_calls of all calls.

    ``calls`` has a text key and a prompt. ``split`` gives a prompt's sub-prompts as an array; a call without any, or
    at ``max_depth``, is answered by the model, the others by the model on their answers in order."""
    frontier = calls.select(F.col(key).cast("string").alias("call_id"), F.lit(None).cast("string").alias("parent_call_id"), F.lit(0).alias("pos"), F.col(prompt).alias("prompt"))
    levels = []
    for depth in range(max_depth + 1):
        subs = F.array().cast("array<string>") if depth == max_depth else F.coalesce(split(F.col("prompt")), F.array().cast("array<string>"))
        level = scratch.table(frontier.withColumns({"depth": F.lit(depth), "subs": subs}), "calls")
        levels.append(level)
        each = level.select("call_id", F.posexplode("subs").alias("pos", "prompt"))
        frontier = each.select(F.concat_ws("/", "call_id", "pos").alias("call_id"), F.col("call_id").alias("parent_call_id"), "pos", "prompt")
        if not level.filter(F.size("subs") > 0).limit(1).count():
            break
    out, below = None, None
    for level in reversed(levels):
        if below is None:
            asked = level.withColumn("ask_", F.col("prompt"))
        else:
            ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "response"))), lambda x: x["response"])
            joined = below.groupBy(F.col("parent_call_id").alias("of")).agg(F.array_join(ordered, "\n").alias("told"))
            asked = level.join(joined, F.col("call_id") == F.col("of"), "left").withColumn("ask_", F.coalesce("told", "prompt")).drop("of", "told")
        answered = lm_map(asked.withColumn("sub_calls", F.size("subs")).drop("subs"), "ask_", **call)
        below = scratch.table(answered.drop("ask_", "seconds"), "answers")
        out = below if out is None else out.unionByName(below)
    return out.drop("pos")
