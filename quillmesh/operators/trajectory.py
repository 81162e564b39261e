"""Analytics over trajectories: per run, per iteration, per tree of calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh import scratch

#: Patterns and lengths by which a run's question is found, and what is told if there is none.
ASKED = r'original query: "([^"]+)"'
NOT_THIS = "answer the prompt"
ABOUT = r"(?i)context variable.*?:(.*?)(?:\n|$)"
NO_QUESTION = "Context available in REPL environment"
SHOWN = 8000


def iteration_stats(iterations: DataFrame) -> DataFrame:
    """Adds code_blocks_n, sub_calls, exec_time, has_error, has_final, input_tokens, output_tokens (characters over 4, rounded)."""
    blocks = F.col("code_blocks")
    times = F.aggregate(blocks, F.lit(0.0), lambda a, b: a + F.coalesce(b["result"]["execution_time"], F.lit(0.0)))
    calls = F.aggregate(blocks, F.lit(0), lambda a, b: a + F.coalesce(F.nullif(F.size(b["result"]["rlm_calls"]), F.lit(-1)), F.lit(0)))
    prompt = F.aggregate("prompt", F.lit(0), lambda a, m: a + F.coalesce(F.length(m["content"]), F.lit(0)))
    rounded = lambda n: F.floor(n / 4 + 0.5).cast("bigint")
    return iterations.withColumns(
        {
            "code_blocks_n": F.greatest(F.size(blocks), F.lit(0)),
            "sub_calls": F.coalesce(calls, F.lit(0)),
            "exec_time": F.coalesce("iteration_time", times, F.lit(0.0)),
            "has_error": F.coalesce(F.exists(blocks, lambda b: F.coalesce(F.length(b["result"]["stderr"]), F.lit(0)) > 0), F.lit(False)),
            "has_final": F.col("final_answer").isNotNull(),
            "input_tokens": rounded(F.coalesce(prompt, F.lit(0))),
            "output_tokens": rounded(F.coalesce(F.length("response"), F.lit(0))),
        }
    )


def answer_text(answer: Column) -> Column:
    """An answer that is written as a pair [type, answer] is its second part."""
    pair = F.from_json(answer, "array<string>")
    return F.when((F.substring(answer, 1, 1) == "[") & (F.size(pair) == 2), F.try_element_at(pair, F.lit(2))).otherwise(answer)


def run_summary(iterations: DataFrame, run: str) -> DataFrame:
    """Per run: n_iterations, code_blocks_n, sub_calls, total_time, has_errors, final_answer (the last that isn't empty)."""
    stats = iteration_stats(iterations)
    order = F.struct("completion_no", "iteration") if "completion_no" in iterations.columns else F.col("iteration")
    told = F.coalesce(F.length("final_answer"), F.lit(0)) > 0
    return stats.groupBy(run).agg(
        F.count("*").alias("n_iterations"),
        F.sum("code_blocks_n").cast("bigint").alias("code_blocks_n"),
        F.sum("sub_calls").cast("bigint").alias("sub_calls"),
        F.sum("exec_time").alias("total_time"),
        F.max("has_error").alias("has_errors"),
        answer_text(F.max_by(F.when(told, F.col("final_answer")), F.when(told, order))).alias("final_answer"),
    )


def context_variable(iterations: DataFrame, run: str) -> DataFrame:
    """The first non-empty ``context`` among the variables of a run's code blocks."""
    each = iterations.select(run, "iteration", F.posexplode("code_blocks").alias("at", "b"))
    each = each.withColumn("context", F.col("b.result.locals")["context"]).filter(F.length("context") > 0)
    return each.groupBy(run).agg(F.min(F.struct("iteration", "at", "context"))["context"].alias("context"))


def question(prompt: Column, context: Column) -> Column:
    """What a run was asked, from its first prompt: a quoted query or the first user message of middling length, whichever
    stands first; else what the system message says of the context; else a short context; else a constant."""
    def of(m: Column) -> Column:
        content = F.coalesce(m["content"], F.lit(""))
        quoted = F.nullif(F.regexp_extract(content, ASKED, 1), F.lit(""))
        n = F.length(content)
        plain = F.concat(F.substring(content, 1, 200), F.when(n > 200, F.lit("...")).otherwise(F.lit("")))
        return F.coalesce(quoted, F.when(~F.contains(content, F.lit(NOT_THIS)) & (n > 50) & (n < 500), plain))

    users = F.filter(prompt, lambda m: m["role"] == "user")
    asked = F.try_element_at(F.filter(F.transform(users, of), lambda x: x.isNotNull()), F.lit(1))
    system = F.try_element_at(F.filter(prompt, lambda m: m["role"] == "system"), F.lit(1))["content"]
    about = F.when(system.rlike(ABOUT), F.substring(F.trim(F.regexp_extract(system, ABOUT, 1)), 1, 200))
    return F.coalesce(asked, about, F.when((F.length(context) > 0) & (F.length(context) < 500), context), F.lit(NO_QUESTION))


def previews(iterations: DataFrame, run: str) -> DataFrame:
    """Per run what a list of logs shows."""
    return run_summary(iterations, run).join(context_variable(iterations, run), run, "left").select(
        run,
        F.substring("context", 1, 200).alias("context_preview"),
        F.col("final_answer").isNotNull().alias("has_answer"),
        "n_iterations",
    )


def shown(text: Column, most: int = SHOWN) -> Column:
    """Text as displayed: cut, with a mark."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("\n... [truncated]"))).otherwise(text)


def call_tree(spark: SparkSession, calls: DataFrame) -> DataFrame:
    """calls (call_id, parent_call_id) with the depth and root of each; a root has no parent, and what no root leads to isn't
    in the tree. Where an id is repeated, a call has a row for each way up."""
    known = scratch.table(calls.select("call_id", "parent_call_id"), "calls")
    roots = known.filter("parent_call_id IS NULL").withColumns({"root_call_id": F.col("call_id"), "depth": F.lit(0)})
    below = known.filter("parent_call_id IS NOT NULL")
    repeated = known.filter("call_id IS NOT NULL").groupBy("call_id").count().filter("count > 1")
    try:
        found = _by_doubling(roots, below) if repeated.isEmpty() else _by_levels(roots, below)
    finally:
        scratch.free(known)
    tree = spark.read.schema(found[0].schema).parquet(*[level.scratch_path for level in found])
    return tree.select("call_id", "parent_call_id", "root_call_id", "depth")


def _by_doubling(roots: DataFrame, below: DataFrame) -> list[DataFrame]:
    """Ways of 1, 2, 4 … steps up are joined to all levels found so far: the number of jobs grows with the depth's logarithm.
    With unique ids a call has at most one such way, and one in a circle never meets a root."""
    found, steps = [scratch.table(roots, "tree")], 1
    ways = below.withColumn("above", F.col("parent_call_id"))
    while not ways.isEmpty():
        tops = reduce(DataFrame.unionByName, found).select(F.col("call_id").alias("above"), "root_call_id", (F.col("depth") + steps).alias("depth"))
        level = scratch.table(ways.join(tops, "above").select(*found[0].columns), "tree")
        if level.isEmpty():
            scratch.free(level)
            break
        found.append(level)
        further = ways.select(F.col("call_id").alias("above"), F.col("above").alias("further"))
        wider = scratch.table(ways.join(further, "above").select("call_id", "parent_call_id", F.col("further").alias("above")), "ways")
        scratch.free(ways)
        ways, steps = wider, 2 * steps
    scratch.free(ways)
    return found


def _by_levels(roots: DataFrame, below: DataFrame) -> list[DataFrame]:
    """One level after the other. Each row carries an id of its way, that of the last level whose depth is a power of two: who
    meets it again goes in a circle below a root and would never end."""
    found = [scratch.table(roots.withColumn("mark", F.col("call_id")), "tree")]
    while True:
        depth = len(found) - 1
        mark = "call_id" if depth & (depth - 1) == 0 else "mark"
        tops = found[-1].select(F.col("call_id").alias("parent_call_id"), "root_call_id", F.lit(depth + 1).alias("depth"), F.col(mark).alias("mark"))
        level = scratch.table(below.join(tops, "parent_call_id").select(*found[0].columns), "tree")
        circle = level.filter("call_id = mark").select("call_id").first()
        if circle:
            scratch.free(level, *found)
            raise ValueError(f"call {circle[0]!r} is among its own parents, below a root")
        if level.isEmpty():
            scratch.free(level)
            return found
        found.append(level)


def tree_rollup(tree: DataFrame, calls: DataFrame, *values: str) -> DataFrame:
    """Per root and depth: how many calls, and sums over them, so that what children spend counts for their root."""
    joined = tree.join(calls.select("call_id", *values), "call_id")
    return joined.groupBy("root_call_id", "depth").agg(F.count("*").alias("n_calls"), *[F.sum(v).alias(v) for v in values])
