"""Calls of language models, a set at a time.

A table of prompts goes through ``mapInPandas``: each partition builds its model once and
keeps a bounded number of calls in flight, so the calls in flight overall are partitions times that.
A failing call is an error in its row, never an exception; rows keep their keys, so order and
length of a batch are those of its prompts. Deterministic models give the same rows when a
lost executor's partition is run again.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.models import Model, get_model

#: Calls in flight of a batch and of recursive calls, characters that a request may have.
BATCH_CALLS, SUB_CALLS = 16, 4
MAX_REQUEST = 400_000
EMPTY_REQUEST = "Missing 'prompt' or 'prompts' in request."
REPLY = "response string, error string, model string, input_tokens bigint, output_tokens bigint, cost double, seconds double"


def answer(model: Model, name: str, prompt: Any, prefix: str = "Error: ") -> tuple:
    """A row of REPLY for a prompt."""
    began = time.monotonic()
    if prompt is None or prompt == "":
        return f"{prefix}{EMPTY_REQUEST}", EMPTY_REQUEST, name, 0, 0, None, 0.0
    try:
        got = model.complete(prompt)
    except Exception as e:
        return f"{prefix}{e}", str(e) or type(e).__name__, name, 0, 0, None, time.monotonic() - began
    u = got.usage
    return got.text, None, name, u.input_tokens, u.output_tokens, u.cost, time.monotonic() - began


def lm_map(
    df: DataFrame,
    prompt: str = "prompt",
    kind: str = "echo",
    settings: dict[str, Any] | None = None,
    in_flight: int = BATCH_CALLS,
    prefix: str = "Error: ",
) -> DataFrame:
    """The rows of ``df`` with REPLY's columns: the response to ``prompt`` or the error."""
    settings = dict(settings or {})
    names = [x.split()[0] for x in REPLY.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = get_model(kind, **settings)
        name = getattr(model, "name", kind)
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                prompts = batch[prompt].tolist()
                replies = list(pool.map(lambda p: answer(model, name, p, prefix), prompts)) if in_flight > 1 else [answer(model, name, p, prefix) for p in prompts]
                yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(replies, columns=names)], axis=1)

    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{given}, {REPLY}")


def lm_map_batched(df: DataFrame, prompts: str = "prompts", **call: Any) -> DataFrame:
    """Rows with an array of prompts get ``responses`` of the same length and order, and n_failed; the other columns stay.

    Rows need no key of their own. An empty array has no responses."""
    keyed = df.withColumn("batch_", F.monotonically_increasing_id())
    keys = [c for c in keyed.columns if c != prompts]
    each = keyed.select("*", F.posexplode_outer(prompts).alias("pos_", "prompt")).drop(prompts)
    done = lm_map(each.filter("pos_ is not null"), "prompt", prefix="Error: llm() call failed - ", **call)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos_", "response"))), lambda x: x["response"])
    gathered = done.groupBy(*keys).agg(ordered.alias("responses"), F.count("error").alias("n_failed"))
    none = each.filter("pos_ is null").select(*keys, F.expr("cast(array() as array<string>)").alias("responses"), F.lit(0).cast("long").alias("n_failed"))
    return gathered.unionByName(none).drop("batch_")


def route(model: Column, depth: Column, registered: list[str], default: str, other: str | None = None) -> Column:
    """The model that answers: a registered one if asked for, else the second one at depth one, else the default."""
    second = F.when((depth == 1) & F.lit(other is not None), F.lit(other))
    return F.when(model.isin(registered) if registered else F.lit(False), model).otherwise(F.coalesce(second, F.lit(default)))


def request_error(prompt: Column, most: int = MAX_REQUEST) -> Column:
    """Why a request can't be sent, or null: it is empty, or longer than a request may be."""
    size = F.length(prompt)
    return F.when(F.coalesce(size, F.lit(0)) == 0, F.lit(EMPTY_REQUEST)).when(
        size > most, F.format_string(f"Error: request of %d characters is over the limit of {most}", size)
    )


def oversized_batches(df: DataFrame, key: str, prompt: str = "prompt", most: int = MAX_REQUEST) -> DataFrame:
    """Count, total and longest prompt of each batch, and whether together they are too long for a request."""
    size = F.length(F.coalesce(prompt, F.lit("")))
    out = df.groupBy(key).agg(F.count("*").alias("n_prompts"), F.sum(size).alias("total_chars"), F.max(size).alias("longest"))
    return out.withColumn("oversized", F.col("total_chars") > most)


def call_counts(df: DataFrame, key: str) -> DataFrame:
    """Calls and failures of each rollout."""
    return df.groupBy(key).agg(F.count("*").alias("calls"), F.count("error").alias("failures"))
