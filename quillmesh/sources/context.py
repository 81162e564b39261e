"""Contexts as tables: one row an element, ``(ctx_id, ctx_index, pos, key, kind, text)``.

A payload is text, a list of texts, a list of messages or a mapping. Contexts and
histories are versioned by an index; index 0 is the one that is meant without a version.
"""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

CONTEXT = "ctx_id bigint, ctx_index int, pos bigint, key string, kind string, text string"


def payload_rows(payload: Any) -> list[tuple[int, str | None, str, str]]:
    """(pos, key, kind, text) of a payload's elements; texts have the lengths that its description counts."""
    if isinstance(payload, str):
        return [(0, None, "str", payload)]
    if isinstance(payload, dict):
        return [(k, str(key), "dict", v if isinstance(v, str) else _written(v)) for k, (key, v) in enumerate(payload.items())]
    if not isinstance(payload, list):
        raise ValueError(f"a context is text, a list or a mapping, not {type(payload).__name__}")
    if payload and isinstance(payload[0], dict):
        if "content" in payload[0]:
            return [(k, None, "list", str(m.get("content", ""))) for k, m in enumerate(payload)]
        return [(k, None, "list", json.dumps(m)) for k, m in enumerate(payload)]
    if not all(isinstance(x, str) for x in payload):
        raise TypeError("elements of a list must be texts or mappings")
    return [(k, None, "list", x) for k, x in enumerate(payload)]


def _written(value: Any) -> str:
    try:
        return json.dumps(value, default=str)
    except (TypeError, ValueError):
        return repr(value)


def load_payload(spark: SparkSession, payload: Any, ctx_id: int = 0, ctx_index: int = 0) -> DataFrame:
    return spark.createDataFrame([(ctx_id, ctx_index, *row) for row in payload_rows(payload)], CONTEXT)


def next_index(versions: DataFrame, id_col: str, index_col: str) -> DataFrame:
    """The index that the next version of each id gets: one more than its largest, whatever gaps there are."""
    return versions.groupBy(id_col).agg((F.max(index_col) + 1).cast("int").alias("next_index"))


def add_context(existing: DataFrame, added: DataFrame, index: int | None = None) -> DataFrame:
    """``existing`` with the rows of ``added`` (without ctx_index) as each id's next version, or as the one told."""
    if index is not None:
        return existing.unionByName(added.withColumn("ctx_index", F.lit(index)).select(existing.columns))
    coming = next_index(existing, "ctx_id", "ctx_index")
    placed = added.join(coming, "ctx_id", "left").withColumn("ctx_index", F.coalesce("next_index", F.lit(0)))
    return existing.unionByName(placed.select(existing.columns))


def add_history(existing: DataFrame, messages: DataFrame, index: int | None = None) -> DataFrame:
    """As ``add_context`` for (session_id, history_index, pos, role, content)."""
    if index is not None:
        return existing.unionByName(messages.withColumn("history_index", F.lit(index)).select(existing.columns))
    coming = next_index(existing, "session_id", "history_index")
    placed = messages.join(coming, "session_id", "left").withColumn("history_index", F.coalesce("next_index", F.lit(0)))
    return existing.unionByName(placed.select(existing.columns))


def unversioned(versions: DataFrame, index_col: str = "ctx_index") -> DataFrame:
    """What the name without a version means."""
    return versions.filter(F.col(index_col) == 0)


def versions_by(df: DataFrame, id_col: str, order_col: str, name: str = "ctx_index") -> DataFrame:
    """Numbers the rows of each id as its versions."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(id_col).orderBy(order_col)) - 1)


def metadata(elements: DataFrame, id_col: str = "ctx_id") -> DataFrame:
    """context_type, context_lengths in order and context_total_length of each context; an empty list counts [0]."""
    size = F.length(F.coalesce("text", F.lit("")))
    return elements.groupBy(id_col).agg(
        F.min("kind").alias("context_type"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", size.alias("n")))), lambda x: x["n"]).alias("context_lengths"),
        F.sum(size).cast("bigint").alias("context_total_length"),
    )


@F.pandas_udf(LongType())
def json_length(value: pd.Series) -> pd.Series:
    """Length of a JSON text once written as Python writes it, with its separators and escapes."""
    return value.map(lambda v: len(json.dumps(json.loads(v))) if v is not None else 0).astype("int64")


def repl_contents(messages: Column) -> Column:
    """A message list as the contents that code sees."""
    return F.transform(messages, lambda m: F.coalesce(m["content"], F.lit("")))


def dataset_rows(
    df: DataFrame,
    name: Column,
    length: Column,
    names: list[str],
    least: int,
    most: int,
    numeric: Column | None = None,
    with_numeric: bool = True,
) -> DataFrame:
    """Rows of the named datasets whose context has a length within both bounds; numeric answers on request only."""
    kept = df.filter(name.isin(names) & length.between(least, most))
    return kept if with_numeric or numeric is None else kept.filter(~numeric)


def shuffled(df: DataFrame, key: Column, seed: int, rows: int | None = None) -> DataFrame:
    """A repeatable shuffle; with ``rows``, its first rows (a sampling operator)."""
    out = df.orderBy(F.xxhash64(key, F.lit(seed)), key)
    return out.limit(rows) if rows else out


def qa_rows(df: DataFrame, question: Column, answer: Column, info: list[Column]) -> DataFrame:
    """example_id, prompt as messages, answer, and the rest as JSON in ``info``."""
    return df.select(
        F.monotonically_increasing_id().alias("example_id"),
        F.array(F.struct(F.lit("user").alias("role"), question.alias("content"))).alias("prompt"),
        answer.alias("answer"),
        F.to_json(F.struct(*info)).alias("info"),
    )
