"""Compaction of long histories: when it is due, and what the history is afterwards."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.calls import lm_map
from quillmesh.operators.usage import context_limit, message_tokens

#: Share of the limit at which compaction is due, and our own wording.
SHARE = 0.85
SUMMARISE = "Summarise the work so far: what was asked, what was found, what is left to do."
GO_ON = "The history was compacted %d time(s); its parts are in `history`. Go on from the summary above."


def status(messages: DataFrame, key: str, model: Column, share: float = SHARE, content: str = "content") -> DataFrame:
    """key, current_tokens, threshold_tokens, limit_tokens, due."""
    out = message_tokens(messages, key, content).withColumn("limit_tokens", context_limit(model))
    out = out.withColumn("threshold_tokens", F.floor(F.col("limit_tokens") * share).cast("bigint"))
    return out.withColumn("due", F.col("current_tokens") >= F.col("threshold_tokens"))


def transcript(messages: Column) -> Column:
    """A history as one text, with the question for a summary."""
    told = F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return F.concat(told, F.lit("\n\n" + SUMMARISE))


def compacted(messages: Column, summary: Column, times: Column) -> Column:
    """The first two messages, the summary, and the note to go on."""
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.concat(F.slice(messages, 1, 2), F.array(said("assistant", summary), said("user", F.format_string(GO_ON, times))))


def compact(histories: DataFrame, messages: str = "messages", times: str = "compactions", **call: Any) -> DataFrame:
    """Histories (array of role, content) summarised by a model; ``summary`` and the segment that was replaced come along."""
    asked = lm_map(histories.withColumn("prompt_", transcript(F.col(messages))), "prompt_", **call)
    count = F.col(times) + 1
    out = asked.withColumn("segment", F.col(messages)).withColumn("summary", F.col("response")).withColumn(times, count)
    out = out.withColumn(messages, compacted(F.col("segment"), F.col("summary"), F.col(times).cast("int")))
    return out.select(*histories.columns, "segment", "summary")


def history_entries(compactions: DataFrame, key: str, order: str) -> DataFrame:
    """What ``history`` holds: for each compaction its segment, then its summary."""
    kinds = F.array(F.struct(F.lit("segment").alias("kind"), F.to_json("segment").alias("content")), F.struct(F.lit("summary").alias("kind"), F.col("summary").alias("content")))
    return compactions.select(key, order, F.posexplode(kinds).alias("pos", "e")).select(key, order, "pos", "e.kind", "e.content")
