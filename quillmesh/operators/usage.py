"""Usage, costs, context limits and redaction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The limit of an unknown model, characters that count as a token, and the limits by model name.
DEFAULT_LIMIT = 128_000
CHARS_PER_TOKEN = 4
CONTEXT_LIMITS = {
    "gpt-5-nano": 272_000,
    "gpt-5": 272_000,
    "gpt-4o-mini": 128_000,
    "gpt-4o-2024": 128_000,
    "gpt-4o": 128_000,
    "gpt-4-turbo-preview": 128_000,
    "gpt-4-turbo": 128_000,
    "gpt-4-32k": 32_768,
    "gpt-4": 8_192,
    "gpt-3.5-turbo-16k": 16_385,
    "gpt-3.5-turbo": 16_385,
    "o1-mini": 128_000,
    "o1-preview": 128_000,
    "o1": 200_000,
    "claude-3-5-sonnet": 200_000,
    "claude-3-5-haiku": 200_000,
    "claude-3-opus": 200_000,
    "claude-3-sonnet": 200_000,
    "claude-3-haiku": 200_000,
    "claude-2.1": 200_000,
    "claude-2": 100_000,
    "gemini-2.5-flash": 1_000_000,
    "gemini-2.5-pro": 1_000_000,
    "gemini-2.0-flash": 1_000_000,
    "gemini-1.5-pro": 1_000_000,
    "gemini-1.5-flash": 1_000_000,
    "gemini-1.0-pro": 30_720,
    "qwen3-max": 256_000,
    "qwen3-72b": 128_000,
    "qwen3-32b": 128_000,
    "qwen3-8b": 32_768,
    "qwen3": 128_000,
    "kimi-k2.5": 262_000,
    "kimi-k2-0905": 256_000,
    "kimi-k2-thinking": 256_000,
    "kimi-k2": 128_000,
    "kimi": 128_000,
    "glm-4.6": 200_000,
    "glm-4-9b": 1_000_000,
    "glm-4": 128_000,
    "glm": 128_000,
}


def totals(calls: DataFrame, *keys: str, input_tokens: str = "input_tokens", output_tokens: str = "output_tokens", cost: str = "cost") -> DataFrame:
    """Sums; total_cost is null if no call has a cost."""
    return calls.groupBy(*keys).agg(
        F.count("*").alias("total_calls"),
        F.sum(input_tokens).alias("total_input_tokens"),
        F.sum(output_tokens).alias("total_output_tokens"),
        F.sum(cost).alias("total_cost"),
    )


def by_model(calls: DataFrame, *keys: str, model: str = "model", **columns: str) -> DataFrame:
    """Sums per model; a cost of nothing is reported as unknown. Equal names add up, whichever client they came from."""
    return totals(calls, *keys, model, **columns).withColumn("total_cost", F.nullif("total_cost", F.lit(0)))


def usage_map(rollup: DataFrame, *keys: str, model: str = "model") -> DataFrame:
    """The per-model sums as one map a key."""
    fields = F.struct("total_calls", "total_input_tokens", "total_output_tokens", "total_cost")
    entries = F.array_sort(F.collect_list(F.struct(F.col(model).alias("key"), fields.alias("value"))))
    return rollup.groupBy(*keys).agg(F.map_from_entries(entries).alias("usage"))


def map_totals(usage: Column) -> dict[str, Column]:
    """Totals of a usage map; the cost is null if every model's is."""
    values = F.map_values(usage)
    add = lambda field: F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + v[field])
    known = F.filter(F.transform(values, lambda v: v["total_cost"]), lambda c: c.isNotNull())
    cost = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, c: a + c))
    return {"total_input_tokens": add("total_input_tokens"), "total_output_tokens": add("total_output_tokens"), "total_cost": cost}


def last_usage(calls: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """The usage of each key's most recent call."""
    return calls.groupBy(key).agg(F.max(F.struct(order, *columns)).alias("l")).select(key, *[F.col(f"l.{c}").alias(c) for c in columns])


def call_cost(cost: Column, extra_cost: Column, upstream_cost: Column) -> Column:
    """The first that is above zero."""
    positive = lambda c: F.when(c > 0, c)
    return F.coalesce(positive(cost), positive(extra_cost), positive(upstream_cost))


def estimated_tokens(chars: Column) -> Column:
    """Characters over 4, rounded up."""
    return F.floor((chars + (CHARS_PER_TOKEN - 1)) / CHARS_PER_TOKEN).cast("bigint")


def message_tokens(messages: DataFrame, key: str, content: str = "content") -> DataFrame:
    """current_tokens of each history, estimated."""
    return messages.groupBy(key).agg(estimated_tokens(F.sum(F.length(F.coalesce(content, F.lit(""))))).alias("current_tokens"))


def context_limit(model: Column, limits: Mapping[str, int] = CONTEXT_LIMITS) -> Column:
    """The limit of the longest key that the model's name holds (an equal name is its own longest), else the default.

    A table of at most some hundred keys, so it is part of the expression."""
    entries = F.array(*[F.struct(F.lit(len(k)).alias("n"), F.lit(v).alias("limit"), F.lit(k).alias("key")) for k, v in limits.items()])
    best = F.array_max(F.filter(entries, lambda e: F.contains(model, e["key"])))
    return F.coalesce(best["limit"], F.lit(DEFAULT_LIMIT))


def redacted(settings: Column) -> Column:
    """A map without the keys that name an API key."""
    return F.map_filter(settings, lambda k, v: ~(F.contains(F.lower(k), F.lit("api")) & F.contains(F.lower(k), F.lit("key"))))
