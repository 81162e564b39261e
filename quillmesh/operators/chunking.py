"""Reading, slicing, packing and batching of long texts.

All are projections or windows per context but ``pack_greedy`` and ``fold``, whose next step
depends on the one before: these run a context at a time on an executor, streaming through
its rows in Arrow batches, so that a context needs no more memory than a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def probe(df: DataFrame, text: str = "text", lines: int = 5) -> DataFrame:
    """Adds n_lines and head, the first lines."""
    split = F.split(text, "\n")
    return df.withColumns({"n_lines": F.size(split), "head": F.array_join(F.slice(split, 1, lines), "\n")})


def prefix(text: Column, n: int = 10_000) -> Column:
    return F.substring(text, 1, n)


def keyword_filter(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """Rows whose text matches: done before any model is asked."""
    return df.filter(F.col(text).rlike(pattern))


def chunk_fixed(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """One row per ``size`` characters: chunk_no, chunk. Empty texts have one empty chunk."""
    n = F.greatest(F.ceil(F.length(text) / size), F.lit(1)).cast("int")
    out = df.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumn("chunk", F.substring(F.col(text), F.col("chunk_no") * size + 1, F.lit(size))).drop(text)


def n_slices(df: DataFrame, key: str, order: str, n: int, text: str = "text") -> DataFrame:
    """Each context's elements in ``n`` runs of equal count, the last with the remainder, joined by line feeds.

    With fewer elements than runs, the last run has them all."""
    by_key = Window.partitionBy(key)
    at = F.row_number().over(by_key.orderBy(order)) - 1
    each = F.expr(f"count_ div {n}")
    rows = df.withColumn("at_", at).withColumn("count_", F.count("*").over(by_key)).withColumn("each_", each)
    run = F.when(F.col("each_") == 0, n - 1).otherwise(F.least(F.expr("at_ div greatest(each_, 1)"), F.lit(n - 1)))
    grouped = rows.groupBy(key, run.cast("int").alias("slice_no"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at_", text))), lambda x: x[text]), "\n")
    return grouped.agg(F.count("*").alias("n_items"), joined.alias("slice"))


def pack_window(df: DataFrame, key: str, order: str, cap: int, text: str = "text") -> DataFrame:
    """Adds pack_no by running length over ``cap``: in the optimizer's terms, but packs may overrun the cap."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum(F.length(text)).over(before), F.lit(0))
    return df.withColumn("running_", running).withColumn("pack_no", F.expr(f"cast(running_ div {cap} as int)")).drop("running_")


def pack_greedy(df: DataFrame, key: str, order: str, cap: int, text: str = "text") -> DataFrame:
    """key, order and pack_no: an element opens a new pack if it doesn't fit the current one."""
    slim = df.select(key, order, F.length(text).alias("size_")).repartition(key).sortWithinPartitions(key, order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, pack, used = object(), 0, 0
        for batch in batches:
            packs = []
            for k, size in zip(batch[key], batch["size_"].fillna(0), strict=True):
                if k != current and not (pd.isna(k) and current is None):
                    current, pack, used = (None if pd.isna(k) else k), 0, 0
                elif used and used + size > cap:
                    pack, used = pack + 1, 0
                used += size
                packs.append(pack)
            yield pd.DataFrame({key: batch[key], order: batch[order], "pack_no": packs})

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in (key, order))
    return slim.mapInPandas(run, f"{kinds}, pack_no int")


def batches(df: DataFrame, key: str, order: str, width: int = 20) -> DataFrame:
    """Adds batch_no and pos within the batch."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    return df.withColumn("at_", at).withColumns({"batch_no": F.expr(f"cast(at_ div {width} as int)"), "pos": F.col("at_") % width}).drop("at_")


def grouped_batches(df: DataFrame, key: str, order: str, width: int = 10, text: str = "text") -> DataFrame:
    """One row per batch with its texts in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", text))), lambda x: x[text])
    return batches(df, key, order, width).groupBy(key, "batch_no").agg(ordered.alias("texts"))


def fold(df: DataFrame, key: str, order: str, step: Callable[[Any, str], Any], start: Any, kind: str = "string", text: str = "text") -> DataFrame:
    """key and carried: ``step(carried, text)`` over each context's elements in order."""
    slim = df.select(key, order, text).repartition(key).sortWithinPartitions(key, order).drop(order)

    def run(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, carried, seen = None, start, False
        for piece in pieces:
            done = []
            for k, value in zip(piece[key], piece[text], strict=True):
                if seen and k != open_key:
                    done.append((open_key, carried))
                    carried = start
                open_key, seen = k, True
                carried = step(carried, value)
            if done:
                yield pd.DataFrame(done, columns=[key, "carried"])
        if seen:
            yield pd.DataFrame([(open_key, carried)], columns=[key, "carried"])

    return slim.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, carried {kind}")


def statistics(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Mean, median, least, largest and sample deviation."""
    return df.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.percentile(value, 0.5).alias("median"),
        F.min(value).alias("least"),
        F.max(value).alias("largest"),
        F.stddev_samp(value).alias("stddev"),
    )


def label_counts(df: DataFrame, label: Column, *keys: str) -> DataFrame:
    """How often each label occurs."""
    return df.groupBy(*keys, label.alias("label")).agg(F.count("*").alias("n"))
