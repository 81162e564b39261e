"""Exact deduplication as stateful streaming with disk-backed state.

Arrivals stream through a keyed state that never expires: for every digest it
retains how often the digest came, the stable id that stays (the largest) and the
locator of that row's content (file and position). The state lives in RocksDB, on
the executors' disks, with checkpoints in the shared folder; a lost executor's
part is restored from there. Digests that were hit more than once are then checked
on full bytes: rows of one digest that aren't all identical are told apart by text.

Scale: what streams is slim (digest, id, locator); texts are never shuffled, except
those that were hit. The state update is an aggregation with partial sums, so a
text that makes up a third of all rows costs each map task one row. The byte check
is a min and max of the text by digest, partial as well. The table of hits is
broadcast only while it is small; beyond that joins shuffle and split skewed keys.

Defined results: a null text counts as empty, and all empty texts are equal; among
equal texts the largest doc_id stays (null only if there is no other), and of
rows that repeat that id the last by locator; other columns pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm import _text

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def locator(docs: DataFrame) -> str:
    """The column that holds the row locator of the located docs."""
    return scratch.free_name("__qm_row", docs)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def stream_state(arrivals: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """Streams a written table of (digest, doc_id, row) through the keyed state, as many files at a time as told (all
    at once if None); returns digest, n and keep (doc_id, row) of the digests that came more than once."""
    spark, path = arrivals.sparkSession, arrivals.inputFiles()
    empty = arrivals.select("digest", F.lit(0).cast("long").alias("n"), F.struct("doc_id", "row").alias("keep")).limit(0)
    if not path:
        return empty
    folder = path[0].rsplit("/", 1)[0]
    updates, batches = scratch.new_path(spark, "dedup-updates"), []
    source = spark.readStream.schema(arrivals.schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    state = (
        source.parquet(folder)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
    )

    def write(batch: DataFrame, number: int) -> None:  # replaced if the batch is run again
        batch.filter("n > 1").write.mode("overwrite").parquet(f"{updates}/{number}")
        batches.append(f"{updates}/{number}")

    with scratch.conf(spark, ROCKSDB):
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", scratch.new_path(spark, "dedup-state"))
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    if not batches:
        return empty
    # the count only grows, so a digest's latest state is its largest
    hits = spark.read.schema(empty.schema).parquet(*dict.fromkeys(batches))
    return hits.groupBy("digest").agg(F.max(F.struct("n", "keep")).alias("s")).select("digest", "s.n", "s.keep")


def _hit_texts(docs: DataFrame, hits: DataFrame, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    whole = _text.whole(F.col(text))
    return docs.select(digest(whole).alias("digest"), whole.alias("text"), "doc_id", "row").join(hits.select("digest"), "digest", "left_semi")


def exact_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(located docs, verdicts): the verdicts have row, doc_id, digest, keep_id, group_size, kept for every row; the
    docs carry the same locator in the column that ``locator`` names."""
    place = locator(docs)
    located = scratch.with_row_locator(docs, place)
    norm = normalise or (lambda c: c)
    slim = located.select(F.col(doc_id).alias("doc_id"), F.col(place).alias("row"), norm(_text.whole(F.col(text))).alias("text"))
    arrivals = scratch.table(slim.select("doc_id", "row", digest(F.col("text")).alias("digest")), "dedup-arrivals")
    hits = scratch.table(stream_state(arrivals, files_per_batch), "dedup-hits")
    small = scratch.bounded(hits)

    texts = _hit_texts(slim, small, "text", digest)
    checked = texts.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most"))
    unequal = scratch.table(checked.filter("least <> most").select("digest"), "dedup-unequal")
    verdicts = arrivals.join(small, "digest", "left")
    if unequal.limit(1).count():  # one digest, several texts: these are grouped by their bytes
        rows = _hit_texts(slim, scratch.bounded(unequal), "text", digest)
        groups = rows.groupBy("digest", "text").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
        again = rows.join(groups, ["digest", "text"]).drop("text").select(verdicts.columns)
        verdicts = verdicts.join(scratch.bounded(unequal), "digest", "left_anti").unionByName(again)
    verdicts = verdicts.select(
        "row",
        "doc_id",
        "digest",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("keep.row") == F.col("row"))).alias("kept"),
    )
    return located, verdicts


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kind) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    columns = docs.columns
    located, verdicts = exact_dedup(docs, doc_id, text, **kind)
    off = scratch.free_name("__qm_gone", docs)
    gone = scratch.table(verdicts.filter("not kept").select(F.col("row").alias(off)), "dedup-gone")
    stay = located.join(scratch.bounded(gone), F.col(locator(docs)) == F.col(off), "left_anti")
    return stay.select(*[F.col(f"`{c}`") for c in columns])
