"""Log lines as a stream: parsed as they arrive, rolled up per run, late lines bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.sources.logs import LINE, parsed


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The lines of the files that arrive in a folder, with the file and the time of each."""
    lines = (
        spark.readStream.schema(f"{LINE}, _bad string")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return parsed(lines.withColumn("file", F.input_file_name())).withColumn("at", F.to_timestamp("timestamp"))


def run_rollup(lines: DataFrame, late: str = "1 hour") -> DataFrame:
    """Iterations, blocks and time of each run and hour; hours are final once the watermark has passed them."""
    each = lines.filter(F.coalesce("type", F.lit("")) != "metadata").withWatermark("at", late)
    return each.groupBy("file", F.window("at", "1 hour").alias("hour")).agg(
        F.count("*").alias("n_iterations"),
        F.sum(F.greatest(F.size("code_blocks"), F.lit(0))).alias("n_blocks"),
        F.sum("iteration_time").alias("total_time"),
    )


def activity_sessions(events: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of activity of each key with pauses under ``gap``: for batch and streaming tables alike."""
    if events.isStreaming:
        events = events.withWatermark(at, late)
    grouped = events.groupBy(key, F.session_window(at, gap).alias("s")).agg(F.count("*").alias("n_events"))
    return grouped.select(key, F.col("s.start").alias("started"), F.col("s.end").alias("ended"), "n_events")


def write_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """A query that writes what is final as Parquet and ends when all that is there has been read."""
    return stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
