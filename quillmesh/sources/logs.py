"""Trajectory logs: JSON lines with one metadata line a run and one line an iteration."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The fields of a line. A call's own trajectory stays JSON text, as it may nest without end.
USAGE = "struct<total_calls:bigint,total_input_tokens:bigint,total_output_tokens:bigint,total_cost:double>"
CALL = (
    f"struct<root_model:string,prompt:string,response:string,usage_summary:struct<model_usage_summaries:map<string,{USAGE}>,"
    "total_cost:double>,execution_time:double,metadata:string,error:string>"
)
BLOCK = (
    f"struct<code:string,result:struct<stdout:string,stderr:string,locals:map<string,string>,execution_time:double,"
    f"rlm_calls:array<{CALL}>,final_answer:string>>"
)
METADATA = (
    "root_model string, max_depth int, max_iterations int, backend string, backend_kwargs map<string,string>, "
    "environment_type string, environment_kwargs map<string,string>, other_backends array<string>"
)
ITERATION = (
    "iteration int, prompt array<struct<role:string,content:string>>, response string, "
    f"code_blocks array<{BLOCK}>, final_answer string, iteration_time double"
)
LINE = f"type string, timestamp string, {METADATA}, {ITERATION}"
METADATA_COLUMNS = [c.split()[0] for c in METADATA.split(", ")]
ITERATION_COLUMNS = ["iteration", "prompt", "response", "code_blocks", "final_answer", "iteration_time"]


def log_name(name: str) -> str:
    return f"{name}_{datetime.now():%Y-%m-%d_%H-%M-%S}_{uuid.uuid4().hex[:8]}.jsonl"


def write_log(lines: DataFrame, path: str) -> None:
    """Appends lines; nulls are left out of them."""
    lines.write.mode("append").option("ignoreNullFields", "true").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The lines that parse, each with the file it is in."""
    lines = spark.read.schema(f"{LINE}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return parsed(lines.withColumn("file", F.input_file_name()))


def parsed(lines: DataFrame) -> DataFrame:
    blank = F.to_json(F.struct(*[c for c in lines.columns if c not in ("_bad", "file")])) == "{}"
    return lines.filter(F.col("_bad").isNull() & ~blank).drop("_bad")


def run_metadata(lines: DataFrame, run: str = "file") -> DataFrame:
    """Each run's first metadata line; later ones are ignored."""
    first = F.row_number().over(Window.partitionBy(run).orderBy("timestamp"))
    return lines.filter("type = 'metadata'").withColumn("n_", first).filter("n_ = 1").select(run, *METADATA_COLUMNS)


def iterations(lines: DataFrame, run: str = "file") -> DataFrame:
    """Every line that isn't metadata, with the number of the completion: the iteration counter starts anew with each."""
    rest = lines.filter(F.coalesce("type", F.lit("")) != "metadata")
    starts = F.sum(F.when(F.col("iteration") == 1, 1).otherwise(0)).over(Window.partitionBy(run).orderBy("timestamp", "iteration"))
    return rest.withColumn("completion_no", starts).select(run, "completion_no", "timestamp", *ITERATION_COLUMNS)


def trajectories(lines: DataFrame, run: str = "file") -> DataFrame:
    """One row a run: its metadata (null fields if it has none) and its iterations in order."""
    each = iterations(lines, run)
    item = F.struct("completion_no", *ITERATION_COLUMNS)
    place = lambda x: F.struct(x["completion_no"], x["iteration"])
    order = lambda x, y: F.when(place(x) < place(y), -1).when(place(x) > place(y), 1).otherwise(0)
    gathered = each.groupBy(run).agg(F.array_sort(F.collect_list(item), order).alias("i"))
    told = run_metadata(lines, run)
    joined = gathered.join(told, run, "full")
    return joined.select(run, *METADATA_COLUMNS, F.coalesce("i", F.array().cast(gathered.schema["i"].dataType)).alias("iterations"))
