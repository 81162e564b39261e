"""Intermediate tables in the folder that the driver and all executors share.

A written table cuts lineage: when an executor is lost, later stages reread
files instead of recomputing, and nothing lives on one machine only.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of row content up to which a table may be broadcast; beyond either, joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20

_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only where it is unset, one of our own."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    own = sc.getCheckpointDir()
    if own:
        return own.rstrip("/")
    if sc.master.split("[")[0] == "local":
        own = "file://" + tempfile.mkdtemp(prefix="quillmesh-")
    else:  # the warehouse is shared on any cluster
        own = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_quillmesh"
    sc.setCheckpointDir(own)
    return (sc.getCheckpointDir() or own).rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/quillmesh/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def free(*tables: DataFrame | None) -> None:
    """Deletes tables that ``table`` made and nothing reads any more: all that was derived from them has been written."""
    for df in tables:
        path = getattr(df, "scratch_path", None) if df is not None else None
        made = _made.get(df.sparkSession.sparkContext.applicationId, []) if path else []
        if path in made:
            made.remove(path)
            delete(df.sparkSession, path)


@contextmanager
def conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings with ``values`` for what is run inside, and as they were afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Deletes every intermediate table of this application; results that still read them can no longer run."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        delete(spark, path)


def _width(kind: T.DataType, c: Column) -> Column:
    """Bytes that a value takes in a row, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, T.StructType):
        return reduce(add, [_width(f.dataType, c.getField(f.name)) for f in kind.fields], F.lit(8))
    if isinstance(kind, T.ArrayType):
        each = 8 if isinstance(kind.elementType, T.NumericType) else 64
        return F.coalesce(F.size(c), F.lit(0)) * each + 16
    return F.lit(8)


def bounded(df: DataFrame, rows: int | None = None, size: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows of ``size`` bytes together, else unchanged (the join
    then shuffles).

    ``df`` should be a written table: it is counted and measured here.
    """
    rows = BROADCAST_ROWS if rows is None else rows
    size = BROADCAST_BYTES if size is None else size
    width = reduce(add, [_width(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields], F.lit(16))
    n, held = df.limit(rows + 1).agg(F.count("*"), F.sum(width.cast("long"))).first()
    return F.broadcast(df) if n <= rows and (held or 0) <= size else df


def free_name(base: str, *frames: DataFrame) -> str:
    """``base``, lengthened until no column of ``frames`` has that name in any case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_row_locator(df: DataFrame, name: str = "__qm_row") -> DataFrame:
    """Adds the place of each row in its file, ``struct(file, pos)``: an identity that repeated ids can't blur.

    ``name`` must be free (``free_name`` finds one). A frame that isn't a plain file scan is written to the shared
    folder first.
    """
    try:
        return _located(df, name)
    except AnalysisException:
        return _located(table(df, "rows"), name)


def _located(df: DataFrame, name: str) -> DataFrame:
    of = df.metadataColumn("_metadata")  # whatever columns of that name the table has itself
    located = df.select("*", F.struct(of.getField("file_path").alias("file"), of.getField("row_index").alias("pos")).alias(name))
    located.schema  # noqa: B018  resolved here
    return located
