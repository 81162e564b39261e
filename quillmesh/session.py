"""Session defaults; every one of them can be overridden by the caller's own configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", app_name: str = "quillmesh", **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` entries use ``__`` for dots and win over them."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in (DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
