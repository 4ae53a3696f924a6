"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in spark.checkpoint.dir; in a local folder only where that is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.gettempdir()}/itemforge-shared"
    return f"{found.rstrip('/')}/bank/{what}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, what: str) -> DataFrame:
    """rows written as a table in the shared folder and read back, for what several steps read; lineage ends there."""
    path = shared_path(rows.sparkSession, what)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
