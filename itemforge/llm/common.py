"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words in every contract of this subpackage.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not found:
        found = context._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='itemforge-')}"
        context.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/itemforge/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """df, which a join then deals out and never sends whole through the driver. For tables of all documents, and for what explode or an Arrow function makes: Spark sizes that by the rows that went in, so what is many times as large counts as small."""
    return df.hint("merge")


def text_bytes(text: str = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in schema], schema=schema)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Exclusive running sum."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def evaluated(df: DataFrame, keep: list[str], **exprs: Column) -> DataFrame:
    """keep and exprs as columns that are computed once: a generator stands between, so no later expression takes them apart or repeats them."""
    return df.select(*keep, F.inline(F.array(F.struct(*(e.alias(n) for n, e in exprs.items())))))
