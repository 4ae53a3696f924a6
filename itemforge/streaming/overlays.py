"""Structured Streaming over event files: windows, deduplication, and an upsert for each batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.sources.shared import shared_path
from itemforge.sources.versions import Versions, merged


def events(spark: SparkSession, path: str, time: str = "ts") -> DataFrame:
    """A stream of the Parquet files at path, its time column a timestamp that can carry a watermark."""
    found = spark.read.parquet(path)
    reader = spark.readStream.schema(found.schema)
    folder, _, name = path.rstrip("/").rpartition("/")
    if any(f.rstrip("/").endswith(f"/{name}") for f in found.inputFiles()):  # the path is a file, and a stream reads folders
        reader, path = reader.option("pathGlobFilter", name), folder
    return reader.parquet(path).withColumn(time, F.col(time).cast("timestamp"))


def windowed(stream: DataFrame, width: str = "1 day", late: str = "1 day", time: str = "ts", value: str = "value") -> DataFrame:
    """Counts and sums by event-time window and event type."""
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select("w.start", "event_type", "n", "total")


def run_available(out: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what there is now and read back what it wrote. State and results stay in the shared folder, so a restart goes on where it ended."""
    spark = out.sparkSession
    path, at = shared_path(spark, "stream"), shared_path(spark, "stream-checkpoint")
    writer = out.writeStream.outputMode(mode).option("checkpointLocation", at).trigger(availableNow=True)
    if mode == "append":
        started = writer.format("parquet").option("path", path).start()
    else:
        started = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).start()
    started.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def run_upserts(stream: DataFrame, keys: Sequence[str], order: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run a stream over what there is now into a table of versions at path, a row for each key, the last by `order`, and read the table.

    Batches carry their numbers into the versions they make, so one that runs again after a crash, under the same checkpoint, changes nothing.
    """
    spark = stream.sparkSession
    table = Versions(spark, path or shared_path(spark, "upserts"))
    writer = stream.writeStream.option("checkpointLocation", checkpoint or shared_path(spark, "stream-checkpoint")).trigger(availableNow=True)
    writer.foreachBatch(merged(table, keys, order)).start().awaitTermination()
    found = table.read()
    return found if found is not None else spark.createDataFrame([], stream.drop(order).schema)
