"""Streams over the events table, each with the same answer in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.plans.registry import query
from itemforge.streaming import overlays


@query("SELECT CAST(date_trunc('day', ts) AS VARCHAR) AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlays.run_available(overlays.windowed(overlays.events(spark, f"{sf_dir}/events.parquet")), "complete")
    return found.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = overlays.events(spark, f"{sf_dir}/events.parquet").select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])
    return overlays.run_available(stream, "append")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, merged batch by batch into a table of versions."""
    events = overlays.events(spark, f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type", "value", F.col("event_id").alias("at"))
    return overlays.run_upserts(events, ["user_id"], "at")
