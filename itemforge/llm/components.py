"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours under the smallest node that it knows."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hangs its smaller neighbours, and itself, under the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for every node of a link between different nodes, the smallest node that links reach from it.

    Each round is a table in the shared folder; the rounds end when one changes nothing, after a number that
    grows with the logarithm of the longest chain. Nodes that no link names are absent.
    """
    now = materialise(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v").distinct(), "links")
    before = None
    while True:
        now = materialise(_small_star(_large_star(now)), "links")
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(after) == before:
            break
        before = tuple(after)
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
