"""Aggregates: guards, exemplars, ordered concatenations, hashes, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def array_points(parts: Column, points: str, before: Column) -> Column:
    """Sum of an array's points, nulls as 0; an empty or null array keeps the former value."""
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x[points].cast("long"), F.lit(0)))
    return F.when(F.size(parts) > 0, total).otherwise(before)


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def one_of_each(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in an order."""
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def first_keys(rows: DataFrame, by: Sequence[str], key: str, named: str, k: int = 3) -> DataFrame:
    """(by, n, named): how many rows a group has and its first k different keys: each part of a group keeps its first k, and those meet."""
    part = F.pmod(F.xxhash64(key), F.lit(64)).alias("_part")
    some = rows.groupBy(*by, part, key).agg(F.count("*").alias("n")).withColumn("_rn", F.row_number().over(W.partitionBy(*by, "_part").orderBy(key)))
    kept = F.when(F.col("_rn") <= k, F.col(key))
    parts = some.groupBy(*by, "_part").agg(F.sum("n").alias("n"), F.collect_list(kept).alias("firsts"))
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.array_join(F.slice(F.array_sort(F.flatten(F.collect_list("firsts"))), 1, k), ",").alias(named))


def exemplars(rows: DataFrame, by: str, key: str, k: int = 3) -> DataFrame:
    """Count and first k keys of each group, of which no task ranks one whole."""
    return first_keys(rows, [by], key, "first_keys", k).select(by, "n", "first_keys")


def ordered_concat(value: str, order: Sequence[str], separator: str = ",") -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("string").alias("_v")))), lambda x: x["_v"]), separator)


def canonical_hash(rows: DataFrame, by: str, value: str, buckets: int = 64, separator: str = ",") -> DataFrame:
    """(by, digest): a digest of each group's values that doesn't depend on their order: buckets of values are sorted and hashed, then their digests.

    A task holds a bucket, so buckets bound what is sorted at once.
    """
    bucket = F.conv(F.substring(F.sha2(F.col(value).cast("string"), 256), 1, 8), 16, 10).cast("long") % buckets
    parts = rows.groupBy(by, bucket.alias("_bucket")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), separator), 256).alias("_d"))
    return parts.groupBy(by).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_bucket", "_d"))), lambda x: x["_d"]), separator), 256).alias("digest"))
