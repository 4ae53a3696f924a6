"""Operators over ordered sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemforge.sources.shared import stored


def previous(value: str, by: Sequence[str], order: Sequence[str]) -> Column:
    """The last non-null value before the row."""
    return F.last(value, True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))


def following(value: Column | str, by: Sequence[str], order: Sequence[str]) -> Column:
    """The first non-null value after the row."""
    return F.first(value, True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(1, W.unboundedFollowing))


def carried(value: Column | str, by: Sequence[str], order: Sequence[str]) -> Column:
    """The last non-null value up to the row."""
    return F.last(value, True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))


def running_count(condition: Column, by: Sequence[str], order: Sequence[str]) -> Column:
    """How many rows up to this one meet a condition."""
    return F.count_if(condition).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))


def gaps(rows: DataFrame, by: str, number: str, block: int = 10_000) -> DataFrame:
    """(by, missing): the numbers between 1 and a group's largest that it lacks, laid out gap by gap in blocks, so no array is longer than a block."""
    seen = rows.filter(F.col(number) >= 1).select(by, F.col(number).cast("int").alias("_n")).distinct()
    before = F.coalesce(F.lag("_n").over(W.partitionBy(by).orderBy("_n")), F.lit(0))
    open_ = seen.withColumn("_from", before + 1).filter("_from < _n").select(by, (F.col("_n") - 1).alias("_to"), F.explode(F.sequence("_from", F.col("_n") - 1, F.lit(block))).alias("_at"))
    return open_.select(by, F.explode(F.sequence("_at", F.least(F.col("_at") + block - 1, F.col("_to")))).alias("missing"))


def renumbered(numbers: Column) -> Column:
    """An array of numbers made ascending, for short arrays: one that isn't over its predecessor becomes the predecessor plus one, with reset set. See renumbered_rows."""
    start = F.struct(F.lit(None).cast("int").alias("at"), F.array().cast("array<struct<n:int,reset:boolean>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        again = F.coalesce(x <= acc["at"], F.lit(False))
        n = F.when(again, acc["at"] + 1).otherwise(x).cast("int")
        return F.struct(n.alias("at"), F.array_append(acc["out"], F.struct(n.alias("n"), again.alias("reset"))).alias("out"))

    return F.aggregate(F.transform(numbers, lambda x: x.cast("int")), start, step, lambda acc: acc["out"])


def renumbered_rows(rows: DataFrame, number: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows with n and reset: numbers made ascending. One that isn't over its predecessor's becomes that plus one, with reset set.

    As each number is at least one over its predecessor's, it is its place plus the largest lead of any number up to it over its own place: a running maximum.
    """
    window = W.partitionBy(*by).orderBy(*order)
    placed = rows.withColumn("_pos", F.row_number().over(window))
    n = F.col("_pos") + F.max(F.col(number) - F.col("_pos")).over(window.rowsBetween(W.unboundedPreceding, 0))
    done = placed.withColumn("n", n.cast("int"))
    return done.withColumn("reset", F.coalesce(F.col(number) <= F.lag("n").over(window), F.lit(False))).drop("_pos")


def adjacent_distinct(rows: DataFrame, value: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Without rows whose value equals that of the row before."""
    before = F.lag(F.struct(value)).over(W.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_before", before).filter(F.col("_before").isNull() | ~F.col(f"_before.{value}").eqNullSafe(F.col(value))).drop("_before")


def retained(rows: DataFrame, by: Sequence[str], order: Sequence[Column], keep: int) -> DataFrame:
    return rows.withColumn("_rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("_rn") <= keep).drop("_rn")


def ranked(rows: DataFrame, order: Sequence[str], named: str = "n") -> DataFrame:
    """rows with their number in the order of columns, from 1: ranges of the order are counted first, then each is numbered by itself, so no task holds all. Rows that are equal in all of them are numbered in any order."""
    cut = stored(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy("_part").agg(F.count("*").alias("_n"))
    # A row a range.
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return cut.withColumn("_own", own).join(sizes.select("_part", before.alias("_before")), "_part").withColumn(named, (F.col("_own") + F.col("_before")).cast("long")).drop("_part", "_own", "_before")
