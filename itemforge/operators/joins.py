"""Joins: fallback keys, as-of, nearest, positional, differences in both directions, upsert, get-or-create."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fallback_join(left: DataFrame, right: DataFrame, candidates: Sequence[Column], right_key: str, take: Sequence[str]) -> DataFrame:
    """left with `take` from the row of right that the first matching candidate key names; null where none does.

    right must have one row for each key. Each candidate is one left join, so every side keeps its own strategy.
    """
    out, found = left, []
    for k, key in enumerate(candidates):
        side = right.select(F.col(right_key).alias(f"_key{k}"), F.struct(*take).alias(f"_row{k}"))
        out = out.withColumn(f"_try{k}", key).join(side, F.col(f"_try{k}") == F.col(f"_key{k}"), "left")
        found.append(f"_row{k}")
    row = F.coalesce(*found)
    return out.select(*left.columns, *(row[c].alias(c) for c in take))


def asof_last(rows: DataFrame, events: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """rows with the value of the last event at or before each, within `by`: one sort of the union, no theta join. Events come first on ties."""
    both = rows.withColumn("_event", F.lit(None).cast(events.schema[value].dataType)).withColumn("_row", F.lit(1))
    marks = events.select(*by, *order, F.col(value).alias("_event"), F.lit(0).alias("_row"))
    window = W.partitionBy(*by).orderBy(*order, "_row").rowsBetween(W.unboundedPreceding, 0)
    filled = both.unionByName(marks, allowMissingColumns=True).withColumn(f"last_{value}", F.last("_event", True).over(window))
    return filled.filter("_row = 1").select(*rows.columns, f"last_{value}")


def nearest_in_order(left: DataFrame, right: DataFrame, by: str, at: str, left_key: str, right_key: str, width: float = 1000.0) -> DataFrame:
    """(left_key, right_key, distance): for each left row the right row of its group whose `at` is nearest, ties to the smaller right key (a number).

    Both sides are sorted together once a direction, by group and stretches of `at` of this width; the neighbours below and above are the only
    candidates, so no pairs are made. Where a stretch has none, the last one of the stretches before or the first of those after counts: a row a stretch carries them.
    A group is as many tasks as it has stretches. Rows whose group has no right row have nulls.
    """
    rows = left.select(by, at, F.col(left_key).alias("_left"), F.lit(None).cast(right.schema[right_key].dataType).alias("_right"))
    both = rows.unionByName(right.select(by, at, F.lit(None).cast(left.schema[left_key].dataType).alias("_left"), F.col(right_key).alias("_right")))
    both = both.withColumn("_stretch", F.floor(F.col(at) / width))
    seen = F.when(F.col("_right").isNotNull(), F.struct(F.col(at).alias("at"), F.col("_right").alias("key")))
    below = F.last(seen, True).over(W.partitionBy(by, "_stretch").orderBy(at, F.desc_nulls_last("_right")).rowsBetween(W.unboundedPreceding, 0))
    above = F.first(seen, True).over(W.partitionBy(by, "_stretch").orderBy(at, F.asc_nulls_first("_right")).rowsBetween(0, W.unboundedFollowing))
    edges = both.groupBy(by, "_stretch").agg(F.max(F.when(seen.isNotNull(), F.struct(F.col(at).alias("at"), (-F.col("_right")).alias("minus")))).alias("_top"), F.min(seen).alias("_low"))
    order = W.partitionBy(by).orderBy("_stretch")
    top = F.last("_top", True).over(order.rowsBetween(W.unboundedPreceding, -1))
    edges = edges.select(by, "_stretch", F.when(top.isNotNull(), F.struct(top["at"].alias("at"), (-top["minus"]).alias("key"))).alias("_before"), F.first("_low", True).over(order.rowsBetween(1, W.unboundedFollowing)).alias("_after"))
    found = both.withColumns({"_below": below, "_above": above}).filter("_left IS NOT NULL")
    found = found.join(edges, (found[by].eqNullSafe(edges[by])) & (found["_stretch"].eqNullSafe(edges["_stretch"])), "left").select(found["*"], "_before", "_after")
    near = F.array(F.coalesce("_below", "_before"), F.coalesce("_above", "_after"))
    ranked = F.array_sort(F.filter(near, lambda x: x.isNotNull()), lambda x, y: F.when(_away(x, at) < _away(y, at), -1).when(_away(x, at) > _away(y, at), 1).when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1).otherwise(0))
    best = F.get(ranked, F.lit(0))
    return found.select(F.col("_left").alias(left_key), best["key"].alias(right_key), _away(best, at).alias("distance"))


def _away(x: Column, at: str) -> Column:
    return F.abs(F.col(at) - x["at"])


def numbered(rows: DataFrame, by: str, order: str, width: int, named: str = "k") -> DataFrame:
    """rows with their number within `by` in the order of a number: counted by stretches of this width, whose sizes are summed first, so a group is many tasks.

    Rows without a group are numbered as one; rows without an order come first, as a stretch of their own.
    """
    cut = rows.withColumn("_stretch", F.floor(F.col(order) / width))
    sizes = cut.groupBy(by, "_stretch").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(by).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(W.partitionBy(by, "_stretch").orderBy(order))
    starts = sizes.select(F.col(by).alias("_by"), F.col("_stretch").alias("_at"), before.alias("_before"))
    return cut.withColumn("_own", own).join(starts, F.col(by).eqNullSafe(F.col("_by")) & F.col("_stretch").eqNullSafe(F.col("_at"))).withColumn(named, F.col("_own") + F.col("_before")).drop("_stretch", "_before", "_own", "_by", "_at")


def positional_join(left: DataFrame, right: DataFrame, by: str, left_order: str, right_order: str, width: int) -> DataFrame:
    """The k-th left row of each group beside the k-th right row; nulls where the right group is shorter. Left rows without a group stay, beside nothing."""
    return numbered(left, by, left_order, width).join(numbered(right, by, right_order, width), [by, "k"], "left")


def differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one side has; a null key is one like others. Keys meet in one aggregation by hash, so nothing is sorted."""
    both = left.select(key, F.lit(True).alias("_left")).unionByName(right.select(key, F.lit(False).alias("_left")))
    sides = both.groupBy(key).agg(F.bool_or("_left").alias("_any"), F.bool_and("_left").alias("_all"))
    return sides.filter(F.col("_any") == F.col("_all")).select(key, F.when(F.col("_all"), "left_only").otherwise("right_only").alias("side"))


def upsert(base: DataFrame, patch: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """base with rows of patch inserted or, column by column of patch, overwritten, also by nulls; other columns of base stay.

    Of several rows of patch under one key the last by `order`, a column that isn't sent, counts; without an order such a key raises when rows are read. Keys may be null: nulls are equal here.
    """
    sent = [c for c in patch.columns if c not in keys and c != order]
    whole = F.struct(*sent, F.lit(True).alias("_sent"))
    again = F.raise_error(F.concat(F.lit("upsert: a key of the patch occurs twice: "), F.to_json(F.struct(*keys))))
    one = F.max_by(whole, order) if order else F.when(F.count("*") > 1, again).otherwise(F.first(whole))
    side = patch.groupBy(*keys).agg(one.alias("_new")).select(*(F.col(k).alias(f"_key_{k}") for k in keys), "_new")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    joined = base.withColumn("_old", F.lit(True)).join(side, same, "full_outer")
    return joined.select(*(F.when(F.col("_old"), F.col(k)).otherwise(F.col(f"_key_{k}")).alias(k) for k in keys), *(F.when(F.col("_new._sent"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in sent else F.col(c) for c in base.columns if c not in keys))


def get_or_create(dimension: DataFrame, rows: DataFrame, natural: Sequence[str], id_column: str) -> DataFrame:
    """The dimension with new natural keys appended under deterministic ids, so a rerun creates none. Nulls are values of a key like others."""
    known = dimension.select(*(F.col(c).alias(f"_known_{c}") for c in natural))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in natural))
    new = rows.select(*natural).distinct().join(known, same, "left_anti")
    return dimension.select(id_column, *natural).unionByName(new.withColumn(id_column, stable_id(*natural)).select(id_column, *natural))


def stable_id(*natural: str) -> Column:
    """An id from a natural key: a digest of its JSON, in which nulls, separators and the parts' borders show, so different keys have different ids."""
    return F.sha2(F.to_json(F.struct(*(F.col(c).alias(f"k{n}") for n, c in enumerate(natural))), {"ignoreNullFields": "false"}), 256)


def overlay_apply(base: DataFrame, patches: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """base with each field's last patch (key, field, value, ts, seq) applied; a patch to null sets null, base keys decide which rows exist."""
    last = patches.groupBy(key, "field").agg(F.max_by(F.struct("value"), F.struct("ts", "seq")).alias("last"))
    wide = last.groupBy(key).pivot("field", list(fields)).agg(F.first("last"))
    joined = base.join(wide.select(key, *(F.col(f).alias(f"_{f}") for f in fields)), key, "left")
    return joined.select(key, *(F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.value")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in base.columns if c != key))


def orphans(patches: DataFrame, base: DataFrame, key: str) -> DataFrame:
    return patches.select(key).distinct().join(base, key, "left_anti")


def last_valid(rows: DataFrame, array: str, valid: DataFrame, key: str, row_key: str) -> DataFrame:
    """For each row the last of its array's values that `valid` holds; null if none."""
    each = rows.select(row_key, F.posexplode(array).alias("pos", key)).join(valid.select(key).distinct(), key)
    found = each.groupBy(row_key).agg(F.max_by(key, "pos").alias("parent"))
    return rows.select(row_key).join(found, row_key, "left")
