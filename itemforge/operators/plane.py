"""Nearest boxes on a page, by a grid whose rings are searched from the inside out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemforge.sources.shared import stored

#: Boxes in a cell of the grid, about.
IN_CELL = 4


def _centre(box: str) -> tuple[Column, Column]:
    b = F.col(box)
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


def _distance(a: str, b: str) -> Column:
    """The sum of squared differences of two boxes' four numbers."""
    return sum(((F.col(a)[k] - F.col(b)[k]) * (F.col(a)[k] - F.col(b)[k]) for k in range(1, 4)), (F.col(a)[0] - F.col(b)[0]) * (F.col(a)[0] - F.col(b)[0]))


def nearest(left: DataFrame, right: DataFrame, by: Sequence[str], left_key: str, right_key: str) -> DataFrame:
    """(left_key, right_key, distance): for each left box the nearest right one with the same `by`, of several the smallest key; left boxes without any are absent.

    Both have `by`, their key and box, four numbers. A box lies in the cell of its centre. The distance is at least twice the squared distance of centres, so
    once a candidate is no farther than that to the border of the rings searched, no cell outside can do better. Each round doubles the rings for boxes still open, and
    joins their new cells with occupied ones, so a round's rows are bounded by cells, not by pairs.
    """
    by = list(by)
    x, y = _centre("box")
    spread = right.agg(F.count("*").alias("n"), F.min(x), F.max(x), F.min(y), F.max(y)).first()
    keys = left.select(F.col(left_key).alias("l"), *by, F.col("box").alias("lbox"))
    if not spread["n"]:
        return keys.select(F.col("l").alias(left_key), F.lit(None).cast(right.schema[right_key].dataType).alias(right_key), F.lit(None).cast("double").alias("distance")).limit(0)
    groups = right.select(*by).distinct().count()
    width, height = max(spread[2] - spread[1], 1.0), max(spread[4] - spread[3], 1.0)
    cell = max((width * height * IN_CELL * groups / spread["n"]) ** 0.5, 1e-9)
    at = lambda v: F.floor(v / cell)
    grid = stored(right.select(*by, F.col(right_key).alias("r"), F.col("box").alias("rbox"), at(x).alias("cx"), at(y).alias("cy")), "grid")
    # Beyond these no box lies, whatever the group.
    low_x, high_x, low_y, high_y = (int(v // cell) for v in spread[1:5])
    lx, ly = _centre("lbox")
    still = stored(keys.join(grid.select(*by).distinct(), by, "left_semi").withColumns({"lx": at(lx), "ly": at(ly), "best": F.lit(None).cast(f"struct<distance:double,r:{right.schema[right_key].dataType.simpleString()}>")}), "open")
    done, inner, outer = [], -1, 1
    while not still.isEmpty():
        span = lambda low, high, c: F.sequence(F.greatest(F.lit(low), F.col(c) - outer), F.least(F.lit(high), F.col(c) + outer))  # noqa: E731, B023
        reach = lambda low, high, c: (F.col(c) + outer >= low) & (F.col(c) - outer <= high)  # noqa: E731, B023
        rings = still.filter(reach(low_x, high_x, "lx") & reach(low_y, high_y, "ly")).select("l", *by, "lbox", "lx", "ly", F.explode(span(low_x, high_x, "lx")).alias("cx")).select("*", F.explode(span(low_y, high_y, "ly")).alias("cy"))
        fresh = rings.filter(F.greatest(F.abs(F.col("cx") - F.col("lx")), F.abs(F.col("cy") - F.col("ly"))) > inner)
        met = fresh.join(grid, [*by, "cx", "cy"]).groupBy("l").agg(F.min(F.struct(_distance("lbox", "rbox").cast("double").alias("distance"), "r")).alias("met"))
        now = stored(still.join(met, "l", "left").withColumn("best", F.least("best", "met")).drop("met"), "open")
        covered = (F.col("lx") - outer <= low_x) & (F.col("lx") + outer >= high_x) & (F.col("ly") - outer <= low_y) & (F.col("ly") + outer >= high_y)
        sure = covered | F.coalesce(F.col("best.distance") < 2 * (outer * cell) ** 2, F.lit(False))
        done.append(now.filter(sure))
        still = now.filter(~sure)
        inner, outer = outer, 2 * outer
    found = done[0] if done else still
    for d in done[1:]:
        found = found.union(d)
    return found.filter("best IS NOT NULL").select(F.col("l").alias(left_key), F.col("best.r").alias(right_key), F.col("best.distance").alias("distance"))


def nearest_boxes(left: DataFrame, right: DataFrame, left_key: str, right_key: str, page: str = "page", kind: str = "kind") -> DataFrame:
    """(left_key, right_key, distance): for each left box the nearest of its own kind on its page, of any kind where the page has none of it, else nulls.

    Rows without a page, or whose box isn't four numbers, match nothing; left ones stay with nulls. A null kind is a kind of its own.
    """
    whole = lambda rows: rows.withColumn(kind, F.coalesce(kind, F.lit("\u0000"))).filter(F.col(page).isNotNull() & (F.size("box") == 4) & F.forall("box", lambda v: v.isNotNull()))
    a, b = whole(left), whole(right)
    same = nearest(a, b, [page, kind], left_key, right_key)
    rest = a.join(b.select(page, kind).distinct(), [page, kind], "left_anti")
    return left.select(left_key).join(same.union(nearest(rest, b, [page], left_key, right_key)), left_key, "left")
