"""Exact search among vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Vectors and queries of one task: they bound its memory whatever the table's size.
VECTORS, QUERIES, AT_ONCE = 20_000, 4_000, 250
#: More than what rounding to six digits, and the order in which products are added, may change.
SLACK = 2e-6


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors as rows of doubles; null ones are not a number throughout."""
    width = next((len(v) for v in vectors if v is not None), 1)
    none = np.full(width, np.nan)
    return np.array([none if v is None else v for v in vectors], dtype=np.float64).reshape(len(vectors), width)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows, added from left to right as functions.text.cosine_distance adds them."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total = total + a[:, j] * b[:, j]
    return total


def _best(asked: np.ndarray, ids: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Which rows may be among the k best of their query by the distance to six digits and the id: the best k of those whose rounding is sure, and every other that is as near."""
    scaled = np.where(np.isnan(distance), np.inf, distance) * 1e6
    with np.errstate(invalid="ignore"):
        unsure = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3
    near = np.round(scaled)
    order = np.lexsort((ids, near, unsure, asked))
    first = np.searchsorted(asked[order], asked[order])
    place = np.arange(len(order)) - first
    limit = np.full(asked.max() + 1 if len(asked) else 0, np.inf)
    at = (place == k - 1) & ~unsure[order]
    limit[asked[order][at]] = near[order][at]
    return order[np.where(unsure[order], near[order] <= limit[asked[order]] + 1, place < k)]


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    if queries.empty or rows.empty:
        return pd.DataFrame({"asked": [], "vec_id": [], "distance": []})
    v, ids = _matrix(rows["embedding"]), rows["vec_id"].to_numpy()
    unit = lambda m: m / np.sqrt(_dot(m, m))[:, None]
    out = []
    with np.errstate(invalid="ignore", divide="ignore"):
        length, units = np.sqrt(_dot(v, v)), unit(v).T
        for start in range(0, len(queries), AT_ONCE):
            part = queries.iloc[start : start + AT_ONCE]
            q = _matrix(part["q"])
            q = q if q.shape[1] == v.shape[1] else np.full((len(part), v.shape[1]), np.nan)
            rough = 1 - unit(q) @ units
            rough[np.isnan(rough)] = np.inf
            last = np.partition(rough, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
            a, b = np.nonzero(rough <= last[:, None] + SLACK)
            distance = np.concatenate([1 - _dot(v[y], q[x]) / (length[y] * np.sqrt(_dot(q[x], q[x]))) for x, y in zip(np.array_split(a, 1 + len(a) // 100_000), np.array_split(b, 1 + len(b) // 100_000), strict=True)])
            kept = _best(a, ids[b], distance, k)
            out.append(pd.DataFrame({"asked": part["asked"].to_numpy()[a[kept]], "vec_id": ids[b[kept]], "distance": distance[kept]}))
    return pd.concat(out)


def nearest(vectors: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(asked, vec_id, distance): of all vectors (vec_id, embedding) the k nearest to each asked one (asked, q) by cosine distance to six digits, ties to the smaller id, null distances last.

    Vectors and queries are dealt into blocks, and each pair of blocks is one task's product of matrices; a task sends each query's best k, with exact distances, to the last choice.
    """
    n, m = vectors.count(), asked.count()
    parts, blocks = max(1, -(-n // VECTORS)), max(1, -(-m // QUERIES))
    dealt = lambda key, own, cuts, other, copies: (F.pmod(F.xxhash64(key), F.lit(cuts)).alias(own), F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))
    rows = vectors.select(*dealt("vec_id", "part", parts, "block", blocks), "vec_id", "embedding").withColumn("block", F.col("block").cast("long"))
    queries = asked.select(*dealt("asked", "block", blocks, "part", parts), "asked", "q").withColumn("part", F.col("part").cast("long"))
    found = queries.groupBy("block", "part").cogroup(rows.groupBy("block", "part")).applyInPandas(lambda q, r: _nearest(q, r, k), "asked long, vec_id long, distance double")
    best = W.partitionBy("asked").orderBy(F.asc_nulls_last("distance"), "vec_id")
    return found.withColumn("distance", F.round("distance", 6)).withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k).drop("rn")
