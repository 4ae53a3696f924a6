"""Variable-capacity best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemforge.llm.common import WORD, materialise, table

CAPACITIES = (256, 512, 1024, 2048)
#: What a sequence costs: a fixed part, its length, and its length's square over ATTENTION, as attention does. Without that square the longest sequence is always the cheapest, so there would be nothing to choose.
OVERHEAD, ATTENTION = 32, 16_384
#: Tokens that are packed together, on average: what one task holds.
GROUP_TOKENS = 500_000


def cost(capacity: int, attention: int | None = None) -> float:
    return OVERHEAD + capacity + (capacity * capacity / attention if attention else 0)


def _filled(room: int, alive: list[int], counts: dict[int, int]) -> int:
    """How much of a room the sizes still to be packed fill, the largest that fits first."""
    full, upto = room, len(alive)
    while room and (k := bisect_right(alive, room, 0, upto) - 1) >= 0:
        room -= alive[k] * min(counts[alive[k]], room // alive[k])
        upto = k
    return full - room


def pack(sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, attention: int | None = None) -> tuple[list[int], list[int], list[int]]:
    """Best fit in decreasing order: for each size its bin and its offset in it, and for each bin its capacity.

    A size goes to the open bin that it leaves least room in. Where none has room, each permitted length that holds it is priced by
    what it would cost for each token that it can be filled with: by the sizes that are still to come, less the room that open bins
    have for them; the cheapest is opened. So all lengths compete for the same small pieces. At the end each bin becomes the
    smallest permitted length for its contents.
    """
    capacities = sorted(capacities)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    counts = Counter(sizes)
    alive = sorted(counts)
    left, vacant = sum(sizes), 0
    of, offset = [0] * len(sizes), [0] * len(sizes)
    filled: list[int] = []
    rooms: list[int] = []  # the different rooms of open bins, in order
    open_bins: dict[int, list[int]] = {}
    for i in order:
        size = sizes[i]
        counts[size] -= 1
        if not counts[size]:
            alive.pop()  # sizes fall, so it is the largest
        left -= size
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            k = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            vacant -= size
        else:
            spare = max(0, left - vacant)
            room = min((c for c in capacities if c >= size), key=lambda c: (cost(c, attention) / (size + min(spare, _filled(c - size, alive, counts))), c))
            vacant += room - size
            k = len(filled)
            filled.append(0)
        of[i], offset[i] = k, filled[k]
        filled[k] += size
        if rest := room - size:
            if rest not in open_bins:
                open_bins[rest] = []
                insort(rooms, rest)
            open_bins[rest].append(k)
    return of, offset, [next(c for c in capacities if c >= f) for f in filled]


def pieces(docs: DataFrame, longest: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, first_token, n_tokens): each whole text as words and one end token, cut every `longest` tokens."""
    tokens = docs.select(F.col(key), (F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)) + 1).alias("n"))
    cut = tokens.select(key, "n", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / longest).cast("int"))).alias("piece"))
    first = F.col("piece") * longest
    return cut.select(key, "piece", first.alias("first_token"), F.least(F.lit(longest), F.col("n") - first).alias("n_tokens"))


def packed(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, group_tokens: int = GROUP_TOKENS, attention: int | None = ATTENTION, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, first_token, n_tokens, bin_group, bin, capacity, bin_offset): where each piece of each document stands.

    Texts are tokenised once, their pieces written as a table. These are dealt by hash into groups of about group_tokens, each packed by
    one task; at that size what groups lose against one another is below a hundredth. The hash takes in where a row was read, so rows that repeat are
    dealt over all groups. Null and empty texts have their end token alone; rows with a null key are packed as well. Further columns of docs, whatever
    their names, are not carried.
    """
    cut = materialise(pieces(docs, max(capacities), text, key).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    total = cut.agg(F.sum("n_tokens")).first()[0] or 0
    n = max(1, -(-total // group_tokens))
    dealt = cut.withColumn("bin_group", F.pmod(F.xxhash64(key, "piece", "n_tokens", "_row"), F.lit(n)).cast("int")).drop("_row")
    kind = T.StructType([*dealt.schema.fields, *(T.StructField(c, T.IntegerType()) for c in ("bin", "capacity", "bin_offset"))])
    sizes = tuple(capacities)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([key, "piece"], kind="stable")
        of, offset, final = pack(group["n_tokens"].tolist(), sizes, attention)
        return group.assign(bin=of, capacity=[final[k] for k in of], bin_offset=offset)

    return dealt.groupBy("bin_group").applyInPandas(run, kind)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands."""
    return packed(table(spark, sf_dir, "documents"))
