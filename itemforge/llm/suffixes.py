"""Removal of repeated substrings by merging shard Burrows-Wheeler transforms.

Documents, in the order of their keys, become shards. Every window of LENGTH bytes has an anchor: of the GRAM-byte
strings in it, the one with the least hash. Windows that are equal have equal anchors, so only windows around anchors
that occur with different surroundings need comparing:

1. A run is a stretch of windows with one anchor. Runs that are byte for byte the same meet by hash, first inside a
   shard, then in ranges of the anchors' hashes; all but the first are repeated as a whole.
2. Runs that share an anchor but not their bytes go, as one Burrows-Wheeler transform for each shard and range, to a
   task that merges them: the interleave of all rows is refined by a few symbols an iteration, which gives the common prefix of
   neighbours, and intervals of rows that share LENGTH symbols are equal windows. All but the first in the order of documents are repeated.

A shard sends a string to a range once, however many of its documents hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.blobs import log_parts, pack, pack_sorted, part_bounds, unpack, unpack_sorted
from itemforge.llm.common import batch, materialise, starts_of, table, text_bytes

LENGTH = 100
GRAM = 48
SHARD_BYTES = 8_000_000
#: Windows that are hashed at once.
CHUNK = 1 << 17
#: Runs that meet in one range, about; those that a merge compares are fewer.
RANGE_RUNS = 100_000

_R = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD1342543DE82EF95)
_Q_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shards(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHARD_BYTES) -> DataFrame:
    """(shard, n_docs, n_bytes, keys, nulls, lengths, body): documents in order, packed; shard numbers follow the order too."""
    schema = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_bytes", pa.int64()), *((c, pa.binary()) for c in ("keys", "nulls", "lengths", "body"))])
    bare = docs.select(F.col(key).cast("long").alias(key), text_bytes(text).alias("_body"))
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = bare.repartitionByRange(int(parts), key).sortWithinPartitions(key, "_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, k, keys, bodies, held = TaskContext.get().partitionId(), 0, [], [], 0

        def closed() -> pa.RecordBatch:
            body = b"".join(bodies)
            return batch({"shard": [task << 32 | k], "n_docs": [len(keys)], "n_bytes": [len(body)], "keys": [pack(np.array([x or 0 for x in keys], np.int64))], "nulls": [pack(np.array([x is None for x in keys], np.uint8))], "lengths": [pack(np.array([len(b) for b in bodies], np.int64))], "body": [pa.compress(body, codec="zstd", asbytes=True)]}, schema)

        for b in batches:
            for doc, body in zip(b.column(0), b.column(1), strict=True):
                keys.append(doc.as_py())
                bodies.append(body.as_py())
                held += len(bodies[-1])
                if held >= size:
                    yield closed()
                    k, keys, bodies, held = k + 1, [], [], 0
        if keys:
            yield closed()

    return dealt.mapInArrow(run, "shard long, n_docs long, n_bytes long, keys binary, nulls binary, lengths binary, body binary")


class Shard:
    """A row of shards() unpacked, with its runs: windows first..last have the anchor at `anchor`, whose hash is `hash`."""

    def __init__(self, row: dict, length: int = LENGTH) -> None:
        n = row["n_docs"]
        self.length = length
        self.keys = [None if gone else k for k, gone in zip(unpack(row["keys"], np.int64, n).tolist(), unpack(row["nulls"], np.uint8, n).tolist(), strict=True)]
        self.edge = starts_of(unpack(row["lengths"], np.int64, n))
        size = row["n_bytes"]
        self.body = pa.decompress(row["body"], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
        self.bytes = np.frombuffer(self.body, np.uint8)
        parts = [self._runs(c, min(c + CHUNK, size - length + 1)) for c in range(0, max(0, size - length + 1), CHUNK)]
        names = ("first", "last", "anchor", "hash", "print")
        joined = {f: np.concatenate([p[f] for p in parts]) if parts else np.zeros(0, np.uint64 if f in ("hash", "print") else np.int64) for f in names}
        order = np.lexsort((joined["first"], joined["print"], joined["hash"]))
        for f in names:
            setattr(self, f, joined[f][order])
        again = np.zeros(len(order), bool)
        again[1:] = (self.hash[1:] == self.hash[:-1]) & (self.print[1:] == self.print[:-1])
        #: Runs that stand earlier in the shard, and the others.
        self.again, self.new = np.flatnonzero(again), np.flatnonzero(~again)

    def _runs(self, low: int, high: int) -> dict[str, np.ndarray]:
        reach = self.length - GRAM + 1  # anchors that a window can have
        stretch = self.bytes[low : high + self.length - 1]
        values = _VALUES[stretch]
        h = _mixed(_grams(values, GRAM))
        mask = np.uint64((1 << 21) - 1)
        least = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < reach:
            least = np.minimum(least[: len(least) - (reach - span)], least[reach - span :])
        whole = np.ones(high - low, bool)
        for end in self.edge[1:][(self.edge[1:] > low) & (self.edge[1:] < high + self.length)].tolist():
            whole[max(0, end - self.length + 1 - low) : max(0, end - low)] = False
        at = np.flatnonzero(whole)
        anchor = (least[at] & mask).astype(np.int64)
        opens = np.ones(len(at), bool)
        opens[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        first = at[opens]
        last = at[np.append(np.flatnonzero(opens)[1:] - 1, len(at) - 1)] if len(at) else at
        anchor = anchor[opens]
        up, down = _powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        size = (last - first + self.length).astype(np.uint64)
        prints = (sums[last + self.length] - sums[first]) * down[first]
        prints = _mixed(prints + size * _R + (anchor - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        # Least hashes are small numbers; mixed again they spread over all ranges.
        return {"first": first + low, "last": last + low, "anchor": anchor + low, "hash": _mixed(h[anchor]), "print": prints}


def _grams(values: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of each `size` values in a row, by doubling."""
    double, step, out, width = values, 1, None, 0
    while step <= size:
        if size & step:
            out = double if out is None else double[: len(double) - width] * np.uint64(pow(int(_R), width, 1 << 64)) + out[step:]
            width += step
            out = out[: len(values) - width + 1]
        if 2 * step <= size:
            double = double[:-step] * np.uint64(pow(int(_R), step, 1 << 64)) + double[step:]
        step *= 2
    return out


_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        for q in (_Q, _Q_INVERSE):
            p = np.full(n, q, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
        del _POWERS[:-2]
    return _POWERS[0], _POWERS[1]


NEW, AGAIN, MIXED = 0, 1, 2


def requests(sharded: DataFrame, parts: int, length: int = LENGTH) -> DataFrame:
    """(part, shard, n, hashes, prints): the different runs of each shard, by ranges of their anchors' hashes."""
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary()), ("prints", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                s = Shard(row, length)
                hashes, prints = s.hash[s.new], s.print[s.new]
                edge = part_bounds(hashes, parts)
                cut = [slice(edge[p], edge[p + 1]) for p in range(1 << parts)]
                yield batch({"part": range(len(cut)), "shard": [row["shard"]] * len(cut), "n": [len(hashes[c]) for c in cut], "hashes": [pack_sorted(hashes[c]) for c in cut], "prints": [pack(prints[c]) for c in cut]}, schema)

    return sharded.mapInArrow(run, "part int, shard long, n long, hashes binary, prints binary")


def classes(asked: DataFrame, parts: int) -> DataFrame:
    """(part, shard, n, told): for each run whether it is new, stands in an earlier shard, or shares its anchor with other runs."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard")
        sizes = rows["n"].tolist()
        h = np.concatenate([unpack_sorted(x, n) for x, n in zip(rows["hashes"], sizes, strict=True)])
        p = np.concatenate([unpack(x, np.uint64, n) for x, n in zip(rows["prints"], sizes, strict=True)])
        order = np.lexsort((p, h))  # stable, so shards stay in order
        h, p = h[order], p[order]
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (p[1:] == p[:-1])
        group = np.cumsum(np.append(True, h[1:] != h[:-1])[: len(h)]) - 1
        mixed = (np.bincount(group, weights=~same) > 1)[group] if len(h) else same
        told = np.empty(len(h), np.uint8)
        told[order] = np.where(same, AGAIN, np.where(mixed, MIXED, NEW))
        edge = starts_of(np.array(sizes, np.int64))
        return pd.DataFrame({"part": rows["part"], "shard": rows["shard"], "n": rows["n"], "told": [pack(told[edge[i] : edge[i + 1]]) for i in range(len(sizes))]})

    return asked.repartition(parts, "part").groupBy("part").applyInPandas(run, "part int, shard long, n long, told binary")


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The Burrows-Wheeler transform of strings that each end in a symbol below all bytes: symbols (bytes plus one, 0 for the end), and rows' first symbols' places.

    Rows with equal suffixes follow the order of the strings.
    """
    lengths = np.array([len(s) + 1 for s in strings], np.int64)
    edge = starts_of(lengths)
    flat = np.zeros(edge[-1] + 8, np.uint64)
    raw = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
    flat[: edge[-1]] = raw.astype(np.uint64) + np.uint64(1)
    flat[edge[1:] - 1] = 0
    end = np.repeat(edge[1:], lengths)
    n = int(edge[-1])
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = key << np.uint64(9) | flat[k : k + n]
    # What stands after a string's end must not count: cut the key there.
    left = end - np.arange(n)
    key &= ~((np.uint64(1) << (np.uint64(9) * (7 - np.minimum(left, 7)).astype(np.uint64))) - np.uint64(1))
    order = np.argsort(key, kind="stable")
    block = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
    depth = 7
    while True:
        size = np.bincount(block)
        tied = np.flatnonzero((size[block] > 1) & (left[order] > depth))
        if not len(tied):
            before = np.where(left[order] == lengths[np.searchsorted(edge, order, "right") - 1], np.uint64(0), flat[order - 1])
            return before.astype(np.uint16), order
        rows = order[tied]
        k = key[rows + depth]
        again = np.lexsort((rows, k, block[tied]))
        order[tied] = rows[again]
        change = np.zeros(n, bool)
        change[1:] = block[1:] != block[:-1]
        b, k = block[tied][again], k[again]
        parted = np.append(False, (b[1:] == b[:-1]) & (k[1:] != k[:-1]))
        change[tied[parted]] = True
        # A suffix that has ended comes before those of its block that go on.
        change[1:] |= (block[1:] == block[:-1]) & (left[order][1:] > depth) & (left[order][:-1] <= depth)
        block = np.cumsum(change)
        depth += 7


def refined(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms, each given by its symbols: the merged rows, and their common-prefix array: how many symbols each row shares with the one before it, up to `depth`.

    The rows start in the order of the transforms. An iteration deals them out by the symbols before them, in order, which takes every
    row to the one that stands so much earlier: rows sorted by k symbols become rows sorted by k + 1, or a few more. No suffix is sorted again. A place between
    two rows once parted stays parted, since as many rows begin with lesser symbols ever after, so the iteration that parts it tells the common prefix there, rounded
    down to the symbols known before. Rows that go past their string's end are ordered by what happens to follow; no window does.
    """
    symbols = np.concatenate(transforms)
    edge = starts_of(np.array([len(t) for t in transforms], np.int64))
    earlier = np.empty(len(symbols), np.int32)
    for i, part in enumerate(transforms):
        earlier[edge[i] + np.argsort(part, kind="stable")] = np.arange(edge[i], edge[i + 1], dtype=np.int32)
    # Few byte strings occur, so several symbols fit into one number of 16 bits and an iteration refines by all of them.
    steps = [(1, np.unique(symbols, return_inverse=True)[1].astype(np.uint16), earlier)]
    while 2 * steps[-1][0] <= depth and len(symbols):
        step, code, back = steps[-1]
        used, code_of = np.unique(code[back].astype(np.uint32) << np.uint32(16) | code, return_inverse=True)
        if len(used) > 1 << 16:
            break
        steps.append((2 * step, code_of.astype(np.uint16), back[back]))
    rows = np.arange(len(symbols), dtype=np.int32)
    block = np.zeros(len(symbols), np.int32)
    common = np.full(len(symbols), depth, np.int32)
    done = 0
    while done < depth:
        step, code, back = next(x for x in reversed(steps) if x[0] <= depth - done)
        now = code[rows]
        dealt = np.argsort(now, kind="stable")
        now, rows, block = now[dealt], back[rows[dealt]], block[dealt]
        parted = np.ones(len(rows), bool)
        parted[1:] = (now[1:] != now[:-1]) | (block[1:] != block[:-1])
        common[parted & (common == depth)] = done
        block = np.cumsum(parted, dtype=np.int32)
        done += step
    return rows, common


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged rows, and the number of the interval in which each lies: a repeated interval is a stretch of rows whose common prefixes reach `depth`."""
    rows, common = refined(transforms, depth)
    return rows, np.cumsum(common < depth, dtype=np.int32)


def places(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The string and the offset of each row of a transform, by walking back from every string's end at once."""
    earlier = np.empty(len(symbols), np.int64)
    earlier[np.argsort(symbols, kind="stable")] = np.arange(len(symbols))
    string, offset = np.empty(len(symbols), np.int32), np.empty(len(symbols), np.int32)
    rows, of, at = np.arange(len(lengths)), np.arange(len(lengths)), lengths.astype(np.int64).copy()
    while len(rows):
        string[rows], offset[rows] = of, at
        on = at > 0
        rows, of, at = earlier[rows[on]], of[on], at[on] - 1
    return string, offset


def _told(rows: pd.DataFrame, kind: type) -> np.ndarray:
    rows = rows.sort_values("part")
    return np.concatenate([unpack(x, kind, n) for x, n in zip(rows["told"], rows["n"].tolist(), strict=True)])


def _mixed_runs(s: Shard, told: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(range, runs in the order of the text) of the shard's runs that share their anchor with others."""
    some = s.new[told == MIXED]
    edge = part_bounds(s.hash[some], parts)
    for p in range(1 << parts):
        runs = some[edge[p] : edge[p + 1]]
        yield p, runs[np.argsort(s.first[runs], kind="stable")]


def transforms(sharded: DataFrame, told: DataFrame, parts: int, length: int = LENGTH) -> DataFrame:
    """(part, shard, n, lengths, windows, n_symbols, symbols): a transform for each shard and range of the runs to compare."""

    def run(row: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        s = Shard(row.to_dict("records")[0], length)
        out = []
        for p, runs in _mixed_runs(s, _told(answers, np.uint8), parts):
            if len(runs):
                strings = [s.body[a : b + length] for a, b in zip(s.first[runs].tolist(), s.last[runs].tolist(), strict=True)]
                symbols, _ = transform(strings)
                out.append((p, int(row["shard"].iloc[0]), len(runs), pack(np.array([len(x) for x in strings], np.int32)), pack((s.last[runs] - s.first[runs] + 1).astype(np.int32)), len(symbols), pack(symbols)))
        return pd.DataFrame(out, columns=["part", "shard", "n", "lengths", "windows", "n_symbols", "symbols"])

    return sharded.groupBy("shard").cogroup(told.groupBy("shard")).applyInPandas(run, "part int, shard long, n long, lengths binary, windows binary, n_symbols long, symbols binary")


def repeated_windows(sent: DataFrame, parts: int, length: int = LENGTH) -> DataFrame:
    """(part, shard, n, told): for each window of the runs sent whether an equal one stands earlier, a byte each in the order of the text."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard")
        held, where, base = [], [], 0
        totals = []
        for n, lengths, windows, size, symbols in zip(rows["n"], rows["lengths"], rows["windows"], rows["n_symbols"], rows["symbols"], strict=True):
            symbols, lengths, windows = unpack(symbols, np.uint16, size), unpack(lengths, np.int32, n), unpack(windows, np.int32, n).astype(np.int64)
            string, offset = places(symbols, lengths)
            first = starts_of(windows)
            # The window's place among all windows here, or -1 for rows that begin none.
            where.append(np.where(offset < windows[string], base + first[string] + offset, -1))
            held.append(symbols)
            base += int(first[-1])
            totals.append(int(first[-1]))
        merged, block = merge(held, length)
        at = np.concatenate(where)[merged]
        some = at >= 0
        at, block = at[some], block[some]
        opens = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        first = np.repeat(np.minimum.reduceat(at, opens), np.diff(np.append(opens, len(at))))
        again = np.zeros(base, np.uint8)
        again[at] = at != first
        edge = starts_of(np.array(totals, np.int64))
        return pd.DataFrame({"part": rows["part"], "shard": rows["shard"], "n": totals, "told": [pack(again[edge[i] : edge[i + 1]]) for i in range(len(totals))]})

    # As many tasks as ranges: their work is far more than their bytes.
    return sent.repartition(parts, "part").groupBy("part").applyInPandas(run, "part int, shard long, n long, told binary")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept binary, spans array<struct<start, end>>): texts without the bytes of repeated strings of `length` bytes.

    A byte goes if a string of that length over it also starts earlier: in a document with a smaller key, or earlier in the same one. Null keys
    come before all others; among rows that share a key, the lesser text comes first. Null and empty texts, and shorter ones, stay whole.
    """
    sharded = materialise(shards(docs, text, key), "shards")
    total = sharded.agg(F.sum("n_bytes")).first()[0] or 0
    parts = log_parts(2 * total // (length - GRAM + 1), RANGE_RUNS)
    told = materialise(classes(requests(sharded, parts, length), 1 << parts), "classes")
    windows = materialise(repeated_windows(transforms(sharded, told, parts, length), 1 << parts, length), "windows")
    both = told.withColumn("kind", F.lit(0)).unionByName(windows.withColumn("kind", F.lit(1)))

    def run(row: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        s = Shard(row.to_dict("records")[0], length)
        marks = np.zeros(len(s.bytes) + 1, np.int32)
        if len(s.first):
            runs = _told(answers[answers["kind"] == 0], np.uint8)
            gone = np.concatenate((s.again, s.new[runs == AGAIN]))
            np.add.at(marks, s.first[gone], 1)
            np.add.at(marks, s.last[gone] + length, -1)
            if (rows := answers[answers["kind"] == 1]).shape[0]:
                again = _told(rows, np.uint8)
                order = np.concatenate([r for _, r in _mixed_runs(s, runs, parts)])
                many = s.last[order] - s.first[order] + 1
                at = np.repeat(s.first[order] - starts_of(many)[:-1], many) + np.arange(many.sum())
                at = at[again.astype(bool)]
                np.add.at(marks, at, 1)
                np.add.at(marks, at + length, -1)
        covered = np.cumsum(marks[:-1]) > 0
        out = []
        for k, doc in enumerate(s.keys):
            low, high = int(s.edge[k]), int(s.edge[k + 1])
            c = covered[low:high]
            turn = np.flatnonzero(np.diff(np.concatenate(([0], c.view(np.int8), [0]))))
            spans = turn.reshape(-1, 2)
            kept = s.bytes[low:high][~c].tobytes() if len(turn) else s.body[low:high]
            out.append((doc, high - low, int(c.sum()), len(spans), kept, [{"start": int(a), "end": int(b)} for a, b in spans]))
        frame = pd.DataFrame(out, columns=[key, "n_bytes", "n_removed", "n_spans", "kept", "spans"])
        frame[key] = frame[key].astype("Int64")
        return frame

    kinds = f"{key} long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,end:long>>"
    return sharded.groupBy("shard").cogroup(both.groupBy("shard")).applyInPandas(run, kinds)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document once repeated strings of 100 bytes are removed."""
    found = deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
