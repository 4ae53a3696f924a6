"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of bigrams and unigrams with a uniform one. The weights depend on a
bucket of the context's frequency and are learned by expectation-maximisation on a slice of the training documents,
whose counts are deleted from the estimates meanwhile.

Documents become shards of about SHARD_TOKENS tokens. A shard asks for the corpus counts of its different words and
bigrams; the requests meet by ranges of a hash, so a frequent word costs one number for each shard, and the answers
go back to the shard that scores its own documents. No task holds more than a shard or a range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.blobs import log_parts, pack, pack_sorted, part_bounds, unpack, unpack_sorted
from itemforge.llm.common import batch, materialise, starts_of, table, text_bytes

SHARD_TOKENS = 2_000_000
#: Requests that meet in one task, about.
RANGE_KEYS = 1_000_000
FOLDS = 10
BUCKETS = 24
EM_ROUNDS = 60
#: Steps of the EM histogram in an octave of probability.
STEPS = 8
LEAST_UNIFORM = 1e-6
END = xxhash.xxh64_intdigest(b"end", 99)
START = xxhash.xxh64_intdigest(b"start", 99)
UNIGRAM, BIGRAM = 0, 1


def fold(key: int | None) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode())


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def shards(docs: DataFrame, text: str = "text", key: str = "doc_id", tokens: int = SHARD_TOKENS) -> DataFrame:
    """(shard, n_docs, n_tokens, n_words, keys, nulls, lengths, ids, hashes): documents as packed token numbers and the hashes of their words."""
    schema = pa.schema([("shard", pa.int64()), *((c, pa.int64()) for c in ("n_docs", "n_tokens", "n_words")), *((c, pa.binary()) for c in ("keys", "nulls", "lengths", "ids", "hashes"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, k = TaskContext.get().partitionId(), 0

        def closed() -> pa.RecordBatch:
            hashes = np.array([END, *(xxhash.xxh64_intdigest(w) for w in words if w is not None)], np.uint64)
            flat = np.concatenate(parts)
            return batch({"shard": [task << 32 | k], "n_docs": [len(keys)], "n_tokens": [len(flat)], "n_words": [len(hashes)], "keys": [pack(np.array([x or 0 for x in keys], np.int64))], "nulls": [pack(np.array([x is None for x in keys], np.uint8))], "lengths": [pack(np.array([len(p) for p in parts], np.int32))], "ids": [pack(flat)], "hashes": [pack(hashes)]}, schema)

        words, keys, parts, held = _Ids({None: 0}), [], [], 0
        for b in batches:
            for doc, body in zip(b.column(0), b.column(1), strict=True):
                split = body.as_py().lower().split()
                row = np.zeros(len(split) + 1, np.uint32)
                row[:-1] = [words[w] for w in split]
                keys.append(doc.as_py())
                parts.append(row)
                held += len(row)
                if held >= tokens:
                    yield closed()
                    words, keys, parts, held, k = _Ids({None: 0}), [], [], 0, k + 1
        if keys:
            yield closed()

    kinds = "shard long, n_docs long, n_tokens long, n_words long, keys binary, nulls binary, lengths binary, ids binary, hashes binary"
    return docs.select(F.col(key).cast("long").alias(key), text_bytes(text)).mapInArrow(run, kinds)


class Shard:
    """A row of shards() unpacked: token numbers, the numbers of the words before them, and the hashes of both."""

    def __init__(self, row: dict) -> None:
        n = row["n_docs"]
        self.keys = [None if gone else k for k, gone in zip(unpack(row["keys"], np.int64, n).tolist(), unpack(row["nulls"], np.uint8, n).tolist(), strict=True)]
        self.lengths = unpack(row["lengths"], np.int32, n).astype(np.int64)
        self.ids = unpack(row["ids"], np.uint32, row["n_tokens"]).astype(np.int64)
        self.hashes = unpack(row["hashes"], np.uint64, row["n_words"])
        self.starts = starts_of(self.lengths)
        folds = np.array([fold(k) for k in self.keys], np.int64)
        self.held_out = folds % FOLDS == 0
        self.deleted = ~self.held_out & (folds // FOLDS % FOLDS == 0)
        # A text's first word follows the end of another: the start's count is the number of texts, as is the end's.
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        self.before[self.starts[:-1]] = 0

    def bigrams(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        a, b = self.hashes[self.before[at]], self.hashes[self.ids[at]]
        h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + (a >> np.uint64(29)))
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def tokens_of(self, docs: np.ndarray) -> np.ndarray:
        return np.repeat(docs, self.lengths)


def _counted(row: dict) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, ascending keys, training counts, counts in the deleted slice) of a shard."""
    s = Shard(row)
    train, deleted = s.tokens_of(~s.held_out), s.tokens_of(s.deleted)
    order = np.argsort(s.hashes)
    uni = [np.bincount(s.ids[m], minlength=len(s.hashes))[order] for m in (train, deleted)]
    every, of = np.unique(s.bigrams(), return_inverse=True)
    bi = [np.bincount(of[m], minlength=len(every)) for m in (train, deleted)]
    return [(UNIGRAM, s.hashes[order], *uni), (BIGRAM, every, *bi)]


def requests(sharded: DataFrame, parts: int) -> DataFrame:
    """(kind, part, shard, n, keys, train, deleted): what a shard knows and asks of each range of hashes."""
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("shard", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("train", pa.binary()), ("deleted", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                for kind, keys, train, deleted in _counted(row):
                    edge = part_bounds(keys, parts)
                    cut = [(p, slice(edge[p], edge[p + 1])) for p in range(1 << parts)]
                    yield batch({"kind": [kind] * len(cut), "part": [p for p, _ in cut], "shard": [row["shard"]] * len(cut), "n": [len(keys[c]) for _, c in cut], "keys": [pack_sorted(keys[c]) for _, c in cut], "train": [pack(train[c].astype(np.uint32)) for _, c in cut], "deleted": [pack(deleted[c].astype(np.uint32)) for _, c in cut]}, schema)

    return sharded.mapInArrow(run, "kind int, part int, shard long, n long, keys binary, train binary, deleted binary")


_ANSWER = "kind int, part int, shard long, n long, train binary, deleted binary, n_known long, n_train long, n_deleted long"


def answers(asked: DataFrame) -> DataFrame:
    """For each request the corpus counts of its keys; and a row with shard -1 for each range with its number of known keys and the sums of counts."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["n"].tolist()
        keys = np.concatenate([unpack_sorted(k, n) for k, n in zip(rows["keys"], sizes, strict=True)])
        every, of = np.unique(keys, return_inverse=True)
        sums = [np.bincount(of, weights=np.concatenate([unpack(x, np.uint32, n) for x, n in zip(rows[c], sizes, strict=True)]), minlength=len(every)).astype(np.int64) for c in ("train", "deleted")]
        edge = starts_of(np.array(sizes, np.int64))
        back = [[pack(s[of[edge[i] : edge[i + 1]]]) for i in range(len(sizes))] for s in sums]
        out = pd.DataFrame({"kind": rows["kind"], "part": rows["part"], "shard": rows["shard"], "n": rows["n"], "train": back[0], "deleted": back[1], "n_known": 0, "n_train": 0, "n_deleted": 0})
        total = pd.DataFrame({"kind": rows["kind"].iloc[:1], "part": rows["part"].iloc[:1], "shard": [-1], "n": [0], "train": [b""], "deleted": [b""], "n_known": [int((sums[0] > 0).sum())], "n_train": [int(sums[0].sum())], "n_deleted": [int(sums[1].sum())]})
        return pd.concat([out, total])

    return asked.groupBy("kind", "part").applyInPandas(run, _ANSWER)


def _looked_up(shard: Shard, told: pd.DataFrame, at: np.ndarray | slice) -> tuple[np.ndarray, ...]:
    """Training and deleted counts of the tokens at `at`, of the words before them, and of their bigrams."""
    told = told.sort_values("part")

    def joined(kind: int, column: str) -> np.ndarray:
        rows = told[told["kind"] == kind]
        return np.concatenate([unpack(x, np.int64, n) for x, n in zip(rows[column], rows["n"].tolist(), strict=True)])

    order = np.argsort(shard.hashes)
    every = np.unique(shard.bigrams())
    of = np.searchsorted(every, shard.bigrams(at))
    out = []
    for column in ("train", "deleted"):
        uni = np.empty(len(order), np.int64)
        uni[order] = joined(UNIGRAM, column)
        out += [uni[shard.ids[at]], uni[shard.before[at]], joined(BIGRAM, column)[of]]
    return tuple(out)


def bucket(context: np.ndarray) -> np.ndarray:
    """A context's bucket: 0 for an unseen one, else one more than the whole part of its frequency's binary logarithm, up to a last bucket."""
    return np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0), BUCKETS - 1)


def _estimates(word: np.ndarray, context: np.ndarray, pair: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.where(context > 0, pair / np.maximum(context, 1), 0.0), word / max(n, 1)


def weights(histogram: list[tuple[int, int, int, int]], vocabulary: int) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of each bucket by expectation-maximisation.

    histogram: (bucket, steps of the bigram's estimate, of the unigram's, tokens), where step s stands for a probability of
    2 ** (-s / STEPS) and -1 for 0. A bucket without tokens has the weights of all buckets together.
    """
    rows = np.array(histogram, np.int64).reshape(-1, 4)
    value = lambda s: np.where(s < 0, 0.0, 2.0 ** (-np.maximum(s, 0) / STEPS))
    p = np.stack([value(rows[:, 1]), value(rows[:, 2]), np.full(len(rows), 1 / (vocabulary + 1))], axis=1)

    def learned(some: np.ndarray) -> np.ndarray:
        mix = np.full(3, 1 / 3)
        for _ in range(EM_ROUNDS):
            share = mix * p[some]
            mix = (share / share.sum(axis=1, keepdims=True) * rows[some, 3:4]).sum(axis=0)
            mix /= mix.sum()
        return mix

    common = learned(np.ones(len(rows), bool)) if len(rows) else np.full(3, 1 / 3)
    out = np.array([learned(some) if (some := rows[:, 0] == k).any() else common for k in range(BUCKETS)])
    out[:, 2] = np.maximum(out[:, 2], LEAST_UNIFORM)
    return out / out.sum(axis=1, keepdims=True)


def scored(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of each whole text, null as empty: its end token alone.

    A null key counts as the empty text in the fold's hash. Repeated rows are scored, and learned from, as often as they occur.
    """
    sharded = materialise(shards(docs, text, key), "shards")
    total = sharded.agg(F.sum("n_tokens")).first()[0] or 0
    told = materialise(answers(requests(sharded, log_parts(total, RANGE_KEYS))), "answers")
    sums = told.filter((F.col("shard") == -1) & (F.col("kind") == UNIGRAM)).agg(F.sum("n_known"), F.sum("n_train"), F.sum("n_deleted")).first()
    known, n, n_deleted = (x or 0 for x in sums)
    to_shards = told.filter("shard >= 0").groupBy("shard")

    def observed(row: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        s = Shard(row.to_dict("records")[0])
        at = np.flatnonzero(s.tokens_of(s.deleted))
        w, c, b, w_, c_, b_ = _looked_up(s, counts, at)
        pair, word = _estimates(w - w_, c - c_, b - b_, n - n_deleted)
        steps = [np.where(x > 0, np.rint(-np.log2(np.maximum(x, 1e-300)) * STEPS), -1).astype(np.int64) for x in (pair, word)]
        rows, many = np.unique(np.stack([bucket(c - c_), *steps], axis=1), axis=0, return_counts=True)
        return pd.DataFrame({"bucket": rows[:, 0], "pair": rows[:, 1], "word": rows[:, 2], "n": many})

    # Buckets and steps bound the histogram, whatever the corpus.
    seen = sharded.groupBy("shard").cogroup(to_shards).applyInPandas(observed, "bucket long, pair long, word long, n long")
    histogram = [tuple(r) for r in seen.groupBy("bucket", "pair", "word").agg(F.sum("n")).collect()]
    mix = weights(histogram, known)

    def score(row: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        s = Shard(row.to_dict("records")[0])
        w, c, b, *_ = _looked_up(s, counts, slice(None))
        pair, word = _estimates(w, c, b, n)
        m = mix[bucket(c)]
        p = m[:, 0] * pair + m[:, 1] * word + m[:, 2] / (known + 1)
        base = np.log10((w + 0.1) / (n + 0.1 * (known + 1)))
        each = lambda x: np.add.reduceat(x, s.starts[:-1])
        return pd.DataFrame({key: pd.array(s.keys, "Int64"), "held_out": s.held_out, "n_tokens": s.lengths, "n_known": each((w > 0).astype(np.int64)), "train_tokens": n, "base_score": each(base), "score": each(np.log10(p))})

    kinds = f"{key} long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return sharded.groupBy("shard").cogroup(to_shards).applyInPandas(score, kinds)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of every document."""
    return scored(table(spark, sf_dir, "documents"))
