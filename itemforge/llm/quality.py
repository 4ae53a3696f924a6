"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger keeps the measurements and one long in which bit k is
set if rule k fails. Policies are versioned masks over those bits, applied without touching a text again, and
ablations are bitwise aggregates over the ledger.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemforge.llm.common import batch, materialise, table, text_bytes

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_MEASURE = re.compile(rf"\b(?:{'|'.join(MEASURES)})\b")


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """How many words lie in windows of `size` words that the text holds twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) > len(words) - size:  # a window found twice repeats its words
        return 0
    mixed = (ids + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    windows = sliding_window_view(ids, size)
    at = np.flatnonzero(same)
    at = at[(windows[order[at]] == windows[order[at + 1]]).all(axis=1)]
    twice = np.unique(np.concatenate((order[at], order[at + 1])))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + size, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The values of MEASURES for a text in UTF-8."""
    words = text.split()
    joined = b"".join(words)
    word_chars = len(joined.decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), word_chars, sum(joined.count(x) for x in (SYMBOLS[k : k + 1] for k in range(len(SYMBOLS)))), len(lines), len(lines) - len(set(lines)), repeat_words(words))


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, MEASURES...) of each whole text, null as a text without words; one row for each row of docs."""
    schema = pa.schema([(key, pa.int64()), *((m, pa.int64()) for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t.as_py()) for t in b.column(1)]
            yield batch({key: b.column(0)} | {m: [r[k] for r in rows] for k, m in enumerate(MEASURES)}, schema)

    kinds = ", ".join(f"{m} long" for m in (key, *MEASURES))
    return docs.select(F.col(key).cast("long").alias(key), text_bytes(text)).mapInArrow(run, kinds)


@dataclass(frozen=True)
class Rule:
    """A rule fails where `fails` is true; its bit never changes."""

    bit: int
    name: str
    fails: str


#: Integer comparisons only, so that every engine agrees on every row.
RULES = (
    Rule(0, "too_few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
)
BASE = 0b000011
#: Version -> mask of the rules that reject under it.
POLICIES = {"v1": BASE, "v2": 0b111111}
POLICY = "v2"


def failure_bits(rules: tuple[Rule, ...] = RULES, prefix: str = "") -> Column:
    """A long with bit k set if rule k fails on the measures, whose names follow a prefix."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(_MEASURE.sub(rf"{prefix}\g<0>", rule.fails)), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, MEASURES..., failed long): each rule evaluated once. A null or empty text fails too_few_words."""
    return measured(docs, text, key).withColumn("failed", failure_bits(rules))


def passes(policy: str = POLICY, policies: dict[str, int] = POLICIES, failed: str = "failed") -> Column:
    """Whether a ledger row has no failure that the policy counts."""
    return F.col(failed).bitwiseAND(F.lit(policies[policy]).cast("long")) == 0


def ledgered(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """docs as a stored table with one more column, a struct of MEASURES and failed, and that column's name: one that docs doesn't have.

    Each rule is evaluated once for each row, in the task that reads it, so texts are not shuffled; any number of policies and ablations then read bits.
    """
    name = "ledger"
    while name in docs.columns:
        name += "_"
    kinds = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            rows = [measure((t.as_py() or "").encode()) for t in texts]
            measures = pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))], list(MEASURES))
            yield pa.RecordBatch.from_arrays([*b.columns, measures], [*b.schema.names, name])

    measures = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    rows = docs.mapInArrow(run, T.StructType([*kinds.fields, T.StructField(name, measures)]))
    return materialise(rows.withColumn(name, F.struct(f"{name}.*", failure_bits(prefix=f"{name}.").alias("failed"))), "ledger"), name


def kept_rows(docs: DataFrame, policy: str = POLICY, text: str = "text") -> DataFrame:
    """The rows of docs that the policy keeps, by the bits of their stored ledger."""
    rows, name = ledgered(docs, text)
    return rows.filter(passes(policy, failed=f"{name}.failed")).select(*docs.columns)


def ablation(ledger_rows: DataFrame, policy: str = POLICY, rules: tuple[Rule, ...] = RULES, policies: dict[str, int] = POLICIES) -> DataFrame:
    """For each rule of the policy: how many rows fail it, fail it alone, and would be kept without it.

    The rows are first counted by their bits (at most two to the number of rules), so the shuffle carries counts.
    """
    mask = policies[policy]
    counts = ledger_rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rows = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if mask >> r.bit & 1))
    each = counts.select("bits", "n", F.explode(rows).alias("r"))
    of = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0))).alias
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        of(hit)("n_failed"), of(F.col("bits") == F.col("r.bit"))("n_failed_alone"), of((F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))) == 0)("n_kept_without")
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document under the current policy."""
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(BASE).cast("long")) != 0).alias("base_failed"), passes().alias("kept"), "n_lines", "failed",
    )
