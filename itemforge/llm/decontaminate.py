"""Benchmark decontamination by template windows.

A text becomes a sequence of template tokens: numbers, units after numbers, and names (capitalised words inside a
sentence) give way to typed placeholders, other words are folded. Windows of template tokens are hash-joined with
those of the benchmark; the values that stood in a window's slots must map to the benchmark's values one to one.
A window whose values are all equal is a copy; another consistent one is a re-parameterised question.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import batch, materialise, starts_of, table, text_bytes

WINDOW = 13
#: At least so many tokens of a window must be literal words.
MIN_LITERAL = 7
#: Benchmarks of up to so many windows filter on the map side and are broadcast; larger ones are joined by shuffle.
LOCAL_WINDOWS = 1_000_000
#: Tokens that are worked on at once, and words that are numbered at once: what a worker holds.
CHUNK = 200_000
#: Abbreviations that count as units after a number.
UNITS = frozenset("mm cm m km in ft yd mi g mg kg lb oz t l ml cl s sec min h hr ms d w kw v a hz khz mhz ghz j kj cal kcal pa bar c f k mol eur usd gbp euros dollars pounds metres meters miles grams litres liters hours minutes seconds days weeks months years percent degrees".split())

_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[.!?%\n]")
LITERAL, NUMBER, UNIT, CAPITAL, BREAK = range(5)
_PLACE = {NUMBER: xxhash.xxh64_intdigest(b"\0number", 7), UNIT: xxhash.xxh64_intdigest(b"\0unit", 7), CAPITAL: xxhash.xxh64_intdigest(b"\0name", 7)}
_MARK = {NUMBER: "n:", UNIT: "u:", CAPITAL: "a:"}


class Words(dict):
    """Numbers of tokens, with the hash of the folded form and the kind of each."""

    def __init__(self) -> None:
        self.hashes: list[int] = []
        self.kinds: list[int] = []

    def __missing__(self, token: str) -> int:
        first = token[0]
        if first.isdigit():
            kind = NUMBER
        elif first == "%" or token.lower() in UNITS:
            kind = UNIT
        elif not first.isalpha():
            kind = BREAK
        else:
            kind = CAPITAL if first.isupper() else LITERAL
        self[token] = at = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(token.lower().encode(), 7))
        self.kinds.append(kind)
        return at


def _hashed(at: np.ndarray, size: int, first: np.ndarray, body: np.ndarray) -> np.ndarray:
    """The hash of the windows at these positions: of first's token there and body's tokens after it."""
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + (body[at + k] if k else first[at])
        if k & 3 == 3:
            h ^= h >> np.uint64(31)
    return h


def _windows(texts: list[str], sizes: tuple[int, ...], keep, words: Words) -> Iterator[tuple[int, int, int, int, list[str]]]:
    """(text, position, size, hash, slots) of the windows whose hash `keep` (a boolean mask of hashes) keeps.

    sizes: the sizes to look for; a negative one asks for windows of folded tokens without placeholders. Without any, each
    text is a benchmark's: its windows are of WINDOW tokens, or of all where it has fewer, and those with fewer than MIN_LITERAL words
    don't count; a text in which none counts is one window without placeholders.

    A capital at a sentence's start or a window's says little, so each window comes with these words as they are and as names:
    its first word and the others in both ways.
    """
    tokens = [_TOKEN.findall(t) for t in texts]
    ids = np.fromiter((words[x] for row in tokens for x in row), np.int64)
    if not len(ids):
        return
    kind = np.array(words.kinds, np.int8)[ids]
    hashes = np.array(words.hashes, np.uint64)[ids]
    text = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
    fresh = np.empty(len(ids), bool)  # at a sentence's start, where a capital says nothing
    fresh[0] = True
    fresh[1:] = (kind[:-1] == BREAK) | (text[1:] != text[:-1])
    after_number = np.zeros(len(ids), bool)
    after_number[1:] = (kind[:-1] == NUMBER) & (text[1:] == text[:-1])
    capital = kind == CAPITAL
    kind[capital & fresh] = LITERAL
    kind[(kind == UNIT) & ~after_number] = LITERAL
    whole = np.flatnonzero(kind != BREAK)
    kind, folded, text, flat, capital = kind[whole], hashes[whole], text[whole], ids[whole], capital[whole]
    # What stands before a window must not matter: its own first token is a word or a number.
    lead = np.where(kind == NUMBER, np.uint64(_PLACE[NUMBER]), folded)
    plain = folded.copy()
    for k, h in _PLACE.items():
        plain[kind == k] = np.uint64(h)
    named = np.where(capital, np.uint64(_PLACE[CAPITAL]), plain)
    counts = np.bincount(text, minlength=len(texts))
    bounds = starts_of(counts)
    names = list(words)
    literal, doubtful = starts_of(kind == LITERAL), starts_of(capital & (kind == LITERAL))
    asked = not sizes
    own = np.minimum(counts, WINDOW)
    counted = np.zeros(len(texts), bool)
    for size in sizes or sorted(set(own[own > 0].tolist())):
        n = len(folded) - abs(size) + 1
        if n < 1:
            continue
        good = text[abs(size) - 1 :] == text[:n]
        if size < 0:
            at = np.flatnonzero(good)
            yield from _kept(at, _hashed(at, -size, folded, folded), keep, text, bounds, size, lambda _: [])
            continue
        if asked:
            good &= (own[text[:n]] == size) & (literal[size:] - literal[:n] + (capital & (kind != LITERAL))[:n] >= MIN_LITERAL)
            counted[text[:n][good]] = True
        inner = doubtful[size:] > doubtful[1 : n + 1]
        for as_name, body in ((False, plain), (False, named), (True, plain), (True, named)):
            at = np.flatnonzero(good & (capital[:n] | (not as_name)) & (inner | (body is plain)))

            def slots(a: int, size: int = size, as_name: bool = as_name, body: np.ndarray = body) -> list[str]:
                out = []
                for i in range(a, a + size):
                    k = CAPITAL if capital[i] and (as_name if i == a else body is named) else int(kind[i])
                    if k == NUMBER or k != LITERAL and (i > a or as_name):
                        out.append(_MARK[k] + names[flat[i]].lower())
                return out

            yield from _kept(at, _hashed(at, size, np.where(capital, np.uint64(_PLACE[CAPITAL]), lead) if as_name else lead, body), keep, text, bounds, size, slots)
    if asked:
        for i in np.flatnonzero(~counted & (counts > 0)).tolist():
            at = bounds[i : i + 1]
            yield from _kept(at, _hashed(at, int(counts[i]), folded, folded), keep, text, bounds, -int(counts[i]), lambda _: [])


def _kept(at: np.ndarray, h: np.ndarray, keep, text: np.ndarray, bounds: np.ndarray, size: int, slots) -> Iterator[tuple[int, int, int, int, list[str]]]:
    some = keep(h)
    for a, x in zip(at[some].tolist(), h[some].view(np.int64).tolist(), strict=True):
        yield int(text[a]), int(a - bounds[text[a]]), size, x, slots(a)


def template_windows(rows: DataFrame, key: str, text: str = "text", sizes: tuple[int, ...] = (), only: np.ndarray | None = None) -> DataFrame:
    """(key, at, size, hash, slots) of every window of each whole text, or of those whose hash is in `only`; sizes as in _windows.
    """
    schema = pa.schema([(key, pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("hash", pa.int64()), ("slots", pa.list_(pa.string()))])
    table_bits = None
    if only is not None:
        only = np.sort(only.view(np.uint64))
        table_bits = np.zeros(1 << 20, bool)
        table_bits[only >> np.uint64(44)] = True

    def keep(h: np.ndarray) -> np.ndarray:
        if only is None:
            return np.ones(len(h), bool)
        out = table_bits[h >> np.uint64(44)]
        at = np.flatnonzero(out)
        found = np.searchsorted(only, h[at])
        out[at] = only[np.minimum(found, len(only) - 1)] == h[at] if len(only) else False
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            keys, texts = b.column(0).to_pylist(), [t.decode("utf-8", "replace") for t in b.column(1).to_pylist()]
            step = 0
            while step < len(texts):
                upto, held = step, 0
                while upto < len(texts) and (held == 0 or held + len(texts[upto]) <= 4 * CHUNK):
                    held += len(texts[upto])
                    upto += 1
                part = texts[step:upto]
                if len(words) > CHUNK:
                    words = Words()
                out = [(keys[step + i], *rest) for i, *rest in _windows(part, sizes, keep, words)]
                if out:
                    yield batch(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema)
                step = upto

    return rows.select(F.col(key).cast("long").alias(key), text_bytes(text)).mapInArrow(run, f"{key} long, at int, size int, hash long, slots array<string>")


def consistent(a: str, b: str) -> Column:
    """Whether the slots' values in a map to those in b one to one; both have their kind as prefix."""
    pairs = F.size(F.array_distinct(F.arrays_zip(a, b)))
    return (F.size(a) == F.size(b)) & (pairs == F.size(F.array_distinct(a))) & (pairs == F.size(F.array_distinct(b)))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """(key, item, n_windows, item_windows, exact boolean): documents that hold a benchmark question, or one like it with other values.

    One consistent window is enough; exact says whether some window has the benchmark's own values. Items with fewer tokens than a
    window count as one window. Items without a window of MIN_LITERAL words, however short, match where all their tokens stand in a
    row, without regard to case. Null and empty texts match nothing. Rows with null keys count as no document.
    """
    asked = materialise(template_windows(benchmark.filter(F.col(item).isNotNull()), item, "text"), "asked")
    n = asked.count()
    small = n <= LOCAL_WINDOWS
    sizes = tuple(sorted(r[0] for r in asked.select("size").distinct().collect())) or (WINDOW,)
    only = np.array([r[0] for r in asked.select("hash").distinct().collect()], np.int64) if small else None
    found = template_windows(docs.filter(F.col(key).isNotNull()), key, text, sizes, only)
    right = asked.select(item, F.col("at").alias("item_at"), "size", "hash", F.col("slots").alias("item_slots"))
    met = found.join(F.broadcast(right) if small else right, ["size", "hash"]).filter(consistent("slots", "item_slots"))
    totals = asked.groupBy(item).agg(F.countDistinct("at").alias("item_windows"))
    pairs = met.groupBy(key, item).agg(F.countDistinct("item_at").alias("n_windows"), F.bool_or(F.col("slots") == F.col("item_slots")).alias("exact"))
    return pairs.join(F.broadcast(totals) if small else totals, item).select(key, item, "n_windows", "item_windows", "exact")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of a document and a benchmark item that it holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
