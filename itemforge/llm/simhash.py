"""SimHash near-duplicates: fingerprints, one-wildcard segment variants, equality join, verification, components.

A fingerprint of 64 bits is cut into three segments. Two fingerprints at a distance of four or less differ by at
most one bit in some segment (two bits in each would make six), so they agree on a variant of that segment in
which one position is a wildcard. The index holds every variant of every *distinct* fingerprint; an equality join
on it finds all links, and the join condition verifies them. Copies meet before, in a grouping by fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import batch, by_shuffle, materialise, table, text_bytes
from itemforge.llm.components import components

BITS = 64
MAX_DISTANCE = 4
#: First bit and width of each segment: 21, 21 and 22 bits.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
SEED = 42


def shingle_hashes(text: bytes, size: int, seed: int = SEED) -> list[int]:
    """XXH64 of each run of `size` words, joined by single spaces; a text with fewer words is one run, one without words none."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], seed) for s, e in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]


def fingerprint(hashes: list[int] | np.ndarray) -> int:
    """Bit k is 1 if it is set in over half the hashes; 0 for none."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(most, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp long): the fingerprint of each whole text as a signed 64-bit number. Null and wordless texts have 0."""
    schema = pa.schema([(key, pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(shingle_hashes(t.as_py(), shingle_words)) for t in b.column(1)], dtype=np.uint64)
            yield batch({key: b.column(0), "fp": fps.view(np.int64)}, schema)

    return docs.select(F.col(key).cast("long").alias(key), text_bytes(text)).mapInArrow(run, f"{key} long, fp long")


def variants(nodes: DataFrame) -> DataFrame:
    """nodes (node, fp) with one row for each segment and wildcard position: (seg, at, rest, node, fp)."""
    keys = []
    for s, (first, width) in enumerate(SEGMENTS):
        part = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        keys += [F.struct(F.lit(s).alias("seg"), F.lit(at).alias("at"), part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << at))).alias("rest")) for at in range(width)]
    return by_shuffle(nodes.select("node", "fp", F.explode(F.array(*keys)).alias("k")).select("k.seg", "k.at", "k.rest", "node", "fp"))


def _segment(x: Column, s: int) -> Column:
    first, width = SEGMENTS[s]
    return F.shiftrightunsigned(x, first).bitwiseAND(F.lit((1 << width) - 1))


def _counts(differ: Column, seg: Column, at: Column) -> Column:
    """Whether a pair that differs in these bits counts at this segment and wildcard: one of those where it meets."""
    first, here = F.lit(-1), F.lit(0).cast("long")
    for s in reversed(range(len(SEGMENTS))):
        first = F.when(F.bit_count(_segment(differ, s)) <= 1, F.lit(s)).otherwise(first)
        here = F.when(seg == s, _segment(differ, s)).otherwise(here)
    # The differing bit of a segment must be the wildcard; an equal segment counts at position 0 alone.
    return F.when(here == 0, at == 0).otherwise(here == F.call_function("shiftleft", F.lit(1).cast("long"), at)) & (first == seg)


def links(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b, distance) for every pair of nodes with distinct fingerprints at a distance of max_distance (4 at most), each once.

    A pair counts only in its first segment that differs by at most one bit, at the differing bit, or at
    position 0 where the segment is equal; so the join returns no pair twice.
    """
    if max_distance > 2 * len(SEGMENTS) - 1:
        raise ValueError(f"three segments find distances up to {2 * len(SEGMENTS) - 1}")
    index = variants(nodes)
    x, y = index.alias("x"), index.alias("y")
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    on = (F.col("x.seg") == F.col("y.seg")) & (F.col("x.at") == F.col("y.at")) & (F.col("x.rest") == F.col("y.rest"))
    met = x.join(y, on & (F.col("x.node") < F.col("y.node")) & (F.bit_count(differ) <= max_distance) & _counts(differ, F.col("x.seg"), F.col("x.at")))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.bit_count(differ).alias("distance"))


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_distance: int = MAX_DISTANCE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp, component_id): the smallest key that chains of links reach from each document, itself included.

    Documents with one fingerprint form a node, named by its smallest key. Null, empty and wordless texts share
    fingerprint 0. A row with a null key counts as no document. Repeated rows keep their number.
    """
    fps = materialise(fingerprints(docs.filter(F.col(key).isNotNull()), shingle_words, text, key), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min(key).alias("node"))
    found = components(links(nodes, max_distance), "a", "b")
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return by_shuffle(fps).join(named, "fp")


#: Fingerprints of a sketch, of BITS one-bit minima each; the first TABLES of them are indexed. Two sets with Jaccard
#: similarity j agree in a bit with probability (1 + j) / 2, so at 0.8 a segment of 21 bits differs by at most one bit
#: with probability 0.36, and one of the index's twelve does with 0.995.
PRINTS, TABLES = 8, 4
FIELDS = [f"f{k}" for k in range(PRINTS)]
#: Minima that a sketch keeps whole; two sets share none of them with probability (1 - j) ** WHOLE, 0.00006 at 0.8.
WHOLE = 6
#: Shingles that are multiplied at once.
BLOCK = 512
_RANDOM = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 32, (3, PRINTS * BITS), np.uint32)
_TIMES, _PLUS, _MIX = _RANDOM[0] | np.uint32(1), _RANDOM[1], _RANDOM[2] | np.uint32(1)


def sketch_distance(similarity: float) -> int:
    """Differing bits of two sketches that a pair to be compared may have: 3.3 deviations over the mean at this similarity."""
    n, p = PRINTS * BITS, (1 - similarity) / 2
    return int(n * p + 3.3 * (n * p * (1 - p)) ** 0.5)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of a set of hashes under each of the sketch's functions."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(PRINTS * BITS, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(short), BLOCK):
        low = np.minimum(low, (short[k : k + BLOCK, None] * _TIMES + _PLUS).min(axis=0))
    return low


def one_bit(low: np.ndarray) -> np.ndarray:
    """A bit of each minimum, as PRINTS signed numbers."""
    return np.packbits((low * _MIX) >> np.uint32(31) != 0, bitorder="little").view(np.int64)


def _shingle_set(text: bytes, size: int) -> tuple[np.ndarray, int, int]:
    """The different shingle hashes of a text, and 128 bits that name the set."""
    h = np.unique(np.array(shingle_hashes(text, size), np.uint64))
    name = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64)
    return h, int(name[0]), int(name[1])


def sketches(docs: DataFrame, shingle_words: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, s0, s1, n, f0..., whole): of each whole text the name of its set of shingles, their number and its sketch."""
    numbers = ("s0", "s1", "n", *FIELDS)
    schema = pa.schema([(key, pa.int64()), *((c, pa.int64()) for c in numbers), ("whole", pa.list_(pa.int64()))])
    function = np.arange(WHOLE, dtype=np.int64) << 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, whole = np.zeros((b.num_rows, len(numbers)), np.int64), []
            for i, t in enumerate(b.column(1)):
                h, s0, s1 = _shingle_set(t.as_py(), shingle_words)
                low = minima(h)
                rows[i, :3] = s0, s1, len(h)
                rows[i, 3:] = one_bit(low)
                whole.append(function | low[:WHOLE])
            yield batch({key: b.column(0), "whole": whole} | {c: rows[:, k] for k, c in enumerate(numbers)}, schema)

    kinds = ", ".join(f"{c} long" for c in (key, *numbers))
    return docs.select(F.col(key).cast("long").alias(key), text_bytes(text)).mapInArrow(run, f"{kinds}, whole array<long>")


def _accompanied(nodes: DataFrame) -> DataFrame:
    """The nodes with words that share a whole minimum with another node; all others have no partner."""
    each = by_shuffle(nodes.filter("n > 0").select("node", F.explode("whole").alias("k")))
    shared = each.groupBy("k").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("k")
    return nodes.drop("whole").join(each.join(shared, "k").select("node").distinct(), "node", "left_semi")


def _shingle_sets(docs: DataFrame, shingle_words: int, text: str, key: str) -> DataFrame:
    """(node, s0, s1, hashes): the set of shingles of each whole text, with its name."""
    schema = pa.schema([("node", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                sets = [_shingle_set(t.as_py(), shingle_words) for t in b.column(1)[k : k + 500]]
                yield batch({"node": b.column(0)[k : k + 500], "s0": [x[1] for x in sets], "s1": [x[2] for x in sets], "hashes": [x[0].view(np.int64) for x in sets]}, schema)

    return docs.select(F.col(key).cast("long").alias("node"), text_bytes(text)).mapInArrow(run, "node long, s0 long, s1 long, hashes array<long>")


def _distance(x: str, y: str, field: str) -> Column:
    return F.bit_count(F.col(f"{x}{field}").bitwiseXOR(F.col(f"{y}{field}")))


def _near(x: str, y: str, similarity: float) -> Column:
    """Whether the sizes of two sets allow the similarity and their sketches make it likely; x and y prefix n and the fields."""
    share = Fraction(str(similarity))
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    away = sum((_distance(x, y, f) for f in FIELDS), F.lit(0))
    return (F.least(n, m) * share.denominator >= F.greatest(n, m) * share.numerator) & (away <= sketch_distance(similarity))


def _ends(pairs: DataFrame) -> DataFrame:
    """(node): both nodes of each pair."""
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b"))


def _verified(pairs: DataFrame, nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The different pairs (a, b) of nodes whose sets of shingles have this Jaccard similarity or more."""
    pairs = materialise(pairs, "pairs")
    wanted = _ends(pairs).distinct()
    held = by_shuffle(sets(wanted)).join(nodes.select("node", "s0", "s1"), ["node", "s0", "s1"]).dropDuplicates(["node", "s0", "s1"])
    held = materialise(held.select("node", "hashes"), "sets")
    met = pairs.join(held.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a").join(held.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
    share, both = Fraction(str(similarity)), F.size(F.array_intersect("ha", "hb"))
    return materialise(met.filter(both * (share.denominator + share.numerator) >= (F.size("ha") + F.size("hb")) * share.numerator).select("a", "b").distinct(), "links")


def _index(nodes: DataFrame, keep: list[str], variants: bool = False) -> DataFrame:
    """keep and k: a row for each segment of each indexed fingerprint as it is and, for variants, with each one of its bits changed."""
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at)
    keys = []
    for t in range(TABLES):
        for s, (first, width) in enumerate(SEGMENTS):
            part = F.shiftrightunsigned(FIELDS[t], first).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(t << 40 | s << 32))
            changed = lambda at, part=part: part.bitwiseXOR(bit(at))
            keys.append(F.concat(F.array(part), _each_bit(changed, width)) if variants else F.array(part))
    return by_shuffle(nodes.select(*keep, F.explode(F.flatten(F.array(*keys))).alias("k")))


def _each_bit(of: Callable[[Column], Column], width: int) -> Column:
    """An array of what `of` makes of each bit's number; a function over numbers, since hundreds of expressions would be hundreds of times the generated code."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda at: of(at))


def _joined_sketches(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The different pairs (a, b) that may be similar."""
    x, y = (nodes.select(F.col("node").alias(c), *(F.col(d).alias(f"{c}{d}") for d in ("n", *FIELDS))) for c in ("a", "b"))
    return pairs.distinct().join(x, "a").join(y, "b").filter(_near("a", "b", similarity)).select("a", "b")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _first_leaders(nodes: DataFrame) -> DataFrame:
    """(a, b): each node with two of those that share a whole segment with it, others in each bucket, so a large group gives two pairs a node and segment."""
    each = _index(nodes, ["node"])
    # Nodes ordered by their bits' difference from the bucket's hash: the ends are other nodes in each bucket.
    turned = F.col("node").bitwiseXOR(F.xxhash64("k"))
    ends = each.groupBy("k").agg(F.min(turned).alias("low"), F.max(turned).alias("high")).filter("low < high")
    met = each.join(ends, "k").select("node", F.explode(F.array(*(F.col(c).bitwiseXOR(F.xxhash64("k")) for c in ("low", "high")))).alias("leader")).filter("node <> leader")
    return met.select(*_pair("node", "leader"))


def _best_leaders(labels: DataFrame) -> DataFrame:
    """(a, b): each node with that of most links among those that share a whole segment with it, unless one component holds both."""
    each = _index(labels, ["node", "c", "deg"])
    best = each.groupBy("k").agg(F.max(F.struct("deg", "node", "c")).alias("best")).select("k", F.col("best.node").alias("leader"), F.col("best.c").alias("lc"))
    return each.join(best, (each["k"] == best["k"]) & (F.col("c") != F.col("lc"))).select(*_pair("node", "leader"))


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes with their component c, its size and their number of links, deg."""
    found = components(links, "a", "b")
    sized = found.join(found.groupBy("component").agg(F.count("*").alias("size")), "component").withColumnRenamed("component", "c")
    deg = _ends(links).groupBy("node").agg(F.count("*").alias("deg"))
    known = nodes.join(sized, "node", "left").join(deg, "node", "left")
    return known.select("node", "n", *FIELDS, F.coalesce("c", "node").alias("c"), F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("deg", F.lit(0)).alias("deg"))


def _once(x: str, y: str, k: Column) -> Column:
    """Whether k is of the first fingerprint and segment in which a pair differs by one bit at most."""
    meets = F.lit(-1).cast("long")
    for t in reversed(range(TABLES)):
        for s, (first, width) in reversed(list(enumerate(SEGMENTS))):
            part = F.shiftrightunsigned(F.col(f"{x}{FIELDS[t]}").bitwiseXOR(F.col(f"{y}{FIELDS[t]}")), first).bitwiseAND(F.lit((1 << width) - 1))
            meets = F.when(F.bit_count(part) <= 1, F.lit(t << 8 | s).cast("long")).otherwise(meets)
    return meets == F.shiftrightunsigned(k, 32)


def _between_components(labels: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the pairs of nodes in different components that a segment's variant retrieves and that may be similar, each once.

    The index has whole segments; variants ask it. Of two nodes that of the smaller component asks, so the members of a large one hold twelve
    rows each and ask for nothing. Variants whose bucket has no larger component go before sketches are joined.
    """
    order = F.struct("size", "c")
    index = _index(labels, ["node", "n", "c", "size", *FIELDS]).withColumn("o", order)
    tops = index.groupBy("k").agg(F.max("o").alias("top"))
    asks = _index(labels, ["node", "c", "size"], variants=True).join(tops, "k").filter(F.col("top") > order).select("k", "node")
    asks = materialise(asks, "asks")
    # A stored ask takes 10 bytes and 66 in a broadcast (check_l), so the file tells too little.
    x, y = by_shuffle(asks).join(labels.withColumn("o", order), "node").alias("x"), index.alias("y")
    met = x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.o") < F.col("y.o")) & (F.col("x.c") != F.col("y.c")) & _near("x.", "y.", similarity) & _once("x.", "y.", F.col("x.k")))
    return met.select(*_pair("x.node", "y.node"))


def similar_groups(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, component_id): groups of texts that chains of pairs with this Jaccard similarity of their sets of shingles, or more, connect.

    A sketch is several fingerprints of one-bit minima, which for such sets part similar from other pairs better than
    majorities do. They only retrieve: pairs with a segment that differs by one bit at most and whose sketches are not far apart are
    compared shingle by shingle. Nodes that share none of a few whole minima with another have no partner. First the others meet a few
    leaders, then the node of most links that shares a segment, and at last what is still in different components meets by the
    segments' variants; a pair within a component can change no group, so it is not retrieved. Of pairs
    at a similarity of exactly 0.8 0.6 % are missed, by calculation, fewer above. Texts without words are one group. Nulls as in near_duplicates.
    """
    docs = docs.filter(F.col(key).isNotNull())
    each = materialise(sketches(docs, shingle_words, text, key), "sketches")
    # Sets of one name have one sketch, so any row's will do.
    every = materialise(each.groupBy("s0", "s1", "n", *FIELDS, "whole").agg(F.min(key).alias("node")), "nodes")
    nodes = materialise(_accompanied(every), "nodes")

    def sets(wanted: DataFrame) -> DataFrame:
        return _shingle_sets(docs.join(wanted, docs[key].cast("long") == wanted["node"], "left_semi"), shingle_words, text, key)

    def linked(pairs: DataFrame) -> DataFrame:
        return _verified(_joined_sketches(pairs, nodes, similarity), nodes, sets, similarity)

    links = linked(_first_leaders(nodes))
    labels = materialise(_labelled(nodes, links), "labels")
    links = links.union(linked(_best_leaders(labels)))
    labels = materialise(_labelled(nodes, links), "labels")
    links = links.union(_verified(_between_components(labels, similarity), nodes, sets, similarity))
    found = components(links, "a", "b")
    named = every.join(found, "node", "left").select("s0", "s1", F.coalesce("component", "node").alias("component_id"))
    return by_shuffle(each.select(key, "s0", "s1")).join(named, ["s0", "s1"]).select(key, "component_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
