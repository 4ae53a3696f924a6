"""HyperMinHash near-duplicates: compressed registers, banding, collision-corrected estimates, exact verification.

A set's hashes fall into REGISTERS buckets; of each bucket's least hash the register keeps the number of leading zeros and
the MANTISSA bits that follow the first one. Registers of empty buckets borrow from others, in an order that all sets share, so
two sets agree in a register with a probability of their Jaccard similarity, whatever their sizes, but for collisions,
which the estimate takes off.

Bands of ROWS registers retrieve: at a similarity of 0.85 each of the 32 bands agrees with probability 0.27, so 0.004 % of
pairs are missed by calculation, fewer above. Members of a band's bucket first meet one leader of it, then
its member of most links. What is still in different components and shares that leader meets by the shingles that the leader lacks, or by the
leader alone where two sets share enough with it. All pairs but those with second leaders are estimated from registers; then sets are compared shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import batch, materialise, table, text_bytes
from itemforge.llm.components import components
from itemforge.llm.simhash import _shingle_set, _shingle_sets

REGISTERS, ROWS, MANTISSA = 256, 8, 10
BUCKET_BITS = REGISTERS.bit_length() - 1
BANDS = REGISTERS // ROWS
#: Deviations below the threshold that an estimate may be for the pair to be compared.
SLACK = 4.5
#: So many nodes at most are broadcast to find their texts; more go through a shuffle.
BROADCAST_NODES = 200_000
#: Members from which on a group's usual shingles are looked for.
LARGE = 8
#: From which bucket an empty one borrows, attempt after attempt.
_PROBES = np.random.Generator(np.random.PCG64(11)).integers(0, REGISTERS, (REGISTERS * 16, REGISTERS))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers (uint16) of a set of hashes in ascending order, which must not be empty."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    full, first = np.unique(bucket, return_index=True)
    rest = (hashes[first] << np.uint64(BUCKET_BITS)) | np.uint64((1 << BUCKET_BITS) - 1)
    zeros = np.zeros(len(rest), np.uint64)
    moved = rest.copy()
    for step in (32, 16, 8, 4, 2, 1):
        small = moved < np.uint64(1 << (64 - step))
        zeros[small] += np.uint64(step)
        moved[small] <<= np.uint64(step)
    value = (zeros << np.uint64(MANTISSA)) | ((moved << np.uint64(1)) >> np.uint64(64 - MANTISSA))
    out, known = np.zeros(REGISTERS, np.uint16), np.zeros(REGISTERS, bool)
    out[full], known[full] = value.astype(np.uint16), True
    missing = np.flatnonzero(~known)
    for probe in _PROBES:
        if not len(missing):
            return out
        lender = probe[missing]
        lent = known[lender]
        out[missing[lent]] = out[lender[lent]]
        missing = missing[~lent]
    out[missing] = out[full[0]]
    return out


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The probability that registers of sets without common elements, of these sizes, agree by chance."""
    level = 2.0 ** -np.arange(64 - BUCKET_BITS)
    # A bucket's least of k hashes has z leading zeros if all are above 2 ** -(z + 1) and not all above 2 ** -z.
    at = lambda k: np.exp(-np.maximum(k, REGISTERS)[:, None] / REGISTERS * level / 2) - np.exp(-np.maximum(k, REGISTERS)[:, None] / REGISTERS * level)
    return (at(n) * at(m)).sum(axis=1) / (1 << MANTISSA)


def estimates(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarities of pairs of sets from their registers (a row a set) and sizes, collisions taken off."""
    chance = collisions(n, m)
    return ((x == y).mean(axis=1) - chance) / (1 - chance)


def sketches(docs: DataFrame, shingle_words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, s0, s1, n, registers): of each whole text the name of its set of shingles, the set's size and its registers (null for none)."""
    schema = pa.schema([(key, pa.int64()), ("s0", pa.int64()), ("s1", pa.int64()), ("n", pa.int64()), ("registers", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = ((_shingle_set(t.as_py(), shingle_words)) for t in b.column(1))
            rows = [(s0, s1, len(h), registers(h).tobytes() if len(h) else None) for h, s0, s1 in sets]
            yield batch({key: b.column(0)} | {c: [r[k] for r in rows] for k, c in enumerate(("s0", "s1", "n", "registers"))}, schema)

    return docs.select(F.col(key).cast("long").alias(key), text_bytes(text)).mapInArrow(run, f"{key} long, s0 long, s1 long, n long, registers binary")


def buckets(nodes: DataFrame) -> DataFrame:
    """(k, node, n): the bands of each node that another shares; size is that of the bucket."""
    keys = [F.xxhash64(F.lit(j), F.substring("registers", 2 * ROWS * j + 1, 2 * ROWS)) for j in range(BANDS)]
    each = nodes.select("node", "n", F.explode(F.array(*keys)).alias("k"))
    shared = each.groupBy("k").agg(F.count("*").alias("size")).filter("size > 1")
    return each.join(shared, "k").select("k", "node", "n", "size")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _likely(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose registers don't rule this similarity out."""
    x, y = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("registers").alias(f"r{c}")) for c in ("a", "b"))
    met = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "ra", "rb")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n, m = (b.column(k).to_numpy().astype(float) for k in (2, 3))
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5))
            least = similarity - SLACK * np.sqrt(similarity * (1 - similarity) / np.minimum(REGISTERS, np.minimum(n, m)))
            take = np.flatnonzero(estimates(x, y, n, m) >= least)
            yield batch({"a": b.column(0).take(pa.array(take)), "b": b.column(1).take(pa.array(take))}, schema)

    return met.mapInArrow(run, "a long, b long")


def _sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, shingle_words: int, text: str, key: str) -> DataFrame:
    """(node, hashes): the sets of shingles of these nodes, from whole texts."""
    few = wanted.count() <= BROADCAST_NODES
    held = _shingle_sets(docs.join(F.broadcast(wanted) if few else wanted, docs[key].cast("long") == wanted["node"], "left_semi"), shingle_words, text, key)
    # Rows may share a key and have other texts.
    return held.join(nodes.select("node", "s0", "s1"), ["node", "s0", "s1"]).dropDuplicates(["node", "s0", "s1"]).select("node", "hashes")


def _against(pairs: DataFrame, held: DataFrame, share: Fraction, usual: DataFrame | None = None) -> DataFrame:
    """The different pairs (node, leader) with sizes n and n_leader, the number `common` of shingles in both, by whole sets, and `own`. Shingles of usual (leader, usual) count as the leader's.

    own: of the node's shingles that the leader lacks, in ascending order, so many that any set similar to the node that needs one of them has one among the first ones of its own as well.
    A similar set shares share * n shingles with the node, at most `common` of them with the leader too; so of the others the last ones that must be shared may be left out.
    """
    pairs = materialise(pairs.distinct(), "pairs")
    met = pairs.join(held.select("node", F.col("hashes").alias("x")), "node").join(held.select(F.col("node").alias("leader"), F.col("hashes").alias("y")), "leader")
    if usual is not None:
        met = met.join(usual, "leader").withColumn("y", F.array_union("y", "usual"))
    sized = met.select("node", "leader", F.size("x").alias("n"), F.size("y").alias("n_leader"), F.array_except("x", "y").alias("own")).withColumn("common", F.col("n") - F.size("own"))
    needed = F.greatest(F.lit(1), F.expr(f"(n * {share.numerator} + {share.denominator - 1}) div {share.denominator} - common").cast("int"))
    return materialise(sized.withColumn("own", F.slice(F.array_sort("own"), F.lit(1), F.greatest(F.lit(0), F.size("own") - needed + 1))), "compared")


def _similar(n: Column, m: Column, both: Column, share: Fraction) -> Column:
    """Whether sets of n and m elements with so many in both have this Jaccard similarity or more; also with bounds from above for both."""
    return both * (share.denominator + share.numerator) >= (n + m) * share.numerator


def _links(compared: DataFrame, share: Fraction) -> DataFrame:
    return compared.filter(_similar(F.col("n"), F.col("n_leader"), F.col("common"), share)).select(*_pair("node", "leader"))


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows (node, ...) with each node's component c, the component's size c_size and the node's number of links deg."""
    found = components(links, "a", "b")
    sized = found.join(found.groupBy("component").agg(F.count("*").alias("c_size")), "component").withColumnRenamed("component", "c")
    deg = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("deg"))
    known = rows.join(sized.join(deg, "node", "left"), "node", "left")
    return known.withColumns({"c": F.coalesce("c", "node"), "c_size": F.coalesce("c_size", F.lit(1)), "deg": F.coalesce("deg", F.lit(0))})


def near_duplicates(docs: DataFrame, shingle_words: int = 3, similarity: float = 0.85, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id): the smallest key that chains of pairs with this Jaccard similarity, or more, reach from each document, itself included.

    Texts with one set of shingles are a node, named by its smallest key. Null, empty and wordless texts have no shingles and are
    linked with nothing, so each is its own component. Rows without a key are no documents; repeated rows keep their number. Texts are
    read whole, whatever their length; further columns of docs are not read, so their names are free.
    """
    share = Fraction(str(similarity))
    docs = docs.select(key, text).filter(F.col(key).isNotNull())
    each = materialise(sketches(docs, shingle_words, text, key), "sketches")
    full = each.filter("n > 0")
    nodes = materialise(full.groupBy("s0", "s1", "n").agg(F.min(F.struct(F.col(key).alias("node"), "registers")).alias("first")).select("s0", "s1", "n", "first.node", "first.registers"), "nodes")
    met = materialise(buckets(nodes), "buckets")

    wanted = materialise(met.select("node").distinct(), "wanted")
    held = materialise(_sets(wanted, docs, nodes, shingle_words, text, key), "sets")

    # First leaders, one a bucket: the least by an order of the bucket's own, so that a large group has many.
    turned = F.col("node").bitwiseXOR(F.xxhash64("k"))
    first = met.groupBy("k").agg(F.min(turned).bitwiseXOR(F.xxhash64("k")).alias("leader"))
    pairs = materialise(met.join(first, "k").filter("node <> leader").select(*_pair("node", "leader")).distinct(), "leaders")
    links = _links(_against(_likely(pairs, nodes, similarity).toDF("node", "leader"), held, share), share)

    # Then each bucket's member of most links. In a bucket of two there is nobody else.
    labels = materialise(_labelled(met.filter("size > 2"), links), "labels")
    best = labels.groupBy("k").agg(F.max(F.struct("deg", "node")).alias("best"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("k", F.col("best.node").alias("leader"))
    apart = labels.join(best, "k").filter("node <> leader")
    told = _against(apart.select("node", "leader"), held, share)
    links = materialise(links.union(_links(told, share)).distinct(), "links")

    # What stays apart meets below its leader. Two sets that share too little with it need a shingle that it lacks; only the others meet by the leader alone.
    member = _labelled(told.drop("n_leader"), links)
    groups = member.groupBy("leader").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("members")).filter("c0 <> c1").select("leader", "members")
    member = materialise(member.join(groups, "leader").withColumn("o", F.struct("c_size", "c")).select("leader", "members", "node", "n", "common", "o", "own"), "members")
    # Where a leader was changed, all others have what it lacks. What most members of a large group have counts as the leader's.
    usual = member.filter(F.col("members") >= LARGE).select("leader", "members", F.explode("own").alias("shingle")).groupBy("leader", "members", "shingle").agg(F.count("*").alias("having"))
    usual = materialise(usual.filter("2 * having > members").groupBy("leader").agg(F.collect_list("shingle").alias("usual")), "usual")
    again = _against(member.join(usual, "leader", "left_semi").select("node", "leader"), held, share, usual).select("leader", "node", "n", "common", "own").join(member.select("leader", "node", "o"), ["leader", "node"])
    member = materialise(member.join(usual, "leader", "left_anti").select("leader", "node", "n", "common", "own", "o").union(again), "met")
    x, y = member.alias("x"), member.alias("y")
    apart = (F.col("x.leader") == F.col("y.leader")) & (F.col("x.o") < F.col("y.o"))
    close = x.join(y, apart & _similar(F.col("x.n"), F.col("y.n"), F.least("x.common", "y.common"), share))
    lacked = member.select("leader", "node", "n", "common", "o", F.explode("own").alias("shingle"))
    x, y = lacked.alias("x"), lacked.alias("y")
    most = F.least("x.common", "y.common") + F.least(F.col("x.n") - F.col("x.common"), F.col("y.n") - F.col("y.common"))
    sharing = x.join(y, apart & (F.col("x.shingle") == F.col("y.shingle")) & _similar(F.col("x.n"), F.col("y.n"), most, share))
    left = materialise(close.select(*_pair("x.node", "y.node")).union(sharing.select(*_pair("x.node", "y.node"))).distinct(), "apart")
    links = links.union(_links(_against(_likely(left, nodes, similarity).toDF("node", "leader"), held, share), share))

    found = components(links, "a", "b")
    named = nodes.join(found, "node", "left").select("s0", "s1", F.coalesce("component", "node").alias("component_id"))
    alone = each.filter("n = 0").select(key, F.col("n").alias("n_shingles"), F.col(key).alias("component_id"))
    return full.join(named, ["s0", "s1"]).select(key, F.col("n").alias("n_shingles"), "component_id").union(alone)


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id") == F.col("component_id"))
