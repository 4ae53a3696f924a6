"""Source divergence audit: exact sums over whole vocabularies by inclusion-exclusion over the terms that sources have.

A source's share p of a term depends on its count alone, and is one constant z where the count is zero. So the sum of f(p, q) over all
V terms of a language is, for two sources g and h,

    sum over the terms of g of f(p_g, z_h)  +  sum over the terms of h of f(z_g, p_h)  +  (V - |g| - |h|) f(z_g, z_h)
    + sum over the terms of both of f(p_g, p_h) - f(p_g, z_h) - f(z_g, p_h) + f(z_g, z_h).

The first line needs a histogram of counts for each source and no terms; only the second meets two sources in a
term, in its posting list, and a task sums the corrections of its terms by pairs of sources before they travel.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itemforge.llm.common import batch, materialise, table, text_bytes

TERM = re.compile(rb"[a-z\x80-\xff]+")
LEAST_DOCS = 3
#: Shares are whole numbers of this part of one.
PARTS = 1_000_000_000
RANKS = 200
#: Counts that a task holds before it hands them on, and corrections computed at once.
HELD, AT_ONCE = 400_000, 1_000_000


def term_counts(docs: DataFrame) -> DataFrame:
    """docs (lang, source, text) to (lang, source, term, n, docs): occurrences, and rows that have the term."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, having) in held.items():
                terms = list(n)
                yield batch({"lang": [lang] * len(terms), "source": [source] * len(terms), "term": pa.array(terms, pa.binary()).cast(pa.string()), "n": list(n.values()), "docs": [having[t] for t in terms]}, schema)

        for b in batches:
            for lang, source, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                n, having = held.setdefault((lang, source), (Counter(), Counter()))
                found = Counter(TERM.findall(body.as_py().lower()))
                n.update(found)
                having.update(found.keys())
            if sum(len(n) for n, _ in held.values()) >= HELD:
                yield from told()
                held.clear()
        yield from told()

    parts = docs.select("lang", "source", text_bytes("text")).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term with n of `total` occurrences among so many terms, at least 1; null without terms."""
    whole = F.call_function("div", (n + 1).cast("decimal(19,0)") * F.lit(PARTS).cast("decimal(19,0)"), (total + terms).cast("decimal(20,0)")).cast("long")
    return F.when(terms > 0, whole + 1)


def _gap(p: Column, q: Column) -> Column:
    """f: the squared difference of two shares over the second, rounded down."""
    return F.call_function("div", (p - q) * (p - q), q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _corrections(source: np.ndarray, p: np.ndarray, z: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(g, h, correction) of all ordered pairs of sources in each posting list; the lists begin at starts, which holds their end as well. AT_ONCE pairs a time, a long list in slices."""

    def told(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j = i[i != j], j[i != j]
        return source[i], source[j], _gaps(p[i], p[j]) - _gaps(p[i], z[j]) - _gaps(z[i], p[j]) + _gaps(z[i], z[j])

    sizes = np.diff(starts)
    for size in np.unique(sizes[sizes > 1]).tolist():
        lists = starts[:-1][sizes == size]
        if size * size <= AT_ONCE:
            each, grid = AT_ONCE // (size * size), np.indices((size, size)).reshape(2, -1)
            for k in range(0, len(lists), each):
                yield told(*((lists[k : k + each, None] + at).ravel() for at in grid))
        else:
            rows = max(1, AT_ONCE // size)
            for begin in lists.tolist():
                for k in range(0, size, rows):
                    few = np.arange(k, min(size, k + rows))
                    yield told(begin + np.repeat(few, size), begin + np.tile(np.arange(size), len(few)))


def overlaps(postings: DataFrame) -> DataFrame:
    """postings (lang, list of (source, p, z)), a row a term, to (lang, g, h, correction) for the pairs of sources that share a term."""
    schema = pa.schema([("lang", pa.string()), ("g", pa.string()), ("h", pa.string()), ("correction", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            flat = lists.flatten()
            lang = b.column(0).dictionary_encode()
            starts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            names = flat.field(0).dictionary_encode()
            many = len(names.dictionary)
            group = np.repeat(lang.indices.to_numpy().astype(np.int64), np.diff(starts)) * many + names.indices.to_numpy()
            sums: dict[tuple[int, int], int] = {}
            for g, h, value in _corrections(group, flat.field(1).to_numpy(), flat.field(2).to_numpy(), starts):
                keys, of = np.unique(g * (many * len(lang.dictionary)) + h, return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, of, value)
                for k, v in zip(keys.tolist(), total.tolist(), strict=True):
                    sums[k] = sums.get(k, 0) + v
            if sums:
                g, h = np.divmod(np.array(list(sums), np.int64), many * len(lang.dictionary))
                at = lambda x: names.dictionary.take(pa.array(x % many))
                yield batch({"lang": lang.dictionary.take(pa.array(g // many)), "g": at(g), "h": at(h), "correction": list(sums.values())}, schema)

    return postings.mapInArrow(run, "lang string, g string, h string, correction long").groupBy("lang", "g", "h").agg(F.sum("correction").alias("correction"))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audited(docs: DataFrame, ranks: int = RANKS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from every other of its language, and by which terms from the whole language.

    docs has lang, source and text; nulls count as empty strings, so they are a language and a source of their own. Rows are documents, repeated ones too;
    an empty or null text has no terms, but its source occurs. Texts are read whole. Further columns are not read. No rows give no rows.
    """
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    every = named.select("lang", "source").distinct()
    counts = term_counts(named).groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("list"), F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    kept = materialise(counts.filter(F.col("docs") >= least_docs).drop("docs"), "terms")
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    each = kept.select("lang", F.inline("list"))
    histogram = materialise(each.groupBy("lang", "source", "n").agg(F.count("*").alias("m")), "histogram")
    sizes = histogram.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("total"), F.sum("m").alias("support"))
    groups = every.join(sizes, ["lang", "source"], "left").join(per_lang, "lang", "left").na.fill(0, ["total", "support", "v", "total_lang"])
    groups = materialise(groups.withColumn("z", _share(F.lit(0).cast("long"), F.col("total"), F.col("v"))), "groups")

    # Pairs of sources: both-zero terms by a constant, one-sided terms by histograms, terms of both by posting lists.
    x, y = (groups.select("lang", F.col("source").alias(c), F.col("support").alias(f"n{c}"), F.col("z").alias(f"z{c}"), *(["v"] if c == "g" else [])) for c in ("g", "h"))
    pairs = x.join(y, "lang").filter("g <> h")
    neither = pairs.select("lang", "g", "h", F.coalesce((F.col("v") - F.col("ng") - F.col("nh")) * _gap(F.col("zg"), F.col("zh")), F.lit(0)).alias("value"))
    priced = histogram.join(groups.select("lang", "source", "total", "v"), ["lang", "source"]).select("lang", "source", "m", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    steps = priced.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("steps"))
    summed = lambda f: F.aggregate("steps", F.lit(0).cast("long"), lambda acc, s: acc + s["m"] * f(s["p"]))
    other = groups.select("lang", F.col("source").alias("other"), "z")
    one_sided = steps.join(other, "lang").filter("source <> other")
    left = one_sided.select("lang", F.col("source").alias("g"), F.col("other").alias("h"), summed(lambda p: _gap(p, F.col("z"))).alias("value"))
    right = one_sided.select("lang", F.col("other").alias("g"), F.col("source").alias("h"), summed(lambda p: _gap(F.col("z"), p)).alias("value"))
    shares = kept.select("lang", "term", "n_lang", F.inline("list")).join(groups.select("lang", "source", "total", "v", "total_lang", "z"), ["lang", "source"])
    shares = shares.select("lang", "source", "term", "z", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), _share(F.col("n_lang"), F.col("total_lang"), F.col("v")).alias("q"))
    shares = materialise(shares, "shares")
    both = overlaps(shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "z")).alias("list")).select("lang", "list"))
    value = neither.union(left).union(right).union(both).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    pair_rows = _ranked(value.select("lang", F.col("g").alias("source"), F.lit("pair").alias("part"), F.col("h").alias("item"), "value"))

    over = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    return pair_rows.union(_ranked(over).filter(F.col("rank") <= ranks))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of the documents' sources."""
    return audited(table(spark, sf_dir, "documents"))
