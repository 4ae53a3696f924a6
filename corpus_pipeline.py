"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Each stage works on all its predecessor kept. The first three filter documents, the fourth rewrites texts, the last
returns where each piece of each document stands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm import decontaminate, packing, quality, secrets, simhash
from itemforge.llm.common import shared_path, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps, judged row by row by the bits of a stored ledger; null and empty texts go, rows without an id are judged as all others. No rows give no rows."""
    return quality.kept_rows(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more, chains included) the document with the smallest id. Rows that share an id stay or go together; those without one stay. Texts without words are one group."""
    groups = simhash.similar_groups(docs)
    gone = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark question; rows without an id stay, as do null and empty texts. Rows that share an id go together."""
    leaks = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, row by row, secrets replaced by their kind in brackets, n_chars that of the new text; a null text stays null, as does its n_chars."""
    return secrets.redacted(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands; null and empty texts are their end token, repeated rows and rows without an id are packed as often as they occur."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SimHash sketches, template windows and packing have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
