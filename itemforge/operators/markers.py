"""Numbers of items that recognition broke: by patterns on the text, and by what else a document's lines say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemforge.functions.repairs import rewritten
from itemforge.operators.headings import found

#: A number inside a formula with a star; then patterns with their replacements, in the order in which they apply.
STARRED = r"\$\\(?:star|bigstar|ast)\b(?:[^$\d]*?)(\d+(?:[\s.]\d+)*)\s*\.\s*\$\s*"
PASSES = (
    (r"\$\\(?:star|bigstar|ast)\$\s*(\d+(?:\.\d+)*\.?)\s*", "$1 "),
    (r"\\\*(\d+(?:\.\d+)*\.?)", "$1"),
    (r"\$[^$\d]*\\(?:star|bigstar|ast)\b[^$\d]*\$\s*(\d+(?:\.\d+)*\.?)\s*", "$1 "),
    (r"(?m)^(\d{1,2}\.)([A-ZÁÀÂÃÉÊÍÓÔÕÚÇ])", "$1 $2"),
    (r"(?m)^(\d{1,2}\.\d{1,2}\.)([A-ZÁÀÂÃÉÊÍÓÔÕÚÇ])", "$1 $2"),
    (r"(?m)^(\d{1,2}) (?=[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ])", "$1. "),
)
SUB_LABEL, MAIN_LABEL = r"^(?:\\[*] )?(\d{1,2}\.\d+)\. ", r"^(?:\\[*] )?(\d{1,2})\. "
JOINED, STAR_ALONE = r"^(\d)([1-9])\. ", r"^\\[*] (?!\d)"


def unstarred(x: Column) -> Column:
    """A text whose items' numbers stand without stars and formulas around them, with a point and a blank behind."""
    now = rewritten(x, STARRED, lambda m: F.concat(F.regexp_replace(F.regexp_extract(m, STARRED, 1), r"\s+", ""), F.lit(". ")))
    for pattern, to in PASSES:
        now = F.regexp_replace(now, pattern, to)
    return now


def parted_numbers(lines: DataFrame, key: str) -> DataFrame:
    """lines (key, pos, line) with `42. ` made `4.2. ` where the document has 4.1 as well.

    The labels of the document's sub-items are a table of their own; only lines that might be such a number meet them.
    """
    labels = lines.select(key, found(F.col("line"), SUB_LABEL).alias("label")).filter("label IS NOT NULL").distinct()
    x, y = found(F.col("line"), JOINED, 1), found(F.col("line"), JOINED, 2)
    before = F.when(y.cast("int") > 1, F.concat(x, F.lit("."), (y.cast("int") - 1).cast("string")))
    asked = lines.filter(x.isNotNull()).select(key, "pos", F.explode(F.array_compact(F.array(before, F.concat(x, F.lit(".1"))))).alias("label"))
    sure = asked.join(labels, [key, "label"], "left_semi").select(key, "pos").distinct().withColumn("_sure", F.lit(True))
    return lines.join(sure, [key, "pos"], "left").select(key, "pos", F.when(F.col("_sure"), F.regexp_replace("line", JOINED, r"$1.$2. ")).otherwise(F.col("line")).alias("line"))


def told_stars(lines: DataFrame, key: str) -> DataFrame:
    """lines with a number behind a star that stands alone: one less than the next main item's, if that isn't the first."""
    following = F.first(found(F.col("line"), MAIN_LABEL).cast("int"), True).over(W.partitionBy(key).orderBy("pos").rowsBetween(1, W.unboundedFollowing))
    number = F.when(F.col("line").rlike(STAR_ALONE) & (F.col("_next") > 1), F.col("_next") - 1)
    named = F.concat(F.lit("\\* "), number.cast("string"), F.lit(". "), F.expr("substring(line, 4)"))
    return lines.withColumn("_next", following).select(key, "pos", F.coalesce(named, "line").alias("line"))


def marked(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text) of documents with their items' numbers mended, first by patterns, then by what other lines of the document say. Null texts are left out; rows that share a key are one document."""
    lines = docs.select(key, F.posexplode(F.split(unstarred(F.col(text)), "\n")).alias("pos", "line"))
    done = told_stars(parted_numbers(lines, key), key)
    return done.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("text"))
