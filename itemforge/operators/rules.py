"""A rule engine: rules are rows of (name, severity, predicate, message), evaluated in one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARNING = "error", "warning"


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    breaks: Column


def judged(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """rows with errors, warnings (arrays of names) and status. A predicate that is null doesn't break its rule."""
    named = lambda severity: F.array_compact(F.array(*(F.when(r.breaks, F.lit(r.name)) for r in rules if r.severity == severity), F.lit(None).cast("string")))
    out = rows.withColumns({"errors": named(ERROR), "warnings": named(WARNING)})
    return out.withColumn("status", F.when(F.size("errors") > 0, "validation_error").when(F.size("warnings") > 0, "approved_with_warnings").otherwise("approved"))


def report(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.size("errors")).alias("n_errors"), F.sum(F.size("warnings")).alias("n_warnings"))
