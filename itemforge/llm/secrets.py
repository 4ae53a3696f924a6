"""Secret scans over a trigram inverted index, in DataFrame operations only.

Each rule's regular expression gives a Boolean trigram query: an OR of alternatives, each an AND of the trigrams
that a match must contain. The index holds a posting (trigram, key) for every trigram that some query asks for.
Intersecting postings gives the candidates of each rule, and the regular expression verifies them. A rule without
mandatory trigrams scans every text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import materialise, table

try:
    from re import _constants as _op
    from re import _parser
except ImportError:  # before Python 3.11
    import sre_constants as _op
    import sre_parse as _parser


@dataclass(frozen=True)
class Rule:
    """A match counts if group `group` has at_least characters."""

    kind: str
    regex: str
    group: int = 0
    at_least: int = 1


#: The three base kinds. A run of hexadecimal digits, or of capitals and digits after AKIA, is as long
#: as it can be, so a lower bound in the pattern finds the same matches as a filter after it.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Formats that public issuers document.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES
#: More alternatives than this make a rule scan every text.
MAX_ALTERNATIVES = 64


def _runs(tree) -> list[tuple[str | None, ...]] | None:
    """The alternatives of a parsed pattern as sequences of letters, None standing for anything; None if there are too many."""
    found: list[tuple] = [()]
    for op, arg in tree:
        if op is _op.LITERAL:
            each: list[tuple] | None = [(chr(arg).lower(),)]
        elif op is _op.SUBPATTERN:
            each = _runs(arg[3])
        elif op is _op.BRANCH:
            parts = [_runs(x) for x in arg[1]]
            each = None if None in parts else [x for part in parts for x in part]
        elif op in (_op.MAX_REPEAT, _op.MIN_REPEAT):
            least, most, inner = arg
            part = _runs(inner)
            each = None if part is None else [(), *part] if (least, most) == (0, 1) else [(None,)] if least == 0 else [x if (least, most) == (1, 1) else (*x, None, *x) if least > 1 else (*x, None) for x in part]
        elif op is _op.AT:
            each = [()]
        else:
            each = [(None,)]
        if each is None or len(found) * len(each) > MAX_ALTERNATIVES:
            return None
        found = [a + b for a in found for b in each]
    return found


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Alternatives of a pattern as sets of folded trigrams of which a match holds one set whole; empty if it must scan every text."""
    runs = _runs(_parser.parse(regex))
    if runs is None:
        return []
    sets = []
    for run in runs:
        letters = "".join(c or "\0" for c in run)
        sets.append(frozenset(t for i in range(len(letters) - 2) if "\0" not in (t := letters[i : i + 3])))
    if not all(sets):
        return []
    return [s for s in dict.fromkeys(sets) if not any(other < s for other in sets)]


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The inverted index (trigram, key): each trigram that a rule asks for, with the documents whose folded text holds it."""
    wanted = sorted({t for r in rules for s in trigram_query(r.regex) for t in s})
    held = docs.select(F.col(key).alias(key), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("folded"))
    has = [F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in wanted]
    every = F.array(*has) if has else F.array().cast("array<string>")
    return held.select(key, F.explode(F.array_compact(every)).alias("trigram")).filter(F.col(key).isNotNull())


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id") -> DataFrame:
    """(key, rules long): bit k is set if the postings of some alternative of rule k all name the document."""
    spark = index.sparkSession
    asked = [(k * MAX_ALTERNATIVES + n, t, len(s), 1 << k) for k, r in enumerate(rules) for n, s in enumerate(trigram_query(r.regex)) for t in sorted(s)]
    terms = spark.createDataFrame(asked, "conj int, trigram string, needed int, bit long")
    # The query table has one row for each trigram of each rule, so its size is that of the rules.
    met = index.join(F.broadcast(terms), "trigram").groupBy(key, "conj", "needed", "bit").agg(F.count_distinct("trigram").alias("n"))
    return met.filter("n = needed").groupBy(key).agg(F.bit_or("bit").alias("rules"))


def _once(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x), with x worked out once: a lambda's argument is a value, where a column would be copied to each place that names it."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _blocks(x: Column) -> Column:
    """An array in runs of about the square root of its length."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(x))).cast("int"))
    return F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(1), F.size(x), width), lambda i: F.slice(x, i, width))).otherwise(F.array(F.slice(x, 1, 0)))


def _scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of ints what op makes of all before it, from 0 on. Appending copies an array, so it is done in runs: the work grows with n * sqrt(n)."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, v: F.struct(op(acc["at"], v).cast("int").alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
    runs = F.transform(_blocks(values), lambda run: F.aggregate(run, empty, step))
    ahead = lambda done: F.aggregate(F.transform(done, lambda r: r["at"]), empty, step, lambda acc: acc["out"])
    return _once(runs, lambda done: F.flatten(F.zip_with(done, ahead(done), lambda r, before: F.transform(r["out"], lambda v: op(before, v).cast("int")))))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, order, end>> of a rule's matches in code points. Text between matches and matches alternate, so lengths give places."""
    regex, group = F.lit(rule.regex), F.lit(rule.group)
    lengths = lambda x: F.transform(x, lambda v: F.length(v))
    whole = lengths(F.regexp_extract_all(text, regex, F.lit(0)))
    value = lengths(F.regexp_extract_all(text, regex, group)) if rule.group else F.array().cast("array<int>")
    met = F.struct(lengths(F.split(text, rule.regex, -1)).alias("gaps"), whole.alias("whole"), value.alias("value"))

    def placed(m: Column) -> Column:
        pairs = F.zip_with(F.slice(m["gaps"], F.lit(1), F.size(m["whole"])), m["whole"], lambda g, w: g + w)
        each = F.arrays_zip(_scan(pairs, lambda a, b: a + b).alias("before"), F.slice(m["gaps"], F.lit(1), F.size(m["whole"])).alias("gap"), m["whole"].alias("whole"), (m["value"] if rule.group else m["whole"]).alias("value"))
        long = F.filter(each, lambda x: x["value"] >= rule.at_least)
        return F.transform(long, lambda x: F.struct((x["before"] + x["gap"]).alias("start"), F.lit(order).alias("order"), (x["before"] + x["gap"] + x["whole"]).alias("end")))

    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    return F.when(text.rlike(rule.regex), _once(met, placed)).otherwise(none)


def _found(docs: DataFrame, rules: tuple[Rule, ...], text: str, key: str) -> DataFrame:
    """(_row, secrets): each row of docs as a struct, with its spans."""
    found = candidates(materialise(postings(docs, rules, text, key), "postings"), rules, key).select(F.col(key).alias("_key"), F.col("rules").alias("_rules"))
    everything = (1 << len(rules)) - 1
    always = sum(1 << k for k, r in enumerate(rules) if not trigram_query(r.regex))
    # A row travels as one struct, so no name of its columns can meet one of ours.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(key).alias("_id"))
    joined = rows.join(found, F.col("_id") == F.col("_key"), "left")
    mask = F.when(F.col("_id").isNull(), F.lit(everything)).otherwise(F.coalesce("_rules", F.lit(0)).bitwiseOR(F.lit(always)))
    told = joined.select("_row", F.coalesce(F.col("_row")[text], F.lit("")).alias("_text"), mask.alias("_mask"))
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    each = [F.when(F.col("_mask").bitwiseAND(F.lit(1 << k)) != 0, _spans(F.col("_text"), r, k)).otherwise(none) for k, r in enumerate(rules)]
    return told.select("_row", F.array_sort(F.concat(*each)).alias("secrets"))


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with secrets array<struct<start, order, end>>: the spans of every rule in code points, end exclusive, by start and rule; a column of docs with that name gives way.

    Null and empty texts have none. Rows with a null key are outside the index and scanned whole; rows that share a key
    share its candidates, of which verification keeps each row's own. Texts of any length are scanned whole.
    """
    return _found(docs, rules, text, key).select(*(F.col("_row")[c].alias(c) for c in docs.columns if c != "secrets"), "secrets")


def _without(text: Column, spans: Column, kinds: Column) -> Column:
    """A text with each run of overlapping spans replaced by the name of its first. The text is cut in two steps, into stretches of many runs and these into pieces, so nothing is counted from its start for each span."""
    ends = lambda s: F.transform(s, lambda x: x["end"])

    def merged(s: Column) -> Column:
        known = F.zip_with(s, _scan(ends(s), F.greatest), lambda x, before: F.struct(x["start"].alias("start"), x["order"].alias("order"), before.alias("before")))
        first = F.filter(known, lambda x: x["start"] >= x["before"])
        # A run ends where the farthest of its spans does: what the next run's first span saw before it.
        until = lambda f: F.concat(F.transform(F.slice(f, F.lit(2), F.greatest(F.size(f) - 1, F.lit(0))), lambda x: x["before"]), F.array(F.array_max(ends(s))))
        return _once(first, lambda f: F.zip_with(f, until(f), lambda x, end: F.struct(x["before"].alias("before"), x["start"].alias("start"), x["order"].alias("order"), end.alias("end"))))

    def stretch(run: Column) -> Column:
        begin = F.get(run, F.lit(0))["before"]
        piece = F.substring(text, begin + 1, F.get(run, F.size(run) - 1)["start"] - begin)
        told = lambda t: F.array_join(F.transform(run, lambda x: F.concat(F.substring(t, x["before"] - begin + 1, x["start"] - x["before"]), F.get(kinds, x["order"]))), "")
        return _once(piece, told)

    rest = F.substring(text, F.array_max(ends(spans)) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(F.transform(_once(merged(spans), _blocks), stretch), ""), rest))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with each secret in text replaced by its rule's name in brackets; overlapping spans give way to the first. A null text stays null."""
    kinds = F.array(*(F.lit(f"[{r.kind}]") for r in rules))
    held = _found(docs, rules, text, key).select("_row", F.inline(F.array(F.struct("secrets", F.col("_row")[text].alias("_text")))))
    clean = _without(F.col("_text"), F.col("secrets"), kinds)
    return held.select(*(clean.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns))


def _joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["order"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts of the base kinds, a digest of their spans, and all spans."""
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda x: x["order"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("secrets", lambda x: x["order"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)),
        F.sha2(_joined(base, RULES).cast("binary"), 256).alias("base_sha256"), _joined(F.col("secrets"), RULES).alias("spans"),
    )
