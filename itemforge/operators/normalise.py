"""Repairs of exam Markdown that need a document's lines in order: parts, stray and broken line numbers, observations, contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemforge.functions.repairs import LOWER, MARGIN, UPPER, broken_margin
from itemforge.operators.headings import GROUP_HEADING, group_of, part_of

LONE_PART = r"^\s*\**\s*([A-C])\s*\**\s*$"


def _numbered(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))


def joined(lines: DataFrame, key: str, line: str = "line") -> DataFrame:
    """(key, text): lines put together in order."""
    return lines.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col(line).alias("l")))), lambda x: x["l"]), "\n").alias("text"))


def _found(line: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, 1), F.lit(""))


def promoted_parts(lines: DataFrame, key: str) -> DataFrame:
    """lines (key, pos, line) with a lone letter inside a group made a heading, if it is the next that the group's parts expect: A, then B, then C.

    A letter is promoted once: it is the first of its kind in the group after the first heading, or first letter, of the letter before it.
    """
    opened = F.count_if(group_of(F.col("line")).isNotNull()).over(W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    headed = part_of(F.col("line"))
    lone = F.when(headed.isNull(), _found(F.col("line"), LONE_PART))
    rows = lines.withColumns({"_group": opened, "_headed": headed, "_lone": lone})
    group = W.partitionBy(key, "_group")
    either = lambda letter: F.when((F.col("_headed") == letter) | (F.col("_lone") == letter), F.col("pos"))
    # Where a letter counts as seen first: A at once, B after A, C after B; a heading counts wherever it stands.
    head = {x: F.min(F.when(F.col("_headed") == x, F.col("pos"))).over(group) for x in "ABC"}
    rows = rows.withColumns({f"_h{x}": head[x] for x in "ABC"}).withColumn("_any", F.least("_hA", "_hB", "_hC"))
    first_a = F.least("_hA", F.min(F.when((F.col("_lone") == "A") & (F.col("_any").isNull() | (F.col("pos") < F.col("_any"))), F.col("pos"))).over(group))
    rows = rows.withColumn("_a", first_a)
    rows = rows.withColumn("_b", F.least("_hB", F.min(F.when((either("B") > F.col("_a")), F.col("pos"))).over(group)))
    rows = rows.withColumn("_c", F.least("_hC", F.min(F.when((either("C") > F.col("_b")), F.col("pos"))).over(group)))
    first = F.when(F.col("_lone") == "A", F.col("_a")).when(F.col("_lone") == "B", F.col("_b")).when(F.col("_lone") == "C", F.col("_c"))
    made = F.when((F.col("_group") > 0) & (first == F.col("pos")), F.concat(F.lit("## "), "_lone")).otherwise(F.col("line"))
    return rows.select(key, "pos", made.alias("line"))


def without_stray_ones(lines: DataFrame, key: str) -> DataFrame:
    """lines with a leading "1 " taken away where a line number 5 stands within the next eight lines and the next five numbers."""
    number = _found(F.col("line"), r"^(\d{1,3})\s+\S").cast("int")
    rows = W.partitionBy(key).orderBy("pos")
    marked = lines.withColumn("_n", number).withColumn("_count", F.count("_n").over(rows.rowsBetween(W.unboundedPreceding, 0)))
    five = F.min(F.when(F.col("_n") == 5, F.col("_count"))).over(rows.rowsBetween(1, 8))
    stray = (F.col("_n") == 1) & (five - F.col("_count") <= 5)
    return marked.withColumn("line", F.when(stray, F.regexp_replace("line", r"^1\s+", "")).otherwise(F.col("line"))).select(key, "pos", "line")


def restored_tens(lines: DataFrame, key: str, *zone: str) -> DataFrame:
    """lines, in each zone by itself, with a leading "0 " made the ten that the line numbers before and after it tell."""
    number = _found(F.col("line"), r"^(\d{1,3})\s").cast("int")
    known = F.when((number % 5 == 0) & number.between(5, 99), number)
    rows = W.partitionBy(key, *zone).orderBy("pos")
    marked = lines.withColumn("_n", known)
    marked = marked.withColumns({"_p": F.last("_n", True).over(rows.rowsBetween(W.unboundedPreceding, -1)), "_x": F.first("_n", True).over(rows.rowsBetween(1, W.unboundedFollowing))})
    guess = F.when(F.col("_x") - F.col("_p") == 10, F.col("_p") + 5).when(F.col("_p") % 10 == 5, F.col("_p") + 5).when(F.col("_x") % 10 == 5, F.col("_x") - 5)
    good = F.col("line").rlike(r"^0\s") & (guess > 0) & (guess % 10 == 0)
    return marked.withColumn("line", F.when(good, F.concat(guess.cast("string"), F.regexp_replace("line", r"^0\s", " "))).otherwise(F.col("line"))).select(key, *zone, "pos", "line")


def expected_numbers(candidates: DataFrame, by: str, order: str, value: str, at_start: str) -> DataFrame:
    """candidates (multiples of five in order) with taken: whether each is the next that is expected.

    The first that stands at a line's start sets the count; from there on a number is taken if it is five more than the last one taken. Numbers
    that are taken rise by five each, so a number is taken at its first place after that of the number five below: one step for each of the nineteen numbers there are, whatever the document's length.
    """
    first = candidates.filter(F.col(at_start)).groupBy(by).agg(F.min_by(F.struct(order, value), order).alias("_s"))
    places = candidates.groupBy(by, value).agg(F.array_sort(F.collect_list(order)).alias("_at"))
    tables = places.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct(value, "_at"))).alias("_places")).join(first, by)
    state = F.struct(F.col("_s")[order].alias("at"), F.col("_s")[value].alias("value"), F.array(F.col("_s")[order]).alias("out"))

    def step(acc: Column, k: Column) -> Column:
        after = F.get(F.filter(F.coalesce(F.col("_places")[acc["value"] + 5], F.array().cast("array<int>")), lambda p: p > acc["at"]), F.lit(0))
        return F.when(after.isNotNull(), F.struct(after.alias("at"), (acc["value"] + 5).alias("value"), F.array_append(acc["out"], after).alias("out"))).otherwise(acc)

    taken = tables.select(by, F.aggregate(F.sequence(F.lit(1), F.lit(19)), state, step, lambda acc: acc["out"]).alias("_taken"))
    return candidates.join(taken, by, "left").withColumn("taken", F.coalesce(F.array_contains("_taken", F.col(order)), F.lit(False))).drop("_taken")


def bracketed_observations(lines: DataFrame, key: str) -> DataFrame:
    """lines with numbers between "Observações" and the next heading in brackets, so that they aren't taken for items."""
    opens = F.col("line").rlike(r"(?iu)^\**\s*observa[çc][õo]es\s*:?\s*\**\s*:?\s*$")
    rows = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    state = F.last(F.when(opens, True).when(F.col("line").rlike(r"^#{1,3}\s"), False), True).over(rows)
    inside = F.coalesce(state, F.lit(False)) & ~opens
    return lines.withColumn("line", F.when(inside, F.regexp_replace("line", r"^(\s*)(\d{1,2})\.\s+", "$1($2) ")).otherwise(F.col("line")))


def normalised(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text): an exam's Markdown with parts promoted, observations in brackets, stray ones gone and tens restored. A second pass changes nothing."""
    lines = _numbered(docs, text, key)
    return joined(restored_tens(without_stray_ones(bracketed_observations(promoted_parts(lines, key), key), key), key), key)


def group_contexts(docs: DataFrame, first_lines: DataFrame, text: str = "text", key: str = "doc_id", least: int = 30) -> DataFrame:
    """(key, grupo, parte, line_start, line_end, texto): the text between a group's or part's heading and its first item, if it is longer than `least`.

    first_lines (key, grupo, parte, line): the first line of each group and part's items, counted from 1; without any the next heading ends the text.
    """
    lines = _numbered(docs, text, key).withColumns({"_g": group_of(F.col("line")), "_p": part_of(F.col("line"))})
    rows = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    lines = lines.withColumns({"grupo": F.last("_g", True).over(rows), "_groups": F.count("_g").over(rows), "_section": F.count_if(F.col("_g").isNotNull() | F.col("_p").isNotNull()).over(rows)})
    lines = lines.withColumn("parte", F.coalesce(F.last("_p", True).over(W.partitionBy(key, "_groups").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)), F.lit("")))
    body = lines.filter("_section > 0 AND grupo IS NOT NULL AND _g IS NULL AND _p IS NULL")
    firsts = first_lines.select(key, "grupo", F.coalesce("parte", F.lit("")).alias("parte"), F.col("line").alias("_first"))
    before = body.join(firsts, [key, "grupo", "parte"], "left").filter(F.col("_first").isNull() | (F.col("pos") + 1 < F.col("_first"))).filter(~F.col("line").rlike(r"^#{1,4}"))
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    found = before.groupBy(key, "_section", "grupo", "parte").agg((F.min("pos") + 1).alias("line_start"), (F.max("pos") + 1).alias("line_end"), F.regexp_replace(told, r"^\s+|\s+$", "").alias("texto"))
    return found.filter(F.length("texto") > least).drop("_section")


#: A group's first item; a line number with a point; a number between words.
FIRST_ITEM = r"^1\.\s+[A-ZÁÀÂÃÉÊÍÓÔÕÚ(«]"
DOTTED = rf"^({MARGIN})\.\s+(?=[{UPPER}{LOWER}«])"
IN_PROSE = rf"(?<=\s)(\d{{1,2}})(?=\s+[{LOWER}{UPPER}«])"


def prose_numbers(lines: DataFrame, key: str, *zone: str) -> DataFrame:
    """lines (key, zone, pos, line) with a line break before each line number that stands among words, if it is the next that is expected in its zone.

    The first multiple of five that stands at a line's start sets the count; see expected_numbers. Each line is cut at its numbers, with what the next line with text begins with behind it, the
    numbers are judged as rows, and the pieces put together again.
    """
    order = W.partitionBy(key, *zone).orderBy("pos")
    behind = F.first(F.when(F.trim("line") != "", F.substring(F.ltrim("line"), 1, 1)), True).over(order.rowsBetween(1, W.unboundedFollowing))
    whole = F.concat(F.lit("\n"), "line", F.lit("\n"), F.coalesce("_behind", F.lit(" ")))
    pieces = lines.withColumn("_behind", behind).select(key, *zone, "pos", F.posexplode(F.split(F.regexp_replace(whole, IN_PROSE, "\u0001$1"), "\u0001")).alias("_k", "_piece"))
    before = F.lag("_piece").over(W.partitionBy(key, *zone, "pos").orderBy("_k"))
    rows = pieces.withColumn("_start", (F.col("_k") == 1) & (F.trim(F.translate(before, "\n\t", "  ")) == "")).withColumn("_value", F.when(F.col("_k") > 0, F.regexp_extract("_piece", r"^(\d{1,2})", 1).try_cast("int")))
    rows = rows.withColumn("_value", F.when((F.col("_value") % 5 == 0) & F.col("_value").between(5, 95), F.col("_value")))
    rows = rows.withColumns({"_by": F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *zone))), "_order": F.row_number().over(W.partitionBy(key, *zone).orderBy("pos", "_k"))})
    taken = expected_numbers(rows.filter("_value IS NOT NULL").select("_by", "_order", "_value", "_start"), "_by", "_order", "_value", "_start").select("_by", "_order", "taken")
    told = rows.join(taken, ["_by", "_order"], "left")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.when(F.col("taken") & ~F.col("_start"), F.concat(F.lit("\n"), "_piece")).otherwise(F.col("_piece")).alias("p")))), lambda x: x["p"]), "")
    # Without the break before and the break and letter behind.
    return told.groupBy(key, *zone, "pos").agg(text.alias("_t")).select(key, *zone, "pos", F.expr("substring(_t, 2, length(_t) - 3)").alias("line"))


def preamble_numbers(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text): line numbers of excerpts on lines of their own. Between a group's heading and its first item points behind them go, where there are two or more, broken tens are restored and numbers
    among words get a line break; anywhere, a line with two or more of them after sentences is broken. A text without headings of groups changes by the last rule alone.
    """
    lines = _numbered(docs, text, key)
    order = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    grouped = lines.withColumn("zone", F.count_if(F.col("line").rlike(GROUP_HEADING)).over(order))
    begun = F.count_if(F.col("line").rlike(FIRST_ITEM)).over(W.partitionBy(key, "zone").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    zoned = grouped.withColumn("_in", (F.col("zone") > 0) & (begun == 0))
    dotted = zoned.filter("_in").withColumn("_dots", F.count_if(F.col("line").rlike(DOTTED)).over(W.partitionBy(key, "zone")))
    bare = dotted.withColumn("line", F.when(F.col("_dots") >= 2, F.regexp_replace("line", DOTTED, "$1 ")).otherwise(F.col("line"))).select(key, "zone", "pos", "line")
    done = prose_numbers(restored_tens(bare, key, "zone"), key, "zone")
    every = done.select(key, "pos", "line").unionByName(zoned.filter("NOT _in").select(key, "pos", "line"))
    return joined(every.withColumn("line", broken_margin(F.col("line"))), key)
