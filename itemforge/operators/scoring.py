"""Scoring tables and criteria read from Markdown, as windows over lines: no state machine walks a document.

A line's kind tells what it is; the group and part it stands in are the last ones before it, and the rows of a table are
the lines of a run that begins with a header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What opens groups, parts, ranges, items, tables and pools.
GROUP = r"(?i)GRUPO\s+(I{1,3}V?|VI*)"
PART = r"(?i)PARTE\s+([A-C])"
RANGE = r"(?i)^(?:#\s*)?(\d+)\.\s+a\s+(\d+)"
TIMES = r"(?i)(\d+)\s*(?:\\times|[×x])\s*(\d+)"
ITEM = r"(?i)^(?:[#*\s]*)?(\d+(?:\.\d+)*)\.?\s+(\d+)\s*pontos?"
GROUP_TABLE = r"(?iu)^\|\s*Grupo\s*\|\s*Item\s*\|\s*Cota[çc][aã]o[^|]*\|"
ITEM_ROW, SCORE_ROW, RULER = r"^\|(?:\s*[\d.]+\s*\|)+", r"^\|(?:\s*\d+\s*\|)+", r"^\|[-|\s:]+\|"
POOL = r"(?is)(?:Destes|dos restantes)\s+(\d+)\s+itens.*?contribuem.*?os\s+(\d+)\s+itens"
HEADER = r"^#{0,4}\s*(\d{1,2}(?:\.\d+)?)\.(?:[ \t]*\.)?[ \t]+(\d+)\s*pontos\b"
IMPLICIT = r"^(\d{1,3})\s*pontos\s*$"


def _part(x: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, k), F.lit(""))


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(key, pos, line, run): the lines of each text that aren't blank, those of one table under one run."""
    split = docs.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "raw")).select(key, "pos", F.trim("raw").alias("line")).filter("line <> ''")
    piped = F.startswith(F.col("line"), F.lit("|"))
    rows = W.partitionBy(key).orderBy("pos")
    run = F.when(piped, F.count_if(~piped).over(rows.rowsBetween(W.unboundedPreceding, 0)))
    return split.withColumn("run", run)


def scores(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, item_id, points, parent, grupo, pos): what a scoring table gives each item; the last mention of an item counts.

    Read are lines `1. a 8. 8 × 5 pontos` (each by the factor, else the total shared out), `2.1. 10 pontos`, tables of groups, items and scores, and rows of items above
    rows of scores. Ids carry the group and part that stand before them; an item with a point in its number has the rest as parent.
    """
    line, run = F.col("line"), F.col("run")
    rows = W.partitionBy(key).orderBy("pos")
    table = W.partitionBy(key, "run").orderBy("pos")
    cells = F.transform(F.slice(F.split("line", r"\|"), F.lit(2), F.greatest(F.size(F.split("line", r"\|")) - 2, F.lit(0))), lambda x: F.trim(x))
    known = _lines(docs, text, key).withColumns({"cells": F.when(run.isNotNull(), cells), "ruler": line.rlike(RULER)})
    grouped = F.when(run.isNotNull(), F.first(line.rlike(GROUP_TABLE)).over(table))
    known = known.withColumns({"by_group": F.coalesce(grouped, F.lit(False)), "_n": F.count_if(~F.col("ruler")).over(table.rowsBetween(W.unboundedPreceding, 0))})
    row = F.col("by_group") & (F.col("_n") > 1) & ~F.col("ruler") & (F.size("cells") >= 3) & ~F.contains(F.lower(F.coalesce(F.get("cells", F.lit(0)), F.lit(""))), F.lit("total"))
    cell = lambda k: F.coalesce(F.get("cells", F.lit(k)), F.lit(""))
    free = run.isNull()
    pool = free & line.rlike(POOL)
    bold = lambda name: rf"^\*{{0,2}}({name})\*{{0,2}}$"
    in_row = F.coalesce(_part(cell(0), bold("[IVX]+"), 1), _part(cell(0), GROUP, 1))
    group = F.upper(F.when(free & ~pool, _part(line, GROUP, 1)).when(row, in_row))
    part = F.upper(F.when(free & ~pool & group.isNull(), _part(line, PART, 1)).when(row & _part(cell(0), bold("[IVX]+"), 1).isNull(), F.coalesce(_part(cell(0), bold("[A-C]"), 1), _part(cell(0), PART, 1))))
    upto = rows.rowsBetween(W.unboundedPreceding, 0)
    marked = known.withColumns({"row": row, "pool": pool, "_g": group, "_p": part})
    placed = marked.withColumns({"grupo": F.coalesce(F.last("_g", True).over(upto), F.lit("")), "_groups": F.count("_g").over(upto)})
    sections = W.partitionBy(key, "_groups").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumn("parte", F.coalesce(F.last("_p", True).over(sections), F.lit("")))
    said = F.when(F.col("row"), cell(1)).when(free & ~F.col("pool") & F.col("_g").isNull() & F.col("_p").isNull(), line)
    first, last = _part(said, RANGE, 1).cast("int"), _part(said, RANGE, 2).cast("int")
    count = last - first + 1
    total = F.coalesce(F.when(F.col("row"), _part(F.replace(cell(2), F.lit("**"), F.lit("")), r"(\d+)", 1)).otherwise(_part(line, r"(?i)(\d+)\s*pontos?", 1)).cast("int"), F.lit(0))
    shared = F.when(count > 0, F.floor(total / F.greatest(count, F.lit(1)))).otherwise(0)
    each = F.coalesce(_part(said, TIMES, 2).cast("int"), shared)
    ranged = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda k: F.struct((first + k).cast("string").alias("num"), each.cast("int").alias("points"))))
    single = F.when(F.col("row"), F.coalesce(_part(said, r"^\s*(\d+(?:\.\d+)?)\.?\s*$", 1), F.when(F.contains(F.lower(said), F.lit("item")), F.lit("1")))).otherwise(_part(said, ITEM, 1))
    worth = F.when(F.col("row"), total).otherwise(_part(said, ITEM, 2).cast("int"))
    headed = F.col("run").isNotNull() & ~F.col("by_group") & ~F.col("ruler")
    above = F.lag("cells").over(W.partitionBy(key, "run", "ruler").orderBy("pos"))
    placed = placed.withColumn("above", F.when(headed & (F.col("_n") % 2 == 0) & line.rlike(SCORE_ROW), above))
    digits = lambda x: F.regexp_replace(x, r"\.+$", "")
    pairs = F.filter(F.zip_with(F.col("above"), F.slice("cells", F.lit(1), F.size("above")), lambda h, s: F.struct(digits(h).alias("num"), s.try_cast("int").alias("points"))), lambda p: p["num"].rlike(r"^\d+$") & p["points"].isNotNull())
    one = F.when(single.isNotNull() & worth.isNotNull(), F.array(F.struct(single.alias("num"), worth.cast("int").alias("points"))))
    found = F.coalesce(F.when(F.col("above").isNotNull(), pairs), F.when(first.isNotNull(), ranged), one)
    out = placed.select(key, "pos", "grupo", "parte", F.posexplode(found).alias("_k", "i"))
    item_id = F.concat_ws("-", F.nullif("grupo", F.lit("")), F.nullif("parte", F.lit("")), F.col("i.num"))
    every = out.select(key, item_id.alias("item_id"), F.struct("pos", "_k", "i.points", "grupo").alias("r"))
    kept = every.groupBy(key, "item_id").agg(F.max("r").alias("r"))
    parent = F.when(F.contains(F.element_at(F.split("item_id", "-"), -1), F.lit(".")), F.regexp_replace("item_id", r"\.[^.]*$", ""))
    return kept.select(key, "item_id", F.col("r.points").alias("points"), parent.alias("parent"), F.col("r.grupo").alias("grupo"), F.col("r.pos").alias("pos"))


def pools(docs: DataFrame, scored: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, grupo, escolher, itens): of how many of a group's items count; items are those of whole numbers. scored: see scores."""
    line = F.col("line")
    rows = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    asked = _lines(docs, text, key).withColumn("_pool", F.when(F.col("run").isNull(), _part(line, POOL, 2)).cast("int"))
    asked = asked.withColumn("grupo", F.coalesce(F.last(F.when(F.col("_pool").isNull(), F.upper(_part(line, GROUP, 1))), True).over(rows), F.lit("")))
    last = asked.filter("_pool IS NOT NULL").groupBy(key, "grupo").agg(F.max_by("_pool", "pos").alias("escolher"))
    tops = scored.filter("parent IS NULL").groupBy(key, "grupo").agg(F.array_sort(F.collect_list("item_id")).alias("itens"))
    every = scored.filter("parent IS NULL").groupBy(key).agg(F.array_sort(F.collect_list("item_id")).alias("_all"))
    joined = last.join(tops, [key, "grupo"], "left").join(every, key, "left")
    return joined.withColumn("itens", F.when(F.col("grupo") == "", F.col("_all")).otherwise(F.col("itens"))).filter("itens IS NOT NULL").select(key, "grupo", "escolher", "itens")


def criteria_blocks(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, item_id, points, implicit, line_start, line_end, body): a text of criteria cut at its headings `3.1. 15 pontos`.

    A line of points alone opens a block as well, if its number can be told: one less than the next heading's where none stands before, one more than the last heading's where the
    next is two or more above it. Tables have been dealt with before, see answer_lines.
    """
    split = docs.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    named, points = _part(F.col("line"), HEADER, 1), F.coalesce(_part(F.col("line"), HEADER, 2), _part(F.trim("line"), IMPLICIT, 1)).cast("int")
    marked = split.withColumns({"_id": named, "points": points})
    marked = marked.withColumn("_main", F.split("_id", r"\.")[0].cast("int"))
    rows = W.partitionBy(key).orderBy("pos")
    before, after = F.last("_main", True).over(rows.rowsBetween(W.unboundedPreceding, -1)), F.first("_main", True).over(rows.rowsBetween(1, W.unboundedFollowing))
    told = marked.withColumns({"_before": before, "_after": after})
    guess = F.when(F.col("_before").isNull() & (F.col("_after") > 1), F.col("_after") - 1).when(F.col("_after") - F.col("_before") >= 2, F.col("_before") + 1)
    lone = F.when(F.col("_id").isNull() & F.col("points").isNotNull(), guess.cast("string"))
    known = told.withColumns({"_lone": lone, "_there": F.collect_set("_id").over(W.partitionBy(key))})
    known = known.withColumn("_lone", F.when(~F.array_contains("_there", F.col("_lone")) & (F.row_number().over(W.partitionBy(key, "_lone").orderBy("pos")) == 1), F.col("_lone")))
    opened = known.withColumns({"item_id": F.coalesce("_id", "_lone")}).withColumn("block", F.count("item_id").over(rows.rowsBetween(W.unboundedPreceding, 0)))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("item_id").isNull(), F.struct("pos", "line")))), lambda x: x["line"]), "\n")
    cut = opened.filter("block > 0").groupBy(key, "block").agg(F.max("item_id").alias("item_id"), F.max(F.when(F.col("item_id").isNotNull(), F.col("points"))).alias("points"), F.bool_or(F.col("_lone").isNotNull()).alias("implicit"), F.min("pos").alias("s"), F.max("pos").alias("e"), body.alias("body"))
    return cut.select(key, "item_id", "points", "implicit", (F.col("s") + 1).alias("line_start"), (F.col("e") + 1).alias("line_end"), F.regexp_replace("body", r"^\s+|\s+$", "").alias("body")).filter("NOT implicit OR body <> ''")


def answer_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text): answer-key tables as lines `3. Chave: (B) 8 pontos`, of the first version's column; all other tables give way to a blank line."""
    split = docs.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    bare = F.trim("line")
    piped = bare.rlike(r"^\|.*\|$")
    rows = W.partitionBy(key).orderBy("pos")
    runs = split.withColumns({"piped": piped, "run": F.count_if(~piped).over(rows.rowsBetween(W.unboundedPreceding, 0))})
    cells = F.transform(F.slice(F.split(bare, r"\|"), F.lit(2), F.greatest(F.size(F.split(bare, r"\|")) - 2, F.lit(0))), lambda x: F.trim(x))
    table = W.partitionBy(key, "run", "piped").orderBy("pos")
    runs = runs.withColumns({"cells": cells, "head": F.transform(F.first(cells).over(table), lambda x: F.lower(x)), "at": F.row_number().over(table)})
    where = lambda test: F.array_position(F.transform("head", test), True).cast("int") - 1
    answer = where(lambda c: F.contains(c, F.lit("vers")) | F.startswith(c, F.lit("chave")))
    points = where(lambda c: F.contains(c, F.lit("pontua")) | F.contains(c, F.lit("cota")) | F.contains(c, F.lit("pontos")))
    headed = F.startswith(F.get("head", F.lit(0)), F.lit("item")) & (answer >= 0) & (points >= 0)
    item, letter = F.regexp_replace(F.get("cells", F.lit(0)), r"\.+$", ""), F.upper(F.regexp_replace(F.get("cells", F.greatest(answer, F.lit(0))), r"^[ (]+|[ )]+$", ""))
    worth = F.regexp_extract(F.get("cells", F.greatest(points, F.lit(0))), r"(\d+)", 1)
    good = headed & (F.col("at") > 1) & item.rlike(r"^\d+(?:\.\d+)?$") & letter.rlike("^[A-D]$") & (worth != "")
    shown = F.when(~F.col("piped"), F.col("line")).when(good, F.concat(item, F.lit(". Chave: ("), letter, F.lit(") "), worth, F.lit(" pontos"))).when(F.col("at") == 1, F.lit(""))
    kept = runs.withColumn("shown", shown).filter("shown IS NOT NULL")
    return kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "shown"))), lambda x: x["shown"]), "\n").alias("text"))


#: Fixed value: a heading of a criterion whose points stand in its text.
INLINE_HEADER = r"^#{0,4}\s*(?:\*\*)?\s*(\d{1,2}(?:\.\d+)?)\.(?:\*\*)?\s+[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ]"


def covered(points: DataFrame, spans: DataFrame, by: str, at: str, low: str, high: str) -> DataFrame:
    """points with covered: whether a span (low to high, both included) of the same `by` holds it. By one sorted union: the largest end of spans that began before, not by pairs."""
    both = spans.select(by, F.col(low).alias("_at"), F.col(high).alias("_end"), F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_row")).unionByName(
        points.select(by, F.col(at).alias("_at"), F.lit(None).cast(spans.schema[high].dataType).alias("_end"), F.lit(1).alias("_kind"), F.col("_row"))
    )
    reach = F.max("_end").over(W.partitionBy(by).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0))
    told = both.withColumn("covered", F.coalesce(reach >= F.col("_at"), F.lit(False))).filter("_kind = 1").select("_row", "covered")
    return points.join(told, "_row").drop("_row")


def expected_blocks(docs: DataFrame, blocks: DataFrame, expected: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, item_id, points, implicit, line_start, line_end, body, inline): criteria_blocks' rows, and those of expected items that no heading with points gave.

    expected: key, item_id, points. An item is looked for by its id without the group, at headings `3.1. Texto` outside all blocks; its text goes to the next such heading.
    Of several expected ids that differ in the group alone the last one's points count.
    """
    plain = F.regexp_replace("item_id", r"^[IVX]+-", "")
    there = blocks.select(key, F.col("item_id").alias("plain")).distinct()
    lacking = expected.withColumn("plain", plain).join(there, [key, "plain"], "left_anti").join(there.withColumnRenamed("plain", "item_id"), [key, "item_id"], "left_anti")
    lacking = lacking.groupBy(key, "plain").agg(F.max_by("points", "item_id").cast("int").alias("points"))
    lines = docs.join(lacking.select(key).distinct(), key, "left_semi").select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    rows = W.partitionBy(key).orderBy("pos")
    opened = lines.withColumn("plain", _part(F.col("line"), INLINE_HEADER, 1)).withColumn("_n", F.count("plain").over(rows.rowsBetween(W.unboundedPreceding, 0))).filter("_n > 0")
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    found = opened.groupBy(key, "_n").agg(F.max("plain").alias("plain"), (F.min("pos") + 1).alias("line_start"), (F.max("pos") + 1).alias("line_end"), F.regexp_replace(told, r"^\s+|\s+$", "").alias("body"))
    wanted = found.join(lacking, [key, "plain"]).withColumn("_row", F.monotonically_increasing_id())
    free = covered(wanted, blocks, key, "line_start", "line_start", "line_end").filter("NOT covered")
    more = free.select(key, F.col("plain").alias("item_id"), "points", F.lit(False).alias("implicit"), "line_start", "line_end", "body", F.lit(True).alias("inline"))
    return blocks.withColumn("inline", F.lit(False)).unionByName(more)
