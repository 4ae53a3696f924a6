"""Segmentation of Markdown into items.

Lines are labelled one by one, windows over a document's lines make blocks of them, and blocks travel as single rows from there on: parents
that no heading opens are taken from the text before a sub-item, sub-items inside lines are cut out, and what begins a new
item without any number is looked for by three kinds of signs, of which the strongest counts at each place.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.functions.repairs import compact_arrays
from itemforge.operators import windows as W
from itemforge.operators.headings import ITEM, SCORING, found, group_of, part_of
from itemforge.operators.normalise import bracketed_observations, promoted_parts, without_stray_ones
from itemforge.sources.shared import stored

#: Verbs that may follow a sub-item's number inside a line; paragraphs that give no context.
INLINE_VERBS = "Averigue|Estude|Determine|Mostre|Resolva|Calcule|Justifique|Apresente"
NO_CONTEXT = (
    r"^\s*(?:\$\$|#|!\[|\|)|(?iu)^\s*(?:Geometria|Progressões|Trigonometria|Derivadas|Complexos|Limites notáveis|Regras de derivação|12\.º Ano|Decreto-Lei|Duração da Prova|É permitido"
    r"|Não é permitido|Utilize apenas|Apresente apenas|As cotações|A prova inclui|Para cada resposta|Nas respostas)"
)
#: Lines that open an item by themselves; what opens one after the last alternative; verbs of a task.
OPENING_LINE = r"^(?:O gr[aá]fico da Figura\s+\d+.*|Complete o texto seguinte,.*|Para certos valores reais.*|Na Figura\s+\d+, est[aá] representad[oa].*)$"
#: One of these is in each such line.
OPENING_WORDS = ("Figura", "Complete o texto seguinte,", "Para certos valores reais")
AFTER_CHOICE = r"(?iu)(\s+[*•-]?\s*)((?:O|Uma|Um|Seja|Considere|Na Figura|A Figura|Admita que|Para certos valores|Para um certo número real)[^\n]{10,})"
TASK = r"(?iu)\b(Escreva|Determine|Mostre|Resolva|Calcule|Averigue)\b"
#: Stands where a text is cut.
CUT = "\u0001"


#: Line breaks of Unicode, before which a blank is one at the end as well.
BREAKS = ("\u0085", "\u2028", "\u2029")


def _bare(x: Column) -> Column:
    """A text without white space at both ends; only texts that end with a rare line break need the expression."""
    return F.when(F.right(x, F.lit(1)).isin(*BREAKS), F.regexp_replace(x, r"^\s+|\s+$", "")).otherwise(F.trim(x, F.lit(" \t\n\x0b\f\r")))


def _breaks(x: Column) -> Column:
    """The number of line breaks in a text."""
    return F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))


def _odd(x: Column) -> Column:
    """Whether a text has anything that the rules on several lines could change: few have."""
    return x.rlike(r"(?mu)^\s*\**\s*[A-C]\s*\**\s*$|^1\s+\S") | (F.contains(F.lower(x), F.lit("erva")) & x.rlike("(?iu)observa[çc]"))


def lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, row, line, body, main, sub, grupo, parte, boundary): each line of the normalised text with its 1-based number, the labels of an item that it opens, and the group and part it stands in.

    Before, items that an escaped asterisk joins to the text before them get lines of their own, and lone letters of parts become headings, observations stand in brackets, and a stray
    1 at a line's start goes. A new group closes the part before it. Null and empty texts have no lines. Where docs have a column _odd, it tells which texts have what rules on several lines look for.
    """
    parted = F.regexp_replace(F.regexp_replace(F.col(text), r"\s+\\[*]\s+(\d{1,3}\.\d{1,2}\.)\s+", "\n\n$1 "), r"([^\n])\n(\\[*]\s+\d{1,3}\.)", "$1\n\n$2")
    parted = F.when(F.contains(text, F.lit("\\")), compact_arrays(parted)).otherwise(F.col(text))
    odd = F.col("_odd") if "_odd" in docs.columns else _odd(F.col(text))
    some = docs.filter(F.col(key).isNotNull() & F.col(text).rlike(r"\S"))
    raw = lambda those: those.select(key, F.posexplode(F.split(parted, "\n")).alias("pos", "line"))
    clean = raw(some.filter(~odd)).unionByName(without_stray_ones(bracketed_observations(promoted_parts(raw(some.filter(odd)), key), key), key))
    body = F.col("line")
    whole, numbered = F.concat(body, F.lit("\n")), F.substring(body, 1, 32).rlike(r"\d")
    heading = body.rlike(r"(?i)^\s*(?:#|grupo|parte)")
    marked = clean.select(
        key, F.col("pos").alias("row"), (F.col("pos") + 1).cast("int").alias("_line"), body.alias("body"), F.when(numbered, found(whole, ITEM, 1)).cast("int").alias("main"), F.when(numbered, found(whole, ITEM, 2)).cast("int").alias("sub"),
        F.when(heading, group_of(body)).alias("_group"), F.when(heading, part_of(body)).alias("_part"),
    )
    grouped = marked.withColumns({"grupo": W.carried("_group", [key], ["row"]), "_groups": W.running_count(F.col("_group").isNotNull(), [key], ["row"])})
    parted = grouped.withColumn("parte", W.carried("_part", [key, "_groups"], ["row"]))
    boundary = F.col("_group").isNotNull() | F.col("_part").isNotNull() | (F.startswith("body", F.lit("#")) & F.col("body").rlike(SCORING))
    return parted.select(key, "row", F.col("_line").alias("line"), "body", "main", "sub", "grupo", "parte", boundary.alias("boundary"))


def essay(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, line_start, line_end, markdown): the text of group III up to the scoring table, for documents with items whose group III opens none. rows: see lines."""
    any_item = F.bool_or(F.col("main").isNotNull()).over(Window.partitionBy(key))
    third = rows.withColumn("_any", any_item).filter("_any AND grupo = 'III'")
    ends = F.min(F.when(F.col("body").rlike(SCORING), F.col("row"))).over(Window.partitionBy(key))
    opens = F.bool_or(F.col("main").isNotNull()).over(Window.partitionBy(key))
    inside = third.withColumns({"_end": ends, "_opens": opens}).filter("NOT _opens AND NOT boundary AND (_end IS NULL OR row < _end)")
    told = _joined(F.lit(True))
    text = inside.groupBy(key).agg(F.min("line").alias("line_start"), F.max("line").alias("line_end"), _bare(told).alias("markdown"))
    return text.filter("markdown <> ''")


def _joined(which: Column) -> Column:
    """The lines (row, body) of a group that meet a condition, in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(which, F.struct("row", "body")))), lambda x: x["body"]), "\n")


def blocks(rows: DataFrame, key: str) -> DataFrame:
    """(key, ordem, raw, sub, grupo, parte, line, text, gap, gap_line): the text of each item up to the next one or a boundary, and the text between that and the next item. rows: see lines.

    ordem 0 is what stands before the first item, if anything does.
    """
    opens = F.col("main").isNotNull()
    numbered = rows.withColumns({"ordem": W.running_count(opens, [key], ["row"]), "_stops": W.running_count(opens | F.col("boundary"), [key], ["row"])})
    first_stop = F.min(F.when(opens, F.col("_stops"))).over(Window.partitionBy(key, "ordem"))
    split = numbered.withColumn("_in", (F.col("ordem") > 0) & (F.col("_stops") == first_stop)).withColumn("_in", F.coalesce("_in", F.lit(False)))
    return split.groupBy(key, "ordem").agg(
        F.max("main").alias("raw"), F.max("sub").alias("sub"), F.max(F.when(opens, F.col("grupo"))).alias("grupo"), F.max(F.when(opens, F.col("parte"))).alias("parte"), F.min(F.when(F.col("_in"), F.col("line"))).alias("line"),
        _joined(F.col("_in")).alias("text"), _joined(~F.col("_in")).alias("gap"), F.min(F.when(~F.col("_in"), F.col("line"))).alias("gap_line"),
    )


def canonical_blocks(found_blocks: DataFrame, key: str) -> DataFrame:
    """blocks with main and reset: numbers made ascending as I.canonical does, by a running maximum instead of a fold.

    A main number is at least one over the last, a sub-item's at least the last; so it is the number of main headings so far plus the largest lead over that number.
    """
    order = Window.partitionBy(key).orderBy("ordem")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    top = F.col("raw").isNotNull() & F.col("sub").isNull()
    placed = found_blocks.withColumn("_place", F.count_if(top).over(so_far))
    known = placed.withColumn("main", (F.col("_place") + F.max(F.col("raw") - F.col("_place")).over(so_far)).cast("int"))
    again = F.when(F.col("sub").isNotNull(), F.col("main") != F.col("raw")).otherwise(F.col("raw") <= F.lag("main").over(order))
    return known.withColumn("reset", F.coalesce(again, F.lit(False))).drop("_place")


def with_parents(found_blocks: DataFrame, key: str) -> DataFrame:
    """(key, ordem, own, main, sub, grupo, parte, line, text, reset): canonical blocks, and before the first sub-item of a number that no heading opens its parent, own 0.

    A parent's text is the last paragraph that gives context among what stands between the block before and the sub-item; if there is none, what follows the last alternative (D) of the
    block before, which then loses it. Without either there is no parent.
    """
    order, family = Window.partitionBy(key).orderBy("ordem"), Window.partitionBy(key, "main")
    child = F.col("sub").isNotNull()
    orphan = child & ~F.bool_or(F.col("raw").isNotNull() & F.col("sub").isNull()).over(family) & (F.row_number().over(family.orderBy("ordem")) == 1)
    # Paragraphs are read before orphans alone, tails before those that have none.
    paragraphs = F.filter(F.split("_gap", r"\n{2,}"), lambda p: (_bare(p) != "") & ~p.rlike(NO_CONTEXT))
    told = found_blocks.withColumn("_orphan", F.coalesce(orphan, F.lit(False))).withColumns({"_gap": F.lag("gap").over(order), "_gap_line": F.lag("gap_line").over(order)})
    told = told.withColumn("_free", F.when(F.col("_orphan"), F.get(paragraphs, F.size(paragraphs) - 1)))
    parted = r"(?s)^(.*\(D\)[^\n]*)(.*)$"
    told = told.withColumn("_asked", F.coalesce(F.lead(F.col("_orphan") & F.col("_free").isNull()).over(order), F.lit(False)))
    told = told.withColumn("_after", F.when(F.col("_asked"), F.regexp_extract("text", parted, 2)))
    told = told.withColumn("_tail", F.when((_bare(F.col("_after")) != "") & ~_bare(F.col("_after")).rlike(r"^(?:\$\$|#|!\[|\()"), F.col("_after"))).withColumn("_lent", F.col("_tail").isNotNull())
    told = told.withColumns({"_theirs": F.lag(F.when(F.col("_lent"), F.struct("_tail", "grupo", "parte", (F.col("line") + _breaks(F.regexp_extract("text", parted, 1))).alias("line")))).over(order), "text": F.when(F.col("_lent"), F.regexp_extract("text", parted, 1)).otherwise(F.col("text"))})
    free_line = F.col("_gap_line") + _breaks(F.expr("left(_gap, cast(length(_gap) - locate(reverse(_free), reverse(_gap)) - length(_free) + 1 as int))"))
    null = F.lit(None).cast("int")
    kinds = "struct<own:int,main:int,sub:int,grupo:string,parte:string,line:int,text:string,reset:boolean>"
    row = lambda own, sub, grupo, parte, line, text, reset: F.struct(F.lit(own), F.col("main"), sub, grupo, parte, line.cast("int"), text, reset).cast(kinds)
    parent = F.when(F.col("_orphan") & F.col("_free").isNotNull(), row(0, null, F.col("grupo"), F.col("parte"), free_line, F.col("_free"), F.lit(False)))
    parent = parent.when(F.col("_orphan") & F.col("_theirs").isNotNull(), row(0, null, F.col("_theirs.grupo"), F.col("_theirs.parte"), F.col("_theirs.line"), F.col("_theirs._tail"), F.lit(False)))
    itself = row(1, F.col("sub"), F.col("grupo"), F.col("parte"), F.col("line"), F.col("text"), F.col("reset"))
    return told.filter("ordem > 0").select(key, "ordem", F.inline(F.array_compact(F.array(parent, itself))))


def with_inner(specs: DataFrame, key: str) -> DataFrame:
    """with_parents' blocks cut before sub-items of their own number that stand inside them, before a verb that sets a task; piece counts them."""
    pattern = F.concat(F.lit(r"(\s|[*★])("), F.col("main").cast("string"), F.lit(rf"\.\d{{1,2}}\.)(?=\s+(?:{INLINE_VERBS})\b)"))
    # An expression that holds a row's number is made for each row, so one that doesn't looks first.
    some = F.col("text").rlike(rf"\d\.\d{{1,2}}\.\s+(?:{INLINE_VERBS})\b")
    cut = F.when(some, F.regexp_replace("text", pattern, F.lit(f"$1{CUT}$2"))).otherwise(F.col("text"))
    pieces = specs.select(key, "ordem", "own", "main", "sub", "grupo", "parte", "line", "reset", F.posexplode(F.split(cut, CUT)).alias("piece", "text"))
    before = F.coalesce(F.sum(_breaks(F.col("text"))).over(Window.partitionBy(key, "ordem", "own").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    label = F.regexp_extract("text", r"^\d+\.(\d{1,2})\.", 1)
    return pieces.withColumns({"line": (F.col("line") + before).cast("int"), "sub": F.when(F.col("piece") > 0, label.cast("int")).otherwise(F.col("sub"))})


def _cuts(specs: DataFrame, by: list[str]) -> DataFrame:
    """(by, at): character offsets before which a block's text opens further items, the strongest sign at each place, as many as numbers are free. specs: by, text and free (null: any number)."""
    opened = specs.filter(F.contains("text", F.lit("\n\n"))).select(*by, F.inline(F.filter(implicit_openings(F.col("text")), lambda o: o["opens"]))).select(*by, "at", "score")
    order = Window.partitionBy(*by).orderBy("pos")
    told = reduce(or_, (F.contains("text", F.lit(x)) for x in OPENING_WORDS)) & F.col("text").rlike(f"(?m){OPENING_LINE}")
    split = specs.filter(F.contains("text", F.lit("(D)")) | told).select(*by, F.posexplode(F.split("text", "\n")).alias("pos", "l"))
    placed = split.withColumns({"_at": F.coalesce(F.sum(F.length("l") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_before": F.last(F.when(F.trim("l") != "", F.col("l")), True).over(order.rowsBetween(Window.unboundedPreceding, -1))})
    closed = F.col("_before").rlike(r"(?:[.?!\])]|\$\$)\s*$")
    explicit = placed.filter((F.col("_at") > 0) & F.col("l").rlike(OPENING_LINE) & closed).select(*by, F.col("_at").alias("at"), F.lit(4).alias("score"))
    last = F.instr("l", "(D)")
    beside = F.expr("substring(l, instr(l, '(D)') + 3)")
    seen = placed.withColumns({"_d": last, "_after": F.max(last > 0).over(order.rowsBetween(Window.unboundedPreceding, -1))})
    tails = seen.select(*by, F.inline(F.array_compact(F.array(
        F.when(F.col("_after"), F.struct((F.col("_at") - 1).alias("base"), F.concat(F.lit("\n"), "l").alias("tail"))),
        F.when(F.col("_d") > 0, F.struct((F.col("_at") + F.col("_d") + 2).alias("base"), beside.alias("tail"))),
    ))))
    tasked = tails.withColumn("_task", F.max(F.col("tail").rlike(TASK)).over(Window.partitionBy(*by)))
    choice = tasked.withColumn("_i", F.regexp_instr("tail", F.lit(AFTER_CHOICE))).filter("_i > 0")
    choice = choice.select(*by, (F.col("base") + F.col("_i") - 1 + F.length(F.regexp_extract("tail", AFTER_CHOICE, 1))).alias("at"), F.when(F.col("_task"), 5).otherwise(4).alias("score"))
    signs = opened.unionByName(explicit).unionByName(choice).groupBy(*by, F.col("at").cast("int").alias("at")).agg(F.max("score").alias("score"))
    ranked = signs.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("at"))).join(specs.select(*by, "free"), by)
    return ranked.filter(F.col("free").isNull() | (F.col("_rank") <= F.col("free"))).select(*by, "at", "score")


def numbers_free(specs: DataFrame, key: str) -> DataFrame:
    """with_inner's blocks with free: how many main numbers there are between a block's own and that of the next block of a main item; null after the last."""
    order = Window.partitionBy(key).orderBy("ordem", "own", "piece")
    following = F.first(F.when(F.col("sub").isNull(), F.col("main")), True).over(order.rowsBetween(1, Window.unboundedFollowing))
    return specs.withColumn("_next", following).withColumn("free", F.when(F.col("_next").isNotNull(), F.greatest(F.lit(0), F.col("_next") - F.col("main") - 1))).drop("_next")


def with_openings(known: DataFrame, key: str) -> DataFrame:
    """numbers_free's blocks cut where an item begins without a number: pieces after the first take the numbers that are free before the next main number, and are marked implicit with their score."""
    by = [key, "ordem", "own", "piece"]
    cuts = _cuts(known.filter("free IS NULL OR free > 0").select(*by, "text", "free"), by).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", "score"))).alias("cuts"))
    held = known.join(cuts, by, "left").withColumn("_text", F.col("text"))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("int").alias("score"))
    ends = F.concat(F.transform(F.coalesce("cuts", F.array().cast("array<struct<at:int,score:int>>")), lambda c: c["at"]), F.array(F.length("text")))
    starts = F.concat(F.array(start), F.coalesce("cuts", F.array().cast("array<struct<at:int,score:int>>")))
    each = held.select(*by, "main", "sub", "grupo", "parte", "line", "reset", "_text", F.posexplode(F.arrays_zip(starts.alias("s"), ends.alias("e"))).alias("part", "_p"))
    later = F.col("part") > 0
    whole = F.col("_p.s.at").eqNullSafe(0) & (F.col("_p.e") == F.length("_text"))
    each = each.withColumn("_piece", F.when(whole, F.col("_text")).otherwise(F.expr("substring(_text, _p.s.at + 1, _p.e - _p.s.at)"))).withColumn("_clear", _bare(F.col("_piece")))
    lead = _breaks(F.regexp_extract("_piece", r"^\s*", 0)) + F.when(later, _breaks(F.expr("left(_text, _p.s.at)"))).otherwise(0)
    starred = F.when(F.startswith("_clear", F.lit("*")), F.regexp_replace("_clear", r"^\*+(?=[A-ZÁÉÍÓÚÀÂÃÇO])", "")).otherwise(F.col("_clear"))
    clean = F.when(F.contains("_clear", F.lit("\\")), _bare(F.regexp_replace(starred, r"\s*\\\s*$", ""))).otherwise(starred)
    # As values of a generator what was worked out isn't worked out again by the filter.
    told = each.select(
        *by, "part", (F.col("main") + F.col("part")).alias("main"), F.when(~later, F.col("sub")).alias("sub"), "grupo", "parte", (F.col("reset") | later).alias("reset"), later.alias("implicit"), F.col("_p.s.score").alias("score"),
        F.inline(F.array(F.struct((F.col("line") + lead).cast("int").alias("line_start"), _breaks(F.col("_clear")).alias("_more"), clean.alias("markdown")))),
    )
    out = told.withColumn("line_end", (F.col("line_start") + F.col("_more")).cast("int")).drop("_more")
    return out.filter("markdown <> ''")


def segments(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ordem, item_id, numero, subitem, grupo, parte, pool, line_start, line_end, suspected_reset, tipo, optional, images, markdown, implicit, score) of each item.

    An item ends before the next one, or at the next heading of a group, a part or the scoring table. A document without item headings is one item. Main
    numbers that don't ascend are renumbered, then made to start at 1 in each group; an item with sub-items is a context stem, and if it names a figure but has no
    image, it takes its sub-items' images. Optional items of a group belong to its pool. A group III without items is one essay, III-1, after all others.

    Lines are those of the normalised text, see `lines`. Rows without a key are left out; rows that share one are a document. No rows give no rows. Columns other than text and key are not read.
    """
    # Expressions over whole texts are worked out once, as columns of a table.
    read = stored(docs.select(key, text).withColumns({"_odd": _odd(F.col(text)), "_third": F.col(text).rlike(r"(?i)grupo\s+III\b")}), "texts")
    found_blocks = blocks(lines(read, text, key), key)
    headed = stored(found_blocks.withColumn("_any", F.max("ordem").over(Window.partitionBy(key)) > 0), "blocks")
    specs = with_inner(with_parents(canonical_blocks(headed.filter("_any").drop("_any"), key), key), key)
    pieces = with_openings(stored(numbers_free(specs, key), "specs"), key)
    whole = headed.filter("NOT _any").select(key, _bare(F.col("gap")).alias("markdown"), (F.col("gap_line") + _breaks(F.regexp_extract("gap", r"^\s*", 0))).cast("int").alias("line_start"))
    whole = whole.withColumns({"line_end": (F.col("line_start") + _breaks(F.col("markdown"))).cast("int"), "main": F.lit(1), "ordem": F.lit(1).cast("long"), "reset": F.lit(False), "implicit": F.lit(False)})
    each = pieces.unionByName(whole, allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy("ordem", "own", "piece", "part")
    family = Window.partitionBy(key, "main")
    child = F.col("sub").isNotNull()
    named = each.withColumns({"_ordem": F.row_number().over(order), "_children": F.count("sub").over(family)})
    least = F.min(F.when(F.col("sub").isNull(), F.col("main"))).over(Window.partitionBy(key, "grupo"))
    numero = F.when(F.col("grupo").isNull(), F.col("main")).otherwise(F.col("main") - F.coalesce(least, F.lit(1)) + 1).cast("int")
    tree = named.withColumns({"numero": numero, "_stem": ~child & (F.col("_children") > 0), "images": I.images(F.col("markdown")), "optional": I.optional_marker(F.substring_index("markdown", "\n", 1))})
    siblings = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(child, F.struct("_ordem", "images"))).over(family)), lambda x: x["images"])))
    lacks = F.col("_stem") & (F.size("images") == 0) & F.col("markdown").rlike(r"(?iu)\bFigura\b")
    moved = tree.withColumns({"_lacks": lacks, "_takes": F.bool_or(lacks).over(family), "_theirs": F.when(lacks, siblings)})
    shown = F.when(F.col("_lacks"), F.col("_theirs")).when(F.col("_takes") & child, F.array().cast("array<string>")).otherwise(F.col("images"))
    item_id = F.concat_ws("-", "grupo", "parte", F.concat_ws(".", F.col("numero").cast("string"), F.col("sub").cast("string")))
    items = stored(moved.select(
        key, F.col("_ordem").alias("ordem"), item_id.alias("item_id"), "numero", F.col("sub").alias("subitem"), "grupo", "parte", F.when(F.col("optional"), F.concat_ws("-", "grupo", F.lit("opt"))).alias("pool"), "line_start", "line_end", F.col("reset").alias("suspected_reset"),
        F.when(F.col("_stem"), "context_stem").otherwise(I.item_type(F.col("markdown"))).alias("tipo"), "optional", shown.alias("images"), "markdown", "implicit", "score",
    ), "items")
    last = items.groupBy(key).agg(F.max("ordem").alias("_last"))
    third = essay(lines(read.filter("_third"), text, key), key).join(last, key, "left").select(
        key, (F.coalesce("_last", F.lit(0)) + 1).cast("int").alias("ordem"), F.lit("III-1").alias("item_id"), F.lit(1).alias("numero"), F.lit("III").alias("grupo"), "line_start", "line_end",
        F.lit(False).alias("suspected_reset"), F.lit("essay").alias("tipo"), F.lit(False).alias("optional"), I.images(F.col("markdown")).alias("images"), "markdown", F.lit(False).alias("implicit"),
    )
    return items.unionByName(third, allowMissingColumns=True)


#: How a new item begins, how one goes on, what opens with a picture, what asks for a completion, and tasks that end an item.
STARTS = r"(?iu)^(?:O gr[aá]fico|Na Figura|Considere|Admita que|Para certos valores|Seja |Em \$?\\mathbb|Resolva|Mostre que|Determine|Complete o texto)"
GOES_ON = r"(?iu)^(?:Apresente|Justifique|Escreva|Selecione|indique|represente|assinale|não justifique|na sua resposta)"
PICTURED = r"(?iu)^(?:O gr[aá]fico|Na Figura|Admita que)"
COMPLETES = r"(?i)\bcomplete o texto\b"
#: A paragraph opens an item from this score on.
OPENING_SCORE = 3


def implicit_openings(block: Column) -> Column:
    """array<struct<paragraph, at, score, opens>> of a block's paragraphs after the first: where each begins, and whether it begins an item of its own.

    Most of a score is of two neighbours; but a first picture, or a task done, is looked for in all that was gathered since the last opening. Two flags carry that
    from paragraph to paragraph, so nothing is read twice. Blank paragraphs count for places alone.
    """
    last = lambda p: F.trim(F.regexp_extract(p, r"([^\n]*)\z", 1))
    first = lambda p: F.trim(F.regexp_extract(p, r"\A([^\n]*)", 1))
    worth = lambda test, n: F.when(test, n).otherwise(0)

    def local(before: Column, p: Column) -> Column:
        head, tail, low = first(p), last(before), F.lower(p)
        return (
            worth(head.rlike(STARTS), 2) + worth(head.rlike(PICTURED), 2) + worth(F.contains(low, F.lit("figura")) | F.contains(low, F.lit("gráfico")) | F.contains(low, F.lit("grafico")), 1) + worth(p.rlike(COMPLETES), 2)
            - worth(F.startswith(p, F.lit("![](")), 2) - worth(head.rlike(GOES_ON), 2) - worth(F.endswith(tail, F.lit(":")), 2) - worth(F.endswith(tail, F.lit(";")), 1) - worth(F.startswith(tail, F.lit("Sabe-se que")), 1) - worth((tail != "") & ~tail.rlike(r"[.!?]$"), 1)
        )

    image = lambda p: p.rlike(I.IMAGE)
    task = lambda p: F.contains(F.lower(p), F.lit("determine o valor de")) | F.contains(F.lower(p), F.lit("mostre que"))
    turn = lambda p: F.contains(F.lower(p), F.lit("o gráfico da figura")) | F.contains(F.lower(p), F.lit("para certos valores reais"))
    placed = "array<struct<p:string,at:int>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(placed).alias("out"))
    put = lambda acc, x: F.struct((acc["at"] + F.length(x) + 2).alias("at"), F.when(_bare(x) == "", acc["out"]).otherwise(F.array_append(acc["out"], F.struct(_bare(x).alias("p"), acc["at"].alias("at")))).alias("out"))
    parts = F.aggregate(F.split(block, r"\n\n"), empty, put, lambda acc: acc["out"])
    # Each paragraph beside the one before: all that needs no memory is worked out once.
    pair = lambda b, x: F.struct(x["p"].alias("p"), x["at"].alias("at"), local(b["p"], x["p"]).alias("local"), image(x["p"]).alias("image"), task(x["p"]).alias("task"), turn(x["p"]).alias("turn"))
    facts = F.filter(F.zip_with(parts, F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), pair), lambda x: x["p"].isNotNull())
    head = F.get(parts, F.lit(0))["p"]
    start = F.struct(F.coalesce(image(head), F.lit(False)).alias("image"), F.coalesce(task(head), F.lit(False)).alias("task"), F.array().cast("array<struct<paragraph:string,at:int,score:int,opens:boolean>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        score = (x["local"] + worth(x["image"] & ~acc["image"], 1) + worth(acc["task"] & x["turn"], 3)).cast("int")
        opens = score >= OPENING_SCORE
        row = F.struct(x["p"].alias("paragraph"), x["at"].alias("at"), score.alias("score"), opens.alias("opens"))
        return F.struct((x["image"] | (acc["image"] & ~opens)).alias("image"), (x["task"] | (acc["task"] & ~opens)).alias("task"), F.array_append(acc["out"], row).alias("out"))

    return F.aggregate(facts, start, step, lambda acc: acc["out"])
