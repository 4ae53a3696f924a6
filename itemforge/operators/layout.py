"""Pages and blocks of a layout: which pages a file's kind keeps, blocks as Markdown, and excerpts of a text by lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemforge.functions import items as I

#: What the name of a file with criteria holds, in capitals.
CRITERIA_NAMES = (r"(?:^|[-_])CC(?:[-_]|\.|$)", r"(?:^|[-_])CC[FP]\d", r"CRITERIOS?", r"CC[-_]?VD")
#: Where the criteria of a file begin, what its general pages say, and where an exam begins.
CRITERIA_START = r"crit[eé]rios?\s+espec[ií]ficos\s+de\s+classifica[cç][aã]o[\s\S]{0,300}?GRUPO\s+I"
GENERAL_PAGES = ("CRITÉRIOS GERAIS DE CLASSIFICAÇÃO", "CRITERIOS GERAIS DE CLASSIFICACAO", "Factores de desvalorização", "Fatores de desvalorização")
EXAM_START = "GRUPO I"
#: Characters from which on a page isn't blank, levels of headings, and where images lie.
BLANK_BELOW, LEVELS, IMAGES = 100, 4, "imagens_extraidas/"
#: How a note about a place that was read doubtfully begins.
SUSPECT = "OCR-SUSPECT:"
#: Fixed value: how many characters before and after a block its images are also looked for.
NEARBY = 400


def file_kind(name: Column) -> Column:
    """`cc` for a file of criteria by its name, else `prova`; null for null."""
    return F.when(name.isNull(), None).when(F.upper(name).rlike("|".join(CRITERIA_NAMES)), "cc").otherwise("prova")


def _stripped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def page_roles(pages: DataFrame, by: str, kind: str = "kind") -> DataFrame:
    """pages (by, n from 1, text, kind) with `dropped`, why a page isn't read on: general, cover, instructions, blank; null for those kept.

    Criteria begin where their section's heading stands; before it pages are general. Without one, all pages to the last that holds a general marker go, the first as the cover;
    without these all pages stay, blank ones too. Exams begin at the first page with a first group; before it pages are instructions. Pages after the last one with BLANK_BELOW
    characters are blank, unless there is no such page.
    """
    said = F.lower(F.coalesce("text", F.lit("")))
    holds = lambda marks: F.exists(F.array(*(F.lit(m.lower()) for m in marks)), lambda m: F.contains(said, m))
    of = F.when(F.col(kind) == "cc", F.when(F.col("text").rlike(f"(?iU){CRITERIA_START}"), F.col("n"))).otherwise(F.when(holds((EXAM_START,)), F.col("n")))
    marks = pages.groupBy(by, kind).agg(F.min(of).alias("_start"), F.max(F.when(holds(GENERAL_PAGES), F.col("n"))).alias("_general"), F.max(F.when(F.length(_stripped(F.col("text"))) >= BLANK_BELOW, F.col("n"))).alias("_end"), F.max("n").alias("_total"))
    n, cc = F.col("n"), F.col(kind) == "cc"
    kept_whole = cc & F.col("_start").isNull() & F.col("_general").isNull()
    early = F.when(F.col("_start").isNotNull(), F.when(n < F.col("_start"), F.when(cc, "general").otherwise("instructions"))).when(cc & (n <= F.col("_general")), F.when(n == 1, "cover").otherwise("general"))
    dropped = F.when(kept_whole, None).when(n > F.coalesce("_end", "_total"), "blank").otherwise(early)
    return pages.join(marks.select(by, kind, "_start", "_general", "_end", "_total"), [by, kind]).select(*pages.columns, dropped.alias("dropped"), F.when(kept_whole, "all").when(cc & F.col("_start").isNull(), "markers").otherwise("start").alias("found_by"))


def triage(roles: DataFrame, by: str, kind: str = "kind") -> DataFrame:
    """(by, kind, total, kept, dropped, confidence, needs_review) of each file's pages.

    Confidence is high; medium where markers stood in for the section's heading, or criteria lose fewer than two pages; low where fewer than two pages stay, or nothing was found.
    """
    told = roles.groupBy(by, kind).agg(F.count("*").alias("total"), F.count_if(F.col("dropped").isNull()).alias("kept"), F.count("dropped").alias("dropped"), F.min("found_by").alias("_by"))
    sure = F.when((F.col("_by") == "all") | (F.col("kept") < 2), "low").when((F.col("_by") == "markers") | ((F.col(kind) == "cc") & (F.col("dropped") < 2)), "medium").otherwise("high")
    return told.select(by, kind, "total", "kept", "dropped", sure.alias("confidence"), (sure != "high").alias("needs_review"))


def _entry_text(text: Column) -> Column:
    return _stripped(F.replace(F.coalesce(text, F.lit("")), F.lit("\u00a0"), F.lit(" ")))


def block(kind: Column, text: Column, level: Column, image: Column, matched: Column, matched_level: Column) -> Column:
    """A layout's block as Markdown, empty where it has nothing to show.

    matched is the text of the better reading of the same place, null where there is none: text and titles take it even if it is empty, equations only if it isn't. Levels of headings
    are cut to 1 to 4, a level of zero is none, a text that begins with # stays. Images and tables, and equations without text, are references.
    """
    said = _entry_text(F.coalesce(matched, text))
    depth = F.coalesce(F.nullif(level, F.lit(0)), F.nullif(matched_level, F.lit(0)))
    headed = F.when(depth.isNotNull() & (said != "") & ~F.startswith(said, F.lit("#")), F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(depth, F.lit(LEVELS))).cast("int")), F.lit(" "), said)).otherwise(said)
    name = F.regexp_extract(F.coalesce(image, F.lit("")), "([^/]+)/*$", 1)
    shown = F.when(name != "", F.concat(F.lit(f"![]({IMAGES}"), name, F.lit(")"))).otherwise("")
    formula = F.coalesce(F.nullif(_entry_text(matched), F.lit("")), F.nullif(_entry_text(text), F.lit("")), shown)
    return F.when(kind.isin("text", "title"), headed).when(kind == "equation", formula).when(kind.isin("image", "table"), shown).otherwise("")


def markdown(blocks: DataFrame, by: str, order: str, block: str = "block") -> DataFrame:
    """(by, markdown): the blocks of each document in order, empty ones and repeats of the one before left out, a blank line between. A document whose blocks are all empty has no row; its blocks meet in one task."""
    shown = blocks.filter(F.col(block) != "")
    kept = shown.withColumn("_before", F.lag(block).over(W.partitionBy(by).orderBy(order))).filter(~F.col("_before").eqNullSafe(F.col(block)))
    return kept.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(block).alias("block")))), lambda x: x["block"]), "\n\n").alias("markdown"))


def lines(text: Column) -> Column:
    """A text's lines; a line break at its end begins none, so empty texts have none."""
    cut = F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r")
    return F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)


def excerpts(texts: DataFrame, spans: DataFrame, pad: int = 3, ws: str = "ws") -> DataFrame:
    """(ws, id_item, first, last, excerpt): for each span (ws, id_item, line_start, line_end) its lines and `pad` more on both sides, each with its number.

    texts: ws, text, a row for each workspace. A missing start or end is line 1; spans beyond the text give what there is, so first may be past last and the excerpt empty.
    A text is read once for all its spans, of which there are as many as its document has items.
    """
    asked = spans.groupBy(ws).agg(F.collect_list(F.struct("id_item", F.coalesce("line_start", F.lit(1)).alias("a"), F.coalesce("line_end", F.lit(1)).alias("b"))).alias("_spans"))
    cut = texts.join(asked, ws).select(ws, "_spans", F.explode(F.array(lines(F.col("text")))).alias("_lines"))

    def part(s: Column) -> Column:
        first, last = F.greatest(F.lit(0), s["a"] - 1 - pad).cast("int"), F.least(F.size("_lines"), s["b"] + pad).cast("int")
        some = F.slice("_lines", first + 1, F.greatest(F.lit(0), last - first))
        told = F.transform(some, lambda line, i: F.format_string("%4d | %s", first + i + 1, line))
        return F.struct(s["id_item"].alias("id_item"), (first + 1).alias("first"), last.alias("last"), F.array_join(told, "\n").alias("excerpt"))

    return cut.select(ws, F.inline(F.transform("_spans", part)))


def likely_pages(line_start: Column, line_end: Column, n_lines: Column, n_pages: Column) -> Column:
    """struct<first, last>: pages on which lines stand, if a text fills its pages evenly, and one more on each side; null without pages."""
    n = F.greatest(n_lines, F.lit(1))
    a = F.greatest(F.coalesce(line_start, F.lit(1)), F.lit(1))
    b = F.greatest(F.coalesce(line_end, a), a)
    # Whole numbers, so that no page depends on a rounded quotient.
    first, last = F.greatest(F.lit(1), F.floor((a - 1) * n_pages / n)), F.least(n_pages, F.floor(b * n_pages / n) + 2)
    return F.when(n_pages > 0, F.struct(first.cast("long").alias("first"), last.cast("long").alias("last")))


def criterion_texts(criteria: DataFrame, order: str, ws: str = "ws") -> DataFrame:
    """(ws, id_item, texto_original, suspects): the first criterion under each id by `order`, with the notes about places that were read doubtfully; an empty text where it has none."""
    doubts = F.coalesce(F.filter("observacoes", lambda o: F.startswith(o, F.lit(SUSPECT))), F.array().cast("array<string>"))
    one = criteria.groupBy(ws, "id_item").agg(F.min_by(F.struct(F.coalesce("texto_original", F.lit("")).alias("texto_original"), doubts.alias("suspects")), order).alias("_c"))
    return one.select(ws, "id_item", "_c.texto_original", "_c.suspects")


def nearby_images(texts: DataFrame, spans: DataFrame, ws: str = "ws") -> DataFrame:
    """(ws, id_item, imagens): a block's images and those NEARBY characters before and after it, each once, its own first, then those before.

    texts: ws, text, a row for each workspace; spans: ws, id_item, first, last (offsets in characters, last exclusive). An image cut by a margin doesn't count. A null text has none, nor has a block without offsets.
    The text is cut into pieces of NEARBY characters once, so that a margin reads two pieces and the work is linear however many blocks there are.
    """
    asked = spans.groupBy(ws).agg(F.collect_list(F.struct("id_item", "first", "last")).alias("_spans"))
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{NEARBY}}}"), F.lit(0))
    cut = texts.join(asked, ws).select(ws, "_spans", F.explode(F.array(pieces)).alias("_pieces"))

    def between(a: Column, b: Column) -> Column:
        """Characters a to b (exclusive) of the pieces."""
        k = F.floor(a / NEARBY).cast("int")
        some = F.array_join(F.slice("_pieces", k + 1, F.greatest(F.lit(0), F.ceil(b / NEARBY).cast("int") - k)), "")
        return F.substring(some, (a - k * NEARBY + 1).cast("int"), F.greatest(F.lit(0), b - a).cast("int"))

    def found(s: Column) -> Column:
        before = between(F.greatest(F.lit(0), s["first"] - NEARBY), s["first"])
        own, after = between(s["first"], s["last"]), between(s["last"], s["last"] + NEARBY)
        return F.struct(s["id_item"].alias("id_item"), F.coalesce(F.array_distinct(F.concat(I.images(own), I.images(before), I.images(after))), F.array().cast("array<string>")).alias("imagens"))

    return cut.select(ws, F.inline(F.transform("_spans", found)))
