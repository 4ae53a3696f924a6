"""The catalogue of validation rules: one table of rules over items, one over criteria, and what they need of a whole document.

Names are stable identifiers; a rule that holds for stems, for other items, or for both says so. All rules of a table are
evaluated in one projection, see operators.rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.functions import text as T
from itemforge.operators.rules import ERROR, WARNING, Rule

#: Limits, in characters unless the name says otherwise.
SHORT_TEXT, LONG_ALTERNATIVE, TOO_LONG_ALTERNATIVE, MANY_NOTES, SUBSTANTIAL = 30, 200, 400, 4, 80
#: Verbs that open a task.
TASK_VERBS = "Determine Calcule Resolva Mostre Escreva Apresente Justifique Averigue Estude Indique Complete Represente Prove Classifique Obtenha Simplifique".split()
#: What an item's id is made of.
ITEM_ID = r"^(?:([IVX]+)-)?(?:([A-C])-)?(\d{1,3}|ctx\d*)(?:\.(\d{1,2}))?$"
#: Metadata of an exam, numbers fused to text, LaTeX outside formulas, line numbers, affirmations.
METADATA = r"(?im)(?:^#\s*COTA[ÇCçc][ÕOõo]ES\b|^\s*GRUPO\s+[IV\d]|\bPág\.\s*\d+|\bVers[aã]o\s+\d)"
FUSED = r"^\d{1,3}[A-ZÁÉÍÓÚÀÂÃÇ]|^\$\\pm\s*\d|^\$\\pm\s*\$\s*\d"
BARE_LATEX = r"\\[a-zA-Z]+|[A-Za-z]\s*_\s*\{|[A-Za-z]\s*\^\s*\{|\d+\s*_\s*\{|\^\s*\{"
LINE_MARK = r"(?m)^(\d{1,3}) \S"
LINE_MARK_LEFT = r"[^\n](?:\s)(\d{1,3})(?:\s)[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ«]|[A-Za-zÁ-ÿ](\d{1,3})[A-Za-zÁ-ÿ]"
AFFIRMATION = r"(?m)^\s*(?:[IVX]+\.|[IVX]+\s)\s+\S"
#: Types of items, and what stands for a missing category.
CRITERION_TYPES = ("multiple_choice", "open_response", "essay", "complete_table", "multi_select")
OPEN_TYPES = ("essay", "open_response", "complete_table", "multi_select")
UNCATEGORISED = "por categorizar"

STEM = "context_stem"


def _verb(x: Column) -> Column:
    return x.rlike(rf"(?i)\b({'|'.join(TASK_VERBS)})\b")


def _blank(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit(""))) == ""


def _dense(x: Column) -> Column:
    """Characters that are no white space."""
    return F.length(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", ""))


def item_rules() -> list[Rule]:
    """Rules V1 to V25 and V-CTX over the columns of an item; those of whole documents come from with_document_checks."""
    c, kind = F.col, F.col("tipo_item")
    stem, mc = kind == STEM, kind == "multiple_choice"
    alts = F.coalesce(c("alternativas"), F.array().cast("array<struct<letra:string,texto:string>>"))
    n = F.size(alts)
    four = mc & (n == 4)
    said = F.transform(alts, lambda a: F.struct(a["letra"].alias("letra"), F.trim(F.coalesce(a["texto"], F.lit(""))).alias("texto")))
    some = lambda test: F.exists(said, test)
    text, both = F.coalesce(c("enunciado"), F.lit("")), F.concat(F.coalesce(c("enunciado"), F.lit("")), F.lit(" "), F.coalesce(c("texto_original"), F.lit("")))
    item_id = F.trim(c("id_item"))
    part = lambda k: F.nullif(F.regexp_extract(item_id, ITEM_ID, k), F.lit(""))
    good_id = item_id.rlike(ITEM_ID)
    alone = good_id & part(1).isNull()
    main = part(3).try_cast("int")
    start, end = c("span.line_start"), c("span.line_end")
    pictured = (F.size(c("imagens")) > 0) | text.rlike(r"!\[.*?\]\(") | F.coalesce(c("contexto_pai"), F.lit("")).rlike(r"!\[.*?\]\(")
    folded = F.filter(F.transform(said, lambda a: F.lower(F.regexp_replace(a["texto"], r"\s+", " "))), lambda t: t != "")
    marker = lambda a: F.regexp_extract(a["texto"], r"^\(([A-D])\)", 1)
    short = lambda t: (F.length(t) < 2) & ~t.rlike(r"\d") & ~t.rlike(r"^\$[^$]{1,10}\$$")
    item = lambda name, severity, breaks: Rule(name, severity, breaks & ~stem)
    only = lambda name, severity, breaks: Rule(name, severity, breaks & stem & c("portugues"))
    maths = ~c("portugues")
    category = lambda x: _blank(x) | (F.lower(F.trim(F.coalesce(x, F.lit("")))) == UNCATEGORISED)
    notes = F.filter(F.coalesce(c("observacoes"), F.array().cast("array<string>")), lambda o: ~o.rlike("^Fornecedor '.+' sem credenciais;"))
    return [
        item("V1-count", ERROR, mc & (n != 4)),
        item("V2-letters", ERROR, four & (F.array_join(F.transform(said, lambda a: F.upper(F.trim(a["letra"]))), "") != "ABCD")),
        item("V3-empty", ERROR, four & some(lambda a: a["texto"] == "")),
        item("V3-short", ERROR, four & some(lambda a: (a["texto"] != "") & short(a["texto"]))),
        item("V4-incomplete", ERROR, ~mc & ~kind.isin(*OPEN_TYPES) & ~n.isin(0, 4)),
        item("V4-type", ERROR, ~mc & ~kind.isin(*OPEN_TYPES) & (n == 4)),
        item("V5-missing", ERROR, _blank(c("id_item"))),
        item("V5-pattern", ERROR, ~_blank(c("id_item")) & ~good_id),
        item("V5-principal", ERROR, alone & (c("numero_principal") != main)),
        item("V5-number", ERROR, alone & (c("numero_questao") != main)),
        item("V5-sub", ERROR, good_id & F.when(part(4).isNull(), c("subitem").isNotNull()).otherwise(F.coalesce(c("subitem"), F.lit("")) != part(4))),
        item("V6-missing", ERROR, c("span").isNull()),
        item("V6-span", ERROR, c("span").isNotNull() & (start.isNull() | end.isNull() | (start <= 0) | (end <= 0) | (end < start))),
        item("V7-statement", ERROR, _blank(c("enunciado"))),
        item("V7-original", ERROR, _dense(c("texto_original")) == 0),
        item("V7-short", WARNING, (_dense(c("enunciado")) > 0) & (_dense(c("enunciado")) < SHORT_TEXT)),
        item("V7-source", WARNING, _blank(c("fonte"))),
        item("V8-image", ERROR, F.size(F.array_except(F.when(F.size("imagens_contexto") > 0, c("imagens_contexto")).otherwise(c("imagens")), "ficheiros")) > 0),
        item("V9-reset", WARNING, c("trace.reset")),
        item("V9-boundary-low", ERROR, c("trace.implicit") & (c("trace.score") <= 2)),
        item("V9-boundary", WARNING, c("trace.implicit") & ~F.coalesce(c("trace.score") <= 2, F.lit(False))),
        Rule("V10-figure", ERROR, both.rlike(r"(?i)\bFigura\s+\d+\b") & ~pictured),
        item("V11-too-long", ERROR, mc & some(lambda a: F.length(a["texto"]) > TOO_LONG_ALTERNATIVE)),
        item("V11-task", ERROR, mc & some(lambda a: F.length(a["texto"]).between(LONG_ALTERNATIVE + 1, TOO_LONG_ALTERNATIVE) & _verb(a["texto"]))),
        item("V11-long", WARNING, mc & some(lambda a: F.length(a["texto"]).between(LONG_ALTERNATIVE + 1, TOO_LONG_ALTERNATIVE) & ~_verb(a["texto"]))),
        item("V12-metadata", ERROR, text.rlike(METADATA)),
        item("V13-fused", WARNING, F.trim(text).rlike(FUSED)),
        item("V14-latex", WARNING, maths & (I.without_math(text).rlike(BARE_LATEX) | some(lambda a: I.without_math(a["texto"]).rlike(BARE_LATEX)))),
        item("V15-dollars", ERROR, maths & (T.odd_dollars(text) | some(lambda a: T.odd_dollars(a["texto"])))),
        item("V15-braces", WARNING, maths & ((~T.odd_dollars(text) & T.brace_mismatch(text)) | some(lambda a: ~T.odd_dollars(a["texto"]) & T.brace_mismatch(a["texto"])))),
        item("V16-block", ERROR, mc & (n > 0) & text.rlike(r"(?:^|\n)\s*\(A\)")),
        item("V16-swapped", ERROR, mc & some(lambda a: (marker(a) != "") & (marker(a) != F.upper(F.trim(a["letra"]))))),
        item("V16-marker", WARNING, mc & some(lambda a: (marker(a) != "") & (marker(a) == F.upper(F.trim(a["letra"]))))),
        item("V16-repeated", ERROR, mc & (F.size(F.array_distinct(folded)) < F.size(folded))),
        Rule("V17-theme", WARNING, category(c("tema"))),
        Rule("V17-subtheme", WARNING, category(c("subtema"))),
        Rule("V17-summary", WARNING, _blank(c("descricao_breve"))),
        Rule("V17-tags", WARNING, F.coalesce(F.size("tags") <= 0, F.lit(True))),
        Rule("V17-unreviewed", ERROR, ~F.coalesce(c("reviewed"), F.lit(False))),
        item("V19-one-line", WARNING, (start == end) & (_dense(c("enunciado")) > SHORT_TEXT)),
        item("V24-notes", WARNING, F.size(notes) >= MANY_NOTES),
        item("V25-words", WARNING, (kind == "essay") & (F.coalesce(c("palavras_min"), F.lit(0)) == 0) & (F.coalesce(c("palavras_max"), F.lit(0)) == 0)),
        item("V25-affirmations", WARNING, (kind == "multi_select") & (F.regexp_count(text, F.lit(AFFIRMATION)) < 3)),
        item("V25-table", WARNING, (kind == "complete_table") & ~text.rlike(r"(?m)!\[|^\|.+\|") & (F.size("imagens") <= 0)),
        only("VCTX-undeclared", ERROR, c("tem_numeracao_linhas").isNull()),
        only("VCTX-unchecked", ERROR, ~F.coalesce(c("linhas_verificadas"), F.lit(False))),
        only("VCTX-unmarked", ERROR, c("tem_numeracao_linhas") & ~text.rlike(LINE_MARK)),
        only("VCTX-left-over", ERROR, ~c("tem_numeracao_linhas") & text.rlike(LINE_MARK_LEFT)),
    ]


def with_document_checks(items: DataFrame, by: str = "ws") -> DataFrame:
    """items (by, id_item, tipo_item, ordem_item, numero_questao, numero_principal, subitem, span, enunciado) with what their document says of them.

    has_subitems, order_breaks, repeated_id, repeated_order, overlaps, main_gap and sub_gap (whether numbers are left out), missing_refs (sub-items that
    an item names but that there aren't). One pass of windows by document, in few sorts; a gap shows in counts, so no range of numbers is laid out.
    """
    c, stem = F.col, F.col("tipo_item") == STEM
    main, sub = F.coalesce("numero_principal", "numero_questao"), F.col("subitem").try_cast("int")
    numbered = items.repartition(by).withColumns({"_main": main, "_sub": sub, "_ordem": F.coalesce(F.nullif(c("ordem_item"), F.lit(0)), "numero_questao")})
    doc, same = W.partitionBy(by), W.partitionBy(by, "_main")
    up = same.orderBy(sub.asc_nulls_first())
    order = doc.orderBy("_ordem", "_main", F.coalesce("_sub", F.lit(0)))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    tops = F.when(c("subitem").isNull() & ~stem, c("_main"))
    named = F.regexp_extract_all(F.concat_ws(" ", "enunciado", "texto_original"), F.lit(r"\b(\d{1,3}\.\d{1,2})\."), F.lit(1))
    own = F.filter(F.array_distinct(named), lambda r: F.split(r, r"\.")[0].cast("int") == c("_main"))
    # One sort by document, number and sub-item serves all windows up to gap: of equal numbers the first is marked, and marks are counted.
    marked = numbered.withColumn("_own", F.when(tops.isNotNull(), own)).withColumns({
        "_new_top": tops.isNotNull() & (F.count(tops).over(up.rowsBetween(W.unboundedPreceding, -1)) == 0), "_new_sub": sub.isNotNull() & ~F.lag(sub).over(up).eqNullSafe(sub),
    })
    counted = marked.withColumns({
        "has_subitems": F.count("subitem").over(same) > 0, "sub_gap": F.coalesce(F.max(sub).over(same) > F.count_if(c("_new_sub")).over(same), F.lit(False)), "missing_refs": F.array_except("_own", F.collect_set("id_item").over(same)),
    })
    gap = counted.withColumn("main_gap", F.coalesce(tops.isNotNull() & (F.max(tops).over(doc) - F.min(tops).over(doc) + 1 > F.count_if(c("_new_top")).over(doc)), F.lit(False)))
    checked = gap.withColumn("repeated_id", F.count("*").over(W.partitionBy(by, "id_item")) > 1).withColumns({
        "order_breaks": F.coalesce(c("_ordem") != F.lag("_ordem").over(order) + 1, F.lit(False)), "overlaps": F.coalesce(c("span.line_start") < F.last("span.line_end", True).over(before), F.lit(False)),
        "repeated_order": F.count("*").over(W.partitionBy(by, "_ordem")) > 1,
    })
    return checked.withColumn("missing_refs", F.coalesce("missing_refs", F.array().cast("array<string>"))).drop("_main", "_sub", "_ordem", "_own", "_new_top", "_new_sub")


def document_rules() -> list[Rule]:
    """Rules over the columns that with_document_checks adds."""
    c, stem = F.col, F.col("tipo_item") == STEM
    return [
        Rule("V18-stem", WARNING, ~stem & c("subitem").isNull() & c("has_subitems") & (c("tipo_item") != "multiple_choice") & ~_verb(F.coalesce(c("enunciado"), F.lit("")))),
        Rule("V20-reference", ERROR, F.size("missing_refs") > 0),
        Rule("V21-gap", ERROR, c("main_gap")), Rule("V21-sub-gap", ERROR, c("sub_gap")),
        Rule("V22-order", ERROR, ~stem & c("order_breaks")), Rule("V22-id", ERROR, ~stem & c("repeated_id")), Rule("V22-repeated-order", ERROR, ~stem & c("repeated_order")),
        Rule("V23-overlap", WARNING, ~stem & c("overlaps")),
    ]


def criterion_rules() -> list[Rule]:
    """Rules C1 to C7 over criteria (tipo, reviewed, observacoes, resposta_correta, respostas_corretas, solucao, passos, texto_original); passos: array of (descricao, nivel)."""
    c, kind = F.col, F.col("tipo")
    known = kind.isin(*CRITERION_TYPES)
    rule = lambda name, severity, breaks: Rule(name, severity, breaks & known)
    resolved = lambda o: F.startswith(o, F.lit("OCR-RESOLVED:")) | F.startswith(o, F.lit("OCR-FALSE-POSITIVE:"))
    many, empty, answer = kind.isin("multi_select", "complete_table"), _blank(c("solucao")), F.coalesce(c("resposta_correta"), F.lit(""))
    steps, answers = F.size("passos") > 0, F.greatest(F.size("respostas_corretas"), F.lit(0))
    open_like = kind.isin(*OPEN_TYPES)
    told = F.array_join(F.transform("passos", lambda s: F.lower(T.compact(F.coalesce(s["descricao"], F.lit(""))))), " ")
    return [
        Rule("C1-type", ERROR, ~F.coalesce(known, F.lit(False))), rule("C1-unreviewed", ERROR, ~F.coalesce(c("reviewed"), F.lit(False))),
        rule("C2-suspect", ERROR, F.exists("observacoes", lambda o: F.startswith(o, F.lit("OCR-SUSPECT:"))) & ~F.exists("observacoes", resolved)),
        rule("C3-answer", ERROR, (kind == "multiple_choice") & ~F.upper(answer).isin("A", "B", "C", "D")),
        rule("C4-single", ERROR, many & (answer != "")), rule("C4-none", ERROR, many & (answers == 0)), rule("C4-one", ERROR, (kind == "multi_select") & (answers == 1)),
        rule("C5-solution", ERROR, open_like & empty & ~F.exists("passos", lambda s: s["nivel"].isNotNull())),
        rule("C5-steps-essay", WARNING, (kind == "essay") & ~steps), rule("C5-both", ERROR, many & ~steps & empty), rule("C5-steps", ERROR, (kind == "open_response") & ~steps),
        rule("C6-words", WARNING, (F.coalesce(c("texto_original"), F.lit("")) != "") & (F.size(new_words()) > 0)),
        rule("C7-mirror", ERROR, kind.isin("open_response", "essay") & (F.length(F.trim("solucao")) >= SUBSTANTIAL) & steps & ~F.contains(told, F.lower(T.compact(c("solucao"))))),
    ]


def new_words() -> Column:
    """Long words of a criterion's edited fields, other solutions included, that neither its original nor a note of resolution has."""
    edited = F.concat_ws(" ", "solucao", F.transform("passos", lambda s: s["descricao"]), "resolucoes_alternativas")
    notes = F.concat_ws(" ", F.filter("observacoes", lambda o: F.startswith(o, F.lit("OCR-RESOLVED:")) | F.startswith(o, F.lit("OCR-FALSE-POSITIVE:"))))
    return F.array_except(F.array_except(T.long_words(edited), T.long_words(F.coalesce("texto_original", F.lit("")))), T.long_words(notes))


def mirrored(tipo: Column, solucao: Column, passos: Column, cotacao: Column) -> Column:
    """C8: the steps (array of struct pontos, descricao, nivel) of a table's criterion with its solution as the first description; others unchanged. Applied twice it changes nothing more."""
    bare = F.trim(solucao)
    points = F.when(passos[0]["pontos"].isNull() & passos[0]["nivel"].isNull(), cotacao).otherwise(passos[0]["pontos"])
    first = F.struct(points.alias("pontos"), bare.alias("descricao"), passos[0]["nivel"].alias("nivel"))
    fresh = F.struct(cotacao.alias("pontos"), bare.alias("descricao"), F.lit(None).cast("string").alias("nivel"))
    same = F.trim(F.coalesce(passos[0]["descricao"], F.lit(""))) == bare
    out = F.when(F.size(passos) <= 0, F.array(fresh)).when(same, passos).otherwise(F.concat(F.array(first), F.slice(passos, F.lit(2), F.greatest(F.size(passos) - 1, F.lit(0)))))
    return F.when((tipo == "complete_table") & (bare != ""), out).otherwise(passos)


def led_by_solution(tipo: Column, solucao: Column, passos: Column, cotacao: Column) -> Column:
    """C8 for open answers and essays: steps whose first description begins with the solution; others unchanged. Applied twice it changes nothing more.

    A solution that stands elsewhere in that description is taken out there, once, and put before it with a blank line between. Without steps there is one of all points, whole, 0 where unknown.
    """
    bare = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)^\s+|\s+$", "")
    told, first = bare(solucao), passos[0]
    own = bare(first["descricao"])
    at = F.position(told, own)
    rest = F.when(at > 0, bare(F.concat(F.substring(own, F.lit(1), at - 1), F.substring(own, at + F.length(told), F.length(own))))).otherwise(own)
    led = first.withField("descricao", F.when(rest == "", told).otherwise(F.concat(told, F.lit("\n\n"), rest)))
    fresh = F.struct(F.coalesce(cotacao, F.lit(0)).cast("long").alias("pontos"), told.alias("descricao"), F.lit("").alias("nivel"))
    out = F.when(F.coalesce(F.size(passos), F.lit(0)) <= 0, F.array(fresh)).when(F.startswith(own, told), passos).otherwise(F.concat(F.array(led), F.slice(passos, F.lit(2), F.greatest(F.size(passos) - 1, F.lit(0)))))
    return F.when(tipo.isin("open_response", "essay") & (told != ""), out).otherwise(passos)


def drafted(status: Column, tipo: Column, solucao: Column, passos: Column) -> Column:
    """The status of a criterion after led_by_solution: one that waited for review and had no steps is a draft once its solution is its step."""
    told = tipo.isin("open_response", "essay") & (F.regexp_replace(F.coalesce(solucao, F.lit("")), r"(?U)\s+", "") != "") & (F.coalesce(F.size(passos), F.lit(0)) <= 0)
    return F.when(told & (status == "pending_review"), "draft").otherwise(status)
