"""Criteria joined to items, contexts and stems resolved by ranked keys, and rows made ready for upload."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemforge.functions import text as T
from itemforge.operators import aggregates as A
from itemforge.operators import joins as J

STEM = "context_stem"
#: Types with an objective key, of which versions of an exam differ.
OBJECTIVE = ("multi_select", "complete_table", "multiple_choice")
#: The heading of an item in a text of criteria, and a mention of one.
HEADING = r"(?m)^#{0,4}\s*(\d{1,2}(?:\.\d+)?)\.(?:[ \t]*\.)?[ \t]+\d+\s*pontos\b"
MENTION = r"(?i)\b(\d{1,2}(?:\.\d+)?)\.\s+\d+\s*pontos\b"
#: How notes begin that the engine itself has written.
OWN_NOTES = tuple(f"[{who}][{what}]" for who in ("validate", "micro-lint") for what in ("erro", "aviso", "corrigido"))
#: Fields whose correction is content, not bookkeeping.
CRITICAL = (
    "enunciado alternativas resposta_correta respostas_corretas solucao criterios_parciais resolucoes_alternativas tema subtema descricao_breve tags imagens "
    "palavras_min palavras_max linhas_referenciadas parametros_classificacao pool_opcional"
).split()
UNCATEGORISED = "por categorizar"


def merge_keys(item_id: Column, number: Column) -> list[Column]:
    """Keys under which an item's criterion may stand, best first: as it is, without its part, and in group II without the group."""
    key = F.lower(F.trim(F.coalesce(F.nullif(F.trim(item_id), F.lit("")), number.cast("string"))))
    return [key, F.regexp_replace(key, "^([iv]+)-[a-c]-", "$1-"), F.when(F.startswith(key, F.lit("ii-")), F.regexp_replace(key, "^ii-", ""))]


def plain_number(item_id: Column) -> Column:
    """An id without its group and part."""
    return F.regexp_replace(F.regexp_replace(F.trim(item_id), "^(?i:[ivx]+)-", ""), "^[A-C]-", "")


def first_version(x: Column, tipo: Column) -> Column:
    """Of a text that gives two versions' keys, for an objective type, the first one's without its label; other texts as they are."""
    line = F.regexp_extract(x, r"(?mi)^[ \t]*versão[ \t]+1[ \t]*[:\-−–][ \t]*(.*)$", 1)
    two = F.contains(x, F.lit("Versão 1")) & F.contains(x, F.lit("Versão 2")) & x.rlike(r"(?mi)^[ \t]*versão[ \t]+1[ \t]*[:\-−–]")
    return F.when(tipo.isin(*OBJECTIVE) & two, F.trim(line)).otherwise(x)


def foreign_heading(item_id: Column, said: Column) -> Column:
    """Whether a text of criteria holds the heading, or a mention with points, of an item other than this one."""
    other = lambda pattern: F.exists(F.regexp_extract_all(said, F.lit(pattern), F.lit(1)), lambda n: n != plain_number(item_id))
    return other(HEADING) | other(MENTION)


def merged(items: DataFrame, criteria: DataFrame, order: str) -> DataFrame:
    """items with merge (stem, missing, type, foreign or merged) and what their criterion says; only merged rows take it.

    criteria (id_item, tipo, resposta_correta, respostas_corretas, solucao): of those under one key the last by `order` counts. A choice keeps its own
    answer where the criterion has none; answers of tables and multiple selections replace an answer of one letter. Where criteria have them, criterios_parciais
    (an array of structs with descricao) and resolucoes_alternativas replace an item's, descriptions as the solution in the first version; descriptions that
    hold another item's heading or mention make a criterion foreign as its solution does.
    """
    more = [c for c in ("criterios_parciais", "resolucoes_alternativas") if c in criteria.columns]
    fields = ["tipo", "resposta_correta", "respostas_corretas", "solucao", *more]
    last = criteria.groupBy(F.lower(F.trim("id_item")).alias("_key")).agg(F.max_by(F.struct(*fields), order).alias("_c"))
    joined = J.fallback_join(items, last, merge_keys(F.col("id_item"), F.col("numero_questao")), "_key", ["_c"])
    c, kind, stem = F.col("_c"), F.col("tipo_item"), F.col("tipo_item") == STEM
    foreign = foreign_heading(F.col("id_item"), F.coalesce(c["solucao"], F.lit("")))
    taken_over = {}
    if "criterios_parciais" in more:
        steps = c["criterios_parciais"]
        foreign = foreign | F.coalesce(F.exists(steps, lambda s: foreign_heading(F.col("id_item"), F.coalesce(s["descricao"], F.lit("")))), F.lit(False))
        taken_over["criterios_parciais"] = F.transform(steps, lambda s: s.withField("descricao", first_version(F.coalesce(s["descricao"], F.lit("")), kind)))
    if "resolucoes_alternativas" in more:
        taken_over["resolucoes_alternativas"] = c["resolucoes_alternativas"]
    state = F.when(stem, "stem").when(c.isNull(), "missing").when(c["tipo"] != kind, "type").when(foreign, "foreign").otherwise("merged")
    taken = state == "merged"
    many = kind.isin("multi_select", "complete_table")
    single = F.when(taken & (kind == "multiple_choice"), F.coalesce(F.nullif(c["resposta_correta"], F.lit("")), F.col("resposta_correta"))).when(taken & many, F.lit(None).cast("string")).otherwise(F.col("resposta_correta"))
    several = F.when(taken & many & (F.size(c["respostas_corretas"]) > 0), c["respostas_corretas"]).otherwise(F.col("respostas_corretas"))
    own = lambda name: F.col(name) if name in items.columns else F.lit(None)
    rest = {name: F.when(taken, value).otherwise(own(name)) for name, value in taken_over.items()}
    return joined.withColumns({"merge": state, "resposta_correta": single, "respostas_corretas": several, "solucao": F.when(taken, first_version(c["solucao"], kind)), **rest}).drop("_c")


def without_criteria(items: DataFrame, criteria: DataFrame) -> DataFrame:
    """Items for which a check before the merge finds no criterion; it knows the fallback of group II alone. Stems and rejected items don't count."""
    keys = criteria.select(F.lower(F.trim("id_item")).alias("_key")).distinct()
    exact, _, second = merge_keys(F.col("id_item"), F.col("numero_questao"))
    asked = items.filter((F.col("tipo_item") != STEM) & (F.col("status") != "validation_error"))
    missed = asked.withColumn("_try", exact).join(keys, F.col("_try") == F.col("_key"), "left_anti").withColumn("_try", second)
    return missed.join(keys, F.col("_try") == F.col("_key"), "left_anti").drop("_try")


def ranked_lookup(rows: DataFrame, key: str, candidates: Column, known: DataFrame, known_key: str, value: str) -> DataFrame:
    """(key, value): for each row the value of the first of its candidates (an array, nulls skipped) that `known` has."""
    each = rows.select(key, F.posexplode(candidates).alias("_rank", "_try"))
    found = each.join(known.select(F.col(known_key).alias("_try"), value), "_try").groupBy(key).agg(F.min_by(value, "_rank").alias(value))
    return rows.select(key).join(found, key, "left")


def context_keys(parents: Column, parent: Column, item_id: Column, main: Column, group: Column) -> Column:
    """Keys of an item's context, best first: several parents together, the parent named, a single one in the list, what stands before the id's point, the main number, the group's context."""
    one = F.size(parents) == 1
    return F.array(
        F.when(F.size(parents) >= 2, F.array_join(F.array_sort(parents), "+")), F.nullif(parent, F.lit("")), F.when(one, F.get(parents, F.lit(0))),
        F.when(F.contains(item_id, F.lit(".")), F.substring_index(item_id, ".", 1)), main.cast("string"), F.when(group != "", F.concat(group, F.lit("-ctx"))),
    )


def joint_contexts(items: DataFrame, stems: DataFrame, by: Sequence[str] = (), lists: Sequence[str] = ("imagens",), first: Sequence[str] = ()) -> DataFrame:
    """(by, combo, texto, lists, first, pagina, n): a context for each combination of two parents or more, its stems' texts under their ids, lists joined, the first stem's value of `first`, the first known page.

    A combination that names a stem there isn't gives none. Only combinations, each once, meet the stems, those of the same `by`.
    """
    combos = items.filter(F.size("parents") >= 2).select(*by, F.array_sort("parents").alias("p")).distinct()
    each = combos.select(*by, F.array_join("p", "+").alias("combo"), F.size("p").alias("wanted"), F.posexplode("p").alias("pos", "id_item"))
    met = each.join(stems, [*by, "id_item"]).groupBy(*by, "combo", "wanted").agg(F.array_sort(F.collect_list(F.struct("pos", "id_item", "texto", *lists, *first, "pagina"))).alias("s"))
    return _told_together(met.filter(F.size("s") == F.col("wanted")), by, lists, first)


def every_joint_context(items: DataFrame, stems: DataFrame, by: Sequence[str] = (), lists: Sequence[str] = ("imagens",), first: Sequence[str] = ()) -> DataFrame:
    """As joint_contexts, for stems of which several have one id: a context for each way to choose one of each parent.

    A parent is one join, whose rows are spread by group and id; the ways of a group are never gathered.
    """
    combos = items.filter(F.size("parents") >= 2).select(*by, F.array_sort("parents").alias("p")).distinct()
    ways, most = combos, combos.agg(F.max(F.size("p"))).first()[0] or 2
    stem = F.struct("id_item", "texto", *lists, *first, "pagina")
    for k in range(most):
        side = stems.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("id_item").alias("_id"), stem.alias("_stem"))
        same = reduce(and_, (F.col(c) == F.col(f"_{c}") for c in by), F.get("p", F.lit(k)) == F.col("_id"))
        one = F.array("_stem")
        met = ways.join(side, same, "left").filter((F.size("p") <= k) | F.col("_stem").isNotNull())
        ways = met.select(*by, "p", (one if k == 0 else F.when(F.size("p") > k, F.concat("s", one)).otherwise(F.col("s"))).alias("s"))
    return _told_together(ways.withColumn("combo", F.array_join("p", "+")), by, lists, first)


def _told_together(rows: DataFrame, by: Sequence[str], lists: Sequence[str], first: Sequence[str]) -> DataFrame:
    """Combinations (by, combo) with their stems s, in order, as contexts."""
    told = F.array_join(F.transform("s", lambda s: F.concat(F.lit("**["), s["id_item"], F.lit("]**\n\n"), F.coalesce(s["texto"], F.lit("")))), "\n\n---\n\n")
    page = F.get(F.filter("s", lambda s: F.coalesce(s["pagina"], F.lit(0)) != 0), F.lit(0))["pagina"]
    joined = [F.flatten(F.filter(F.col(f"s.{c}"), lambda x: x.isNotNull())).alias(c) for c in lists]
    return rows.select(*by, "combo", told.alias("texto"), *joined, *(F.col("s")[0][c].alias(c) for c in first), page.alias("pagina"), F.size("s").alias("n"))


def roman_order(group: Column) -> Column:
    """Groups I to V in order, others after them."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ("I", "II", "III", "IV", "V"))), group), F.lit(0)).cast("int") - 1, F.lit(9))


def numbered_contexts(contexts: DataFrame, by: Sequence[str]) -> DataFrame:
    """contexts (by, grupo, parte) with ctx_id: the group and a running number of its parts."""
    n = F.row_number().over(W.partitionBy(*by, "grupo").orderBy("parte"))
    return contexts.withColumn("ctx_id", F.concat("grupo", F.lit("-ctx"), n.cast("string")))


def placed_stems(items: DataFrame, contexts: DataFrame, by: str) -> DataFrame:
    """(by, id, is_stem, ordem): items (by, id, grupo, parte, ordem) and contexts (by, ctx_id, grupo, parte) numbered as one sequence.

    A context stands before the first item of its part; the group's own, without a part, before the group's first item. A part without items stands after its
    group, a group without items after the groups before it.
    """
    order = F.coalesce("ordem", F.lit(99999))
    part = items.groupBy(by, "grupo", "parte").agg(F.min(order).alias("first_p"))
    group = items.groupBy(by, "grupo").agg(F.min(order).alias("first_g"), F.max(F.coalesce("ordem", F.lit(0))).alias("last_g"))
    rank = W.partitionBy(by).orderBy("_r")
    both = contexts.select(by, "grupo").distinct().join(group, [by, "grupo"], "full_outer").withColumn("_r", roman_order(F.col("grupo")))
    led = both.withColumn("last_before", F.max("last_g").over(rank.rangeBetween(W.unboundedPreceding, -1))).drop("_r")
    known = contexts.join(part, [by, "grupo", "parte"], "left").join(led, [by, "grupo"], "left")
    own = F.col("first_p") - 0.5
    at = F.when(F.col("first_p").isNotNull(), own).when((F.col("parte") == "") & F.col("first_g").isNotNull(), F.col("first_g") - 0.5)
    at = at.when(F.col("parte") != "", F.coalesce("last_g", F.lit(0)) + 0.5).otherwise(F.coalesce(F.col("last_before") + 0.5, F.lit(0.0)))
    stems = known.select(by, F.col("ctx_id").alias("id"), F.lit(True).alias("is_stem"), F.ceil(at).cast("double").alias("_at"))
    rows = items.select(by, "id", F.lit(False).alias("is_stem"), (order + 0.5).alias("_at")).unionByName(stems)
    return rows.select(by, "id", "is_stem", F.row_number().over(W.partitionBy(by).orderBy("_at", "id")).alias("ordem"))


def unlabelled(notes: Column) -> Column:
    """Notes without those that the engine wrote itself."""
    return F.filter(notes, lambda n: ~F.exists(F.array(*map(F.lit, OWN_NOTES)), lambda p: F.startswith(n, p)))


def uncategorised(tema: Column, subtema: Column, summary: Column, tags: Column) -> Column:
    bare = lambda x: F.lower(F.trim(F.coalesce(x, F.lit(""))))
    return (bare(tema) == "") | (bare(subtema) == "") | (bare(summary) == "") | (F.coalesce(F.size(tags), F.lit(0)) <= 0) | (bare(tema) == UNCATEGORISED) | (bare(subtema) == UNCATEGORISED)


def parents(listed: Column, single: Column) -> Column:
    """The canonical list of parents: the list without blanks if it has entries, else the one named, else none."""
    bare = F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x != "")
    one = F.trim(F.coalesce(single, F.lit("")))
    return F.when(F.size(listed) > 0, bare).when(one != "", F.array(one)).otherwise(F.array().cast("array<string>"))


def image_entries(images: Column, urls: Column, said: Column) -> Column:
    """array<struct<url, descricao, alt>> of images: urls and said are maps; a description stands under the reference or its URL."""
    def entry(r: Column) -> Column:
        url = F.coalesce(urls[r], r)
        told = F.coalesce(F.nullif(said[r], F.lit("")), F.nullif(said[url], F.lit("")), F.lit(""))
        last = F.regexp_extract(url, "([^/]*)$", 1)
        alt = F.when(F.startswith(r, F.lit("http")), F.substring_index(last, ".", 1)).otherwise(F.regexp_extract(r, r"([^/]+?)(?:\.[^./]*)?$", 1))
        return F.struct(url.alias("url"), told.alias("descricao"), alt.alias("alt"))

    return F.transform(images, entry)


def upload_row(items: DataFrame) -> DataFrame:
    """Items in the shape of the bank's table: texts that are null become empty, an empty pool null; stems go elsewhere."""
    empty = {"enunciado", "grupo", "solucao", "materia", "tema", "subtema", "descricao_breve", "fonte"}
    shown = [F.coalesce(c, F.lit("")).alias(c) if c in empty else F.nullif(c, F.lit("")).alias(c) if c == "pool_opcional" else F.col(c) for c in map(str, items.columns)]
    return items.filter(F.col("tipo_item") != STEM).select(*shown)


def upload_faults(items: DataFrame, by: str) -> DataFrame:
    """(by, fault, n, first_ids): why a document may not be uploaded; a document without a row may.

    Faults: items without source, without category, several sources, a source that isn't canonical, items without subject, a subject that isn't the source's.
    first_ids: the first three ids, kept by a partial selection, so no document's ids are gathered whole.
    """
    bare = lambda c: F.trim(F.coalesce(c, F.lit("")))
    many = items.groupBy(by).agg(F.min(F.coalesce("fonte", F.lit(""))).alias("_low"), F.max(F.coalesce("fonte", F.lit(""))).alias("_high"))
    row = items.join(many.withColumn("_label", T.source_label(F.col("_low"))), by)
    stem, one = F.col("tipo_item") == STEM, F.col("_low") == F.col("_high")
    faults = {
        "no_source": bare("fonte") == "", "no_category": ~stem & F.lower(bare("tema")).isin("", UNCATEGORISED), "several_sources": ~one,
        "source_not_canonical": one & F.col("_label").isNull(), "no_subject": bare("materia") == "", "subject_differs": one & (F.col("materia") != "") & (F.col("materia") != F.col("_label.materia")),
    }
    each = row.select(by, "id_item", F.explode(F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in faults.items())))).alias("fault"))
    return A.first_keys(each, [by, "fault"], "id_item", "first_ids")
