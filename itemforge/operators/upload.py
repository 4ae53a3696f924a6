"""Items of reviewed documents as rows of the bank: sources, topics, contexts and questions, beside what the bank holds already."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemforge.functions import text as T
from itemforge.operators import aggregates as A
from itemforge.operators import joins as J
from itemforge.operators import merge as M
from itemforge.sources.shared import stored

#: The columns of a question in the bank, apart from its three references; their types, and whether a null becomes empty.
TEXTS = "id_item grupo enunciado solucao materia tema subtema descricao_breve fonte".split()
LISTS = {
    "alternativas": "array<struct<letra:string,texto:string>>", "imagens": "array<struct<url:string,descricao:string,alt:string>>", "criterios_parciais": "array<struct<pontos:bigint,descricao:string,nivel:string>>",
    "resolucoes_alternativas": "array<string>", "tags": "array<string>", "linhas_referenciadas": "array<string>", "parametros_classificacao": "array<string>", "respostas_corretas": "array<string>", "observacoes": "array<string>",
}
OTHERS = {"numero_questao": "int", "subitem": "string", "tipo_item": "string", "resposta_correta": "string", "pool_opcional": "string", "palavras_min": "int", "palavras_max": "int", "pagina_origem": "int", "status": "string"}
REFERENCES = ("fonte_id", "contexto_id", "topico_id")
QUESTION = [*REFERENCES, *TEXTS, *LISTS, *OTHERS]
TOPIC = ["id", "materia", "slug", "nome", "nivel", "pai_id"]
CONTEXT = ["id", "fonte_id", "id_item_original", "texto", "imagens", "grupo", "pagina_origem", "notas_rodape"]
#: How the note begins that holds an item's footnotes as JSON.
FOOTNOTES = "notas_rodape:"
NOTE = "array<struct<numero:string,texto:string>>"
#: So many items, about, are sorted in one task.
DEALT_ROWS = 50_000


def footnotes(notes: Column) -> Column:
    """Footnotes (numero, texto) in the first of the notes that holds readable ones as JSON; malformed ones are passed over, none are an empty list."""
    told = F.transform(F.filter(notes, lambda n: F.startswith(n, F.lit(FOOTNOTES))), lambda n: F.trim(F.substring(n, len(FOOTNOTES) + 1, 2**31 - 1)))
    read = F.transform(told, lambda j: F.from_json(F.when(F.startswith(j, F.lit("[")), j), NOTE))
    return F.coalesce(F.get(F.filter(read, lambda r: r.isNotNull()), F.lit(0)), F.array().cast(NOTE))


def question_fields(items: DataFrame) -> DataFrame:
    """items with every field of a question: those missing are added, null texts and lists become empty, an empty pool null, no status `approved`. Other columns stay."""
    there = set(items.columns)
    own = lambda c, kind: F.col(c).cast(kind) if c in there else F.lit(None).cast(kind)
    out = {c: F.coalesce(own(c, "string"), F.lit("")) for c in TEXTS}
    out |= {c: F.coalesce(own(c, kind), F.array().cast(kind)) for c, kind in LISTS.items()}
    out |= {c: own(c, kind) for c, kind in OTHERS.items()}
    out["pool_opcional"] = F.nullif(out["pool_opcional"], F.lit(""))
    out["status"] = F.coalesce(F.nullif(out["status"], F.lit("")), F.lit("approved"))
    return items.withColumns(out)


def latest(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row for each key, the last by `order`, chosen by a maximum that combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")


def topics_named(items: DataFrame, order: str) -> DataFrame:
    """(materia, slug, nome, nivel, pai): the topics that items name, each once for a subject and slug, whatever its level.

    The first item by `order`, a number, that names a slug gives its name, level and theme; an item's theme comes before its subtheme. Items without a theme, or with one without letters or digits, name none.
    Items that name the same words meet first, in an aggregation by hash, so slugs are made once for each and only what differs is sorted.
    """
    named = items.groupBy("materia", "tema", "subtema").agg(F.min(order).alias("_at"))
    theme, sub, none = T.slug(F.col("tema")), T.slug(F.col("subtema")), F.lit(None).cast("string")
    topic = lambda slug, name, level, up: F.struct(slug.alias("slug"), F.col(name).alias("nome"), F.lit(level).alias("nivel"), up.alias("pai"))
    each = named.filter(theme != "").select("materia", "_at", F.explode(F.array_compact(F.array(topic(theme, "tema", 1, none), F.when(sub != "", topic(sub, "subtema", 2, theme))))).alias("t"))
    return each.groupBy("materia", F.col("t.slug").alias("slug")).agg(F.min_by("t", F.struct("_at", "t.nivel", "t.nome")).alias("t")).select("materia", "slug", "t.nome", "t.nivel", "t.pai")


def with_topics(topics: DataFrame, items: DataFrame, order: str) -> DataFrame:
    """topics (id, materia, slug, nome, nivel, pai_id) and those that items name and the bank lacks, under ids that a rerun gives again."""
    new = topics_named(items, order).join(topics.select("materia", "slug"), ["materia", "slug"], "left_anti").withColumn("id", J.stable_id("materia", "slug"))
    up = topics.select("id", "materia", "slug").unionByName(new.select("id", "materia", "slug")).select(F.col("id").alias("pai_id"), "materia", F.col("slug").alias("pai"))
    return topics.select(*TOPIC).unionByName(new.join(up, ["materia", "pai"], "left").select(*TOPIC))


def contexts_named(items: DataFrame, order: str | None) -> DataFrame:
    """(fonte_id, id_item_original, texto, imagens, grupo, pagina_origem, notas_rodape): a context for each stem, and for each combination of two stems or more that an item names.

    Of several stems under one id the last by `order` counts; without an order all do, and a combination has a context for each way to choose its stems. Combinations with a missing stem give none.
    """
    told = items.filter(F.col("tipo_item") == M.STEM)
    stems = (latest(told, ["fonte_id", "id_item"], order) if order else told).select("fonte_id", "id_item", F.col("enunciado").alias("texto"), "imagens", "grupo", F.col("pagina_origem").alias("pagina"), footnotes(F.col("observacoes")).alias("notas_rodape"))
    asked = items.filter(F.col("tipo_item") != M.STEM).select("fonte_id", F.col("ids_contexto_pai").alias("parents"))
    joint = (M.joint_contexts if order else M.every_joint_context)(asked, stems, by=["fonte_id"], lists=["imagens", "notas_rodape"], first=["grupo"])
    told = lambda rows, key: rows.select("fonte_id", F.col(key).alias("id_item_original"), "texto", "imagens", "grupo", F.col("pagina").alias("pagina_origem"), "notas_rodape")
    return told(stems, "id_item").unionByName(told(joint, "combo"))


def with_contexts(contexts: DataFrame, items: DataFrame, order: str) -> DataFrame:
    """The bank's contexts with those of items put in or, under the same source and id, overwritten; an id once given stays."""
    new = contexts_named(items, order)
    done = J.upsert(contexts.select(*CONTEXT), new, ["fonte_id", "id_item_original"])
    return done.withColumn("id", F.coalesce("id", J.stable_id("fonte_id", "id_item_original"))).select(*CONTEXT)


def every_context(contexts: DataFrame, items: DataFrame) -> DataFrame:
    """The bank's contexts that items don't name, and all that items do: documents of one source keep each their stem under an id that they share. The id of a new one is a digest of its row."""
    keys, new = ["fonte_id", "id_item_original"], contexts_named(items, None)
    kept = contexts.select(*CONTEXT).join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*CONTEXT).unionByName(new.withColumn("id", J.stable_id(*(c for c in CONTEXT if c != "id"))).select(*CONTEXT))


def question_rows(items: DataFrame, topics: DataFrame, contexts: DataFrame, order: str) -> DataFrame:
    """The questions among items as rows of the bank, with their topic (the subtheme's, else the theme's) and the first of their contexts that there is.

    items need fonte_id and the fields of a question. Of several items under one source, group and id the last by `order` counts.
    """
    one = latest(items.filter(F.col("tipo_item") != M.STEM), ["fonte_id", "grupo", "id_item"], order).withColumn("_key", F.struct("fonte_id", "grupo", "id_item"))
    named = M.context_keys(F.col("ids_contexto_pai"), F.coalesce("id_contexto_pai", F.lit("")), F.col("id_item"), F.col("numero_principal"), F.col("grupo"))
    tries = F.transform(named, lambda k: F.when(k.isNotNull(), F.struct(F.col("fonte_id").alias("f"), k.alias("k"))))
    known = contexts.select(F.struct(F.col("fonte_id").alias("f"), F.col("id_item_original").alias("k")).alias("_known"), F.col("id").alias("contexto_id"))
    asked = one.select("_key", F.filter(tries, lambda t: t.isNotNull()).alias("_tries"))
    placed = one.join(M.ranked_lookup(asked, "_key", F.col("_tries"), known, "_known", "contexto_id"), "_key", "left")
    sub, theme = T.slug(F.col("subtema")), T.slug(F.col("tema"))
    topic = topics.select(F.col("id").alias("topico_id"), F.col("materia").alias("_m"), F.col("slug").alias("_s"))
    leaf = F.when(theme != "", F.coalesce(F.nullif(sub, F.lit("")), theme))
    return placed.join(topic, (F.col("materia") == F.col("_m")) & (leaf == F.col("_s")), "left").select(*QUESTION)


def sound_rows(items: DataFrame, sources: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """The sources (id, fonte) with those of items that the bank lacks, and the items of documents without a fault, with every field of a question and fonte_id, stored once.

    A source that the bank holds under several ids is uploaded under the smallest, so an item is one row. Items are counted and dealt by document into parts of DEALT_ROWS first: no task's share
    depends on how their files are cut, nor on how small their rows are when compressed. Documents with a fault and sources are tables of their own, each computed once.
    """
    dealt = items.repartition(items.count() // DEALT_ROWS + 1, by)
    sound = question_fields(dealt).join(stored(M.upload_faults(dealt, by).select(by).distinct(), "faults"), by, "left_anti")
    known = stored(J.get_or_create(sources, sound, ["fonte"], "id"), "fontes")
    return known, stored(sound.join(known.groupBy("fonte").agg(F.min("id").alias("fonte_id")), "fonte"), "upload")


def uploaded(items: DataFrame, bank: dict[str, DataFrame], by: str, order: str, now: Column | None = None) -> dict[str, DataFrame]:
    """The bank's tables (fontes, topicos, contextos, questoes) after an upload of items (by, ids_contexto_pai, id_contexto_pai, numero_principal and fields of a question).

    Documents (`by`) with a fault that upload_faults finds stay out as a whole, their questions in the bank as they were. Questions are put in or overwritten under source, group and id;
    questoes has the columns of a question and created_at, updated_at: both are `now` for new rows, the second alone for others. A second upload changes nothing but updated_at.
    order: a column whose values differ, by which the last of several rows under one key counts. Sources, sound items, topics and contexts are tables in the shared folder, each computed once.
    """
    at = F.current_timestamp() if now is None else now
    sources, rows = sound_rows(items, bank["fontes"], by)
    topics = stored(with_topics(bank["topicos"], rows.filter(F.col("tipo_item") != M.STEM), order), "topicos")
    contexts = stored(with_contexts(bank["contextos"], rows, order), "contextos")
    sent = question_rows(rows, topics, contexts, order).withColumn("updated_at", at)
    questions = J.upsert(bank["questoes"], sent, ["fonte_id", "grupo", "id_item"]).withColumn("created_at", F.coalesce("created_at", "updated_at"))
    return {"fontes": sources, "topicos": topics, "contextos": contexts, "questoes": questions}


def source_values(items: DataFrame, by: str, value: str = "fonte", key: str = "id_item") -> DataFrame:
    """(by, value, n, first_keys): of documents that should share one value but hold several, each value with its rows and first three keys; null counts as a value."""
    several = items.groupBy(by).agg(F.count_distinct(F.coalesce(value, F.lit(""))).alias("_n")).filter("_n > 1").select(by)
    shown = items.select(by, F.coalesce(value, F.lit("")).alias(value), key).join(several, by, "left_semi")
    return A.first_keys(shown, [by, value], key, "first_keys")


def contains_all(have: Column, asked: Column) -> Column:
    """Whether a list holds every value of another; an empty one is held by all."""
    return F.size(F.array_except(asked, have)) == 0
