"""Merging criteria, resolving contexts, placing stems and making upload rows, bound to parts, customers, orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators import merge as M
from itemforge.plans.registry import query, table

_TYPE = "CASE {0} % 6 WHEN 0 THEN 'multiple_choice' WHEN 1 THEN 'multi_select' WHEN 2 THEN 'complete_table' WHEN 3 THEN 'open_response' ELSE 'essay' END"
#: Items and criteria as expressions that both dialects read; k is a key.
_ITEM = {
    "id_item": "CASE k % 5 WHEN 0 THEN 'I-A-' || (k % 40) WHEN 1 THEN 'II-' || (k % 40) WHEN 2 THEN 'I-' || (k % 40) WHEN 3 THEN ' ' || (k % 40) || ' ' ELSE '' END", "numero_questao": "k % 40",
    "tipo_item": f"CASE WHEN k % 13 = 0 THEN 'context_stem' ELSE {_TYPE.format('(k % 40)')} END", "resposta_correta": "CASE WHEN k % 3 = 0 THEN 'B' END", "status": "CASE WHEN k % 10 = 9 THEN 'validation_error' ELSE 'approved' END",
}
_CRITERION = {
    "id_item": "CASE k % 3 WHEN 0 THEN 'I-' || (k % 40) WHEN 1 THEN '' || (k % 40) ELSE 'i-a-' || (k % 40) || ' ' END", "tipo": f"CASE WHEN k % 7 = 0 THEN 'essay' ELSE {_TYPE.format('(k % 40)')} END",
    "resposta_correta": "CASE k % 4 WHEN 0 THEN 'A' WHEN 1 THEN '' END", "answers": "CASE WHEN k % 4 > 1 THEN 'I;III' ELSE '' END",
    "solucao": "CASE k % 11 WHEN 0 THEN 'ver 99. 10 pontos' WHEN 1 THEN '## 98. 5 pontos' || chr(10) || 'resto' WHEN 2 THEN 'Versão 1: (a) 2' || chr(10) || 'Versão 2: (a) 3' WHEN 3 THEN 'Opcao (A)' ELSE 'resultado ' || k END",
}


def _made(spark: SparkSession, sf_dir: str, name: str, key: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, name).withColumn("k", F.col(key)).selectExpr("k", *(f"{e} AS {n}" for n, e in columns.items()))


def _sql(name: str, key: str, columns: dict[str, str]) -> str:
    return f"SELECT k, {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM (SELECT {key} AS k FROM {name})"


def _list(text: str):
    return F.filter(F.split(text, ";"), lambda x: x != "")


def _bank(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = _made(spark, sf_dir, "part", "p_partkey", _ITEM).withColumn("respostas_corretas", F.array(F.lit("II"), F.lit("IV")))
    return items, _made(spark, sf_dir, "customer", "c_custkey", _CRITERION).withColumn("respostas_corretas", _list("answers")).withColumnRenamed("k", "at")


_BOTH = f"""i AS ({_sql('part', 'p_partkey', _ITEM)}), c AS ({_sql('customer', 'c_custkey', _CRITERION)}),
    l AS (SELECT * FROM (SELECT *, lower(trim(id_item)) AS ck, row_number() OVER (PARTITION BY lower(trim(id_item)) ORDER BY k DESC) AS rn FROM c) WHERE rn = 1),
    q AS (SELECT *, lower(trim(CASE WHEN id_item = '' THEN numero_questao || '' ELSE id_item END)) AS k1 FROM i), p AS (SELECT *, regexp_replace(k1, '^([iv]+)-[a-c]-', '\\1-') AS k2, CASE WHEN starts_with(k1, 'ii-') THEN substr(k1, 4) END AS k3 FROM q)"""


@query(f"""
    WITH {_BOTH}, j AS (SELECT p.*, CASE WHEN a.ck IS NOT NULL THEN a WHEN b.ck IS NOT NULL THEN b ELSE d END AS m, regexp_replace(regexp_replace(trim(p.id_item), '^[IVXivx]+-', ''), '^[A-C]-', '') AS own
        FROM p LEFT JOIN l a ON a.ck = k1 LEFT JOIN l b ON b.ck = k2 LEFT JOIN l d ON d.ck = k3),
        s AS (SELECT *, CASE WHEN tipo_item = 'context_stem' THEN 'stem' WHEN m.ck IS NULL THEN 'missing' WHEN m.tipo <> tipo_item THEN 'type' WHEN contains(m.solucao, '99. 10 pontos') OR contains(m.solucao, '98. 5 pontos') THEN 'foreign' ELSE 'merged' END AS merge FROM j)
    SELECT k, merge, CASE WHEN merge = 'merged' AND tipo_item = 'multiple_choice' THEN coalesce(nullif(m.resposta_correta, ''), resposta_correta) WHEN merge = 'merged' AND tipo_item IN ('multi_select', 'complete_table') THEN NULL ELSE resposta_correta END AS resposta_correta,
        CASE WHEN merge = 'merged' AND tipo_item IN ('multi_select', 'complete_table') AND m.answers <> '' THEN m.answers ELSE 'II;IV' END AS respostas,
        CASE WHEN merge = 'merged' THEN CASE WHEN tipo_item IN ('multiple_choice', 'multi_select', 'complete_table') AND starts_with(m.solucao, 'Versão 1') THEN '(a) 2' ELSE m.solucao END END AS solucao FROM s""")
def criteria_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their criterion by three keys, what blocks a merge, and the fields that it sets."""
    items, criteria = _bank(spark, sf_dir)
    return M.merged(items, criteria, "at").select("k", "merge", "resposta_correta", F.array_join("respostas_corretas", ";").alias("respostas"), "solucao")


@query(f"WITH {_BOTH} SELECT k FROM p WHERE tipo_item <> 'context_stem' AND status <> 'validation_error' AND k1 NOT IN (SELECT ck FROM l WHERE k % 40 < 25) AND coalesce(k3 NOT IN (SELECT ck FROM l WHERE k % 40 < 25), true)")
def merge_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that lack a criterion before a merge."""
    items, criteria = _bank(spark, sf_dir)
    return M.without_criteria(items, criteria.filter("at % 40 < 25")).select("k")


_ORDER = {
    "id_item": "CASE WHEN k % 5 = 0 THEN 'I-' || (k % 9) || '.' || (k % 3) ELSE 'I-' || (k % 9) END", "listed": "CASE k % 6 WHEN 0 THEN 'c' || (k % 20) || ';c' || (k % 7) WHEN 1 THEN ' c' || (k % 30) || ' ; ' WHEN 2 THEN ' ' ELSE '' END",
    "single": "CASE WHEN k % 4 = 1 THEN 'c' || (k % 50) END", "main": "CASE WHEN k % 7 > 1 THEN k % 12 END", "grupo": "CASE WHEN k % 3 = 0 THEN 'I' WHEN k % 3 = 1 THEN 'II' ELSE '' END",
}
_CONTEXT = "SELECT CASE c_custkey % 4 WHEN 0 THEN 'c' || (c_custkey % 25) WHEN 1 THEN '' || (c_custkey % 6) WHEN 2 THEN 'I-' || (c_custkey % 9) ELSE CASE WHEN c_custkey % 8 = 3 THEN 'I-ctx' ELSE 'c3+c5' END END AS ctx, min(c_custkey) AS ctx_id FROM customer GROUP BY ALL"


@query(f"""
    WITH o AS ({_sql('orders', 'o_orderkey', _ORDER)}), x AS ({_CONTEXT}),
        p AS (SELECT *, list_filter(list_transform(string_split(listed, ';'), lambda v: trim(v)), lambda v: v <> '') AS ps FROM o),
        q AS (SELECT *, CASE WHEN listed <> '' THEN ps WHEN single IS NOT NULL THEN [single] ELSE [] END AS pa FROM p)
    SELECT k, array_to_string(pa, ',') AS parents, coalesce(a.ctx_id, b.ctx_id, c.ctx_id, d.ctx_id, e.ctx_id, f.ctx_id) AS ctx_id FROM q
    LEFT JOIN x a ON len(pa) >= 2 AND a.ctx = array_to_string(list_sort(pa), '+') LEFT JOIN x b ON b.ctx = single LEFT JOIN x c ON len(pa) = 1 AND c.ctx = pa[1] LEFT JOIN x d ON contains(id_item, '.') AND d.ctx = string_split(id_item, '.')[1]
    LEFT JOIN x e ON e.ctx = main || '' LEFT JOIN x f ON grupo <> '' AND f.ctx = grupo || '-ctx'""")
def context_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item's canonical parents, and its context by the first of six keys that there is."""
    rows = _made(spark, sf_dir, "orders", "o_orderkey", _ORDER).withColumn("pa", M.parents(F.when(F.col("listed") != "", F.split("listed", ";")), F.col("single")))
    c = F.col("c_custkey")
    text = lambda *p: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in p))
    name = F.when(c % 4 == 0, text("c", c % 25)).when(c % 4 == 1, text(c % 6)).when(c % 4 == 2, text("I-", c % 9)).when(c % 8 == 3, "I-ctx").otherwise("c3+c5")
    known = table(spark, sf_dir, "customer").groupBy(name.alias("ctx")).agg(F.min("c_custkey").alias("ctx_id"))
    keys = M.context_keys(F.col("pa"), F.coalesce("single", F.lit("")), F.col("id_item"), F.col("main"), F.col("grupo"))
    return rows.select("k", F.array_join("pa", ",").alias("parents")).join(M.ranked_lookup(rows, "k", keys, known, "ctx", "ctx_id"), "k").select("k", "parents", "ctx_id")


@query("""
    WITH c AS (SELECT DISTINCT least(a, b) AS x, greatest(a, b) AS y FROM (SELECT o_custkey % 60 AS a, o_orderkey % 60 AS b FROM orders) WHERE a <> b),
        s AS (SELECT s_suppkey AS k, 'c' || s_suppkey AS id_item, CASE WHEN s_suppkey % 5 > 0 THEN s_name END AS texto, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey || '.png' END AS img, CASE WHEN s_suppkey % 4 = 1 THEN s_suppkey % 9 END AS pagina FROM supplier WHERE s_suppkey % 10 < 8),
        n AS (SELECT *, CASE WHEN 'c' || x < 'c' || y THEN x ELSE y END AS u, CASE WHEN 'c' || x < 'c' || y THEN y ELSE x END AS v FROM c)
    SELECT a.id_item || '+' || b.id_item AS combo, '**[' || a.id_item || ']**' || chr(10) || chr(10) || coalesce(a.texto, '') || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '**[' || b.id_item || ']**' || chr(10) || chr(10) || coalesce(b.texto, '') AS texto,
        concat_ws(',', a.img, b.img) AS imagens, coalesce(nullif(a.pagina, 0), nullif(b.pagina, 0)) AS pagina FROM n JOIN s a ON a.k = u JOIN s b ON b.k = v""")
def joint_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts of several stems, in the order of their ids; combinations that name a missing stem give none."""
    name = lambda c: F.concat(F.lit("c"), (F.col(c) % 60).cast("string"))
    items = table(spark, sf_dir, "orders").filter("o_custkey % 60 <> o_orderkey % 60").select(F.array(name("o_custkey"), name("o_orderkey")).alias("parents"))
    k = F.col("s_suppkey")
    stems = table(spark, sf_dir, "supplier").filter(k % 10 < 8).select(
        F.concat(F.lit("c"), k.cast("string")).alias("id_item"), F.when(k % 5 > 0, F.col("s_name")).alias("texto"), F.when(k % 3 > 0, F.array(F.concat(k.cast("string"), F.lit(".png")))).alias("imagens"), F.when(k % 4 == 1, k % 9).alias("pagina")
    )
    return M.joint_contexts(items, stems).select("combo", "texto", F.array_join("imagens", ",").alias("imagens"), "pagina")


_G = "CASE {0} % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' ELSE '' END"
_P = "CASE {0} % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE 'B' END"


@query(f"""
    WITH i AS (SELECT l_orderkey AS ws, l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INT) AS id, {_G.format('l_linenumber')} AS grupo, {_P.format('l_partkey')} AS parte, CASE WHEN l_suppkey % 9 > 0 THEN l_linenumber END AS ordem FROM lineitem),
        c AS (SELECT ws, grupo, parte, grupo || '-ctx' || row_number() OVER (PARTITION BY ws, grupo ORDER BY parte) AS ctx_id FROM (SELECT DISTINCT l_orderkey AS ws, {_G.format('l_partkey')} AS grupo, {_P.format('l_suppkey')} AS parte FROM lineitem)),
        r AS (SELECT *, CASE grupo WHEN 'I' THEN 0 WHEN 'II' THEN 1 WHEN 'III' THEN 2 ELSE 9 END AS g FROM i),
        t AS (SELECT c.*, (SELECT min(coalesce(ordem, 99999)) FROM i WHERE i.ws = c.ws AND i.grupo = c.grupo AND i.parte = c.parte) AS fp, (SELECT min(coalesce(ordem, 99999)) FROM i WHERE i.ws = c.ws AND i.grupo = c.grupo) AS fg,
            (SELECT max(coalesce(ordem, 0)) FROM i WHERE i.ws = c.ws AND i.grupo = c.grupo) AS lg, (SELECT max(coalesce(ordem, 0)) FROM r WHERE r.ws = c.ws AND g < CASE c.grupo WHEN 'I' THEN 0 WHEN 'II' THEN 1 WHEN 'III' THEN 2 ELSE 9 END) AS lb FROM c),
        u AS (SELECT ws, ctx_id AS id, true AS is_stem, ceil(CASE WHEN fp IS NOT NULL THEN fp - 0.5 WHEN parte = '' AND fg IS NOT NULL THEN fg - 0.5 WHEN parte <> '' THEN coalesce(lg, 0) + 0.5 ELSE coalesce(lb + 0.5, 0) END) AS stands FROM t
            UNION ALL SELECT ws, id, false, coalesce(ordem, 99999) + 0.5 FROM i)
    SELECT ws, id, is_stem, CAST(row_number() OVER (PARTITION BY ws ORDER BY stands, id) AS INT) AS ordem FROM u""")
def stem_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts numbered within their group and placed among the items of their part."""
    t = table(spark, sf_dir, "lineitem")
    g = lambda c: F.when(F.col(c) % 4 == 0, "I").when(F.col(c) % 4 == 1, "II").when(F.col(c) % 4 == 2, "III").otherwise("")
    p = lambda c: F.when(F.col(c) % 3 == 0, "").when(F.col(c) % 3 == 1, "A").otherwise("B")
    name = F.concat_ws("-", *(F.col(c).cast("int").cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")))
    items = t.select(F.col("l_orderkey").alias("ws"), name.alias("id"), g("l_linenumber").alias("grupo"), p("l_partkey").alias("parte"), F.when(F.col("l_suppkey") % 9 > 0, F.col("l_linenumber")).alias("ordem"))
    contexts = t.select(F.col("l_orderkey").alias("ws"), g("l_partkey").alias("grupo"), p("l_suppkey").alias("parte")).distinct()
    return M.placed_stems(items, M.numbered_contexts(contexts, ["ws"]), "ws")


@query("""
    WITH s AS (SELECT n_nationkey AS k, n_regionkey AS g, CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE 'B' END AS p, n_name FROM nation WHERE n_nationkey % 4 > 0),
        f AS (SELECT g, p, min(n_name) AS stem FROM s GROUP BY ALL), o AS (SELECT min(n_name) AS stem FROM s WHERE p = '')
    SELECT c_custkey, coalesce(a.stem, b.stem, (SELECT stem FROM o)) AS stem FROM (SELECT c_custkey, c_nationkey % 7 AS g, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE 'C' END AS p FROM customer) c
        LEFT JOIN f a ON a.g = c.g AND a.p = c.p LEFT JOIN f b ON b.g = c.g AND b.p = ''""")
def stem_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item's stem: its group and part's, its group's, else the one without a group."""
    from itemforge.operators import joins as J

    k = F.col("n_nationkey")
    part = F.when(k % 3 == 0, "").when(k % 3 == 1, "A").otherwise("B")
    stems = table(spark, sf_dir, "nation").filter(k % 4 > 0).groupBy(F.concat_ws("|", F.col("n_regionkey").cast("string"), part).alias("key")).agg(F.min("n_name").alias("stem"))
    bare = table(spark, sf_dir, "nation").filter((k % 4 > 0) & (k % 3 == 0)).agg(F.min("n_name").alias("stem")).select(F.lit("*").alias("key"), "stem")
    c = F.col("c_custkey")
    group, own = (F.col("c_nationkey") % 7).cast("string"), F.when(c % 4 == 0, "").when(c % 4 == 1, "A").when(c % 4 == 2, "B").otherwise("C")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return J.fallback_join(rows, stems.unionByName(bare), [F.concat_ws("|", group, own), F.concat_ws("|", group, F.lit("")), F.lit("*")], "key", ["stem"]).select("c_custkey", "stem")


@query("""
    WITH n AS (SELECT page_id, regexp_extract(url, '([^/]+?)(\\.[^./]*)?$', 1) || CASE WHEN page_id % 2 = 0 THEN '_net' ELSE '' END AS ws FROM pages),
        d AS (SELECT CASE page_id % 4 WHEN 0 THEN regexp_replace(ws, '_net$', '-CC-VD_net') WHEN 1 THEN ws || '-CC-VD' WHEN 2 THEN regexp_replace(ws, '_net$', '-CC-VD') ELSE ws END AS sibling FROM n)
    SELECT page_id, CASE WHEN one IN (SELECT sibling FROM d) THEN one WHEN two IN (SELECT sibling FROM d) THEN two END AS sibling FROM
        (SELECT page_id, CASE WHEN ws LIKE '%\\_net' ESCAPE '\\' THEN regexp_replace(ws, '_net$', '-CC-VD_net') ELSE ws || '-CC-VD' END AS one, CASE WHEN ws LIKE '%\\_net' ESCAPE '\\' THEN regexp_replace(ws, '_net$', '-CC-VD') ELSE ws || '-CC-VD_net' END AS two FROM n)""")
def sibling_workspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder of criteria beside a folder of an exam: its name with a suffix, or the other spelling of it."""
    stem = F.regexp_extract("url", r"([^/]+?)(\.[^./]*)?$", 1)
    k, net = F.col("page_id"), F.when(F.col("page_id") % 2 == 0, "_net").otherwise("")
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(stem, net).alias("ws"))
    cut, ends = F.regexp_replace("ws", "_net$", ""), F.endswith(F.col("ws"), F.lit("_net"))
    there = rows.select(F.when(k % 4 == 0, F.concat(cut, F.lit("-CC-VD_net"))).when(k % 4 == 1, F.concat("ws", F.lit("-CC-VD"))).when(k % 4 == 2, F.concat(cut, F.lit("-CC-VD"))).otherwise(F.col("ws")).alias("sibling")).distinct()
    names = F.when(ends, F.array(F.concat(cut, F.lit("-CC-VD_net")), F.concat(cut, F.lit("-CC-VD")))).otherwise(F.array(F.concat("ws", F.lit("-CC-VD")), F.concat("ws", F.lit("-CC-VD_net"))))
    return M.ranked_lookup(rows, "page_id", names, there.withColumn("name", F.col("sibling")), "name", "sibling")


_UPLOAD = {
    "tipo_item": "CASE WHEN k % 8 = 0 THEN 'context_stem' ELSE 'essay' END", "enunciado": "CASE WHEN k % 3 > 0 THEN p_name END", "pool_opcional": "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'I-opt' END", "grupo": "CASE WHEN k % 4 > 0 THEN 'I' END",
    "tema": "CASE k % 5 WHEN 0 THEN ' Por categorizar' WHEN 1 THEN '' ELSE p_type END", "subtema": "CASE WHEN k % 7 > 0 THEN p_brand END", "descricao_breve": "CASE WHEN k % 9 > 0 THEN p_name ELSE ' ' END", "n_tags": "k % 11",
}


@query(f"""
    SELECT k, coalesce(enunciado, '') AS enunciado, nullif(pool_opcional, '') AS pool_opcional, coalesce(grupo, '') AS grupo, coalesce(subtema, '') AS subtema, 
        trim(tema) = '' OR lower(trim(tema)) = 'por categorizar' OR subtema IS NULL OR trim(descricao_breve) = '' OR n_tags = 0 AS uncategorised,
        'https://b/' || k || '.png|' || CASE WHEN k % 2 = 0 THEN 'figura' ELSE '' END || '|' || k || ';http://x/y.z/f.jpg||f' AS imagens FROM (SELECT k, {', '.join(f'{e} AS {n}' for n, e in _UPLOAD.items())} FROM (SELECT p_partkey AS k, p_name, p_type, p_brand FROM part)) WHERE tipo_item <> 'context_stem'""")
def upload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as rows of the bank: defaults for nulls, image entries from two maps, and whether they lack a category."""
    rows = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey")).selectExpr("k", *(f"{e} AS {n}" for n, e in _UPLOAD.items()))
    ref = F.concat("k", F.lit(".png"))
    url = F.concat(F.lit("https://b/"), ref)
    images = M.image_entries(F.array(ref, F.lit("http://x/y.z/f.jpg")), F.create_map(ref, url), F.when(F.col("k") % 4 == 0, F.create_map(ref, F.lit("figura"))).when(F.col("k") % 4 == 2, F.create_map(url, F.lit("figura"))).otherwise(F.create_map(ref, F.lit(""))))
    lacks = M.uncategorised(F.col("tema"), F.col("subtema"), F.col("descricao_breve"), F.array_repeat(F.lit("#t"), F.col("n_tags").cast("int")))
    shown = F.array_join(F.transform(images, lambda i: F.concat_ws("|", i["url"], i["descricao"], i["alt"])), ";")
    return M.upload_row(rows.withColumns({"uncategorised": lacks, "imagens": shown})).select("k", "enunciado", "pool_opcional", "grupo", "subtema", "uncategorised", "imagens")


_LABELS = ("Exame Nacional, Português, 1.ª Fase, 2024", "Exame Nacional, Matemática A, 2.ª Fase, 2023", "Exame Nacional, Matematica, 1.ª Fase, 2014")


@query(f"""
    WITH i AS (SELECT o_custkey AS ws, o_orderkey AS id_item, o_orderkey % 9 = 0 AS stem, CASE WHEN o_orderkey % 50 = 0 THEN ' ' WHEN o_custkey % 5 = 0 AND o_orderkey % 4 = 0 THEN '{_LABELS[1]}' WHEN o_custkey % 3 = 0 THEN '{_LABELS[0]}' WHEN o_custkey % 3 = 1 THEN '{_LABELS[1]}' ELSE '{_LABELS[2]}' END AS fonte,
            CASE o_orderkey % 40 WHEN 0 THEN '' WHEN 1 THEN 'Por categorizar' ELSE 'tema' END AS tema, CASE WHEN o_orderkey % 30 = 0 THEN NULL WHEN o_orderkey % 30 < 20 THEN 'Português' ELSE 'Matemática A' END AS materia FROM orders),
        m AS (SELECT ws, min(fonte) AS lo, max(fonte) AS hi FROM i GROUP BY ws),
        f AS (SELECT i.ws, id_item, unnest(list_filter([CASE WHEN trim(fonte) = '' THEN 'no_source' END, CASE WHEN NOT stem AND lower(trim(tema)) IN ('', 'por categorizar') THEN 'no_category' END, CASE WHEN lo <> hi THEN 'several_sources' END,
            CASE WHEN lo = hi AND lo NOT IN ('{_LABELS[0]}', '{_LABELS[1]}') THEN 'source_not_canonical' END, CASE WHEN materia IS NULL THEN 'no_subject' END,
            CASE WHEN lo = hi AND lo IN ('{_LABELS[0]}', '{_LABELS[1]}') AND materia <> string_split(lo, ', ')[2] THEN 'subject_differs' END], lambda v: v IS NOT NULL)) AS fault FROM i JOIN m ON i.ws = m.ws)
    SELECT ws, fault, count(*) AS n, list_aggregate(list_slice(list(id_item ORDER BY id_item), 1, 3), 'string_agg', ',') AS first_ids FROM f GROUP BY ALL""")
def upload_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a document may not be uploaded, with the first three items of each reason."""
    k, w = F.col("o_orderkey"), F.col("o_custkey")
    label = F.when(k % 50 == 0, " ").when((w % 5 == 0) & (k % 4 == 0), _LABELS[1]).when(w % 3 == 0, _LABELS[0]).when(w % 3 == 1, _LABELS[1]).otherwise(_LABELS[2])
    items = table(spark, sf_dir, "orders").select(
        w.alias("ws"), k.alias("id_item"), F.when(k % 9 == 0, M.STEM).otherwise("essay").alias("tipo_item"), label.alias("fonte"), F.when(k % 40 == 0, "").when(k % 40 == 1, "Por categorizar").otherwise("tema").alias("tema"),
        F.when(k % 30 == 0, None).when(k % 30 < 20, "Português").otherwise("Matemática A").alias("materia"),
    )
    return M.upload_faults(items, "ws")


@query("""
    WITH p AS (SELECT event_id, event_type AS field, user_id, props FROM events)
    SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click', 'signup') THEN 'unknown field' WHEN event_type = 'signup' AND event_id % 4 = 3 THEN 'not an array' END AS fault,
        CASE WHEN event_type = 'signup' AND event_id % 4 < 3 THEN CAST(json_extract_string(props, '$.k') AS INT) END AS first_k FROM events""")
def edit_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits of known fields only; those of array fields may be JSON once or twice encoded."""
    k = F.col("event_id") % 4
    plain = F.concat(F.lit("["), "props", F.lit("]"))
    twice = F.to_json(F.struct(plain.alias("v")))
    value = F.when(k == 3, F.col("props")).when(k == 2, F.regexp_extract(twice, r'^\{"v":(.*)\}$', 1)).otherwise(plain)
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("field"), value.alias("value"))
    shape = "array<struct<k:int>>"
    inner = F.get_json_object(F.concat(F.lit('{"v":'), "value", F.lit("}")), "$.v")
    parsed = F.coalesce(F.when(F.startswith(F.trim("value"), F.lit("[")), F.from_json("value", shape)), F.when(F.startswith(F.trim("value"), F.lit('"')), F.from_json(inner, shape)))
    known, array = F.col("field").isin("view", "click", "signup"), F.col("field") == "signup"
    fault = F.when(~known, "unknown field").when(array & parsed.isNull(), "not an array")
    return rows.select("event_id", fault.alias("fault"), F.when(array & fault.isNull(), parsed[0]["k"]).alias("first_k"))
