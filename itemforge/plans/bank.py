"""The rule catalogue over items, documents and criteria that are made from parts, line items and suppliers.

What an item's columns hold is written once, in expressions that both dialects read; rules are written in each on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators import catalogue as C
from itemforge.operators import rules as R
from itemforge.plans.registry import query, table

#: Columns of an item as expressions over part, k being its key.
ITEM = {
    "tipo_item": "CASE WHEN k % 45 = 13 THEN 'completion' WHEN k % 9 < 4 THEN 'multiple_choice' WHEN k % 9 = 4 THEN 'open_response' WHEN k % 9 = 5 THEN 'essay' WHEN k % 9 = 6 THEN 'multi_select' WHEN k % 9 = 7 THEN 'complete_table' ELSE 'context_stem' END",
    "id_item": "CASE k % 17 WHEN 0 THEN '' WHEN 1 THEN 'x-1' WHEN 2 THEN 'I-' || (k % 30 + 1) WHEN 3 THEN (k % 30 + 1) || '.2' WHEN 4 THEN 'II-A-' || (k % 30 + 1) ELSE (k % 30 + 1) || '' END",
    "numero_questao": "CASE WHEN k % 19 = 0 THEN 99 ELSE k % 30 + 1 END",
    "numero_principal": "CASE WHEN k % 23 = 0 THEN 98 WHEN k % 2 = 0 THEN k % 30 + 1 END",
    "subitem": "CASE WHEN k % 17 = 3 AND k % 5 > 0 THEN '2' WHEN k % 29 = 0 THEN '3' END",
    "enunciado": """CASE k % 16 WHEN 0 THEN '' WHEN 1 THEN 'curto' WHEN 2 THEN 'GRUPO I' || chr(10) || 'e mais texto que chega para trinta letras'
        WHEN 3 THEN '12Na Figura 3 vemos um triangulo inscrito numa circunferencia' WHEN 4 THEN 'Na Figura 1 ![f](a.png) vemos um triangulo inscrito numa circunferencia'
        WHEN 5 THEN 'Seja ' || chr(92) || 'frac{1}{2} um numero racional maior do que zero e menor que um' WHEN 6 THEN 'Seja $x um numero racional maior do que zero e menor que um'
        WHEN 7 THEN 'Seja $x{$ um numero racional maior do que zero e menor que um' WHEN 8 THEN 'Escolha uma das opcoes que se seguem' || chr(10) || '(A) um (B) dois (C) tres (D) quatro'
        WHEN 9 THEN 'I. primeira' || chr(10) || 'II.  segunda afirmacao' || chr(10) || 'III.  terceira afirmacao' || chr(10) || 'IV.  quarta afirmacao' WHEN 10 THEN '| a | b |' || chr(10) || '| c | d |' || chr(10) || 'quadro com valores por completar'
        WHEN 11 THEN 'Era uma vez' || chr(10) || '5 um texto que tem linhas numeradas' || chr(10) || '10 e que acaba aqui' WHEN 12 THEN 'Era uma vez palavra5outra que ficou no meio do texto corrido'
        WHEN 13 THEN 'Calcule o valor exato de ' || p_name || ' em funcao de x' ELSE p_name || ' e um nome com mais de trinta letras, sem mais nada' END""",
    "texto_original": "CASE WHEN k % 31 = 0 THEN ' ' ELSE p_name END",
    "alts": """CASE k % 12 WHEN 0 THEN 'A:um;B:dois;C:tres' WHEN 1 THEN 'A:um;C:dois;B:tres;D:quatro' WHEN 2 THEN 'A:um;B:;C:x;D:$e$' WHEN 3 THEN 'A:um;B:Um;C:(C) tres;D:(A) quatro'
        WHEN 4 THEN 'A:um;B:dois;C:tres;D:' || repeat('longo ', 50) WHEN 5 THEN 'A:um;B:dois;C:tres;D:' || repeat('x', 401) WHEN 6 THEN 'A:um;B:dois;C:tres;D:Calcule ' || repeat('longo ', 40)
        WHEN 7 THEN 'A:$a;B:' || chr(92) || 'frac{1}{2};C:$x{$;D:quatro' WHEN 8 THEN '' ELSE 'A:um;B:dois;C:tres;D:quatro' END""",
    "imagens": "CASE WHEN k % 7 = 0 THEN 'a.png;b.png' WHEN k % 7 = 1 THEN 'x.png' ELSE '' END",
    "contexto_pai": "CASE WHEN k % 10 = 0 THEN 'ver ![f](c.png)' END",
    "line_start": "CASE WHEN k % 37 = 0 THEN 0 WHEN k % 41 > 0 THEN k % 50 + 1 END",
    "line_end": "CASE WHEN k % 43 = 0 THEN 1 WHEN k % 11 = 0 THEN k % 50 + 1 ELSE k % 50 + 4 END",
    "has_span": "k % 47 > 0",
    "reset": "k % 14 = 0", "implicit": "k % 15 = 0", "score": "CASE WHEN k % 45 > 0 THEN k % 4 END",
    "tema": "CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN ' Por Categorizar ' ELSE p_type END", "subtema": "CASE WHEN k % 6 > 0 THEN p_brand END", "descricao_breve": "CASE WHEN k % 5 > 0 THEN p_name ELSE ' ' END",
    "n_tags": "k % 4", "reviewed": "CASE WHEN k % 25 > 1 THEN k % 25 > 2 END", "fonte": "CASE WHEN k % 27 > 0 THEN p_brand ELSE ' ' END", "n_notes": "k % 6",
    "palavras_min": "CASE WHEN k % 18 = 5 THEN 0 WHEN k % 54 = 14 THEN 200 END", "tem_numeracao_linhas": "CASE WHEN k % 3 = 0 THEN k % 2 = 0 WHEN k % 3 = 1 THEN k % 4 < 2 END",
    "linhas_verificadas": "k % 5 < 3", "portugues": "k % 2 = 1",
}
_ITEMS = f"items AS (SELECT k AS p_partkey, {', '.join(f'{e} AS {n}' for n, e in ITEM.items())} FROM (SELECT p_partkey AS k, p_name, p_brand, p_type FROM part))"
_NOTES = ("nota um", "Fornecedor 'x' sem credenciais; nada", "nota dois", "nota tres", "nota quatro")


def _split(text: str):
    return F.filter(F.split(text, ";"), lambda x: x != "")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in the bank's shape: strings of alternatives, images and counts become arrays and structs."""
    rows = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey")).selectExpr("p_partkey", *(f"{e} AS {n}" for n, e in ITEM.items()))
    span = F.when(F.col("has_span"), F.struct("line_start", "line_end"))
    notes = F.slice(F.array(*map(F.lit, _NOTES)), F.lit(1), F.col("n_notes").cast("int"))
    return rows.withColumns({
        "alternativas": F.transform(_split("alts"), lambda x: F.struct(F.substring(x, 1, 1).alias("letra"), F.substring(x, 3, 1000).alias("texto"))),
        "imagens": _split("imagens"), "imagens_contexto": F.array().cast("array<string>"), "ficheiros": F.array(F.lit("a.png"), F.lit("b.png")), "span": span,
        "trace": F.struct("reset", "implicit", "score"), "tags": F.slice(F.array(F.lit("#a"), F.lit("#b"), F.lit("#c")), F.lit(1), F.col("n_tags").cast("int")),
        "observacoes": notes, "palavras_max": F.lit(None).cast("long"),
    })


_V = r"regexp_matches({0}, '(?i)\b(Determine|Calcule|Resolva|Mostre|Escreva|Apresente|Justifique|Averigue|Estude|Indique|Complete|Represente|Prove|Classifique|Obtenha|Simplifique)\b')"
_BARE = r"regexp_matches(regexp_replace({0}, '(?s)\$\$.*?\$\$|\$[^$\n]+?\$', '', 'g'), '\\[a-zA-Z]+|[A-Za-z]\s*_\s*\{{|[A-Za-z]\s*\^\s*\{{|\d+\s*_\s*\{{|\^\s*\{{')"
_ODD = "(length({0}) - length(replace({0}, '$', ''))) % 2 = 1"
_BRACES = r"(contains({0}, '$') OR contains({0}, '\')) AND length(replace({0}, '{{', '')) <> length(replace({0}, '}}', ''))"
_SOME = "len(list_filter(tx, lambda t: {0})) > 0"
_ALT = "len(list_filter(list_zip(le, tx), lambda a: {0})) > 0"
_DENSE = r"length(regexp_replace({0}, '\s+', '', 'g'))"
_MC, _NOT, _STEM = "tipo_item = 'multiple_choice'", "tipo_item NOT IN ('multiple_choice', 'essay', 'open_response', 'complete_table', 'multi_select', 'context_stem')", "tipo_item = 'context_stem'"
_MARK = r"regexp_extract(a[2], '^\(([A-D])\)', 1)"
_CATEGORY = "(trim(coalesce({0}, '')) = '' OR lower(trim(coalesce({0}, ''))) = 'por categorizar')"
_ITEM_SQL = [
    ("V1-count", 0, f"{_MC} AND n <> 4"), ("V2-letters", 0, f"{_MC} AND n = 4 AND array_to_string(le, '') <> 'ABCD'"), ("V3-empty", 0, f"{_MC} AND n = 4 AND list_contains(tx, '')"),
    ("V3-short", 0, f"{_MC} AND n = 4 AND " + _SOME.format(r"t <> '' AND length(t) < 2 AND NOT regexp_matches(t, '\d') AND NOT regexp_matches(t, '^\$[^$]{1,10}\$$')")),
    ("V4-incomplete", 0, f"{_NOT} AND n NOT IN (0, 4)"), ("V4-type", 0, f"{_NOT} AND n = 4"), ("V5-missing", 0, "i AND id_item = ''"), ("V5-pattern", 0, "i AND id_item <> '' AND NOT good"),
    ("V5-principal", 0, "i AND good AND grp = '' AND numero_principal <> main"), ("V5-number", 0, "i AND good AND grp = '' AND numero_questao <> main"),
    ("V5-sub", 0, "i AND good AND CASE WHEN sub = '' THEN subitem IS NOT NULL ELSE coalesce(subitem, '') <> sub END"),
    ("V6-missing", 0, "i AND NOT has_span"), ("V6-span", 0, "i AND has_span AND (line_start IS NULL OR line_end IS NULL OR line_start <= 0 OR line_end <= 0 OR line_end < line_start)"),
    ("V7-statement", 0, "i AND enunciado = ''"), ("V7-original", 0, "i AND trim(texto_original) = ''"), ("V7-short", 1, f"i AND {_DENSE.format('enunciado')} BETWEEN 1 AND 29"), ("V7-source", 1, "i AND trim(fonte) = ''"),
    ("V8-image", 0, "i AND imagens = 'x.png'"), ("V9-reset", 1, "i AND reset"), ("V9-boundary-low", 0, "i AND implicit AND score <= 2"), ("V9-boundary", 1, "i AND implicit AND NOT coalesce(score <= 2, false)"),
    ("V10-figure", 0, r"regexp_matches(enunciado, '(?i)\bFigura\s+\d+\b') AND imagens = '' AND NOT contains(enunciado, '![') AND contexto_pai IS NULL"),
    ("V11-too-long", 0, f"{_MC} AND " + _SOME.format("length(t) > 400")), ("V11-task", 0, f"{_MC} AND " + _SOME.format("length(t) BETWEEN 201 AND 400 AND " + _V.format("t"))),
    ("V11-long", 1, f"{_MC} AND " + _SOME.format("length(t) BETWEEN 201 AND 400 AND NOT " + _V.format("t"))),
    ("V12-metadata", 0, "i AND starts_with(enunciado, 'GRUPO I')"), ("V13-fused", 1, "i AND starts_with(enunciado, '12N')"),
    ("V14-latex", 1, f"i AND NOT portugues AND ({_BARE.format('enunciado')} OR {_SOME.format(_BARE.format('t'))})"), ("V15-dollars", 0, f"i AND NOT portugues AND ({_ODD.format('enunciado')} OR {_SOME.format(_ODD.format('t'))})"),
    ("V15-braces", 1, f"i AND NOT portugues AND ((NOT {_ODD.format('enunciado')} AND {_BRACES.format('enunciado')}) OR {_SOME.format(f'NOT {_ODD} AND {_BRACES}'.format('t'))})"),
    ("V16-block", 0, f"{_MC} AND n > 0 AND contains(enunciado, chr(10) || '(A)')"), ("V16-swapped", 0, f"{_MC} AND " + _ALT.format(f"{_MARK} NOT IN ('', a[1])")), ("V16-marker", 1, f"{_MC} AND " + _ALT.format(f"{_MARK} = a[1]")),
    ("V16-repeated", 0, f"{_MC} AND len(list_distinct(list_transform(list_filter(tx, lambda t: t <> ''), lambda t: lower(t)))) < len(list_filter(tx, lambda t: t <> ''))"),
    ("V17-theme", 1, _CATEGORY.format("tema")), ("V17-subtheme", 1, _CATEGORY.format("subtema")), ("V17-summary", 1, "trim(descricao_breve) = ''"), ("V17-tags", 1, "n_tags = 0"), ("V17-unreviewed", 0, "NOT coalesce(reviewed, false)"),
    ("V19-one-line", 1, f"i AND has_span AND line_start = line_end AND {_DENSE.format('enunciado')} > 30"), ("V24-notes", 1, "i AND n_notes = 5"), ("V25-words", 1, "tipo_item = 'essay' AND coalesce(palavras_min, 0) = 0"),
    ("V25-affirmations", 1, "tipo_item = 'multi_select' AND NOT starts_with(enunciado, 'I. primeira')"), ("V25-table", 1, "tipo_item = 'complete_table' AND NOT starts_with(enunciado, '|') AND NOT contains(enunciado, '![') AND imagens = ''"),
    ("VCTX-undeclared", 0, f"{_STEM} AND portugues AND tem_numeracao_linhas IS NULL"), ("VCTX-unchecked", 0, f"{_STEM} AND portugues AND NOT linhas_verificadas"),
    ("VCTX-unmarked", 0, rf"{_STEM} AND portugues AND tem_numeracao_linhas AND NOT regexp_matches(enunciado, '(?m)^\d{{1,3}} \S')"),
    ("VCTX-left-over", 0, rf"{_STEM} AND portugues AND NOT tem_numeracao_linhas AND regexp_matches(enunciado, '[^\n]\s\d{{1,3}}\s[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ«]|[A-Za-zÁ-ÿ]\d{{1,3}}[A-Za-zÁ-ÿ]')"),
]


def judged_sql(rules: list[tuple[str, int, str]], key: str, source: str) -> str:
    """The errors, warnings and status of rules (name, severity, predicate) over a source, as the engine gives them."""
    named = lambda severity: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, s, p in rules if s == severity) + "], lambda v: v IS NOT NULL), ',')"
    return f"SELECT *, CASE WHEN errors <> '' THEN 'validation_error' WHEN warnings <> '' THEN 'approved_with_warnings' ELSE 'approved' END AS status FROM (SELECT {key}, {named(0)} AS errors, {named(1)} AS warnings FROM {source})"


_PARSED = rf"""WITH {_ITEMS}, a AS (SELECT *, CASE WHEN alts = '' THEN [] ELSE string_split(alts, ';') END AS al FROM items),
    x AS (SELECT *, len(al) AS n, list_transform(al, lambda v: v[1]) AS le, list_transform(al, lambda v: trim(substr(v, 3))) AS tx, tipo_item <> 'context_stem' AS i,
        regexp_matches(id_item, '^(?:[IVX]+-)?(?:[A-C]-)?(?:\d{{1,3}}|ctx\d*)(?:\.\d{{1,2}})?$') AS good, regexp_extract(id_item, '^(?:([IVX]+)-)', 1) AS grp,
        TRY_CAST(regexp_extract(id_item, '^(?:[IVX]+-)?(?:[A-C]-)?(\d{{1,3}})', 1) AS INT) AS main, regexp_extract(id_item, '\.(\d+)$', 1) AS sub FROM a) """


def _told(judged: DataFrame, *keys: str) -> DataFrame:
    return judged.select(*keys, F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "status")


@query(_PARSED + judged_sql(_ITEM_SQL, "p_partkey", "x"))
def item_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule on a single item, on items that break each of them."""
    return _told(R.judged(items(spark, sf_dir), C.item_rules()), "p_partkey")


_LINES = """lines AS (SELECT l_orderkey AS ws, l_linenumber AS line, l_partkey, l_suppkey, l_quantity,
        CASE WHEN l_partkey % 11 = 0 THEN 'context_stem' WHEN l_partkey % 3 = 0 THEN 'multiple_choice' ELSE 'open_response' END AS tipo_item,
        CASE WHEN l_partkey % 4 = 0 AND l_linenumber > 1 THEN l_linenumber - 1 ELSE l_linenumber END AS numero, CASE WHEN l_partkey % 4 = 0 AND l_linenumber > 1 THEN (l_partkey % 3 + 1) || '' END AS subitem,
        CASE WHEN l_suppkey % 5 > 0 THEN l_linenumber END AS ordem_item, CASE WHEN l_suppkey % 6 > 0 THEN l_linenumber * 10 END AS line_start, CASE WHEN l_suppkey % 7 > 0 THEN l_linenumber * 10 + l_partkey % 15 END AS line_end,
        CASE l_partkey % 5 WHEN 0 THEN 'Calcule o que falta' WHEN 1 THEN 'Veja 1.1. e 2.3. e ' || l_linenumber || '.2. antes' ELSE 'Um texto' END AS enunciado FROM lineitem)"""


@query(f"""
    WITH {_LINES}, a AS (SELECT *, numero || CASE WHEN subitem IS NULL THEN '' ELSE '.' || subitem END AS id_item, coalesce(ordem_item, numero) AS o, subitem IS NULL AND tipo_item <> 'context_stem' AS top FROM lines),
        b AS (SELECT ws, numero, count(subitem) AS subs, count(DISTINCT subitem) AS ds, max(CAST(subitem AS INT)) AS ms FROM a GROUP BY ALL),
        t AS (SELECT ws, count(DISTINCT numero) AS dn, max(numero) - min(numero) + 1 AS way FROM a WHERE top GROUP BY ws),
        ids AS (SELECT ws, id_item, count(*) AS n FROM a GROUP BY ALL), os AS (SELECT ws, o, count(*) AS n FROM a GROUP BY ALL),
        q AS (SELECT ws, numero, enunciado, unnest(regexp_extract_all(enunciado, '\\b(\\d{{1,3}}\\.\\d{{1,2}})\\.', 1)) AS r FROM a WHERE top),
        refs AS (SELECT DISTINCT ws, numero, enunciado FROM q WHERE CAST(string_split(r, '.')[1] AS INT) = numero AND NOT EXISTS (SELECT 1 FROM ids WHERE ids.ws = q.ws AND ids.id_item = r))
    SELECT a.ws, a.tipo_item, a.id_item, subs > 0 AS has_subitems, ids.n > 1 AS repeated_id, os.n > 1 AS repeated_order, coalesce(a.top AND way > dn, false) AS main_gap, coalesce(ms > ds, false) AS sub_gap, a.top AND refs.ws IS NOT NULL AS missing
    FROM a JOIN b ON a.ws = b.ws AND a.numero = b.numero LEFT JOIN t ON t.ws = a.ws JOIN ids ON ids.ws = a.ws AND ids.id_item = a.id_item JOIN os ON os.ws = a.ws AND os.o = a.o
        LEFT JOIN refs ON refs.ws = a.ws AND refs.numero = a.numero AND refs.enunciado = a.enunciado""")
def document_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document says of its items: sub-items, repeated ids and orders, gaps, references to nothing."""
    found = C.with_document_checks(_lines(spark, sf_dir))
    return found.select("ws", "tipo_item", "id_item", "has_subitems", "repeated_id", "repeated_order", "main_gap", "sub_gap", (F.size("missing_refs") > 0).alias("missing"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as items of an order's document."""
    k, n = F.col("l_partkey"), F.col("l_linenumber")
    child = (k % 4 == 0) & (n > 1)
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ws"), F.when(k % 11 == 0, C.STEM).when(k % 3 == 0, "multiple_choice").otherwise("open_response").alias("tipo_item"),
        F.when(child, n - 1).otherwise(n).alias("numero_questao"), F.lit(None).cast("int").alias("numero_principal"), F.when(child, (k % 3 + 1).cast("string")).alias("subitem"),
        F.when(F.col("l_suppkey") % 5 > 0, n).alias("ordem_item"), F.struct(F.when(F.col("l_suppkey") % 6 > 0, n * 10).alias("line_start"), F.when(F.col("l_suppkey") % 7 > 0, n * 10 + k % 15).alias("line_end")).alias("span"),
        F.when(k % 5 == 0, "Calcule o que falta").when(k % 5 == 1, F.concat(F.lit("Veja 1.1. e 2.3. e "), n.cast("string"), F.lit(".2. antes"))).otherwise("Um texto").alias("enunciado"), F.lit("").alias("texto_original"),
    )
    return rows.withColumn("id_item", F.concat_ws(".", F.col("numero_questao").cast("string"), "subitem"))


#: Columns of a criterion as expressions over supplier, k being its key.
CRITERION = {
    "tipo": "CASE k % 7 WHEN 0 THEN 'multiple_choice' WHEN 1 THEN 'open_response' WHEN 2 THEN 'essay' WHEN 3 THEN 'complete_table' WHEN 4 THEN 'multi_select' WHEN 5 THEN 'open_response' ELSE 'unknown' END",
    "reviewed": "CASE WHEN k % 10 > 0 THEN k % 10 > 1 END", "resposta_correta": "CASE k % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'd' WHEN 2 THEN 'E' END", "n_answers": "k % 3",
    "note": "CASE k % 5 WHEN 0 THEN 'OCR-SUSPECT: x' WHEN 1 THEN 'OCR-SUSPECT: y;OCR-RESOLVED: palavra nova' ELSE 'nota' END",
    "solucao": "CASE k % 6 WHEN 0 THEN ' ' WHEN 1 THEN 'Mostra que a soma dos termos da progressao e igual ao valor pedido no enunciado, como se queria' WHEN 2 THEN 'palavra nova' ELSE 'resultado correto' END",
    "steps": "CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN 'Mostra que a soma  dos termos da progressao e igual ao valor pedido no enunciado, como se queria;fim' WHEN 2 THEN 'N:nivel quatro' ELSE 'primeiro passo;resultado correto' END",
    "texto_original": "CASE WHEN k % 9 > 0 THEN 'resultado correto do primeiro passo; palavra' ELSE '' END", "cotacao_total": "k % 20",
    "other": "CASE k % 11 WHEN 0 THEN 'equação resolvida' WHEN 1 THEN 'palavra;résultado correto' ELSE '' END",
}
_CRITERIA = f"c AS (SELECT k AS s_suppkey, {', '.join(f'{e} AS {n}' for n, e in CRITERION.items())} FROM (SELECT s_suppkey AS k FROM supplier UNION ALL SELECT 1000000 + c_custkey FROM customer))"
_CRITERION_SQL = [
    ("C1-type", 0, "tipo = 'unknown'"), ("C1-unreviewed", 0, "k AND NOT coalesce(reviewed, false)"), ("C2-suspect", 0, "k AND note = 'OCR-SUSPECT: x'"), ("C3-answer", 0, "tipo = 'multiple_choice' AND upper(coalesce(resposta_correta, '')) NOT IN ('A', 'B', 'C', 'D')"),
    ("C4-single", 0, "many AND resposta_correta IS NOT NULL"), ("C4-none", 0, "many AND n_answers = 0"), ("C4-one", 0, "tipo = 'multi_select' AND n_answers = 1"),
    ("C5-solution", 0, "k AND tipo <> 'multiple_choice' AND trim(solucao) = '' AND steps NOT LIKE 'N:%'"), ("C5-steps-essay", 1, "tipo = 'essay' AND steps = ''"), ("C5-both", 0, "many AND steps = '' AND trim(solucao) = ''"), ("C5-steps", 0, "tipo = 'open_response' AND steps = ''"),
    ("C6-words", 1, "k AND texto_original <> '' AND len(list_filter(regexp_extract_all(lower(solucao || ' ' || replace(steps, ';', ' ') || ' ' || replace(other, ';', ' ')), '[a-záàâãéêíóôõúüçA-ZÁÀÂÃÉÊÍÓÔÕÚÜÇ]{5,}'), lambda w: NOT list_contains(regexp_extract_all(lower(texto_original || CASE WHEN note LIKE '%RESOLVED%' THEN ' palavra' ELSE '' END), '[a-záàâãéêíóôõúüçA-ZÁÀÂÃÉÊÍÓÔÕÚÜÇ]{5,}'), w))) > 0"),
    ("C7-mirror", 0, r"tipo IN ('open_response', 'essay') AND length(trim(solucao)) >= 80 AND steps <> '' AND NOT contains(regexp_replace(lower(steps), '\s+', ' ', 'g'), lower(solucao))"),
]


def criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")).unionAll(table(spark, sf_dir, "customer").select(F.col("c_custkey") + 1000000))
    rows = keys.selectExpr("k AS s_suppkey", *(f"{e} AS {n}" for n, e in CRITERION.items()))
    level = lambda x: F.when(F.startswith(x, F.lit("N:")), "N4")
    step = lambda x: F.struct(F.when(level(x).isNull(), F.lit(5).cast("long")).alias("pontos"), F.regexp_replace(x, "^N:", "").alias("descricao"), level(x).alias("nivel"))
    answers = F.slice(F.array(F.lit("I"), F.lit("II")), F.lit(1), F.col("n_answers").cast("int"))
    return rows.withColumns({"observacoes": _split("note"), "passos": F.transform(_split("steps"), step), "respostas_corretas": answers, "resolucoes_alternativas": _split("other")})


@query(f"WITH {_CRITERIA}, x AS (SELECT *, tipo <> 'unknown' AS k, tipo IN ('multi_select', 'complete_table') AS many FROM c) " + judged_sql(_CRITERION_SQL, "s_suppkey", "x"))
def criterion_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule on criteria."""
    return _told(R.judged(criteria(spark, sf_dir), C.criterion_rules()), "s_suppkey")


@query(f"""
    WITH {_CRITERIA}, s AS (SELECT *, CASE WHEN steps = '' THEN [] ELSE list_transform(string_split(steps, ';'), lambda v: CASE WHEN starts_with(v, 'N:') THEN 'null:N4:' || substr(v, 3) ELSE '5::' || v END) END AS ss FROM c)
    SELECT s_suppkey, array_to_string(CASE WHEN tipo <> 'complete_table' OR trim(solucao) = '' OR (len(ss) > 0 AND string_split(ss[1], ':')[3] = solucao) THEN ss
        WHEN len(ss) = 0 THEN [cotacao_total || '::' || solucao] ELSE list_concat([string_split(ss[1], ':')[1] || ':' || string_split(ss[1], ':')[2] || ':' || solucao], ss[2:]) END, ';') AS passos FROM s""")
def mirror_solution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Criteria of tables with their solution as the first step."""
    done = C.mirrored(F.col("tipo"), F.col("solucao"), F.col("passos"), F.col("cotacao_total"))
    told = F.transform(done, lambda p: F.concat(F.coalesce(p["pontos"].cast("string"), F.lit("null")), F.lit(":"), F.coalesce(p["nivel"], F.lit("")), F.lit(":"), p["descricao"]))
    return criteria(spark, sf_dir).select("s_suppkey", F.array_join(told, ";").alias("passos"))
