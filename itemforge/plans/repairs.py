"""Repairs, scoring tables, criteria, files and small functions, bound to parts, suppliers, customers, orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.functions import repairs as P
from itemforge.operators import normalise as N
from itemforge.operators import scoring as S
from itemforge.plans.registry import query, table
from itemforge.sources import files
from itemforge.sources.shared import shared_path

#: Texts as expressions over part that both dialects read; k is its key.
STATEMENT = """CASE k % 9 WHEN 0 THEN '$' || chr(92) || 'pm 6 . 1 .$ ' || p_name WHEN 1 THEN '$' || chr(92) || 'pm 8.$ 8. ' || p_name WHEN 2 THEN '$' || chr(92) || 'ast$ 3. ' || p_name WHEN 3 THEN '10.2.' || p_name
    WHEN 4 THEN '  15. ' || p_name WHEN 5 THEN '1Na Figura ' || p_name WHEN 6 THEN '4.1. 2. ' || p_name ELSE p_name END"""
_NAMES = ("fused_subitem", "fused_item", "decorated", "subitem", "item", "fused_text")
_PATTERNS = (r"^\$\\pm\s*\d{1,3}\s*\.\s*\d{1,2}\s*\.\s*\$\s*", r"^\$\\pm\s*\d{1,3}\s*\.\s*\$\s*", r"^\$\\(?:ast|bigstar|star|bullet|cdot)\$\s*\d{1,3}(?:\.\d{1,2})*\.?\s*", r"^\d{1,3}\.\d{1,2}\.\s*", r"^\d{1,3}\.\s*", r"^\d{1,3}([A-ZÁÀÂÃÉÊÍÓÔÕÚÜÇÈÌÒÙ])")
_NOW, _LOG = "ltrim(s)", []
for _n, _p in zip(_NAMES, _PATTERNS, strict=True):
    _to = r"\1" if _n == "fused_text" else ""
    _LOG.append(f"CASE WHEN regexp_replace({_NOW}, '{_p}', '{_to}') <> {_NOW} THEN '{_n}' END")
    _NOW = f"regexp_replace({_NOW}, '{_p}', '{_to}')"


def _parts(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    """Parts with columns of expressions. Texts cost far more than rows weigh, so rows are dealt by key first: a small file of many rows would be one task."""
    return table(spark, sf_dir, "part").repartition("p_partkey").withColumn("k", F.col("p_partkey")).selectExpr("k", *(f"{e} AS {n}" for n, e in columns.items()))


def _from(**columns: str) -> str:
    return f"(SELECT k, {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM (SELECT p_partkey AS k, p_name, p_brand, p_type, p_size FROM part))"


@query(f"SELECT k, {_NOW} AS statement, concat_ws(',', {', '.join(_LOG)}) AS log FROM {_from(s=STATEMENT)}")
def prefix_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and marks before statements taken away in order, each once, with a log."""
    fixed, log = P.without_prefix(F.col("s"))
    return _parts(spark, sf_dir, s=STATEMENT).select("k", fixed.alias("statement"), F.array_join(log, ",").alias("log"))


_MATH = """CASE k % 8 WHEN 0 THEN chr(92) || 'frac { ' || k || ' } { 2 } de ' || p_name WHEN 1 THEN 'x ^ { 1 ' || (k % 10) || ' } + ' || p_name WHEN 2 THEN chr(92) || 'mathrm{ s e } ' || p_name WHEN 3 THEN 'a _ { 2 } e $b$'
    WHEN 4 THEN chr(92) || 'begin{array} { l l } ' || p_name || '  fim' WHEN 5 THEN 'a { } b' WHEN 6 THEN chr(92) || chr(92) || 'alpha ' || chr(92) || chr(92) || chr(92) || 'beta' ELSE p_name END"""


@query(rf"""
    SELECT k, CASE WHEN NOT contains(s, '$') AND regexp_matches(s, '\\[a-zA-Z]+|[A-Za-z]\s*_\s*\{{|[A-Za-z]\s*\^\s*\{{|\d+\s*_\s*\{{|\^\s*\{{') THEN '$' || trim(s) || '$' ELSE s END AS delimited, regexp_replace(s, '\\{{2,}}', '\\', 'g') AS single,
        CASE k % 8 WHEN 0 THEN chr(92) || 'frac{{' || k || '}}{{2}} de ' || p_name WHEN 1 THEN 'x^{{1' || (k % 10) || '}} + ' || p_name WHEN 2 THEN chr(92) || 'text{{se}} ' || p_name WHEN 3 THEN 'a_{{2}} e $b$'
            WHEN 4 THEN chr(92) || 'begin{{array}}{{ll}} ' || p_name || ' fim' WHEN 5 THEN 'a b' ELSE s END AS compact FROM {_from(s=_MATH, p_name='p_name')}""")
def latex_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LaTeX wrapped in dollars, with single backslashes, and without the blanks of recognition."""
    s = F.col("s")
    return _parts(spark, sf_dir, s=_MATH).select("k", P.delimited(s).alias("delimited"), P.single_backslashes(s).alias("single"), P.compact_latex(s).alias("compact"))


_ALTS = """CASE k % 5 WHEN 0 THEN 'Qual das opcoes? (A) ' || p_name || ' ' || chr(92) || ' (B) dois } (C) x ' || chr(92) || 'in ' || chr(92) || 'mathbb{ R (D) { quatro'
    WHEN 1 THEN 'Qual das expressoes? $$' || chr(92) || 'begin{array}{l} ' || p_name || ' & ' || chr(92) || chr(92) || ' segunda {} linha ' || chr(92) || chr(92) || ' terceira linha ' || chr(92) || chr(92) || ' quarta linha ' || k || chr(92) || 'end{array}$$'
    WHEN 2 THEN 'Qual das expressoes? $$' || chr(92) || 'begin{array}{l} primeira linha ' || chr(92) || chr(92) || ' abc ' || chr(92) || 'end{array}$$' WHEN 3 THEN 'Calcule $$' || chr(92) || 'begin{array}{l} aaaaaa ' || chr(92) || 'end{array}$$' ELSE p_name END"""


@query(rf"""
    SELECT k, CASE k % 5 WHEN 0 THEN 'A=' || p_name || ';B=dois;C=x \in \mathbb{{ R }};D=quatro' WHEN 1 THEN 'A=' || p_name || ';B=segunda linha;C=terceira linha;D=quarta linha ' || k ELSE '' END AS alternatives FROM {_from(p_name='p_name')}""")
def inferred_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternatives that are marked in a text, or stand as four rows of an array."""
    found = F.transform(P.inferred_alternatives(F.col("s")), lambda a: F.concat(a["letra"], F.lit("="), F.regexp_replace(a["texto"], r"\s+", " ")))
    return _parts(spark, sf_dir, s=_ALTS).select("k", F.array_join(found, ";").alias("alternatives"))


_PAGE = """CASE k % 4 WHEN 0 THEN 'antes ' || p_name || chr(10) || chr(10) || '# FORMULARIO' || chr(10) || 'a = b' || chr(10) || '# GRUPO I' || chr(10) || 'texto' WHEN 1 THEN p_name || chr(10) || 'F O R M U L Á R I O' || chr(10) || 'sem fim' WHEN 2 THEN '## Formulário' || chr(10) || 'x' || chr(10) || chr(10) || '## Outro' || chr(10) || p_name ELSE p_name || chr(10) || '# Nada' END"""


@query(rf"""
    WITH x AS (SELECT k, s, regexp_extract(s, '(?is)^(.*?)(?:^|\n)(?:#{{1,4}}\s+|\*{{1,2}})?F\s*O\s*R\s*M\s*[UÚú]\s*L\s*[AÁá]\s*R\s*I\s*[OÓó]\s*S?[ \t]*\n.*?\n(#{{1,4}}\s+\S.*)$', 1) AS pre, regexp_extract(s, '(?is)^(.*?)(?:^|\n)(?:#{{1,4}}\s+|\*{{1,2}})?F\s*O\s*R\s*M\s*[UÚú]\s*L\s*[AÁá]\s*R\s*I\s*[OÓó]\s*S?[ \t]*\n.*?\n(#{{1,4}}\s+\S.*)$', 2) AS post FROM {_from(s=_PAGE)})
    SELECT k, CASE WHEN post = '' THEN s ELSE regexp_replace(regexp_replace(pre, '\n+$', '') || chr(10) || chr(10) || post, '^\s+|\s+$', '', 'g') END AS text FROM x""")
def formula_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without their sheet of formulas."""
    return _parts(spark, sf_dir, s=_PAGE).select("k", P.without_formula_sheet(F.col("s")).alias("text"))


_RAISED = """'palavra® e outra© fim° ' || p_name || chr(10) || '# NOTAS' || chr(10) || CASE k % 3 WHEN 0 THEN '8 oito' WHEN 1 THEN '9 nove' || chr(10) || '0 zero' ELSE 'sem numeros' END || chr(10) || '## Fim' || chr(10) || '8 fora'"""
_MARGIN = """CASE WHEN k % 2 = 0 THEN '5. Um texto' || chr(10) || p_name || chr(10) || '10. Outro texto' ELSE '5. Um texto' || chr(10) || p_name END"""
_VERSE = """'Era. 5 Uma vez! 10 Outra ' || p_name || chr(10) || 'So. 15 Uma'"""


@query(f"""
    SELECT k, CASE k % 3 WHEN 0 THEN replace(r, 'palavra®', 'palavra⁸') WHEN 1 THEN replace(replace(r, 'outra©', 'outra⁹'), 'fim°', 'fim⁰') ELSE r END AS raised,
        CASE WHEN k % 2 = 0 THEN replace(replace(m, '5. Um', '5 Um'), '10. Outro', '10 Outro') ELSE m END AS margin, replace(replace(v, '. 5 Uma', '.' || chr(10) || '5 Uma'), '! 10 Outra', '!' || chr(10) || '10 Outra') AS verse FROM {_from(r=_RAISED, m=_MARGIN, v=_VERSE)}""")
def margin_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raised digits that the notes confirm, line numbers without points, and numbers inside lines of verse."""
    found = _parts(spark, sf_dir, r=_RAISED, m=_MARGIN, v=_VERSE)
    return found.select("k", P.raised_digits(F.col("r")).alias("raised"), P.undotted_margin(F.col("m")).alias("margin"), P.broken_margin(F.col("v")).alias("verse"))


_TIDY = """'um ponto • dois•tres; Calcule x. Mostre que $a. Mostre$ ' || p_name || '  ' || chr(10) || 'Determine ' || chr(92) || 'in uma palavra2 e ' || chr(92) || 'in tudo, nota10.'"""


@query(rf"""
    SELECT k, 'um ponto' || chr(10) || '• dois' || chr(10) || '• tres;' || chr(10) || chr(10) || 'Calcule x.' || chr(10) || chr(10) || 'Mostre que $a. Mostre$ ' || p_name || chr(10) || chr(10) || 'Determine é uma palavra² e e tudo, nota¹⁰.' AS text FROM {_from(p_name='p_name')}""")
def tidy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bullets, raised note numbers, blanks at line ends and verbs of instruction."""
    return _parts(spark, sf_dir, s=_TIDY).select("k", P.tidy(F.col("s")).alias("text"))


_LINT = """CASE k % 4 WHEN 0 THEN 'Escolha $x' || chr(10) || chr(10) || chr(10) || chr(10) || 'uma' || chr(10) || '(A) um (B) dois' ELSE ' ' || p_name || ' ' END"""
_ORDERS = "CASE k % 5 WHEN 0 THEN 'b:(B) dois;A:um;D:quatro;C:tres' WHEN 1 THEN 'A:um;B: Um ;C:$c;D:quatro' WHEN 2 THEN 'A:um;C:tres;B:dois' WHEN 3 THEN '' ELSE 'D:(D) d;C:c;B:b;A:a' END"


@query(f"""
    WITH x AS (SELECT *, CASE WHEN o = '' THEN [] ELSE string_split(o, ';') END AS al FROM {_from(s=_LINT, o=_ORDERS)}),
        y AS (SELECT *, CASE WHEN k % 4 = 0 THEN CASE WHEN len(al) > 0 THEN 'Escolha $x' || chr(10) || chr(10) || 'uma' ELSE 'Escolha $x' || chr(10) || chr(10) || 'uma' || chr(10) || '(A) um (B) dois' END ELSE trim(s) END AS statement,
            list_transform(al, lambda a: upper(a[1]) || '=' || CASE WHEN starts_with(trim(substr(a, 3)), '(' || upper(a[1]) || ')') THEN trim(substr(a, 7)) ELSE trim(substr(a, 3)) END) AS bl FROM x)
    SELECT k, statement, array_to_string(CASE WHEN len(bl) = 4 THEN list_sort(bl) ELSE bl END, ';') AS alternatives, concat_ws(',', CASE WHEN k % 4 = 0 THEN 'statement_dollars' END, CASE WHEN k % 5 = 1 THEN 'alternative_dollars' END, CASE WHEN k % 5 = 1 THEN 'repeated_alternative' END) AS faults FROM y""")
def micro_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small repairs of items: line breaks, alternatives in the statement, letters, markers and order."""
    rows = _parts(spark, sf_dir, s=_LINT, o=_ORDERS)
    alts = F.transform(F.filter(F.split("o", ";"), lambda x: x != ""), lambda a: F.struct(F.substring(a, 1, 1).alias("letra"), F.substring(a, 3, 1000).alias("texto")))
    statement, found, faults = P.linted(F.col("s"), alts)
    return rows.select("k", statement.alias("statement"), F.array_join(F.transform(found, lambda a: F.concat(a["letra"], F.lit("="), a["texto"])), ";").alias("alternatives"), F.array_join(faults, ",").alias("faults"))


_LEVELS = """'Nível 4 (N4) ' || (k % 9 + 1) || ' pontos' || chr(10) || p_name || chr(10) || 'nível N2 - 3 pontos' || chr(10) || repeat('x', 310) || chr(10) || chr(10) || 'fora'"""
_ROMANS = "CASE k % 3 WHEN 0 THEN 'Resposta: I, III e IV' || chr(10) || chr(10) || 'III e ' || p_name WHEN 1 THEN 'So II' ELSE p_name || chr(10) || 'a' || chr(10) || 'b' || chr(10) || 'I e II' END"
_SHOWN = "CASE k % 3 WHEN 0 THEN '5 ' || p_name || chr(10) || 'meio' || chr(10) || '10 fim' WHEN 1 THEN 'Leia o poema' || chr(10) || p_name ELSE '7 ' || p_name || chr(10) || '205 x' || chr(10) || '5 y' END"


@query(f"""
    SELECT k, 'N4:' || (k % 9 + 1) || ':os' || chr(10) || p_name || ';N2:3:os' || chr(10) || repeat('x', 297) AS levels, CASE WHEN k % 3 = 0 THEN 'I,III,IV' ELSE '' END AS romans, CASE k % 3 WHEN 0 THEN 'excerpt' WHEN 1 THEN 'poem' ELSE 'prose' END AS shown FROM {_from(p_name='p_name')}""")
def criteria_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance levels, roman answers, and how a context is shown."""
    rows = _parts(spark, sf_dir, l=_LEVELS, r=_ROMANS, s=_SHOWN)
    told = F.transform(P.levels(F.col("l")), lambda v: F.concat_ws(":", v["nivel"], v["pontos"].cast("string"), v["descritor"]))
    return rows.select("k", F.array_join(told, ";").alias("levels"), F.array_join(P.roman_answers(F.col("r")), ",").alias("romans"), P.line_kind(F.col("s")).alias("shown"))


_WAYS = """CASE k % 4 WHEN 0 THEN 'passo um 3 pontos' || chr(10) || 'passo dois 5 pontos' || chr(10) || 'Por dois processos.' || chr(10) || '1.º Processo' || chr(10) || p_name || chr(10) || '2.º Processo' || chr(10) || 'outro' WHEN 1 THEN '1.º Processo' || chr(10) || 'so aqui 4 pontos' WHEN 2 THEN 'simples 2 pontos' ELSE p_name END"""


@query(f"""
    SELECT k, CASE k % 4 WHEN 0 THEN 'passo um=3;passo dois' || chr(10) || chr(10) || 'Por dois processos.' || chr(10) || chr(10) || '1.º Processo' || chr(10) || p_name || '=5' WHEN 1 THEN 'so aqui=4' WHEN 2 THEN 'simples=2' ELSE '' END AS steps,
        CASE WHEN k % 4 = 0 THEN '2.º Processo' || chr(10) || 'outro' ELSE '' END AS others FROM {_from(p_name='p_name')}""")
def solution_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps with the first way of solution, and the other ways."""
    steps, others = P.open_criteria(F.col("w"))
    return _parts(spark, sf_dir, w=_WAYS).select("k", F.array_join(F.transform(steps, lambda s: F.concat(s["descricao"], F.lit("="), s["pontos"].cast("string"))), ";").alias("steps"), F.array_join(others, ";").alias("others"))


_TABLE = """'GRUPO I' || chr(10) || CASE k % 5 WHEN 0 THEN '1. a ' || (k % 4 + 2) || '. ....... ' || (k % 4 + 2) || ' × 5 pontos' || chr(10) || 'GRUPO II' || chr(10) || '1.1. ' || (k % 9 + 1) || ' pontos' || chr(10) || '# 2. 15 pontos'
    WHEN 1 THEN 'PARTE A' || chr(10) || '1. a 3. ..... ' || (k % 30) || ' pontos' || chr(10) || 'PARTE B' || chr(10) || '4. 7 pontos' || chr(10) || '4. 8 pontos'
    WHEN 2 THEN '| 1. | 2. | 5. |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| 13 | ' || (k % 20) || ' | 9 |' || chr(10) || 'Destes 3 itens, contribuem para a classificação final os 2 itens'
    WHEN 3 THEN '| Grupo | Item | Cotação (em pontos) |' || chr(10) || '|---|---|---|' || chr(10) || '| **III** | 1. a 2. (2 × 10 pontos) | 20 |' || chr(10) || '| B | 3. | **' || (k % 50) || '** |' || chr(10) || '| IV | Item único | 44 |' || chr(10) || '| TOTAL | | 200 |'
    ELSE 'sem tabela ' || p_name END"""
_SCORES = f"""
    WITH x AS {_from(z='k % 5')}, r AS (
        SELECT k, 'I-' || unnest(range(1, k % 4 + 3)) AS item_id, 5 AS points FROM x WHERE z = 0 UNION ALL SELECT k, 'II-1.1', k % 9 + 1 FROM x WHERE z = 0 UNION ALL SELECT k, 'II-2', 15 FROM x WHERE z = 0
        UNION ALL SELECT k, 'I-A-' || unnest(range(1, 4)), (k % 30) // 3 FROM x WHERE z = 1 UNION ALL SELECT k, 'I-B-4', 8 FROM x WHERE z = 1
        UNION ALL SELECT k, 'I-1', 13 FROM x WHERE z = 2 UNION ALL SELECT k, 'I-2', k % 20 FROM x WHERE z = 2 UNION ALL SELECT k, 'I-5', 9 FROM x WHERE z = 2
        UNION ALL SELECT k, 'III-' || unnest(range(1, 3)), 10 FROM x WHERE z = 3 UNION ALL SELECT k, 'III-B-3', k % 50 FROM x WHERE z = 3 UNION ALL SELECT k, 'IV-1', 44 FROM x WHERE z = 3)"""


@query(_SCORES + " SELECT k, item_id, CAST(points AS INT) AS points, CASE WHEN item_id = 'II-1.1' THEN 'II-1' END AS parent FROM r")
def scoring_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of items as four layouts of scoring tables give them."""
    return S.scores(_parts(spark, sf_dir, s=_TABLE), "s", "k").select("k", "item_id", "points", "parent")


@query(_SCORES + " SELECT k, 'I' AS grupo, 2 AS escolher, 'I-1,I-2,I-5' AS itens FROM x WHERE z = 2")
def scoring_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of which items only some count."""
    docs = _parts(spark, sf_dir, s=_TABLE)
    return S.pools(docs, S.scores(docs, "s", "k"), "s", "k").select("k", "grupo", "escolher", F.array_join("itens", ",").alias("itens"))


@query(_SCORES + " SELECT k, count(*) FILTER (item_id <> 'II-1.1') AS n_top, CAST(sum(points) AS BIGINT) AS total FROM r GROUP BY k")
def scoring_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many items of whole numbers a table has, and their points."""
    return S.scores(_parts(spark, sf_dir, s=_TABLE), "s", "k").groupBy("k").agg(F.count_if(F.col("parent").isNull()).alias("n_top"), F.sum("points").cast("long").alias("total"))


_CRITERIA = """CASE WHEN k % 3 = 0 THEN '15 pontos' || chr(10) || 'texto antes' || chr(10) ELSE '' END || '## ' || (k % 3 + 2) || '. 10 pontos' || chr(10) || p_name || chr(10) || CASE WHEN k % 2 = 0 THEN '7 pontos' || chr(10) || 'no meio' || chr(10) ELSE '' END || (k % 3 + 4) || '. 5 pontos' || chr(10) || 'fim'"""


@query(f"""
    WITH x AS {_from(p_name='p_name', a='k % 3 + 2')}
    SELECT k, a || '' AS item_id, 10 AS points, false AS implicit, p_name AS body FROM x UNION ALL SELECT k, (a + 2) || '', 5, false, 'fim' FROM x
    UNION ALL SELECT k, (a - 1) || '', 15, true, 'texto antes' FROM x WHERE k % 3 = 0 UNION ALL SELECT k, (a + 1) || '', 7, true, 'no meio' FROM x WHERE k % 2 = 0""")
def criteria_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Criteria cut at their headings; lines of points alone get the number that their neighbours leave."""
    return S.criteria_blocks(_parts(spark, sf_dir, s=_CRITERIA), "s", "k").select("k", "item_id", "points", "implicit", "body")


_KEYS = """p_name || chr(10) || '| Item | Versão 1 | Versão 2 | Pontuação |' || chr(10) || '|---|---|---|---|' || chr(10) || '| 1. | (A) | (B) | 8 |' || chr(10) || '| ' || (k % 9 + 2) || ' | d | C | 10 pontos |' || chr(10) || '| x | A | B | 1 |' || chr(10) || 'meio' || chr(10) || '| a | b |' || chr(10) || '| c | d |' || chr(10) || 'fim'"""


@query(f"SELECT k, p_name || chr(10) || chr(10) || '1. Chave: (A) 8 pontos' || chr(10) || (k % 9 + 2) || '. Chave: (D) 10 pontos' || chr(10) || 'meio' || chr(10) || chr(10) || 'fim' AS text FROM {_from(p_name='p_name')}")
def answer_key_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer keys as lines; other tables give way."""
    return S.answer_lines(_parts(spark, sf_dir, s=_KEYS), "s", "k").select("k", "text")


_EXAM = """'# GRUPO I' || chr(10) || 'B' || chr(10) || 'A' || chr(10) || '1 ' || p_name || chr(10) || 'meio' || chr(10) || CASE WHEN k % 2 = 0 THEN '5 cinco' ELSE '6 seis' END || chr(10) || 'B' || chr(10) || '5 x' || chr(10) || '0 dez' || chr(10) || '**Observações:**' || chr(10) || '1. nota' || chr(10) || '# GRUPO II' || chr(10) || 'A' || chr(10) || '2. item'"""


@query(f"""
    SELECT k, '# GRUPO I' || chr(10) || 'B' || chr(10) || '## A' || chr(10) || CASE WHEN k % 2 = 0 OR true THEN p_name END || chr(10) || 'meio' || chr(10) || CASE WHEN k % 2 = 0 THEN '5 cinco' ELSE '6 seis' END || chr(10) || '## B' || chr(10) || '5 x' || chr(10) || '10 dez' || chr(10)
        || '**Observações:**' || chr(10) || '(1) nota' || chr(10) || '# GRUPO II' || chr(10) || '## A' || chr(10) || '2. item' AS text FROM {_from(p_name='p_name')}""")
def exam_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts promoted, a stray first line number gone, observations in brackets, a broken ten restored."""
    return N.normalised(_parts(spark, sf_dir, s=_EXAM), "s", "k")


_GROUPS = """'GRUPO I' || chr(10) || 'Leia o texto com atencao: ' || p_name || chr(10) || '## titulo' || chr(10) || 'fim' || chr(10) || 'PARTE A' || chr(10) || 'curto' || chr(10) || '1. item' || chr(10) || 'GRUPO II' || chr(10) || 'Um texto expositivo com mais de trinta letras ' || k || chr(10) || '2. item'"""


@query(f"""
    SELECT k, 'I' AS grupo, '' AS parte, 2 AS line_start, 'Leia o texto com atencao: ' || p_name || chr(10) || 'fim' AS texto FROM {_from(p_name='p_name')} UNION ALL SELECT p_partkey, 'II', '', 9, 'Um texto expositivo com mais de trinta letras ' || p_partkey FROM part""")
def group_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts before the first item of each group and part."""
    docs = _parts(spark, sf_dir, s=_GROUPS)
    firsts = docs.select("k", F.explode(F.array(F.struct(F.lit("I").alias("grupo"), F.lit("A").alias("parte"), F.lit(7).alias("line")), F.struct(F.lit("II").alias("grupo"), F.lit("").alias("parte"), F.lit(10).alias("line")))).alias("f")).select("k", "f.*")
    return N.group_contexts(docs, firsts, "s", "k").select("k", "grupo", "parte", "line_start", "texto")


@query("""
    WITH RECURSIVE c AS (SELECT user_id, event_id AS place, CAST((event_id * 7 % 19 + 1) * 5 AS INT) AS v, event_id % 3 = 0 AS s FROM events),
        f AS (SELECT user_id, min(place) AS place, arg_min(v, place) AS v FROM c WHERE s GROUP BY user_id),
        r AS (SELECT user_id, place, v FROM f UNION ALL SELECT r.user_id, (SELECT min(c.place) FROM c WHERE c.user_id = r.user_id AND c.v = r.v + 5 AND c.place > r.place), r.v + 5 FROM r
            WHERE EXISTS (SELECT 1 FROM c WHERE c.user_id = r.user_id AND c.v = r.v + 5 AND c.place > r.place))
    SELECT c.user_id, c.place, r.place IS NOT NULL AS taken FROM c LEFT JOIN r ON r.user_id = c.user_id AND r.place = c.place""")
def expected_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of multiples of five in order those that are the next expected."""
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select("user_id", k.cast("int").alias("at"), ((k * 7 % 19 + 1) * 5).cast("int").alias("v"), (k % 3 == 0).alias("s"))
    return N.expected_numbers(rows, "user_id", "at", "v", "s").select("user_id", F.col("at").cast("long").alias("place"), "taken")


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, 'v' || strftime(o_orderdate, '%Y%m%d-%H%M%S') AS version, CAST(CASE WHEN o_custkey % 5 > 0 THEN o_orderkey // (o_custkey % 5) ELSE 0 END AS BIGINT) AS shared,
        CAST(ceil(o_totalprice / 1000) AS BIGINT) AS up, CAST(greatest(1, least(o_custkey % 9, 4)) AS BIGINT) AS level, CAST(floor((o_orderkey % 40) * 12 / 40.0) + 1 AS BIGINT) AS page, coalesce(nullif(o_orderkey % 4, 0), o_custkey) AS sort_first,
        replace(replace(o_orderpriority || ' a/b', ' ', '%20'), '/', '%2F') AS quoted, CASE WHEN o_orderstatus = 'O' THEN 'O,x' ELSE 'O,x,' || o_orderstatus END AS appended, CASE WHEN o_custkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS parsed FROM orders""")
def scalar_kit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO times and version names, shares with a guard against zero, ceilings, clamps, estimates, keys where 0 is missing, quoting, appending what is absent, and numbers that may fail."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    at = F.col("o_orderdate").cast("timestamp")
    n = c % 5
    quoted = F.replace(F.url_encode(F.concat("o_orderpriority", F.lit(" a/b"))), F.lit("+"), F.lit("%20"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.concat(F.lit("v"), F.date_format(at, "yyyyMMdd-HHmmss")).alias("version"), F.when(n > 0, F.floor(k / F.greatest(n, F.lit(1)))).otherwise(0).alias("shared"),
        F.ceil(F.col("o_totalprice") / 1000).alias("up"), F.greatest(F.lit(1).cast("long"), F.least(c % 9, F.lit(4))).alias("level"), (F.floor((k % 40) * 12 / F.lit(40.0)) + 1).alias("page"), F.coalesce(F.nullif(k % 4, F.lit(0)), c).alias("sort_first"),
        quoted.alias("quoted"), F.array_join(F.array_union(F.array(F.lit("O"), F.lit("x")), F.array("o_orderstatus")), ",").alias("appended"), F.when(c % 3 == 0, k.cast("string")).otherwise("n/a").try_cast("long").cast("string").alias("parsed"),
    )


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 50")
def ranked_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources with the most items."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(50)


@query(r"""
    SELECT p_partkey, CASE WHEN ok THEN CASE g WHEN 'I' THEN 0 WHEN 'II' THEN 1 WHEN 'III' THEN 2 ELSE -1 END ELSE -1 END AS g, coalesce(TRY_CAST(regexp_extract(id, '^(?:([IVX]+)-)?(\d+)(?:\.(\d+))?$', 2) AS INT), 0) AS main,
        coalesce(TRY_CAST(regexp_extract(id, '^(?:([IVX]+)-)?(\d+)(?:\.(\d+))?$', 3) AS INT), 0) AS sub, round_even(round(p_retailprice, 2), 1) AS y
    FROM (SELECT *, regexp_matches(id, '^(?:([IVX]+)-)?(\d+)(?:\.(\d+))?$') AS ok, regexp_extract(id, '^([IVX]+)-', 1) AS g
        FROM (SELECT p_partkey, p_retailprice, CASE p_partkey % 5 WHEN 0 THEN 'II-A-' || p_size WHEN 1 THEN p_size || '.' || (p_partkey % 7) WHEN 2 THEN 'IV-' || p_size ELSE CASE WHEN p_partkey % 2 = 0 THEN 'x' ELSE 'III-' || p_size || '.' || p_partkey END END AS id FROM part))""")
def manifest_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sort keys of a manifest's ids, (-1, 0, 0) for those that can't be read, and a coordinate rounded for reading order."""
    from itemforge.operators.workspace import manifest_key

    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    third = F.concat(F.lit("III-"), size, F.lit("."), k.cast("string"))
    item = F.when(k % 5 == 0, F.concat(F.lit("II-A-"), size)).when(k % 5 == 1, F.concat(size, F.lit("."), (k % 7).cast("string"))).when(k % 5 == 2, F.concat(F.lit("IV-"), size)).when(k % 2 == 0, "x").otherwise(third)
    key = manifest_key(item)
    return table(spark, sf_dir, "part").select("p_partkey", key["grupo"].alias("g"), key["main"].alias("main"), key["sub"].alias("sub"), F.bround(F.round("p_retailprice", 2), 1).alias("y"))


@query("""
    SELECT user_id, place, arg_max(kind, score * 10 - rank) AS kind, max(score) AS score FROM (SELECT user_id, event_id // 3 AS place, event_type AS kind, CAST(value * 7 AS BIGINT) % 5 AS score, event_id % 3 AS rank FROM events) GROUP BY ALL""")
def best_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several proposals at one place that of the highest score, the first list's on ties."""
    rows = table(spark, sf_dir, "events").select("user_id", F.floor(F.col("event_id") / 3).alias("place"), F.col("event_type").alias("kind"), (F.rint(F.col("value") * 7).cast("long") % 5).alias("score"), (F.col("event_id") % 3).alias("rank"))
    return rows.groupBy("user_id", "place").agg(F.max_by("kind", F.struct("score", -F.col("rank"))).alias("kind"), F.max("score").alias("score"))


@query("""
    SELECT event_id, CASE WHEN x IS NULL THEN NULL WHEN x % 2 = 1 AND x > 1 THEN x - 1 END AS inferred FROM (SELECT event_id, first_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS x FROM events)""")
def inferred_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number inferred from the next known one."""
    from itemforge.operators import windows as W

    x = W.following(F.when(F.col("event_type") == "click", F.col("event_id")), ["user_id"], ["event_id"])
    found = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").withColumn("x", x)
    return found.select("event_id", F.when((F.col("x") % 2 == 1) & (F.col("x") > 1), F.col("x") - 1).alias("inferred"))


def _question_files(spark: SparkSession, sf_dir: str) -> str:
    """Parts as JSON records in the shared folder: some lack fields, and one record in nine is broken."""
    path, k = shared_path(spark, "questions"), F.col("p_partkey")
    item = F.concat(F.when(k % 2 == 0, "II-").otherwise(""), "p_size")
    row = F.struct(item.alias("id_item"), F.when(k % 3 > 0, F.col("p_size")).alias("numero_questao"), F.when(k % 4 == 0, F.array(F.lit("[review-pending]"))).alias("observacoes"), F.when(k % 5 == 0, k % 2 == 0).alias("reviewed"), F.when(k % 7 == 0, F.array(F.lit(" a "), F.lit(""))).alias("ids_contexto_pai"), F.when(k % 3 == 0, F.lit("b")).alias("id_contexto_pai"), F.col("p_name").alias("enunciado"), k.alias("numero_principal"))
    text = F.when(k % 9 == 8, F.concat(F.lit('{"id_item": "'), "p_name")).otherwise(F.to_json(row))
    table(spark, sf_dir, "part").select(text.alias("value")).write.text(path)
    return path


@query("""
    SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'II-' ELSE '' END || p_size AS id_item, p_size AS numero, CASE WHEN p_partkey % 5 = 0 THEN p_partkey % 2 = 0 ELSE p_partkey % 4 > 0 END AS reviewed, CASE WHEN p_partkey % 7 = 0 THEN 'a' WHEN p_partkey % 3 = 0 THEN 'b' ELSE '' END AS parents,
        'unknown' AS tipo, p_name AS enunciado FROM part WHERE p_partkey % 9 < 8""")
def json_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON and read with their defaults; broken ones are left out."""
    found = files.with_defaults(files.json_lines(spark, _question_files(spark, sf_dir), files.QUESTION))
    return found.select(F.col("numero_principal").cast("long").alias("k"), "id_item", F.col("numero_questao").alias("numero"), "reviewed", F.array_join("ids_contexto_pai", ",").alias("parents"), F.col("tipo_item").alias("tipo"), "enunciado")


@query("SELECT 'nation' AS \"table\", count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'supplier', count(*) FROM supplier")
def export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written under one folder, counted as they were written."""
    return files.exported({n: table(spark, sf_dir, n) for n in ("nation", "region", "supplier")}, shared_path(spark, "export"))


@query("""
    SELECT o_orderkey, concat_ws(',', CASE WHEN o_totalprice > 300000 THEN 'price' END, CASE WHEN o_orderstatus = 'P' THEN 'status' END) AS faults FROM orders WHERE o_totalprice > 300000 OR o_orderstatus = 'P'
    UNION ALL SELECT count(*), 'loaded' FROM orders WHERE NOT (o_totalprice > 300000 OR o_orderstatus = 'P')""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that can't be loaded with their faults, and how many others there are."""
    good, bad = files.quarantined(table(spark, sf_dir, "orders"), {"price": F.col("o_totalprice") > 300000, "status": F.col("o_orderstatus") == "P"})
    return bad.select("o_orderkey", F.array_join("faults", ",").alias("faults")).unionByName(good.agg(F.count("*").alias("o_orderkey")).withColumn("faults", F.lit("loaded")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey AS INT) END AS upserted, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS INT) END AS skipped FROM orders")
def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of result lines; other lines have none."""
    line = F.concat(F.when(F.col("o_orderkey") % 3 > 0, "[resultado] status=ok upserted=").otherwise("upserted="), "o_orderkey", F.lit(" skipped="), "o_custkey", F.lit(" erros=0"))
    r = files.upload_result(line)
    return table(spark, sf_dir, "orders").select("o_orderkey", r["upserted"].alias("upserted"), r["skipped"].alias("skipped"))


@query("""
    WITH p AS (SELECT page_id, n, CASE WHEN n % 4 = 0 THEN '' ELSE 'text' END AS body, n = 3 + page_id % 3 AS starts, n = 7 + page_id % 2 AS ends FROM (SELECT page_id, unnest(range(1, 11)) AS n FROM pages))
    SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'criteria' WHEN 1 THEN 'exam' ELSE 'other' END AS kind, min(n) FILTER (starts) AS first_page, max(n) FILTER (ends) - 1 AS last_page, count(*) FILTER (body <> '') AS with_text,
        CASE WHEN page_id % 5 = 0 THEN 'low' ELSE 'high' END AS confidence FROM p GROUP BY page_id""")
def triage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a file is by its name, its useful pages between two anchors, pages with text, and how sure that is."""
    k, n = F.col("page_id"), F.col("n")
    name = F.concat(F.when(k % 4 == 0, "EX-MatA635-F1-2024-CC-VD").when(k % 4 == 1, "EX-Port639-EE-2023").otherwise("nota"), F.lit(".pdf"))
    kind = F.when(name.rlike("-CC(-VD)?"), "criteria").when(name.rlike(r"^EX-\w+-(?:EE|F\w+)-\d{4}"), "exam").otherwise("other")
    pages = table(spark, sf_dir, "pages").select("page_id", kind.alias("kind"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("n"))
    body = F.when(n % 4 == 0, "").otherwise("text")
    said = pages.select("page_id", "kind", "n", F.concat(body, F.when(n == 3 + k % 3, " GRUPO I").when(n == 7 + k % 2, " COTAÇÕES").otherwise("")).alias("text"), body.alias("body"))
    found = said.groupBy("page_id", "kind").agg(F.min(F.when(F.col("text").rlike("GRUPO"), n)).cast("long").alias("first_page"), (F.max(F.when(F.col("text").rlike("COTA"), n)) - 1).cast("long").alias("last_page"), F.count_if(F.length(F.trim("body")) > 0).alias("with_text"))
    sure = F.when(k % 5 == 0, F.lit(None).cast("long")).otherwise(F.col("first_page"))
    return found.withColumn("confidence", F.when(sure.isNull() | F.col("last_page").isNull(), "low").otherwise("high"))


@query("""
    SELECT conv_id, string_agg(block, chr(10) || chr(10) ORDER BY turn) AS markdown FROM (
        SELECT conv_id, turn, block, lag(block) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM (
            SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN '![](imagens/' || conv_id || '.png)' WHEN role = 'system' THEN '#### ' || trim(role) WHEN role = 'user' AND turn % 3 = 0 THEN '# ' || role ELSE role END AS block FROM conversations)) WHERE before IS DISTINCT FROM block GROUP BY conv_id""")
def content_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of a layout as Markdown: headings of level 1 to 4, images, and no block twice in a row."""
    from pyspark.sql import Window

    t = F.col("turn")
    level = F.when(F.col("role") == "system", 9).when((F.col("role") == "user") & (t % 3 == 0), 0)
    text = F.trim("role")
    headed = F.when(level.isNotNull(), F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(level, F.lit(4)))), F.lit(" "), text)).otherwise(text)
    block = F.when(t % 4 == 3, F.concat(F.lit("![](imagens/"), "conv_id", F.lit(".png)"))).otherwise(headed)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", block.alias("block")).filter("block <> ''")
    kept = rows.withColumn("before", F.lag("block").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("NOT before <=> block")
    return kept.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "block"))), lambda x: x["block"]), "\n\n").alias("markdown"))


@query(r"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN list_contains(['enunciado', 'tags'], f) AND o THEN f END AS critical FROM (SELECT *, CASE l_partkey % 4 WHEN 0 THEN 'enunciado' WHEN 1 THEN 'status' WHEN 2 THEN 'tags' ELSE 'observacoes' END AS f, l_orderkey % 2 = 1 AS o FROM lineitem)""")
def critical_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of items there aren't that change content."""
    from itemforge.operators.merge import CRITICAL

    k = F.col("l_partkey") % 4
    field = F.when(k == 0, "enunciado").when(k == 1, "status").when(k == 2, "tags").otherwise("observacoes")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(field.isin(*CRITICAL) & (F.col("l_orderkey") % 2 == 1), field).alias("critical"))


@query(r"""
    SELECT doc_id, array_to_string(list_filter(string_split('nota;[validate][erro] x;[micro-lint][corrigido] y;' || lang, ';'), lambda v: NOT starts_with(v, '[')), ';') AS notes FROM documents""")
def own_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes without those that earlier runs wrote."""
    from itemforge.operators.merge import unlabelled

    notes = F.split(F.concat(F.lit("nota;[validate][erro] x;[micro-lint][corrigido] y;"), "lang"), ";")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(unlabelled(notes), ";").alias("notes"))


_BLOCKS = """'Mostre que ' || p_name || ' tem area 3.' || chr(10) || chr(10) || CASE k % 6 WHEN 0 THEN 'O gráfico da Figura 2 mostra uma reta.' WHEN 1 THEN 'Justifique a resposta:' WHEN 2 THEN 'Considere a funcao f;' WHEN 3 THEN '![](a.png)' WHEN 4 THEN 'Complete o texto seguinte.' ELSE 'sem fecho' END
    || chr(10) || chr(10) || 'Na Figura ' || (k % 9) || ', está representada uma reta. ![](b.png)' || chr(10) || chr(10) || 'Para certos valores reais de k.'"""


@query(f"""
    WITH x AS {_from(z='k % 6', p_name='p_name')}
    SELECT k, CASE z WHEN 0 THEN 8 WHEN 1 THEN -2 WHEN 2 THEN 2 WHEN 3 THEN -1 WHEN 4 THEN 4 ELSE 0 END || ',' || CASE z WHEN 0 THEN 6 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 4 WHEN 4 THEN 6 ELSE 5 END || ',' || CASE WHEN z IN (0, 1, 2, 3, 4, 5) THEN 1 END AS scores FROM x""")
def implicit_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that begin an item of their own, scored against all that was gathered before them."""
    from itemforge.operators.segment import implicit_openings as openings

    return _parts(spark, sf_dir, s=_BLOCKS).select("k", F.array_join(F.transform(openings(F.col("s")), lambda o: o["score"].cast("string")), ",").alias("scores"))


@query("""
    WITH x AS (SELECT c_custkey, c_custkey % 6 AS form, c_nationkey AS p, 'II-' || (c_custkey % 4 + 1) AS two FROM customer)
    SELECT c_custkey, CASE form WHEN 2 THEN 'I-1=;' || two || '=;III-1=' WHEN 4 THEN 'I-1=;I-2=;I-3=' WHEN 0 THEN 'I-1=;I-2=I-2.1,I-2.2' WHEN 1 THEN 'I-1=;I-2=I-2.1,I-2.2' END AS tree,
        CAST(CASE WHEN form < 2 THEN round_even(p + 0.5, 0) + 7 WHEN form = 2 THEN 13 + 44 + p WHEN form = 4 THEN p + 2 * round_even((p + 20) / 2.0, 0) END AS BIGINT) AS points,
        CASE WHEN form < 2 THEN 2 WHEN form IN (2, 4) THEN 3 END AS n, CASE form WHEN 1 THEN 'baixa' WHEN 0 THEN 'alta' WHEN 2 THEN 'alta' WHEN 4 THEN 'alta' END AS sure FROM x""")
def manifest_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of older forms in the canonical one: maps of points and of objects, pools, and what is no manifest."""
    k, p = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    flat = F.concat(F.lit('{"I-1": '), p, F.lit('.5, "I-2.2": 3, "I-2.1": 4}'))
    objects = F.concat(F.lit('{"I-1": {"tipo": ""}, "III-1": {"pontos": null}, "II-'), (k % 4 + 1).cast("string"), F.lit('": {"pontos": '), p, F.lit("}}"))
    pool = F.concat(F.lit('{"I-1": '), p, F.lit(', "pool_opcional": {"pontos": '), (F.col("c_nationkey") + 20).cast("string"), F.lit(', "itens": ["I-1", "I-2", "I-3"], "escolher": 2}}'))
    value = F.when(k % 6 == 0, flat).when(k % 6 == 1, F.concat(F.lit('{"cotacoes": '), flat, F.lit(', "confianca": "baixa"}'))).when(k % 6 == 2, objects).when(k % 6 == 3, "[1]").when(k % 6 == 4, pool).otherwise("x")
    found = files.migrated_manifests(table(spark, sf_dir, "customer").select("c_custkey", value.alias("json")), "json")
    tree = F.array_join(F.transform(F.array_sort(F.map_entries("m.estrutura")), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")
    points = F.aggregate(F.map_values("m.cotacoes"), F.lit(0).cast("long"), lambda a, v: a + v)
    return found.select("c_custkey", tree.alias("tree"), points.alias("points"), F.col("m.n").alias("n"), F.col("m.confianca").alias("sure"))

