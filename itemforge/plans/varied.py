"""Functions over texts that vary: pieces in changing order, repeated, with odd blanks, around each document's own text; the SQL reads the answer from the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.functions import repairs as P
from itemforge.functions import text as T
from itemforge.operators import scoring as S
from itemforge.plans.registry import query, table


def _pick(slot: int, pieces: tuple[str, ...], key: str = "doc_id") -> str:
    """One of the pieces, another for each key and slot, as SQL that both dialects read."""
    n = len(pieces)
    cases = " ".join(f"WHEN {k} THEN '{p}'" for k, p in enumerate(pieces))
    return f"CASE ({key} * {2 * slot + 3} + CAST(floor({key} / {n + slot}) AS BIGINT) + {slot}) % {n} {cases} END"


def _texts(pieces: tuple[str, ...], slots: int, between: str = " || ' ' || ", around: str = "") -> str:
    picked = [_pick(k, pieces) for k in range(slots)]
    half = slots // 2
    return between.join([*picked[:half], *([around] if around else []), *picked[half:]])


def _made(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql("SELECT doc_id, " + text.replace("\\", "\\\\") + " AS t FROM {docs}", docs=table(spark, sf_dir, "documents"))


_NOTES = _texts(("1 abc – def", "² Água — fria ", "12 Xis: no – x", "sem número – x", "3 sem traço", " 4 recuado – x", "⁵ a(b) – c", "¹² dois - três", "", "7  dois blancos —  x  "), 6, " || chr(10) || ", "coalesce(text, '')")
#: The pattern of a note as it stands in the library.
_NOTE = I.NOTE


@query(rf"""
    WITH d AS (SELECT doc_id, string_split({_NOTES}, chr(10)) AS c FROM documents), l AS (SELECT doc_id, unnest(c) AS line, unnest(range(1, len(c) + 1)) AS i FROM d),
        m AS (SELECT *, regexp_matches(line, '{_NOTE}') AS hit FROM l), f AS (SELECT doc_id, min(i) FILTER (hit) AS at, max(i) AS n FROM m GROUP BY doc_id)
    SELECT m.doc_id, coalesce(string_agg(translate(regexp_extract(line, '{_NOTE}', 1), '¹²³⁴⁵⁶⁷⁸⁹', '123456789') || '=' || trim(regexp_extract(line, '{_NOTE}', 2), ' '), ',' ORDER BY i) FILTER (hit), '') AS notes,
        sha256(CASE WHEN any_value(f.at) IS NULL THEN string_agg(line, chr(10) ORDER BY i) ELSE regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (i < f.at), ''), '\s+$', '') END) AS body
    FROM m JOIN f ON f.doc_id = m.doc_id GROUP BY m.doc_id""")
def notes_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footnotes before and after each document's own lines, and what stands before the first."""
    found = F.array_join(F.transform(I.notes(F.col("t")), lambda n: F.concat(n["numero"], F.lit("="), n["texto"])), ",")
    return _made(spark, sf_dir, _NOTES).select("doc_id", found.alias("notes"), F.sha2(I.without_notes(F.col("t")), 256).alias("body"))


_STEPS = _texts(("Calcula a área", "2 pontos", "10  ponto", "escreve 3", "  ", "pontas 4 ponta", "5pontos", "6 pontas;"), 7, " || chr(10) || ")


@query(rf"""
    WITH d AS (SELECT doc_id, {_STEPS} AS t FROM documents), m AS (SELECT doc_id, regexp_extract_all(t, '(?s)(.*?)([0-9]+) +pont[oa]s?', 1) AS said, regexp_extract_all(t, '(?s)(.*?)([0-9]+) +pont[oa]s?', 2) AS n FROM d)
    SELECT doc_id, array_to_string(list_transform(range(1, len(n) + 1), lambda i: n[i] || ':' || regexp_replace(said[i], '^\s+|\s+$', '', 'g')), ';') AS steps, CAST(coalesce(list_sum(list_transform(n, lambda x: CAST(x AS INT))), 0) AS BIGINT) AS total FROM m""")
def steps_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Criteria with their points, in texts where points also stand alone, fused or in other words."""
    said = I.steps(F.col("t"))
    told = F.transform(said, lambda s: F.concat(s["pontos"].cast("string"), F.lit(":"), s["descricao"]))
    return _made(spark, sf_dir, _STEPS).select("doc_id", F.array_join(told, ";").alias("steps"), F.aggregate(said, F.lit(0).cast("long"), lambda a, s: a + s["pontos"]).alias("total"))


_KEYS = _texts(("1. Opção (A)", "1. Opção (B)", "12. Opção (C)", "2. Opção (E)", "3. opção (A)", "2. Opção (D)", "4.Opção (A)", "I-3. Opção (C)", "2.  Opção (A)"), 6)


@query(rf"""
    WITH d AS (SELECT doc_id, {_KEYS} AS t FROM documents), m AS (SELECT doc_id, unnest(regexp_extract_all(t, '([0-9]+)\. Opção \(([A-D])\)', 1)) AS n, unnest(regexp_extract_all(t, '([0-9]+)\. Opção \(([A-D])\)', 2)) AS c, unnest(range(len(regexp_extract_all(t, '([0-9]+)\. Opção \(([A-D])\)')))) AS i FROM d),
        l AS (SELECT doc_id, n || arg_max(c, i) AS k FROM m GROUP BY doc_id, n)
    SELECT d.doc_id, coalesce(string_agg(k, ',' ORDER BY k), '') AS keys FROM d LEFT JOIN l ON l.doc_id = d.doc_id GROUP BY d.doc_id""")
def keys_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers by item number, of several for one item the last."""
    entries = F.transform(F.map_entries(I.key_letters(F.col("t"))), lambda e: F.concat(e["key"], e["value"]))
    return _made(spark, sf_dir, _KEYS).select("doc_id", F.array_join(F.array_sort(entries), ",").alias("keys"))


_PHRASES = ("num texto de opinião", "Identifique as  duas", "complete a afirmação", "COMPLETE AS AFIRMAÇÕES", "incomplete as afirmações", "Complete o texto", "(A) um", "(B) dois", "(C) três", "(D) quatro", "qual das rectas", "redija um textos", "três afirmações verdadeiras")
_TYPED = _texts(_PHRASES, 5)


@query(rf"""
    WITH d AS (SELECT doc_id, {_TYPED} AS t FROM documents)
    SELECT doc_id, CASE WHEN len(regexp_extract_all(t, '\([A-D]\)')) = 4 THEN 'multiple_choice' WHEN contains(lower(t), 'num texto de opinião') THEN 'essay'
        WHEN contains(lower(t), 'três afirmações verdadeiras') OR contains(lower(t), 'identifique as  duas') THEN 'multi_select'
        WHEN regexp_matches(' ' || lower(t) || ' ', '[^a-z]complete as afirmações[^a-z]') THEN 'complete_table' WHEN regexp_matches(' ' || lower(t) || ' ', '[^a-z]complete o texto[^a-z]') THEN 'completion' ELSE 'open_response' END AS tipo FROM d""")
def types_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of texts with phrases of several types, near misses among them."""
    return _made(spark, sf_dir, _TYPED).select("doc_id", I.item_type(F.col("t")).alias("tipo"))


_LABEL = " || ', ' || ".join((
    _pick(0, ("Exame Nacional", "Exame Nacional", "Exame Final Nacional", "Teste Intermédio", " Exame Nacional"), "c_custkey"), _pick(1, ("Português", "Matemática A", "Matematica A", "Física", "Matemática"), "c_custkey"),
    _pick(2, ("1.ª Fase", "2.ª Fase", "Época Especial", "3.ª Fase", "1xª Fase"), "c_custkey"), "'20' || " + _pick(3, ("24", "07", "1", "999", "24, extra", "24 "), "c_custkey"),
))


@query(f"""
    WITH d AS (SELECT c_custkey, {_LABEL} AS t FROM customer), p AS (SELECT c_custkey, string_split(t, ', ') AS c FROM d),
        k AS (SELECT *, len(c) = 4 AND c[1] = 'Exame Nacional' AND c[2] IN ('Português', 'Matemática A') AND c[3] IN ('1.ª Fase', '2.ª Fase', 'Época Especial') AND regexp_full_match(c[4], '20[0-9][0-9]') AS ok FROM p)
    SELECT c_custkey, CASE WHEN ok THEN c[2] END AS materia, CASE WHEN ok THEN c[3] END AS fase, CASE WHEN ok THEN CAST(c[4] AS INT) END AS ano FROM k""")
def labels_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source labels of right and wrong parts in all combinations."""
    rows = spark.sql(f"SELECT c_custkey, {_LABEL} AS t FROM {{rows}}", rows=table(spark, sf_dir, "customer"))
    label = T.source_label(F.col("t"))
    return rows.select("c_custkey", label["materia"].alias("materia"), label["fase"].alias("fase"), label["ano"].alias("ano"))


_IDS = " || ".join((_pick(0, ("", "I-", "IV-", "x-", "i-", "II-A-", "I-I-"), "p_partkey"), _pick(1, ("1", "012", "1234", "", "7.2", "ctx1", "20.11"), "p_partkey")))
_MARKED = " || ".join((_pick(2, ("", " ", "x"), "p_partkey"), _pick(3, ("*", "★", r"\bigstar", r"$\star$", r"$\ast$", "$*$", "**", "1. "), "p_partkey"), "p_name"))


@query(rf"""
    SELECT p_partkey, TRY_CAST(nullif(regexp_extract(regexp_replace(i, '^[IVX]+-', ''), '^[0-9]{{1,3}}'), '') AS INT) AS number,
        starts_with(ltrim(m), '*') OR starts_with(ltrim(m), '★') OR starts_with(ltrim(m), '\bigstar') OR starts_with(ltrim(m), '$\star$') OR starts_with(ltrim(m), '$\ast$') AS optional FROM (SELECT p_partkey, {_IDS} AS i, {_MARKED} AS m FROM part)""")
def ids_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main numbers of ids, readable or not, and marks of optional items."""
    marked = _MARKED.replace("\\", "\\\\")
    rows = spark.sql(f"SELECT p_partkey, {_IDS} AS i, {marked} AS m FROM {{rows}}", rows=table(spark, sf_dir, "part"))
    return rows.select("p_partkey", T.item_number(F.col("i")).alias("number"), I.optional_marker(F.col("m")).alias("optional"))


def _line_sql(text: str) -> str:
    """Lines of each text with their place, trimmed, without blank ones."""
    return f"l AS (SELECT doc_id, pos, trim(raw) AS line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS raw, unnest(range(len(string_split(t, chr(10))))) AS pos FROM (SELECT doc_id, {text} AS t FROM documents)) WHERE trim(raw) <> '')"


_SCORED = _texts(("GRUPO I", "GRUPO II", "Parte a", "1. 10 pontos", "# 3. 15  pontos", "2.1. 7 pontos", "grupo iii (50 pontos)", "2.2 1 ponto", "4. a 6. ...... 10 pontos", "7. a 8. 2 × 6 pontos", "x 5. 9 pontos", "", "PARTE B", "1. 8 pontos", "9. sem pontos", "Destes 3 itens, contribuem para a classificação final os 2 itens"), 12, " || chr(10) || ")
_PLACED = rf"""{_line_sql(_SCORED)}, m AS (SELECT *, try_cast(nullif(regexp_extract(line, '^Destes \d+ itens.*os (\d+) itens', 1), '') AS INT) AS pool, upper(nullif(regexp_extract(line, '(?i)^grupo\s+([IV]+)', 1), '')) AS g, upper(nullif(regexp_extract(line, '(?i)^parte\s+([A-C])', 1), '')) AS p FROM l),
    n AS (SELECT *, coalesce(last_value(g IGNORE NULLS) OVER w, '') AS grupo, count(g) OVER w AS groups FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    q AS (SELECT *, coalesce(last_value(p IGNORE NULLS) OVER (PARTITION BY doc_id, groups ORDER BY pos), '') AS parte FROM n),
    i AS (SELECT doc_id, pos, grupo, parte, regexp_extract(line, '^(?:# )?(\d+(?:\.\d+)?)\.?\s+\d+\s*ponto', 1) AS num, try_cast(regexp_extract(line, '^(?:# )?\d+(?:\.\d+)?\.?\s+(\d+)\s*ponto', 1) AS INT) AS points FROM q WHERE g IS NULL AND p IS NULL
        UNION ALL SELECT doc_id, pos, grupo, parte, unnest(['4', '5', '6']), 3 FROM q WHERE starts_with(line, '4. a 6.') UNION ALL SELECT doc_id, pos, grupo, parte, unnest(['7', '8']), 6 FROM q WHERE starts_with(line, '7. a 8.')),
    s AS (SELECT doc_id, concat_ws('-', nullif(grupo, ''), nullif(parte, ''), num) AS item_id, arg_max(points, pos) AS points, arg_max(grupo, pos) AS grupo FROM i WHERE num <> '' AND points IS NOT NULL GROUP BY ALL)"""


@query(f"WITH {_PLACED} SELECT doc_id, item_id, points, CASE WHEN contains(item_id, '.') THEN regexp_replace(item_id, '\\.[0-9]+$', '') END AS parent, grupo FROM s")
def scores_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of items from lines, ranges, groups and parts in changing order, the same item more than once."""
    return S.scores(_made(spark, sf_dir, _SCORED), "t").drop("pos")


@query(f"""
    WITH {_PLACED}, a AS (SELECT doc_id, grupo, arg_max(pool, pos) AS escolher FROM q WHERE pool IS NOT NULL GROUP BY ALL), w AS (SELECT * FROM s WHERE NOT contains(item_id, '.'))
    SELECT a.doc_id, a.grupo, escolher, string_agg(item_id, ',' ORDER BY item_id) AS itens FROM a JOIN w ON w.doc_id = a.doc_id AND (a.grupo = '' OR w.grupo = a.grupo) GROUP BY ALL""")
def pools_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which some count, for the group whose lines say so, or for all where none stands before."""
    docs = _made(spark, sf_dir, _SCORED)
    return S.pools(docs, S.scores(docs, "t"), "t").select("doc_id", "grupo", "escolher", F.array_join("itens", ",").alias("itens"))


_BLOCKS = _texts(("## 2. 10 pontos", "3. 5 pontos", "7 pontos", "um passo", "5.1. 4 pontos", "9. . 8 pontos", "", "12 pontos ", "outro passo ", "6.  20 pontos", "a 4. 3 pontos"), 11, " || chr(10) || ")


@query(rf"""
    WITH l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM (SELECT doc_id, {_BLOCKS} AS t FROM documents)),
        m AS (SELECT *, nullif(regexp_extract(line, '^(?:## )?(\d+(?:\.\d+)?)\.(?: \.)? +\d+ pontos', 1), '') AS id, try_cast(regexp_extract(line, '(\d+) pontos *$', 1) AS INT) AS points, regexp_matches(line, '^\d+ pontos *$') AS alone FROM l),
        n AS (SELECT *, try_cast(string_split(id, '.')[1] AS INT) AS main FROM m),
        b AS (SELECT *, last_value(main IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, first_value(main IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM n),
        g AS (SELECT *, CASE WHEN alone THEN CASE WHEN before IS NULL THEN CASE WHEN after > 1 THEN after - 1 END WHEN after >= before + 2 THEN before + 1 END END || '' AS guess FROM b),
        u AS (SELECT g.*, CASE WHEN guess IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, guess ORDER BY pos) = 1 AND NOT EXISTS (SELECT 1 FROM m o WHERE o.doc_id = g.doc_id AND o.id = g.guess) THEN guess END AS lone FROM g),
        k AS (SELECT *, count(coalesce(id, lone)) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM u)
    SELECT doc_id, max(coalesce(id, lone)) AS item_id, arg_min(points, pos) AS points, bool_or(lone IS NOT NULL) AS implicit, CAST(min(pos) + 1 AS INT) AS line_start, CAST(max(pos) + 1 AS INT) AS line_end,
        regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (id IS NULL AND lone IS NULL), ''), '^\s+|\s+$', '', 'g') AS body FROM k WHERE block > 0 GROUP BY doc_id, block HAVING NOT implicit OR body <> ''""")
def criteria_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Criteria cut at headings in changing order, with lines of points alone whose number the neighbours tell, or not."""
    return S.criteria_blocks(_made(spark, sf_dir, _BLOCKS), "t")


_TABLES = _texts(("| Item | Versão 1 | Pontuação |", "| 1. | (A) | 8 |", "| 2.1 | d | 10 pontos |", "| x | A | 1 |", "| 3. | E | 2 |", "texto", "", "| 4 | ( B ) | sem |", "|---|---|---|", "| ITEM | Versões | Cotação |"), 13, " || chr(10) || ", "coalesce(replace(text, chr(10), ' '), '')")


@query(rf"""
    WITH l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM (SELECT doc_id, {_TABLES} AS t FROM documents)),
        m AS (SELECT *, starts_with(trim(line), '|') AND ends_with(trim(line), '|') AND length(trim(line)) > 1 AS piped FROM l), r AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, piped ORDER BY pos) AS run FROM m),
        h AS (SELECT *, row_number() OVER w AS nth, lower(first_value(line) OVER w) LIKE '| item%' AS headed, string_split(line, '|') AS c FROM r WINDOW w AS (PARTITION BY doc_id, piped, run ORDER BY pos)),
        s AS (SELECT *, regexp_replace(trim(c[2]), '\.$', '') AS item, upper(trim(c[3], ' ()')) AS letter, regexp_extract(c[4], '\d+') AS worth FROM h),
        x AS (SELECT doc_id, pos, CASE WHEN NOT piped THEN line WHEN nth = 1 THEN '' WHEN headed AND regexp_full_match(item, '\d+(\.\d+)?') AND letter IN ('A', 'B', 'C', 'D') AND worth <> '' THEN item || '. Chave: (' || letter || ') ' || worth || ' pontos' END AS shown FROM s)
    SELECT doc_id, string_agg(shown, chr(10) ORDER BY pos) AS text FROM x WHERE shown IS NOT NULL GROUP BY doc_id""")
def tables_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer keys with and without a header, with rows that aren't answers, beside free lines."""
    return S.answer_lines(_made(spark, sf_dir, _TABLES), "t")


_SHORT = _texts(("I, III e IV", "só II", "", "V e VI", "I", "  ", "5 verso", "10 outro", "205 longe", "Leia o Poema", "15", "IV.", "7 ímpar", "III e III"), 7, " || chr(10) || ")


@query(rf"""
    WITH d AS (SELECT doc_id, list_filter(string_split({_SHORT}, chr(10)), lambda x: trim(x) <> '') AS ls FROM documents),
        r AS (SELECT *, regexp_extract_all(array_to_string(ls[1:3], chr(10)), '\b(III|II|IV|I|V)\b', 1) AS f, len(list_filter(ls, lambda x: coalesce(try_cast(regexp_extract(x, '^(\d+)\s+\S', 1) AS INT), 1) % 5 = 0 AND try_cast(regexp_extract(x, '^(\d+)\s+\S', 1) AS INT) <= 200)) AS n FROM d)
    SELECT doc_id, CASE WHEN len(list_distinct(f)) >= 2 THEN array_to_string(list_filter(f, lambda v, k: list_position(f, v) = k), ',') ELSE '' END AS romans, CASE WHEN n >= 2 THEN 'excerpt' WHEN len(list_filter(ls[1:3], lambda x: contains(lower(x), 'leia o poema'))) > 0 THEN 'poem' ELSE 'prose' END AS shown FROM r""")
def contexts_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roman answers of the first lines, and how a context is shown, over lines in changing order."""
    return _made(spark, sf_dir, _SHORT).select("doc_id", F.array_join(P.roman_answers(F.col("t")), ",").alias("romans"), P.line_kind(F.col("t")).alias("shown"))


_LEVELS = _texts(("Nível 4 (N4) 9 pontos", "nível N2 - 3 pontos", "Nivel 1 12 pontos cheios", "Nível N10 2 pontos", "texto do nível", "", "passo 3 pontos", "NÍVEL 3 4 pontos", "Nível n 5 sem", "nível 2 e nível 3: 7  ponto"), 9, " || chr(10) || ", "coalesce(replace(substr(text, 1, 400), chr(10), ' '), '')")
_HEADING = r"[Nn][íi]vel\s*(?:[Nn]\s*)?\d\b[^\n]*?\d+\s*pont"


@query(rf"""
    WITH d AS (SELECT doc_id, {_LEVELS} AS t FROM documents), f AS (SELECT doc_id, unnest(regexp_extract_all(t, '{_HEADING}')) AS m, unnest((regexp_split_to_array(t, '{_HEADING}'))[2:]) AS a, unnest(range(len(regexp_extract_all(t, '{_HEADING}')))) AS k FROM d)
    SELECT doc_id, CAST(k AS INT) AS k, 'N' || regexp_extract(m, '\d') AS nivel, CAST(regexp_extract(m, '(\d+)\s*pont$', 1) AS INT) AS pontos, substr(regexp_replace(string_split(a, chr(10) || chr(10))[1], '^\s+|\s+$', '', 'g'), 1, 300) AS descritor FROM f""")
def levels_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance levels in changing order, near misses among them, and long descriptions cut."""
    return _made(spark, sf_dir, _LEVELS).select("doc_id", F.posexplode(P.levels(F.col("t"))).alias("k", "v")).select("doc_id", "k", "v.*")


_CHOICES = _texts(("(A) um", "(B)  dois  e meio", "(C)três (D) quatro", "(E) cinco", "texto (A", "(D) $x$", "(B) (A) vazio", "(a) minúscula", "fim"), 7, around="coalesce(substr(text, 1, 60), '')")


@query(rf"""
    WITH d AS (SELECT doc_id, replace(' ' || regexp_replace({_CHOICES}, '\s+', ' ', 'g'), '(B) (A)', '(B) [A]') AS t FROM documents), f AS (SELECT doc_id, regexp_extract_all(t, ' \(([A-D])\)', 1) AS letters, (regexp_split_to_array(t, ' \([A-D]\)'))[2:] AS texts FROM d)
    SELECT doc_id, array_to_string(list_transform(letters, lambda v, k: v || '=' || trim(replace(texts[k], '[A]', '(A)'))), ';') AS alternativas FROM f""")
def choices_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternatives of texts in which letters repeat, miss or stand in another order, among other brackets."""
    rows = _made(spark, sf_dir, _CHOICES).withColumn("t", F.regexp_replace("t", r"\s+", " "))
    return rows.select("doc_id", F.array_join(F.transform(I.alternatives(F.col("t")), lambda a: F.concat(a["letra"], F.lit("="), a["texto"])), ";").alias("alternativas"))
