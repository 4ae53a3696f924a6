"""Text functions, rules, search and segmentation, bound to documents, conversations, pages and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.functions import text as T
from itemforge.operators import rules as R
from itemforge.operators import vectors as V
from itemforge.operators.segment import segments
from itemforge.plans.registry import query, table

_FOLD = f"translate(lower({{0}}), '{T.ACCENTED}', '{T.PLAIN}')"
_SLUG = f"trim(regexp_replace({_FOLD.format('trim(text)')}, '[^a-z0-9]+', '-', 'g'), '-')"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query(f"SELECT doc_id, sha256({_SLUG}) AS digest, length({_SLUG}) AS n FROM documents")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.slug(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.sha2(s, 256).alias("digest"), F.length(s).cast("long").alias("n"))


@query(f"SELECT doc_id, sha256({_FOLD.format('text')}) AS digest FROM documents")
def unaccent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.sha2(T.unaccent(F.lower("text")), 256).alias("digest"))


@query("SELECT page_id, coalesce(nullif(trim(regexp_replace(trim(url), '[^A-Za-z0-9._-]+', '-', 'g'), '-'), ''), 'documento') AS name FROM pages")
def file_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.file_slug(F.col("url")).alias("name"))


@query("""
    WITH x AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Exame Nacional, Português, 1.ª Fase, 20' WHEN 1 THEN 'Exame Nacional, Matemática A, Época Especial, 20' WHEN 2 THEN 'Exame Nacional, Matematica A, 1.ª Fase, 20' ELSE 'Teste Intermédio, Português, 2.ª Fase, 20' END || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS label FROM customer)
    SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 THEN string_split(label, ', ')[2] END AS subject, CASE WHEN c_custkey % 4 < 2 THEN string_split(label, ', ')[3] END AS phase, CASE WHEN c_custkey % 4 < 2 THEN CAST(string_split(label, ', ')[4] AS INT) END AS year FROM x""")
def parse_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source labels taken apart; one that isn't canonical gives nulls."""
    kind = F.col("c_custkey") % 4
    start = F.when(kind == 0, "Exame Nacional, Português, 1.ª Fase, 20").when(kind == 1, "Exame Nacional, Matemática A, Época Especial, 20").when(kind == 2, "Exame Nacional, Matematica A, 1.ª Fase, 20").otherwise("Teste Intermédio, Português, 2.ª Fase, 20")
    parsed = T.source_label(F.concat(start, F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
    return table(spark, sf_dir, "customer").select("c_custkey", parsed["materia"].alias("subject"), parsed["fase"].alias("phase"), parsed["ano"].alias("year"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linenumber AS INT) AS number FROM lineitem")
def parse_item_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main numbers of ids with a group before and a sub-item behind."""
    item = F.concat(F.when(F.col("l_partkey") % 2 == 0, "II-").otherwise(""), F.col("l_linenumber").cast("string"), F.lit("."), F.col("l_suppkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", T.item_number(item).alias("number"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '([^/]+?)(\\.[^./]*)?$', 1) AS stem FROM pages")
def parse_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("url", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"))


@query(r"SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g')) AS digest FROM documents")
def compact_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.sha2(T.compact(F.col("text")), 256).alias("digest"))


@query("""
    SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'essay' WHEN 1 THEN 'multi_select' WHEN 2 THEN 'complete_table' WHEN 3 THEN 'completion' WHEN 4 THEN 'multiple_choice' ELSE 'open_response' END AS tipo FROM documents""")
def infer_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with a phrase behind it that tells a type."""
    k = F.col("doc_id") % 6
    phrase = F.when(k == 0, " Num texto de opinião").when(k == 1, " identifique as TRÊS").when(k == 2, " Complete as afirmações").when(k == 3, " Complete o texto").when(k == 4, " (A) um (B) dois (C) três (D) quatro").otherwise(" fim")
    return _docs(spark, sf_dir).select("doc_id", I.item_type(F.concat(F.regexp_replace("text", r"\([A-D]\)", ""), phrase)).alias("tipo"))


@query(r"""
    WITH x AS (SELECT doc_id, regexp_replace(text, '[¹²³⁴⁵⁶⁷⁸⁹0-9]', '', 'g') AS t FROM documents)
    SELECT doc_id, CAST((doc_id % 9) + 1 AS VARCHAR) || '=calamistrar – tornar crespo,2=outra — coisa' AS notes, length(regexp_replace(t, '\s+$', '')) AS n_body FROM x""")
def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footnotes behind each document, and the length of what stands before them."""
    bare = F.regexp_replace("text", "[¹²³⁴⁵⁶⁷⁸⁹0-9]", "")
    noted = F.concat(bare, F.lit("\n\n"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit(" calamistrar – tornar crespo\n² outra — coisa"))
    found = F.array_join(F.transform(I.notes(F.col("t")), lambda n: F.concat(n["numero"], F.lit("="), n["texto"])), ",")
    # A generator stands between, so the text is made once.
    made = _docs(spark, sf_dir).select("doc_id", F.explode(F.array(noted)).alias("t"))
    return made.select("doc_id", found.alias("notes"), F.length(I.without_notes(F.col("t"))).cast("long").alias("n_body"))


@query(r"SELECT doc_id, sha256(regexp_replace(replace(replace(text, '###', ''), '$$$', ''), '\n{3,}', chr(10) || chr(10), 'g')) AS digest FROM documents")
def boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.sha2(I.without_boilerplate(F.col("text"), ("###", "$$$")), 256).alias("digest"))


@query("SELECT p_partkey, CASE WHEN string_split(p_name, ' ')[1] = string_split(p_name, ' ')[2] THEN '#' || string_split(p_name, ' ')[1] ELSE '#' || replace(p_name, ' ', ',#') END AS tags FROM part")
def tags_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags trimmed, with their sign, each once, in order."""
    raw = F.concat(F.split("p_name", " "), F.array(F.lit(" "), F.concat(F.lit(" #"), F.split("p_name", " ")[0])))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(T.normal_tags(raw), ",").alias("tags"))


#: (name, pattern, replacement) in both regex dialects.
FIXES = (("number", r"^\s*\d{1,3}\.\s*", ""), ("ellipsis", r"\.\.\.", "…"), ("marks", "#{2,}", "#"), ("blanks", " {2,}", " "), ("dollars", r"\$+", "€"))
_FIXED = "text"
_STEPS = []
for _name, _pattern, _to in FIXES:
    _new = f"regexp_replace({_FIXED}, '{_pattern}', '{_to}', 'g')"
    _STEPS.append(f"CASE WHEN {_new} <> {_FIXED} THEN '{_name}' END")
    _FIXED = _new


@query(f"SELECT doc_id, sha256({_FIXED}) AS digest, concat_ws(',', {', '.join(_STEPS)}) AS log FROM documents")
def fix_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered corrections and a log of those that changed something."""
    return T.fixed(_docs(spark, sf_dir), ["doc_id"], F.col("text"), FIXES).select("doc_id", F.sha2("fixed", 256).alias("digest"), F.array_join("log", ",").alias("log"))


@query(r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(text, '"([^"\n]*)"', '«\1»', 'g'), '\.\.\.', '…', 'g'), '([a-z])-\n([a-z])', '\1\2', 'g')) AS digest FROM documents""")
def pt_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotation marks, ellipses and words broken at line ends."""
    fixed, _ = T.fix_chain(F.col("text"), (("quotes", r'"([^"\n]*)"', "«$1»"), ("ellipsis", r"\.\.\.", "…"), ("hyphen", r"([a-z])-\n([a-z])", "$1$2")))
    return _docs(spark, sf_dir).select("doc_id", F.sha2(fixed, 256).alias("digest"))


@query(r"""
    SELECT doc_id, sha256(list_aggregate(list_transform(regexp_extract_all(text, '(?s)(\$[^$]*\$|[^$]+|\$)', 1), lambda p: CASE WHEN starts_with(p, '$') THEN p ELSE regexp_replace(p, '[0-9]+', '0', 'g') END), 'string_agg', '')) AS digest FROM documents WHERE text <> ''""")
def outside_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers replaced, but not between dollar signs."""
    return _docs(spark, sf_dir).filter("text <> ''").select("doc_id", F.sha2(T.outside_math(F.col("text"), "[0-9]+", "0"), 256).alias("digest"))


@query(r"SELECT doc_id, (length(text) - length(replace(text, '$', '')) - (length(text) - length(replace(text, '\$', ''))) / 2) % 2 = 1 AS odd FROM documents")
def dollar_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.odd_dollars(F.col("text")).alias("odd"))


@query(r"SELECT doc_id, (contains(text, '$') OR contains(text, '\')) AND length(replace(text, '{', '')) <> length(replace(text, '}', '')) AS mismatch FROM documents")
def brace_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.brace_mismatch(F.col("text")).alias("mismatch"))


@query(r"""
    WITH m AS (SELECT doc_id, text, regexp_replace(text, '(?s)\$\$.*?\$\$|\$[^$\n]+?\$', '', 'g') AS t FROM documents),
        c AS (SELECT doc_id, text, t, length(text) - length(replace(text, '$', '')) AS d, length(replace(t, ')', '')) - length(replace(t, '(', '')) AS p, length(replace(t, ']', '')) - length(replace(t, '[', '')) AS b FROM m)
    SELECT doc_id, concat_ws(',', CASE WHEN d % 2 = 1 THEN 'odd_dollars' END, CASE WHEN abs(p) > 1 THEN 'parens' END, CASE WHEN abs(b) > 1 THEN 'brackets' END, CASE WHEN regexp_matches(text, '[A-Za-z]0[A-Za-z]') THEN 'zero_in_word' END,
        CASE WHEN regexp_matches(text, '\\frac\{[^}]*\}[^{]') THEN 'frac_without_denominator' END, CASE WHEN regexp_matches(text, '\\sqrt[^{\[]') THEN 'sqrt_without_brace' END,
        CASE WHEN regexp_matches(text, '[\^_][A-Za-z0-9]{2,}') THEN 'bare_script' END, CASE WHEN regexp_matches(t, '[a-záàâãéêíóôõúç]I[a-záàâãéêíóôõúç]') THEN 'capital_i' END) AS flags FROM c""")
def ocr_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.array_join(I.ocr_flags(F.col("text")), ",").alias("flags"))


@query("""
    SELECT doc_id, list_aggregate(list_slice(list_sort(list_filter(list_distinct(list_transform(regexp_extract_all(d.text, '[a-záàâãéêíóôõúüçA-ZÁÀÂÃÉÊÍÓÔÕÚÜÇ]{5,}'), lambda x: lower(x))), lambda x: NOT list_contains(list_transform(regexp_extract_all(b.text, '[a-záàâãéêíóôõúüçA-ZÁÀÂÃÉÊÍÓÔÕÚÜÇ]{5,}'), lambda y: lower(y)), x))), 1, 4), 'string_agg', ',') AS sample
    FROM documents d JOIN benchmark b ON doc_id % 40 = item_id""")
def token_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four long words of an edited text that its original lacks."""
    original = table(spark, sf_dir, "benchmark").select("item_id", T.long_words(F.col("text")).alias("had"))
    joined = _docs(spark, sf_dir).join(original, F.col("doc_id") % 40 == F.col("item_id"))
    sample = F.slice(F.array_sort(F.array_except(T.long_words(F.col("text")), "had")), 1, 4)
    return joined.select("doc_id", F.nullif(F.array_join(sample, ","), F.lit("")).alias("sample"))


@query("SELECT doc_id, 'primeiro=' || CAST(doc_id % 7 AS VARCHAR) || ',segundo=3' AS steps FROM documents")
def steps_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Criteria with their points, parsed from a text that is made of them."""
    text = F.concat(F.lit("primeiro "), (F.col("doc_id") % 7).cast("string"), F.lit(" pontos\nsegundo 3 pontos\n"), F.regexp_replace("text", "pont[oa]", ""))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(F.transform(I.steps(text), lambda s: F.concat(s["descricao"], F.lit("="), s["pontos"].cast("string"))), ",").alias("steps"))


@query("SELECT doc_id, chr(CAST(65 + doc_id % 4 AS INT)) AS first, 'C' AS second FROM documents")
def mc_key_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer letters by item; the last mention wins."""
    letter = F.char(F.lit(65) + F.col("doc_id") % 4)
    found = I.key_letters(F.concat(F.lit("1. Opção (A) 2. Opção (C) "), F.col("text"), F.lit(" 1. Opção ("), letter, F.lit(")")))
    return _docs(spark, sf_dir).select("doc_id", found["1"].alias("first"), found["2"].alias("second"))


@query(r"""
    WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM conversations),
        k AS (SELECT *, CASE WHEN trim(line) = '' THEN 'blank' WHEN regexp_matches(line, '^\s*[0-9]+[.)]') THEN 'number' WHEN regexp_matches(line, '^\s*[*-] ') THEN 'bullet' WHEN regexp_matches(line, '^#+ ') THEN 'heading' ELSE 'prose' END AS kind FROM l)
    SELECT conv_id, turn, CAST(pos - 1 AS INT) AS pos, kind, lead(kind) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS next FROM k""")
def line_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind of each line and of the one after."""
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.col("line")
    kind = F.when(F.trim(line) == "", "blank").when(line.rlike(r"^\s*[0-9]+[.)]"), "number").when(line.rlike(r"^\s*[*-] "), "bullet").when(line.rlike("^#+ "), "heading").otherwise("prose")
    return lines.withColumn("kind", kind).select("conv_id", "turn", "pos", "kind", F.lead("kind").over(Window.partitionBy("conv_id", "turn").orderBy("pos")).alias("next"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", F.sha2("text", 256).alias("digest"))
    counts = docs.groupBy("digest").agg(F.count("*").alias("copies"))
    rules = [
        R.Rule("V7-short", R.ERROR, F.length(F.regexp_replace("text", r"\s", "")) < 30), R.Rule("V7-source", R.ERROR, F.coalesce("source", F.lit("")) == ""), R.Rule("V15-dollars", R.ERROR, T.odd_dollars(F.col("text"))),
        R.Rule("V22-duplicate", R.ERROR, F.col("copies") > 1), R.Rule("V12-contamination", R.WARNING, F.contains("text", F.lit("###"))), R.Rule("V11-long", R.WARNING, F.length("text") > 5000),
    ]
    return R.judged(docs.join(counts, "digest"), rules)


_JUDGED = r"""
    WITH x AS (SELECT d.*, count(*) OVER (PARTITION BY text) AS copies FROM documents d),
        j AS (SELECT doc_id, list_filter([CASE WHEN length(regexp_replace(text, '\s', '', 'g')) < 30 THEN 'V7-short' END, CASE WHEN coalesce(source, '') = '' THEN 'V7-source' END,
            CASE WHEN (length(text) - length(replace(text, '$', '')) - (length(text) - length(replace(text, '\$', ''))) / 2) % 2 = 1 THEN 'V15-dollars' END, CASE WHEN copies > 1 THEN 'V22-duplicate' END], lambda v: v IS NOT NULL) AS errors,
            list_filter([CASE WHEN contains(text, '###') THEN 'V12-contamination' END, CASE WHEN length(text) > 5000 THEN 'V11-long' END], lambda v: v IS NOT NULL) AS warnings FROM x),
        s AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'validation_error' WHEN len(warnings) > 0 THEN 'approved_with_warnings' ELSE 'approved' END AS status FROM j)"""


@query(_JUDGED + " SELECT doc_id, array_to_string(errors, ',') AS errors, array_to_string(warnings, ',') AS warnings, status FROM s")
def rule_engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule on every document."""
    return _judged(spark, sf_dir).select("doc_id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "status")


@query(_JUDGED + " SELECT status, count(*) AS n, CAST(sum(len(errors)) AS BIGINT) AS n_errors, CAST(sum(len(warnings)) AS BIGINT) AS n_warnings FROM s GROUP BY status")
def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.report(_judged(spark, sf_dir))


@query("SELECT doc_id, array_to_string(list_slice(string_split(text, chr(10)), 2, 4), chr(10)) AS excerpt FROM documents")
def excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.excerpt(F.col("text"), 2, 3).alias("excerpt"))


@query("SELECT page_id, regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1)[1] AS heading, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS n_links FROM pages")
def html_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit("(?s)<h1>(.*?)</h1>"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.get(found, F.lit(0)).alias("heading"), F.size(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).cast("long").alias("n_links"))


_HEADING = r"^(?:\$\\(?:star|bigstar|ast)\$\s*|\$?\\pm\s*|\\[*]\s*|[*±•-]\s*|\*\*\s*)?(?:Quest[aã]o\s+)?(\d{1,3})(?:\.(\d{1,2}))?(?:\s*\.\s*(?:\*\*)?\s*\$?\s+|\s*\.\*\*\s+|[A-ZÁÉÍÓÚÀÂÃÇ])"


@query(rf"""
    WITH t AS (SELECT doc_id, string_split(regexp_replace(text, '\. ([A-Z])', '.' || chr(10) || '1. \1', 'g'), chr(10)) AS ls FROM documents WHERE trim(text) <> ''),
        l AS (SELECT doc_id, unnest(ls) AS body, unnest(range(1, len(ls) + 1)) AS line FROM t),
        h AS (SELECT *, TRY_CAST(regexp_extract(body || chr(10), '{_HEADING}', 1) AS INT) AS raw, TRY_CAST(regexp_extract(body || chr(10), '{_HEADING}', 2) AS INT) AS sub FROM l),
        n AS (SELECT *, count(raw) OVER w AS k, count(*) FILTER (raw IS NOT NULL AND sub IS NULL) OVER w AS place FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
        m AS (SELECT *, place + max(raw - place) OVER (PARTITION BY doc_id ORDER BY line) AS main FROM n),
        b AS (
            SELECT doc_id, k, max(raw) AS raw, max(sub) AS sub, max(main) AS main, min(line) AS line, string_agg(body, chr(10) ORDER BY line) AS md FROM m WHERE k > 0 GROUP BY doc_id, k
            UNION ALL SELECT doc_id, 1, 1, NULL, 1, min(line), string_agg(body, chr(10) ORDER BY line) FROM m GROUP BY doc_id HAVING max(k) = 0),
        c AS (SELECT *, regexp_replace(md, '^\s+|\s+$', '', 'g') AS t, lag(main) OVER (PARTITION BY doc_id ORDER BY k) AS before, count(sub) OVER (PARTITION BY doc_id, main) AS subs FROM b),
        p AS (SELECT *, line + length(regexp_extract(md, '^\s*', 0)) - length(replace(regexp_extract(md, '^\s*', 0), chr(10), '')) AS first FROM c WHERE t <> '')
    SELECT doc_id, CAST(k AS INT) AS ordem, concat_ws('.', main, sub) AS item_id, CAST(first AS INT) AS line_start, CAST(first + length(t) - length(replace(t, chr(10), '')) AS INT) AS line_end,
        coalesce(CASE WHEN sub IS NULL THEN raw <= before ELSE raw <> main END, false) AS suspected_reset,
        CASE WHEN sub IS NULL AND subs > 0 THEN 'context_stem' WHEN len(regexp_extract_all(t, '\([A-D]\)')) = 4 THEN 'multiple_choice' ELSE 'open_response' END AS tipo
    FROM p""")
def split_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sentences are items of one number each, segmented and renumbered."""
    docs = _docs(spark, sf_dir).select("doc_id", F.regexp_replace("text", r"\. ([A-Z])", ".\n1. $1").alias("text"))
    return segments(docs).select("doc_id", "ordem", "item_id", "line_start", "line_end", "suspected_reset", "tipo")


_TOKENS = f"list_filter(string_split_regex({_FOLD.format('text')}, '[^a-z0-9]+'), lambda t: t <> '')"


@query(f"""
    WITH x AS (SELECT doc_id, {_TOKENS} AS toks FROM documents)
    SELECT doc_id, len(list_filter(toks, lambda t: t = 'de' OR t = 'que')) AS tf, len(toks) AS n_tokens FROM x WHERE list_contains(toks, 'de') AND list_contains(toks, 'que')""")
def fts_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold all terms of a query, with the terms' frequency. Terms without any letter in common with a text are dropped before it is split."""
    wanted = ("de", "que")
    docs = _docs(spark, sf_dir).select("doc_id", T.unaccent(F.lower("text")).alias("folded")).filter(F.contains("folded", F.lit("de")) & F.contains("folded", F.lit("que")))
    found = docs.select("doc_id", F.filter(F.split("folded", "[^a-z0-9]+"), lambda t: t != "").alias("toks"))
    tf = F.size(F.filter("toks", lambda t: t.isin(*wanted))).cast("long")
    return found.filter(F.size(F.array_except(F.array(*map(F.lit, wanted)), "toks")) == 0).select("doc_id", tf.alias("tf"), F.size("toks").cast("long").alias("n_tokens"))


@query("""
    SELECT vec_id, round(list_cosine_distance(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS distance FROM embeddings
    ORDER BY distance, vec_id LIMIT 20""")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty vectors nearest to one."""
    vectors = table(spark, sf_dir, "embeddings")
    asked = F.broadcast(vectors.filter("vec_id = 0").select(F.col("embedding").alias("q")).limit(1))  # one row is broadcast
    return vectors.join(asked).select("vec_id", F.round(T.cosine_distance(F.col("embedding"), F.col("q")), 6).alias("distance")).orderBy("distance", "vec_id").limit(20)


@query("""
    WITH q AS (SELECT vec_id AS asked, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 100 = 0), d AS (SELECT asked, v.vec_id, round(list_cosine_distance(CAST(v.embedding AS DOUBLE[]), e), 6) AS distance FROM q, embeddings v)
    SELECT asked, vec_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY distance, vec_id) AS rn FROM d) WHERE rn <= 20""")
def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty vectors nearest to each vector whose id is divisible by 100, exact, by products of blocks."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return V.nearest(vectors, vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("asked"), F.col("embedding").alias("q")), 20)
