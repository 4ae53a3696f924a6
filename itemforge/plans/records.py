"""Review and meta halves, synthesized rows, traces, exam codes, ranked search and frames, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itemforge.functions import text as T
from itemforge.operators import joins as J
from itemforge.plans.registry import query, table

#: Fields of an item that reviewers edit, its key among them.
REVIEW = (
    "id_item tipo_item enunciado alternativas resposta_correta respostas_corretas tema subtema descricao_breve tags observacoes reviewed imagens enunciado_contexto_pai id_contexto_pai ids_contexto_pai grupo parte solucao "
    "pool_opcional palavras_min palavras_max linhas_referenciadas parametros_classificacao tem_numeracao_linhas linhas_verificadas"
).split()
#: Heavy fields of a criterion that a compact view leaves out.
HEAVY = ("texto_original", "imagens", "fonte")


def halves(items: DataFrame, key: str = "id_item") -> tuple[DataFrame, DataFrame]:
    """The columns that reviewers edit, and the others with the key."""
    return items.select(*(c for c in items.columns if c in REVIEW)), items.select(key, *(c for c in items.columns if c not in REVIEW))


def rejoined(review: DataFrame, meta: DataFrame, key: str = "id_item") -> DataFrame:
    """Both halves as one row; a column that both have is the review's, null or not, where the review has the row."""
    shared = [c for c in review.columns if c in meta.columns and c != key]
    joined = meta.join(review.select(key, F.lit(True).alias("_reviewed"), *(F.col(c).alias(f"_new_{c}" if c in shared else c) for c in review.columns if c != key)), key, "left")
    for c in shared:
        joined = joined.withColumn(c, F.when(F.col("_reviewed"), F.col(f"_new_{c}")).otherwise(F.col(c))).drop(f"_new_{c}")
    return joined.drop("_reviewed")


@query("SELECT p_partkey, p_name AS enunciado, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS tema, p_size, p_type FROM part")
def review_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items split for review, edited, and put together again; an edit to null counts."""
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id_item"), F.col("p_name").alias("enunciado"), F.col("p_brand").alias("tema"), "p_size", "p_type")
    review, meta = halves(items)
    edited = review.withColumn("tema", F.when(F.col("id_item") % 3 > 0, F.col("tema")))
    return rejoined(edited, meta.withColumn("tema", F.lit("old"))).select(F.col("id_item").alias("p_partkey"), "enunciado", "tema", "p_size", "p_type")


@query("""
    WITH m AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ordem FROM orders WHERE o_orderkey % 3 > 0),
        t AS (SELECT o_custkey, max(ordem) AS top FROM m GROUP BY o_custkey),
        s AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_orderkey % 3 = 0)
    SELECT o_custkey, o_orderkey, ordem, false AS synthesized FROM m UNION ALL SELECT s.o_custkey, o_orderkey, coalesce(top, 0) + k, true FROM s LEFT JOIN t ON t.o_custkey = s.o_custkey""")
def synthesized_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed rows without their other half come after the last known order of their document, numbered on."""
    by = Window.partitionBy("o_custkey")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 3 == 0).alias("synthesized"))
    own = F.row_number().over(Window.partitionBy("o_custkey", "synthesized").orderBy("o_orderkey")).cast("long")
    known = F.count_if(~F.col("synthesized")).over(by)
    return rows.withColumn("n", own).select("o_custkey", "o_orderkey", F.when(F.col("synthesized"), known + F.col("n")).otherwise(F.col("n")).alias("ordem"), "synthesized")


@query("""
    WITH t AS (SELECT l_orderkey, l_linenumber, max(struct_pack(p := l_partkey, s := l_suppkey, q := l_quantity)) AS r FROM lineitem WHERE l_partkey % 4 > 0 AND l_linenumber > 1 GROUP BY ALL)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, r.s AS trace FROM lineitem l LEFT JOIN t ON t.l_orderkey = l.l_orderkey AND t.l_linenumber = l.l_linenumber""")
def trace_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the last good trace of their document and order."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    good = rows.filter("l_partkey % 4 > 0 AND l_linenumber > 1")
    last = good.groupBy("l_orderkey", "l_linenumber").agg(F.max(F.struct("l_partkey", "l_suppkey", "l_quantity")).alias("r"))
    return rows.join(last, ["l_orderkey", "l_linenumber"], "left").select("l_orderkey", "l_linenumber", "l_partkey", F.col("r.l_suppkey").alias("trace"))


@query("""
    SELECT r.s_suppkey, r.s_name || '!' AS solucao, CASE WHEN r.s_suppkey % 2 = 0 THEN s.s_acctbal END AS texto_original, n.n_name AS pais FROM supplier r LEFT JOIN supplier s ON s.s_suppkey = r.s_suppkey AND s.s_suppkey % 2 = 0 JOIN nation n ON n.n_nationkey = r.s_nationkey""")
def criteria_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed criteria with the heavy columns of their raw halves."""
    raw = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select("s_suppkey", F.col("s_acctbal").alias("texto_original"))
    review = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", F.lit("!")).alias("solucao"), "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("pais"))
    return review.join(raw, "s_suppkey", "left").join(nation, "s_nationkey").select("s_suppkey", "solucao", "texto_original", "pais")


@query("SELECT p_type = 'PROMO' AS stem, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY ALL")
def stems_and_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems and items, which go to tables of their own; heavy columns stay behind."""
    rows = table(spark, sf_dir, "part").drop("p_name", "p_retailprice")
    split = [rows.filter(F.col("p_type") == "PROMO"), rows.filter(F.col("p_type") != "PROMO")]
    told = [part.agg(F.count("*").alias("n"), F.min("p_partkey").alias("first")).withColumn("stem", F.lit(k == 0)).filter("n > 0") for k, part in enumerate(split)]
    return told[0].unionByName(told[1]).select("stem", "n", "first")


_PATHS = "CASE p_partkey % 6 WHEN 0 THEN '/ws/EX-MatA635-F1-' || (2000 + p_size) || '_net/prova.md' WHEN 1 THEN '/ws/x/EX-Port639-EE-' || (2000 + p_size) || '.pdf' WHEN 2 THEN '/ws/EX-Xyz1-F2-' || (2000 + p_size) || '/EX-Bio702-FR-2011/prova.md' WHEN 3 THEN 'ex-MatA635-f9-2020.md' WHEN 4 THEN '/ws/' || p_brand || '/prova.md' ELSE '' END"


@query(f"""
    WITH x AS (SELECT p_partkey, {_PATHS} AS path, p_size FROM part)
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Exame Nacional, Matemática A, 1.ª Fase, ' || (2000 + p_size) WHEN 1 THEN 'Exame Nacional, Português, Época Especial, ' || (2000 + p_size) WHEN 2 THEN 'Exame Nacional, Biologia e Geologia, Recurso, 2011' WHEN 3 THEN 'Exame Nacional, Matemática A, F9, 2020' ELSE '' END AS label FROM x""")
def exam_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources told by the codes in a file's name, else in its folders from the nearest up."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_PATHS} AS path").select("p_partkey", T.exam_label(F.col("path")).alias("label"))


@query("""
    WITH x AS (SELECT doc_id, list_filter(string_split_regex(translate(lower(text), 'ãâàáäêéèëîíïôóõöúûüçñ', 'aaaaaeeeeiiioooouuucn'), '[^a-z0-9]+'), lambda t: t <> '' AND NOT list_contains(['de', 'que', 'a', 'o', 'e', 'the', 'of'], t)) AS toks FROM documents WHERE text IS NOT NULL),
        f AS (SELECT doc_id, len(toks) AS n, len(list_filter(toks, lambda t: t = 'and')) AS a, len(list_filter(toks, lambda t: t = 'in')) AS b FROM x)
    SELECT doc_id, CAST(floor(1000000 * (a + b) / (n + 100)) AS BIGINT) AS rank FROM f WHERE a > 0 AND b > 0 ORDER BY rank DESC, doc_id LIMIT 50""")
def fts_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for a query of several words; stop words count on neither side, frequencies are measured against length."""
    wanted = T.fts_terms("the and of in")
    folded = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", T.unaccent(F.lower("text")).alias("folded"))
    for word in wanted:  # what doesn't hold a word anywhere has no such token, and needn't be split
        folded = folded.filter(F.contains("folded", F.lit(word)))
    # A generator stands between, so a text is split once, not for each count.
    docs = folded.select("doc_id", F.explode(F.array(T.fts_tokens(F.col("folded")))).alias("toks"))
    count = lambda w: F.size(F.filter("toks", lambda t: t == w))
    found = docs.select("doc_id", F.size("toks").alias("n"), F.array(*map(count, wanted)).alias("tf")).filter(F.forall("tf", lambda x: x > 0))
    rank = F.floor(1000000 * F.aggregate("tf", F.lit(0), lambda a, x: a + x) / (F.col("n") + 100))
    return found.select("doc_id", rank.alias("rank")).orderBy(F.desc("rank"), "doc_id").limit(50)


@query(r"""
    SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '"([^"\n]*)"', '«\1»', 'g'), '([a-záàâãéêíóôõúç])-\n([a-záàâãéêíóôõúç])', '\1\2', 'g')) AS digest,
        length(replace(t, '«', '')) <> length(replace(t, '»', '')) AS unbalanced FROM (SELECT doc_id, text, regexp_replace(text, '"([^"\n]*)"', '«\1»', 'g') AS t FROM documents)""")
def typography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotation marks and broken words, and whether the marks are unbalanced."""
    rules = (("quotes", r'"([^"\n]*)"', "«$1»"), ("hyphen", r"([a-záàâãéêíóôõúç])-\n([a-záàâãéêíóôõúç])", "$1$2"))
    done = T.fixed(table(spark, sf_dir, "documents"), ["doc_id"], F.col("text"), rules)
    return done.select("doc_id", F.sha2("fixed", 256).alias("digest"), (F.length(F.replace("fixed", F.lit("«"), F.lit(""))) != F.length(F.replace("fixed", F.lit("»"), F.lit("")))).alias("unbalanced"))


@query("""
    SELECT a.event_id, string_agg(DISTINCT b.event_type, ',' ORDER BY b.event_type) AS near FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_id BETWEEN a.event_id - 400 AND a.event_id + 400 AND b.event_type <> 'view' GROUP BY a.event_id
    UNION ALL SELECT event_id, '' FROM events a WHERE NOT EXISTS (SELECT 1 FROM events b WHERE a.user_id = b.user_id AND b.event_id BETWEEN a.event_id - 400 AND a.event_id + 400 AND b.event_type <> 'view')""")
def nearby_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands within 400 places before or after, each once: a frame over offsets, no pairs."""
    frame = Window.partitionBy("user_id").orderBy("event_id").rangeBetween(-400, 400)
    found = F.collect_set(F.when(F.col("event_type") != "view", F.col("event_type"))).over(frame)
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").select("event_id", F.array_join(F.array_sort(found), ",").alias("near"))


@query("""
    WITH s AS (SELECT event_id, user_id, ts, event_type, CAST(value * 100 AS BIGINT) % 7 AS score FROM events)
    SELECT event_id, CASE WHEN n % 3 = 0 THEN 'three' WHEN n % 3 = 1 THEN 'one' ELSE 'two' END AS place, CAST(least(greatest(floor((n - 1) * 12 / total) + 1, 1), 12) AS BIGINT) AS page
    FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id) AS total FROM s)""")
def page_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page on which a line stands, in proportion to the lines of its document."""
    by = Window.partitionBy("user_id")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id").withColumns({"n": F.row_number().over(by.orderBy("event_id")), "total": F.count("*").over(by)})
    page = F.least(F.greatest(F.floor((F.col("n") - 1) * 12 / F.col("total")) + 1, F.lit(1)), F.lit(12))
    return rows.select("event_id", F.when(F.col("n") % 3 == 0, "three").when(F.col("n") % 3 == 1, "one").otherwise("two").alias("place"), page.cast("long").alias("page"))


@query("""
    WITH o AS (SELECT o_custkey AS ws, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS pending, count(*) AS n, max(o_orderdate) AS edited FROM orders GROUP BY o_custkey),
        l AS (SELECT o_custkey AS ws, max(l_shipdate) AS built FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
    SELECT o.ws, concat_ws(',', CASE WHEN pending > 0 THEN 'not_reviewed' END, CASE WHEN built IS NULL OR built < edited THEN 'stale' END, CASE WHEN done < n - pending THEN 'silent_drop' END) AS gates FROM o LEFT JOIN l ON l.ws = o.ws""")
def stage_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds a document back from its next stage: rows not reviewed, a result older than its source, rows that were dropped."""
    from itemforge.sources.files import stale

    status = F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders")
    own = orders.groupBy(F.col("o_custkey").alias("ws")).agg(F.count_if(status == "F").alias("done"), F.count_if(status == "P").alias("pending"), F.count("*").alias("n"), F.max("o_orderdate").alias("edited"))
    built = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("at")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("ws")).agg(F.max("at").alias("built"))
    both = own.join(built, "ws", "left")
    gates = F.array_compact(F.array(F.when(F.col("pending") > 0, F.lit("not_reviewed")), F.when(stale(both, "edited", "built"), F.lit("stale")), F.when(F.col("done") < F.col("n") - F.col("pending"), F.lit("silent_drop"))))
    return both.select("ws", F.array_join(gates, ",").alias("gates"))


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'fallback' WHEN c_custkey % 3 = 1 THEN coalesce(n_name, 'none') ELSE 'kept' END AS tipo FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0""")
def composed_key_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item's type under its composed key, else under its plain one."""
    k = F.col("c_custkey")
    known = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.concat(F.lit("I-"), "n_nationkey").alias("key"), F.col("n_name").alias("tipo"))
    plain = spark.createDataFrame([("plain", "fallback"), ("other", "kept")], "key string, tipo string")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    first = F.when(k % 3 == 1, F.concat(F.lit("I-"), "c_nationkey")).otherwise("I-none")
    second = F.when(k % 3 == 0, "plain").when(k % 3 == 2, "other").otherwise("missing")
    found = J.fallback_join(rows, known.unionByName(plain), [first, second], "key", ["tipo"])
    return found.select("c_custkey", F.coalesce("tipo", F.lit("none")).alias("tipo"))
