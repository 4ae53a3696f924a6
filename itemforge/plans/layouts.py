"""Pages, blocks and excerpts, bound to conversations and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators import layout as L
from itemforge.plans.registry import query, table

# A conversation is a file, its turns are pages; markers stand on some, others are cut short. Both dialects read it.
_PAGE = """CASE WHEN turn % 3 = 2 THEN substr(text, 1, 90) ELSE text END || CASE WHEN (conv_id + turn) % 7 = 3 THEN ' Grupo i' WHEN (conv_id + turn) % 7 = 1 THEN ' Critérios   Específicos de CLASSIFICAÇÃO, cenários ' || role || ' GRUPO  I'
    WHEN (conv_id + turn) % 7 = 5 THEN ' FACTORES DE DESVALORIZAÇÃO' ELSE '' END"""
_NAME = "CASE conv_id % 5 WHEN 0 THEN 'EX-MatA635-F1-2024-CC-VD.pdf' WHEN 1 THEN 'portuguesB639_ccf1_07.pdf' WHEN 2 THEN 'EX-Port639-EE-2023.pdf' WHEN 3 THEN 'Portugues639_criterios_' || conv_id || '.pdf' ELSE 'accc' || conv_id || '.pdf' END"
_PAGES_SQL = rf"""
    p AS (SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS n, {_PAGE} AS text, {_NAME} AS name FROM conversations),
    k AS (SELECT *, CASE WHEN regexp_matches(upper(name), '(?:^|[-_])CC(?:[-_]|\.|$)|(?:^|[-_])CC[FP]\d|CRITERIOS?|CC[-_]?VD') THEN 'cc' ELSE 'prova' END AS kind FROM p),
    m AS (SELECT conv_id, min(n) FILTER (CASE WHEN kind = 'cc' THEN regexp_matches(text, '(?i)crit[eé]rios?\s+espec[ií]ficos\s+de\s+classifica[cç][aã]o[\s\S]{{0,300}}?GRUPO\s+I') ELSE contains(lower(text), 'grupo i') END) AS s,
        max(n) FILTER (contains(lower(text), 'factores de desvalorização')) AS g, max(n) FILTER (length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 100) AS e, max(n) AS total FROM k GROUP BY conv_id),
    r AS (SELECT k.conv_id, k.kind, n, s, g, CASE WHEN kind = 'cc' AND s IS NULL AND g IS NULL THEN NULL WHEN n > coalesce(e, total) THEN 'blank' WHEN n < s THEN CASE WHEN kind = 'cc' THEN 'general' ELSE 'instructions' END
        WHEN s IS NULL AND kind = 'cc' AND n <= g THEN CASE WHEN n = 1 THEN 'cover' ELSE 'general' END END AS dropped FROM k JOIN m ON m.conv_id = k.conv_id)"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    named = spark.sql(f"SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, {_PAGE} AS text, {_NAME} AS name FROM {{rows}}", rows=rows)
    return named.select("conv_id", F.col("n").cast("long").alias("n"), "text", L.file_kind(F.col("name")).alias("kind"))


@query(f"WITH {_PAGES_SQL} SELECT conv_id, n, kind, dropped FROM r")
def page_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages of a file are read on, and why others aren't."""
    return L.page_roles(_pages(spark, sf_dir), "conv_id").select("conv_id", "n", "kind", "dropped")


@query(f"""
    WITH {_PAGES_SQL}, t AS (SELECT conv_id, kind, count(*) AS total, count(*) FILTER (dropped IS NULL) AS kept, count(dropped) AS dropped, bool_or(kind = 'cc' AND s IS NULL AND g IS NULL) AS whole, bool_or(kind = 'cc' AND s IS NULL) AS marks FROM r GROUP BY ALL)
    SELECT conv_id, kind, total, kept, dropped, CASE WHEN whole OR kept < 2 THEN 'low' WHEN marks OR (kind = 'cc' AND dropped < 2) THEN 'medium' ELSE 'high' END AS confidence FROM t""")
def file_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages of each file stay, and how sure that is."""
    return L.triage(L.page_roles(_pages(spark, sf_dir), "conv_id"), "conv_id").drop("needs_review")


_BLOCK = """conv_id, turn, CASE turn % 6 WHEN 0 THEN 'title' WHEN 1 THEN 'equation' WHEN 2 THEN 'image' WHEN 5 THEN 'footer' ELSE 'text' END AS kind, CASE WHEN conv_id % 4 = 0 THEN '  ' || role || ' ' WHEN turn % 5 = 4 THEN '# ' || role ELSE substr(text, 1, 25) END AS text,
    CASE WHEN turn % 2 = 0 THEN CAST(conv_id % 7 AS INT) END AS level, CASE WHEN conv_id % 3 > 0 THEN 'out/' || conv_id || '.png' END AS img, CASE WHEN conv_id % 5 = 1 THEN upper(role) WHEN conv_id % 5 = 2 THEN ' ' END AS matched"""


@query(rf"""
    WITH b AS (SELECT {_BLOCK} FROM conversations), s AS (SELECT *, regexp_replace(coalesce(matched, text), '^\s+|\s+$', '', 'g') AS said, regexp_replace(text, '^\s+|\s+$', '', 'g') AS own, CASE WHEN img IS NULL THEN '' ELSE '![](imagens_extraidas/' || conv_id || '.png)' END AS shown FROM b),
        x AS (SELECT conv_id, turn, CASE WHEN kind IN ('text', 'title') THEN CASE WHEN said <> '' AND level > 0 AND NOT starts_with(said, '#') THEN repeat('#', least(level, 4)) || ' ' || said ELSE said END
            WHEN kind = 'equation' THEN CASE WHEN trim(coalesce(matched, '')) <> '' THEN trim(matched) WHEN own <> '' THEN own ELSE shown END WHEN kind = 'image' THEN shown ELSE '' END AS block FROM s),
        l AS (SELECT *, lag(block) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM x WHERE block <> '')
    SELECT conv_id, string_agg(block, chr(10) || chr(10) ORDER BY turn) AS markdown FROM l WHERE before IS DISTINCT FROM block GROUP BY conv_id""")
def layout_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts as Markdown, with better readings of the same places where there are some."""
    rows = spark.sql(f"SELECT {_BLOCK} FROM {{rows}}", rows=table(spark, sf_dir, "conversations"))
    shown = L.block(F.col("kind"), F.col("text"), F.col("level"), F.col("img"), F.col("matched"), F.lit(None).cast("int"))
    return L.markdown(rows.select("conv_id", "turn", shown.alias("block")), "conv_id", "turn")


@query(r"""
    WITH d AS (SELECT doc_id, string_split_regex(coalesce(text, ''), '\r\n|\n|\r') AS c FROM documents), l AS (SELECT doc_id, CASE WHEN c[-1] = '' THEN c[:-2] ELSE c END AS c FROM d),
        s AS (SELECT doc_id, c, k, (doc_id * 7 + k * 5) % 30 + 1 AS a, CASE WHEN k < 3 THEN (doc_id * 7 + k * 5) % 30 + 1 + k ELSE 1 END AS b FROM l, (VALUES (1), (2), (3)) AS t(k)),
        f AS (SELECT doc_id, c, k, greatest(0, a - 4) AS first, least(len(c), b + 3) AS last FROM s)
    SELECT doc_id, '' || k AS id_item, first + 1 AS first, last, coalesce((SELECT string_agg(format('{:4d} | {}', i, c[i]), chr(10) ORDER BY i) FROM (SELECT unnest(range(first + 1, last + 1)) AS i)), '') AS excerpt FROM f""")
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spans of each document with their lines numbered."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ws"), "text")
    each = docs.select("ws", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("k")).withColumn("line_start", ((F.col("ws") * 7 + F.col("k") * 5) % 30 + 1).cast("long"))
    spans = each.select("ws", F.col("k").cast("string").alias("id_item"), "line_start", F.when(F.col("k") < 3, F.col("line_start") + F.col("k")).alias("line_end"))
    found = L.excerpts(docs, spans)
    return found.select(F.col("ws").alias("doc_id"), "id_item", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "excerpt")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(1, (l_partkey % 200) * (l_suppkey % 15 + 1) // 200) AS first, least(l_suppkey % 15 + 1, (l_partkey % 200 + 1 + l_linenumber) * (l_suppkey % 15 + 1) // 200 + 2) AS last FROM lineitem""")
def likely_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On which pages lines may stand."""
    a, pages = F.col("l_partkey") % 200 + 1, F.col("l_suppkey") % 15 + 1
    found = L.likely_pages(a, a + F.col("l_linenumber"), F.lit(200), pages)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", found["first"].alias("first"), found["last"].alias("last"))
