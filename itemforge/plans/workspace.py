"""Halves, parents, corrections, gates and reports of workspaces, bound to orders, events and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators import workspace as S
from itemforge.plans.registry import query, table

#: Ids of four forms, some of them twice in a workspace; both dialects read it.
_ID = "CASE o_orderkey % 4 WHEN 0 THEN 'II-' || (o_orderkey % 90) WHEN 1 THEN (o_orderkey % 9) || '.' || (o_orderkey % 7) WHEN 2 THEN 'I-A-' || (o_orderkey % 9) ELSE '' || (o_orderkey % 9) END"
_ORDERS = f"o_custkey AS ws, o_orderkey AS pos, {_ID} AS id_item"


def _picked(rows: DataFrame, columns: str) -> DataFrame:
    """rows with these columns, a list as it stands in SQL."""
    return rows.sparkSession.sql(f"SELECT {columns} FROM {{rows}}", rows=rows)


def _orders(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return _picked(table(spark, sf_dir, "orders"), ", ".join((_ORDERS, *more)))


@query(rf"""
    WITH o AS (SELECT {_ORDERS}, o_orderpriority AS enunciado, nullif(o_orderstatus, 'P') AS tema, CASE WHEN o_orderkey % 8 > 0 THEN o_orderstatus ELSE '' END AS materia, o_orderkey % 7 AS ordem FROM orders),
        m AS (SELECT * FROM o WHERE pos % 3 > 0), r AS (SELECT * FROM o WHERE pos % 5 > 0),
        l AS (SELECT ws, id_item, max(pos) AS pos FROM m GROUP BY ALL), k AS (SELECT m.* FROM m JOIN l ON l.ws = m.ws AND l.id_item = m.id_item AND l.pos = m.pos),
        t AS (SELECT ws, max(ordem) AS top, arg_min(materia, pos) AS materia FROM m GROUP BY ws),
        x AS (SELECT r.ws, r.pos, r.id_item, r.enunciado, r.tema, k.pos IS NULL AS synthesized, k.ordem, k.materia AS own, t.top, t.materia AS first, regexp_extract(r.id_item, '^(?:[IVX]+-)?(\d{{1,3}})(?:\.(\d{{1,2}}))?$', 1) AS n, regexp_extract(r.id_item, '^(?:[IVX]+-)?(\d{{1,3}})(?:\.(\d{{1,2}}))?$', 2) AS s
            FROM r LEFT JOIN k ON k.ws = r.ws AND k.id_item = r.id_item LEFT JOIN t ON t.ws = r.ws)
    SELECT ws, pos, id_item, enunciado, tema, synthesized, CASE WHEN synthesized THEN coalesce(top, 0) + row_number() OVER (PARTITION BY ws, synthesized ORDER BY pos) ELSE ordem END AS ordem_item,
        CASE WHEN synthesized THEN coalesce(nullif(first, ''), 'Português') ELSE own END AS materia, CASE WHEN synthesized THEN coalesce(TRY_CAST(n AS BIGINT), 0) ELSE 77 END AS numero_questao, CASE WHEN synthesized THEN nullif(s, '') ELSE 'm' END AS subitem,
        CASE WHEN synthesized THEN 'draft' END AS status FROM x""")
def reviewed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed items over their other halves; those that have none are made up, in places after the known ones."""
    rows = _orders(spark, sf_dir, "o_orderpriority AS enunciado", "nullif(o_orderstatus, 'P') AS tema", "CASE WHEN o_orderkey % 8 > 0 THEN o_orderstatus ELSE '' END AS materia", "o_orderkey % 7 AS ordem_item")
    meta = rows.filter("pos % 3 > 0").select("ws", "pos", "id_item", "ordem_item", "materia", F.lit("old").alias("tema"), F.lit(77).cast("long").alias("numero_questao"), F.lit("m").alias("subitem"), F.lit(None).cast("string").alias("status"))
    return S.reviewed_items(rows.filter("pos % 5 > 0").select("ws", "pos", "id_item", "enunciado", "tema"), meta, "pos")


@query(f"""
    WITH o AS (SELECT {_ORDERS} FROM orders WHERE o_custkey % 4 > 0), r AS (SELECT DISTINCT ws, id_item FROM o WHERE pos % 5 > 0 OR ws % 4 = 1), m AS (SELECT DISTINCT ws, id_item FROM o WHERE pos % 3 > 0 OR ws % 4 = 2),
        n AS (SELECT * FROM r EXCEPT SELECT * FROM m), g AS (SELECT * FROM m EXCEPT SELECT * FROM r)
    SELECT ws, id_item AS id, 'new' AS side FROM n WHERE ws IN (SELECT ws FROM g) UNION ALL SELECT ws, id_item, 'orphan' FROM g WHERE ws IN (SELECT ws FROM n)""")
def divergent_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of workspaces that were renumbered: each half has some that the other lacks."""
    rows = _orders(spark, sf_dir).filter("ws % 4 > 0")
    return S.divergent_ids(rows.filter("pos % 5 > 0 OR ws % 4 = 1"), rows.filter("pos % 3 > 0 OR ws % 4 = 2"))


@query(f"""
    WITH o AS (SELECT {_ORDERS}, o_orderpriority AS texto_original, o_orderstatus AS fonte FROM orders), m AS (SELECT * FROM o WHERE pos % 3 > 0), l AS (SELECT ws, id_item, max(pos) AS pos FROM m GROUP BY ALL)
    SELECT r.ws, r.pos, r.id_item, 'nova ' || r.fonte AS fonte, coalesce(m.texto_original, '') AS texto_original FROM o r LEFT JOIN l ON l.ws = r.ws AND l.id_item = r.id_item LEFT JOIN m ON m.ws = l.ws AND m.pos = l.pos""")
def reviewed_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed criteria with the heavy fields of their raw halves that they haven't themselves."""
    rows = _orders(spark, sf_dir, "o_orderpriority AS texto_original", "o_orderstatus AS fonte")
    return S.reviewed_criteria(S.compact(rows.withColumn("nova", F.concat(F.lit("nova "), "fonte"))).withColumnRenamed("nova", "fonte"), rows.filter("pos % 3 > 0"), "pos")


# Items of a user: every fifth is a stem, some have no order; groups and parts by number.
_EVENTS = """user_id AS ws, event_id AS pos, CASE WHEN event_id % 3 = 0 THEN 'I' WHEN event_id % 3 = 1 THEN 'II' ELSE '' END AS grupo, CASE WHEN event_id % 4 = 1 THEN 'A' WHEN event_id % 4 = 2 THEN 'B' ELSE '' END AS parte,
    CASE WHEN event_id % 5 = 0 THEN 'context_stem' WHEN event_id % 7 > 0 THEN event_type END AS tipo_item, CASE WHEN event_id % 11 > 0 THEN CAST(event_id * 37 % 1009 AS BIGINT) END AS ordem_item"""
_ITEM = "grupo || '-' || parte || CASE WHEN parte = '' THEN '' ELSE '-' END || pos AS id_item"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _picked(table(spark, sf_dir, "events"), _EVENTS).selectExpr("*", _ITEM)


@query(f"""
    WITH e AS (SELECT {_EVENTS} FROM events), i AS (SELECT *, {_ITEM} FROM e)
    SELECT ws, id_item, CASE WHEN tipo_item = 'context_stem' THEN '' ELSE coalesce(last_value(CASE WHEN tipo_item = 'context_stem' THEN id_item END IGNORE NULLS) OVER (PARTITION BY ws, grupo ORDER BY coalesce(ordem_item, 99999), id_item ROWS UNBOUNDED PRECEDING), '') END AS pai FROM i""")
def stems_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item's last stem before it in its group."""
    return S.with_stems(_items(spark, sf_dir)).select("ws", "id_item", "pai")


@query(f"""
    WITH e AS (SELECT {_EVENTS} FROM events), i AS (SELECT *, {_ITEM} FROM e), c AS (SELECT ws, grupo, parte, min('c' || pos) AS ctx FROM e WHERE pos % 13 = 0 GROUP BY ALL)
    SELECT i.ws, id_item, CASE WHEN tipo_item = 'context_stem' THEN '' ELSE coalesce(p.ctx, g.ctx, '') END AS pai FROM i
        LEFT JOIN c p ON p.ws = i.ws AND p.grupo = i.grupo AND p.parte = i.parte LEFT JOIN c g ON g.ws = i.ws AND g.grupo = i.grupo AND g.parte = ''""")
def stems_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item's stem by its group and the part in its id, else by its group."""
    items = _items(spark, sf_dir)
    contexts = items.filter("pos % 13 = 0").select("ws", "grupo", "parte", F.concat(F.lit("c"), "pos").alias("ctx_id"))
    return S.with_stems(items, contexts).select("ws", "id_item", "pai")


@query(f"""
    WITH e AS (SELECT {_EVENTS} FROM events), b AS (SELECT ws, pos % 10 AS n, arg_max(CASE WHEN pos % 3 > 0 THEN 'b' || pos ELSE '' END, pos) AS t FROM e WHERE pos % 17 = 0 GROUP BY ALL),
        c AS (SELECT ws, grupo, parte, min('c' || pos) FILTER (pos % 2 > 0) AS t FROM e WHERE pos % 13 = 0 GROUP BY ALL)
    SELECT e.ws, e.pos, coalesce(nullif(b.t, ''), p.t, g.t, '') AS contexto FROM e LEFT JOIN b ON b.ws = e.ws AND b.n = e.pos % 10
        LEFT JOIN c p ON p.ws = e.ws AND p.grupo = e.grupo AND p.parte = e.parte LEFT JOIN c g ON g.ws = e.ws AND g.grupo = e.grupo AND g.parte = ''""")
def parent_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each item's parent block, else of its part's context, else of its group's."""
    items = _items(spark, sf_dir).withColumn("numero_principal", F.col("pos") % 10)
    blocks = items.filter("pos % 17 = 0").select("ws", "numero_principal", F.col("pos").alias("line"), F.when(F.col("pos") % 3 > 0, F.concat(F.lit("b"), "pos")).otherwise("").alias("text"))
    contexts = items.filter("pos % 13 = 0").select("ws", "grupo", "parte", F.when(F.col("pos") % 2 > 0, F.concat(F.lit("c"), "pos")).otherwise("").alias("text"))
    return S.with_parent_texts(items, blocks, contexts).select("ws", "pos", "contexto")


@query("""
    WITH e AS (SELECT user_id AS ws, event_id AS pos, event_id % 4 AS principal, event_id % 3 AS numero, event_id % 23 AS sub FROM events),
        i AS (SELECT ws, pos, coalesce(nullif(principal, 0), numero) AS main, CASE WHEN pos % 6 = 0 THEN 'I-' || sub WHEN sub % 5 = 0 THEN '' || principal ELSE principal || '.' || sub END AS id_item,
            CASE WHEN pos % 6 = 0 THEN 0 ELSE principal END AS a, CASE WHEN pos % 6 = 0 OR sub % 5 = 0 THEN -1 ELSE sub END AS b FROM e),
        g AS (SELECT ws, main, string_agg(id_item, ',' ORDER BY a, b, pos) AS ids FROM i GROUP BY ALL)
    SELECT i.ws, pos, id_item, ids FROM i JOIN g ON g.ws = i.ws AND g.main = i.main""")
def member_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With each item the ids under its main number, sorted by their numbers."""
    k, sub = F.col("event_id"), F.col("event_id") % 23
    principal = (k % 4).cast("string")
    name = F.when(k % 6 == 0, F.concat(F.lit("I-"), sub.cast("string"))).when(sub % 5 == 0, principal).otherwise(F.concat(principal, F.lit("."), sub.cast("string")))
    items = table(spark, sf_dir, "events").select(F.col("user_id").alias("ws"), k.alias("pos"), (k % 4).alias("numero_principal"), (k % 3).alias("numero_questao"), name.alias("id_item"))
    return S.with_members(items, "pos").select("ws", "pos", "id_item", F.array_join("grupo_ids", ",").alias("ids"))


_VALUE = """CASE event_id % 7 WHEN 0 THEN '[' || props || ',' || (event_id % 10) || ']' WHEN 1 THEN '"[' || (event_id % 10) || ',2]"' WHEN 2 THEN props WHEN 3 THEN '"\\"[1]\\""' WHEN 4 THEN event_type WHEN 5 THEN '[]' ELSE '[1, ' || event_type END"""


@query(f"""
    WITH e AS (SELECT event_id, user_id, event_type AS field, {_VALUE} AS value FROM events),
        o AS (SELECT *, CASE WHEN json_valid(value) THEN json_type(value) END AS kind, CASE WHEN json_valid(value) AND json_type(value) = 'VARCHAR' THEN json_extract_string(value, '$') END AS inside FROM e),
        p AS (SELECT *, CASE WHEN kind = 'ARRAY' THEN CAST(json(value) AS VARCHAR) WHEN json_valid(inside) AND json_type(inside) = 'ARRAY' THEN CAST(json(inside) AS VARCHAR) END AS arr FROM o),
        f AS (SELECT *, CASE WHEN user_id % 6 = 0 OR event_id % 19 = 0 THEN 'unknown item' WHEN field NOT IN ('view', 'click', 'signup') THEN 'unknown field' WHEN field <> 'view' AND arr IS NULL THEN 'not an array' END AS fault FROM p)
    SELECT event_id, fault, CASE WHEN fault IS NULL THEN CASE WHEN field <> 'view' THEN arr ELSE value END END AS kept FROM f""")
def judged_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections that are kept, and why others aren't."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "user_id AS ws", "'' || event_id AS id_item", "event_type AS field", _VALUE.replace("\\", "\\\\") + " AS value")
    base = rows.filter("ws % 6 > 0 AND event_id % 19 > 0").select("ws", "id_item")
    return S.judged_edits(rows, base, ["view", "click", "signup"], ["click", "signup"]).select("event_id", "fault", "kept")


_FIELD = "CASE l_partkey % 5 WHEN 0 THEN 'enunciado' WHEN 1 THEN 'status' WHEN 2 THEN 'tags' WHEN 3 THEN 'tema' ELSE 'observacoes' END"


@query(f"""
    SELECT l_suppkey AS ws, '' || l_orderkey AS id_item, string_agg(DISTINCT f, ',' ORDER BY f) AS fields FROM (SELECT *, {_FIELD} AS f FROM lineitem) WHERE f IN ('enunciado', 'tags', 'tema')
        AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F') GROUP BY ALL""")
def lost_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of content whose item has gone."""
    patches = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS ws", "'' || l_orderkey AS id_item", f"{_FIELD} AS field")
    left = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").selectExpr("'' || o_orderkey AS id_item")
    base = patches.join(left, "id_item", "left_semi")
    return S.critical_orphans(patches, base).select("ws", "id_item", F.array_join("fields", ",").alias("fields"))


# Times are numbers of days; every seventh workspace is merged already, every ninth has no approved items.
_STATE = """c_custkey AS ws, c_custkey % 5 AS review_at, CASE WHEN c_custkey % 9 > 0 THEN 3 END AS approved_at, CASE WHEN c_custkey % 2 > 0 THEN c_custkey % 6 END AS criteria_raw_at, c_custkey % 4 AS criteria_review_at,
    CASE WHEN c_custkey % 10 > 0 THEN 2 + c_custkey % 3 END AS criteria_at, CASE WHEN c_custkey % 7 = 0 THEN 'cc_merged' WHEN c_custkey % 7 = 1 THEN 'extracted' ELSE 'validated' END AS stage, CASE WHEN c_custkey % 8 > 0 THEN 'cc_validated' END AS cc_stage"""
_APPROVED = """o_custkey AS ws, CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN 'II-' || (o_orderkey % 40) ELSE ' I-' || (o_orderkey % 40) END AS id_item, o_orderkey % 40 AS numero_questao, CASE WHEN o_orderkey % 11 = 0 THEN 'context_stem' ELSE 'essay' END AS tipo_item,
    CASE WHEN o_orderkey % 13 = 0 THEN 'validation_error' ELSE 'approved' END AS status, CASE WHEN o_orderkey % 17 = 0 THEN 'Por categorizar ' ELSE 't' END AS tema, CASE WHEN o_orderkey % 19 > 0 THEN 's' END AS subtema, 'd' AS descricao_breve"""
_CRITERIA = "o_custkey AS ws, CASE o_orderkey % 3 WHEN 0 THEN 'i-' || (o_orderkey % 40) || ' ' WHEN 1 THEN '' || (o_orderkey % 40) ELSE 'II-' || (o_orderkey % 40) END AS id_item"


@query(f"""
    WITH s AS (SELECT {_STATE} FROM customer WHERE c_custkey % 3 > 0), a AS (SELECT {_APPROVED}, lower(trim(CASE WHEN o_orderkey % 6 = 0 THEN '' || (o_orderkey % 40) WHEN o_orderkey % 2 = 0 THEN 'II-' || (o_orderkey % 40) ELSE ' I-' || (o_orderkey % 40) END)) AS name, o_orderkey % 23 = 0 AS untagged
            FROM orders WHERE o_orderkey % 4 > 0 AND o_custkey IN (SELECT ws FROM s)), c AS (SELECT ws, lower(trim(id_item)) AS id FROM (SELECT {_CRITERIA} FROM orders)),
        g AS (SELECT ws, 'no_items' AS gate, NULL AS item FROM s WHERE approved_at IS NULL UNION ALL SELECT ws, 'no_criteria', NULL FROM s WHERE criteria_at IS NULL UNION ALL SELECT ws, 'stale_items', NULL FROM s WHERE review_at > approved_at
            UNION ALL SELECT ws, 'stale_criteria', NULL FROM s WHERE criteria_raw_at > criteria_at UNION ALL SELECT ws, 'stale_criteria_review', NULL FROM s WHERE criteria_review_at > criteria_at
            UNION ALL SELECT o_custkey, 'rejected', 'r' || o_orderkey FROM orders WHERE o_orderkey % 29 = 0 AND o_custkey IN (SELECT ws FROM s)
            UNION ALL SELECT ws, 'already_merged', NULL FROM s WHERE stage = 'cc_merged' UNION ALL SELECT ws, 'not_validated', NULL FROM s WHERE stage = 'extracted' UNION ALL SELECT ws, 'criteria_not_validated', NULL FROM s WHERE cc_stage IS NULL
            UNION ALL SELECT ws, 'uncategorised', CASE WHEN id_item = '' THEN name ELSE id_item END FROM a WHERE trim(lower(tema)) = 'por categorizar' OR subtema IS NULL OR untagged
            UNION ALL SELECT ws, 'validation_error', CASE WHEN id_item = '' THEN name ELSE id_item END FROM a WHERE status = 'validation_error'
            UNION ALL SELECT ws, 'no_criterion', CASE WHEN id_item = '' THEN name ELSE id_item END FROM a WHERE status <> 'validation_error' AND tipo_item <> 'context_stem' AND NOT EXISTS (SELECT 1 FROM c WHERE c.ws = a.ws AND (c.id = name OR (starts_with(name, 'ii-') AND c.id = substr(name, 4)))))
    SELECT ws, gate, item, gate NOT IN ('already_merged', 'not_validated', 'validation_error', 'no_criterion') AS hard,
        list_position(['no_items', 'no_criteria', 'stale_items', 'stale_criteria', 'stale_criteria_review', 'rejected', 'already_merged', 'not_validated', 'criteria_not_validated', 'uncategorised', 'validation_error', 'no_criterion'], gate) AS step FROM g""")
def merge_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds each workspace's merge back, item by item."""
    states = _picked(table(spark, sf_dir, "customer"), _STATE).filter("ws % 3 > 0")
    orders = table(spark, sf_dir, "orders")
    approved = _picked(orders.filter("o_orderkey % 4 > 0"), f"{_APPROVED}, CASE WHEN o_orderkey % 23 > 0 THEN array('t') ELSE array() END AS tags")
    rejected = orders.filter("o_orderkey % 29 = 0").selectExpr("o_custkey AS ws", "'r' || o_orderkey AS id_item")
    criteria = _picked(orders, _CRITERIA)
    return S.merge_gates(states, approved, rejected, criteria)


@query("""
    WITH i AS (SELECT o_custkey AS ws, '' || (o_orderkey % 300) AS id_item, o_orderkey AS ordem_item FROM orders),
        f AS (SELECT o_custkey AS ws, '' || (l_orderkey % 300) AS id_item, CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'warning' END AS severity, l_returnflag || (l_partkey % 5) AS message, min(l_partkey * 10 + l_linenumber) AS pos
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_partkey % 3 = 0 GROUP BY ALL),
        t AS (SELECT ws, id_item, string_agg(message, ',' ORDER BY pos, message) FILTER (severity = 'error') AS e, string_agg(message, ',' ORDER BY pos, message) FILTER (severity = 'warning') AS w FROM f GROUP BY ALL)
    SELECT i.ws, i.id_item, ordem_item, CASE WHEN e IS NOT NULL THEN 'validation_error' WHEN w IS NOT NULL THEN 'approved_with_warnings' ELSE 'approved' END AS status, coalesce(e, '') AS errors, coalesce(w, '') AS warnings
    FROM i LEFT JOIN t ON t.ws = i.ws AND t.id_item = i.id_item""")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each item with its state, errors and warnings, each told once."""
    orders = table(spark, sf_dir, "orders")
    items = orders.selectExpr("o_custkey AS ws", "'' || (o_orderkey % 300) AS id_item", "o_orderkey AS ordem_item")
    lines = table(spark, sf_dir, "lineitem").filter("l_partkey % 3 = 0").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("ws")), "l_orderkey")
    findings = lines.selectExpr("ws", "'' || (l_orderkey % 300) AS id_item", "CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'warning' END AS severity", "l_returnflag || (l_partkey % 5) AS message", "l_partkey * 10 + l_linenumber AS at")
    told = S.validation_report(items, findings)
    return told.select("ws", "id_item", "ordem_item", "status", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))
