"""Structure of a workspace: items against manifests, and boxes on pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators import manifest as M
from itemforge.operators import plane
from itemforge.plans.registry import query, table

# Items: lines of an order; every third has two sub-items of which some are lost, some lines are stems, some ids have a group.
_ITEMS = """lineitem_items AS (
        SELECT DISTINCT l_orderkey AS ws, CASE WHEN l_orderkey % 4 = 0 THEN 'I-' ELSE '' END || l_linenumber AS id_item, l_linenumber AS numero, CAST(NULL AS VARCHAR) AS subitem,
            CASE WHEN l_linenumber % 3 = 0 THEN 'context_stem' ELSE 'open_response' END AS tipo_item FROM lineitem WHERE l_linenumber <= 6
        UNION SELECT l_orderkey, CASE WHEN l_orderkey % 4 = 0 THEN 'I-' ELSE '' END || l_linenumber || '.' || s, l_linenumber, CAST(s AS VARCHAR), 'open_response'
        FROM lineitem CROSS JOIN (VALUES (1), (2), (3)) AS t(s) WHERE l_linenumber <= 6 AND (l_linenumber + s) % 3 = 0 AND (l_partkey + s) % 5 > 0)"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber <= 6").select("l_orderkey", "l_linenumber", "l_partkey")
    prefix = F.when(F.col("l_orderkey") % 4 == 0, "I-").otherwise("")
    s = F.col("s")
    each = lines.withColumn("s", F.explode(F.array(F.lit(0), *map(F.lit, (1, 2, 3))))).filter("s = 0 OR (l_linenumber + s) % 3 = 0 AND (l_partkey + s) % 5 > 0")
    item = F.concat(prefix, "l_linenumber", F.when(s > 0, F.concat(F.lit("."), s)).otherwise(""))
    return each.select(F.col("l_orderkey").alias("ws"), item.alias("id_item"), F.col("l_linenumber").alias("numero"), F.when(s > 0, s.cast("string")).alias("subitem"), F.when((s == 0) & (F.col("l_linenumber") % 3 == 0), "context_stem").otherwise("open_response").alias("tipo_item"))


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest an order: its first 1 to 5 items, every other with sub-items 1 and 2, a pool of two members."""
    k, prefix = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 4 == 0, "I-").otherwise("")
    ids = F.transform(F.sequence(F.lit(1), (k % 5 + 1).cast("int")), lambda n: F.concat(prefix, n.cast("string")))
    subs = F.transform(F.sequence(F.lit(1), (k % 5 + 1).cast("int")), lambda n: F.when((n + k) % 2 == 0, F.array(F.concat(prefix, n.cast("string"), F.lit(".1")), F.concat(prefix, n.cast("string"), F.lit(".2")))).otherwise(F.array().cast("array<string>")))
    pool = F.array(F.struct(F.array(F.concat(prefix, F.lit("1")), F.concat(prefix, F.lit("6"))).alias("itens"), F.lit(1).alias("escolher")))
    return table(spark, sf_dir, "orders").select(k.alias("ws"), F.map_from_arrays(ids, subs).alias("estrutura"), F.when(k % 3 == 0, pool).alias("pools"), F.when(k % 7 == 0, "baixa").otherwise("alta").alias("confianca"), (k % 11 == 0).alias("bypass"))


@query(f"""
    WITH {_ITEMS}, o AS (SELECT o_orderkey AS ws, CASE WHEN o_orderkey % 4 = 0 THEN 'I-' ELSE '' END AS g FROM orders WHERE o_orderkey % 11 > 0),
        e AS (SELECT ws, g, n, g || n AS main, (n + ws) % 2 = 0 AS split FROM (SELECT *, unnest(range(1, ws % 5 + 2)) AS n FROM o)),
        w AS (SELECT ws, main, main || '.' || s AS sub FROM e CROSS JOIN (VALUES (1), (2)) AS t(s) WHERE split),
        i AS (SELECT * FROM lineitem_items WHERE ws IN (SELECT ws FROM o)),
        b AS (SELECT i.ws, e.main, id_item AS sub FROM i JOIN e ON e.ws = i.ws AND id_item LIKE e.main || '.%' WHERE subitem IS NOT NULL),
        lacking AS (SELECT * FROM w EXCEPT SELECT * FROM b), surplus AS (SELECT * FROM b EXCEPT SELECT * FROM w),
        top AS (SELECT e.*, EXISTS (SELECT 1 FROM i WHERE i.ws = e.ws AND subitem IS NULL AND (id_item = main OR CAST(numero AS VARCHAR) = main)) AS has,
            EXISTS (SELECT 1 FROM b WHERE b.ws = e.ws AND b.main = e.main) AS subs FROM e),
        f AS (
            SELECT ws, 'missing' AS "check", main AS item, NULL AS target FROM top WHERE NOT has
            UNION SELECT ws, 'missing_sub', sub, main FROM lacking UNION SELECT l.ws, 'missing_sub', l.sub, b.sub FROM lacking l JOIN b ON b.ws = l.ws AND b.main = l.main
            UNION SELECT ws, 'extra_sub', sub, sub FROM surplus
            UNION SELECT ws, 'simple', main, main FROM top WHERE NOT split AND subs UNION SELECT t.ws, 'simple', t.main, b.sub FROM top t JOIN b ON b.ws = t.ws AND b.main = t.main WHERE NOT split
            UNION SELECT ws, 'no_subs', main, main FROM top WHERE has AND split AND NOT subs
            UNION SELECT i.ws, 'extra', id_item, id_item FROM i WHERE subitem IS NULL AND tipo_item <> 'context_stem' AND NOT EXISTS (SELECT 1 FROM e WHERE e.ws = i.ws AND (main = id_item OR main = CAST(numero AS VARCHAR)))
            UNION SELECT ws, 'pool', g || n, NULL FROM (SELECT ws, g, unnest([1, 6]) AS n FROM o WHERE ws % 3 = 0) p WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.ws = p.ws AND id_item = g || n AND tipo_item <> 'context_stem'))
    SELECT DISTINCT ws, "check", item, CASE WHEN ws % 7 > 0 THEN target END AS target, CASE WHEN ws % 7 = 0 THEN 'warning' ELSE 'error' END AS severity FROM f""")
def manifest_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What items and manifests of workspaces don't have in common, told to whom it concerns."""
    return M.cross_check(_items(spark, sf_dir), _manifests(spark, sf_dir))


_BOX = "[CAST({k} * 37 % 1009 AS INT), CAST({k} * 91 % 997 AS INT), CAST({k} * 37 % 1009 + 5 + {k} % 23 AS INT), CAST({k} * 91 % 997 + 3 + {k} % 41 AS INT)]"


@query(f"""
    WITH l AS (SELECT s_suppkey, s_suppkey % 5 AS page, CASE s_suppkey % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'table' ELSE 'chart' END AS kind, {_BOX.format(k='s_suppkey')} AS a FROM supplier),
        r AS (SELECT p_partkey, p_partkey % 4 AS page, CASE p_partkey % 2 WHEN 0 THEN 'image' ELSE 'table' END AS kind, {_BOX.format(k='p_partkey')} AS b FROM part),
        p AS (SELECT s_suppkey, p_partkey, l.kind <> r.kind AS other, (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 AS d FROM l JOIN r USING (page)),
        n AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY other, d, p_partkey) AS k FROM p)
    SELECT l.s_suppkey, p_partkey, CAST(d AS DOUBLE) AS distance FROM l LEFT JOIN n ON n.s_suppkey = l.s_suppkey AND k = 1""")
def nearest_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each box the nearest of its kind on its page, or of any kind where there is none of its own."""
    def boxes(name: str, key: str, page: int, kind) -> DataFrame:
        k = F.col(key)
        box = F.array(*(v.cast("int") for v in (k * 37 % 1009, k * 91 % 997, k * 37 % 1009 + 5 + k % 23, k * 91 % 997 + 3 + k % 41)))
        return table(spark, sf_dir, name).select(key, (k % page).alias("page"), kind(k).alias("kind"), box.alias("box"))

    left = boxes("supplier", "s_suppkey", 5, lambda k: F.when(k % 3 == 0, "image").when(k % 3 == 1, "table").otherwise("chart"))
    right = boxes("part", "p_partkey", 4, lambda k: F.when(k % 2 == 0, "image").otherwise("table"))
    return plane.nearest_boxes(left, right, "s_suppkey", "p_partkey")
