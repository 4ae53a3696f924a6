"""Views, filters, joins and aggregates of the bank, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.operators import aggregates as A
from itemforge.operators import joins as J
from itemforge.plans.registry import query, table


@query("""
    SELECT c_custkey, c_name, n_name, count(o_orderkey) AS total, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS closed,
        CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name, n_name""")
def fontes_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of each source by type, sources without items included. Orders are counted before the join, so the shuffle carries a row a source."""
    status = lambda s: F.count_if(F.col("o_orderstatus") == s)
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("total"), status("F").alias("closed"), status("O").alias("open"))
    sources = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = sources.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "c_name", "n_name", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "closed", "open")))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, c_name, p_name, s_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey""")
def questoes_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their source and subject, and with topic and context where there are any."""
    t = lambda n: table(spark, sf_dir, n)
    joined = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"), "left").join(t("supplier").filter("s_acctbal > 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", "c_name", "p_name", "s_name")


@query("""
    WITH leaf AS (SELECT DISTINCT p_brand, p_type FROM part),
        tree AS (SELECT p_brand AS topic, CAST(NULL AS VARCHAR) AS parent, 1 AS level FROM leaf UNION SELECT p_type, p_brand, 2 FROM leaf),
        used AS (SELECT p_brand, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT t.topic, t.parent, up.topic AS parent_name, t.level, CAST(coalesce(n, 0) AS BIGINT) AS total
    FROM tree t LEFT JOIN tree up ON up.level = 1 AND up.topic = t.parent LEFT JOIN used ON t.level = 2 AND p_brand = t.parent AND p_type = t.topic""")
def topicos_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of topics with their parents and item counts, zero included."""
    part = table(spark, sf_dir, "part")
    leaf = part.select(F.col("p_type").alias("topic"), F.col("p_brand").alias("parent"), F.lit(2).alias("level")).distinct()
    root = leaf.select(F.col("parent").alias("topic"), F.lit(None).cast("string").alias("parent"), F.lit(1).alias("level")).distinct()
    per_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    used = per_part.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_type").alias("topic"), F.col("p_brand").alias("parent")).agg(F.sum("n").alias("total"))
    up = root.select(F.col("topic").alias("parent"), F.col("topic").alias("parent_name"))
    joined = root.unionByName(leaf).join(up, "parent", "left").join(used, ["topic", "parent"], "left")
    return joined.select("topic", "parent", "parent_name", "level", F.coalesce("total", F.lit(0)).alias("total"))


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, c_name, c_acctbal FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey
    WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderkey""")
def quiz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source's items in order, with context where there is any."""
    rows = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 5000")
    return rows.join(known, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_custkey", "o_orderstatus", "c_name", "c_acctbal").orderBy("o_orderkey")


@query("""
    WITH p AS (SELECT p_partkey, p_size, list_transform(list_filter(string_split(p_name, ' '), lambda x: length(x) > 4), lambda x: length(x)) AS points FROM part)
    SELECT p_partkey, CAST(CASE WHEN len(points) > 0 THEN list_sum(points) ELSE p_size END AS BIGINT) AS points_max FROM p""")
def pontos_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points summed over an array of criteria; the former total where it is empty."""
    parts = F.transform(F.filter(F.split("p_name", " "), lambda x: F.length(x) > 4), lambda x: F.struct(F.length(x).alias("points")))
    return table(spark, sf_dir, "part").select("p_partkey", A.array_points(parts, "points", F.col("p_size").cast("long")).alias("points_max"))


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 100000")
def heuristic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_totalprice") >= 100000)).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = (SELECT max(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')")
def scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").agg(F.max("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(F.broadcast(last), "o_custkey", "left_semi").select("o_orderkey", "o_custkey")  # one row is broadcast


@query("SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'red') OR list_contains(string_split(p_name, ' '), 'bolt')")
def tags_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.split("p_name", " ")
    return table(spark, sf_dir, "part").filter(F.array_contains(tags, "red") | F.array_contains(tags, "bolt")).select("p_partkey", "p_name")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) % 10 = 3")
def json_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose JSON, parsed to an array of objects, has one that matches."""
    parsed = F.array(F.from_json("props", "k int"))
    return table(spark, sf_dir, "events").filter(F.exists(parsed, lambda x: x["k"] % 10 == 3)).select("event_id", parsed[0]["k"].alias("k"))


@query("SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'LARGE') AND p_brand IS NOT NULL")
def partial_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_type").isin("PROMO", "LARGE") & F.col("p_brand").isNotNull()).select("p_partkey", "p_type")


@query("""
    SELECT coalesce(b.o_orderkey, p.o_orderkey) AS o_orderkey, CASE WHEN p.o_orderkey IS NULL THEN b.o_totalprice ELSE p.o_totalprice END AS o_totalprice, b.o_orderstatus
    FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 0) b FULL JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice + 1 END AS o_totalprice FROM orders WHERE o_orderkey % 3 = 0) p ON b.o_orderkey = p.o_orderkey""")
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert or overwrite the columns sent; a null that is sent overwrites, a column that isn't stays."""
    orders = table(spark, sf_dir, "orders")
    base = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice", "o_orderstatus")
    patch = orders.filter("o_orderkey % 3 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice") + 1).alias("o_totalprice"))
    return J.upsert(base, patch, ["o_orderkey"])


def _patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    return events.select("user_id", F.col("event_type").alias("field"), F.when(F.col("event_id") % 7 > 0, F.col("value")).alias("value"), "ts", F.col("event_id").alias("seq"))


_LAST = """
    WITH patches AS (SELECT user_id, event_type AS field, CASE WHEN event_id % 7 > 0 THEN value END AS value, ts, event_id FROM events WHERE event_type IN ('view', 'click')),
        last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, field ORDER BY ts DESC, event_id DESC) AS rn FROM patches) WHERE rn = 1)"""


@query(_LAST + """
    SELECT c_custkey AS user_id, CASE WHEN v.user_id IS NULL THEN c_acctbal ELSE v.value END AS view, CASE WHEN k.user_id IS NULL THEN -1 ELSE k.value END AS click
    FROM customer LEFT JOIN last v ON v.user_id = c_custkey AND v.field = 'view' LEFT JOIN last k ON k.user_id = c_custkey AND k.field = 'click'""")
def overlay_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source with the last patch to each field; a patch to null counts."""
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("view"), F.lit(-1.0).alias("click"))
    return J.overlay_apply(base, _patches(spark, sf_dir), "user_id", ["view", "click"])


@query("SELECT DISTINCT user_id FROM events WHERE event_type IN ('view', 'click') AND user_id % 2 = 1")
def overlay_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"))
    return J.orphans(_patches(spark, sf_dir), base, "user_id")


@query(_LAST + " SELECT count(DISTINCT user_id) AS items, count(*) AS fields, count(DISTINCT CASE WHEN user_id % 2 = 1 THEN user_id END) AS orphans FROM last")
def overlay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _patches(spark, sf_dir).select("user_id", "field").distinct()
    known = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"), F.lit(1).alias("known"))
    per_item = fields.groupBy("user_id").agg(F.count("*").alias("n")).join(known, "user_id", "left")
    return per_item.agg(F.count("*").alias("items"), F.sum("n").alias("fields"), F.count_if(F.col("known").isNull()).alias("orphans"))


@query("""
    SELECT r.o_orderkey, o_custkey, CASE WHEN m.o_orderkey IS NULL THEN 5000000 + r.o_orderkey ELSE m.rank END AS rank, m.o_orderkey IS NULL AS synthesized
    FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 < 3) r LEFT JOIN (SELECT o_orderkey, CAST(o_totalprice AS BIGINT) AS rank FROM orders WHERE o_orderkey % 3 > 0) m ON r.o_orderkey = m.o_orderkey""")
def review_meta_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed rows with their other half; a row that lacks it gets derived values."""
    orders = table(spark, sf_dir, "orders")
    review = orders.filter("o_orderkey % 4 < 3").select("o_orderkey", "o_custkey")
    meta = orders.filter("o_orderkey % 3 > 0").select("o_orderkey", F.rint("o_totalprice").cast("long").alias("rank"), F.lit(True).alias("there"))
    gone = F.col("there").isNull()
    return review.join(meta, "o_orderkey", "left").select("o_orderkey", "o_custkey", F.when(gone, F.lit(5000000) + F.col("o_orderkey")).otherwise(F.col("rank")).alias("rank"), gone.alias("synthesized"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'left_only' ELSE 'right_only' END AS side FROM orders WHERE (o_orderkey % 4 < 3) <> (o_orderkey % 3 > 0)""")
def renumber_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that only one of two halves has; both kinds at once mean that rows were renumbered."""
    orders = table(spark, sf_dir, "orders")
    return J.differences(orders.filter("o_orderkey % 4 < 3"), orders.filter("o_orderkey % 3 > 0"), "o_orderkey")


@query("""
    WITH q AS (SELECT p_partkey, lower(trim(p_brand)) || '-' || p_type AS k1, lower(trim(p_brand)) || '-' || p_size AS k2, lower(trim(p_brand)) AS k3 FROM part),
        c AS (SELECT key, min(s) AS answer FROM (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'brand#' || s_suppkey % 25 || '-LARGE' WHEN s_suppkey % 3 = 1 THEN 'brand#' || s_suppkey % 25 || '-' || s_suppkey % 50 ELSE 'brand#' || s_suppkey % 13 END AS key, s_name AS s FROM supplier) GROUP BY key)
    SELECT p_partkey, coalesce(a.answer, b.answer, d.answer) AS answer FROM q LEFT JOIN c a ON k1 = a.key LEFT JOIN c b ON k2 = b.key LEFT JOIN c d ON k3 = d.key""")
def merge_fallback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the criterion under their whole key, else under a shorter one, else under a shorter one still."""
    brand, key = F.lower(F.trim("p_brand")), F.col("s_suppkey")
    text = lambda *parts: F.concat(*(p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts))
    named = F.when(key % 3 == 0, text("brand#", key % 25, "-LARGE")).when(key % 3 == 1, text("brand#", key % 25, "-", key % 50)).otherwise(text("brand#", key % 13))
    criteria = table(spark, sf_dir, "supplier").groupBy(named.alias("key")).agg(F.min("s_name").alias("answer"))
    candidates = [text(brand, "-", F.col("p_type")), text(brand, "-", F.col("p_size")), brand]
    return J.fallback_join(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size"), criteria, candidates, "key", ["answer"]).select("p_partkey", "answer")


@query("""
    WITH e AS (SELECT o_orderkey, unnest(range(1, o_orderkey % 7 + 2)) AS line FROM orders), p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    SELECT coalesce(o_orderkey, l_orderkey) AS orderkey, CAST(coalesce(line, l_linenumber) AS INT) AS line, CASE WHEN l_orderkey IS NULL THEN 'missing' WHEN o_orderkey IS NULL THEN 'extra' ELSE 'present' END AS kind
    FROM e FULL JOIN p ON o_orderkey = l_orderkey AND line = l_linenumber""")
def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a manifest expects against those there are, classified by the side that lacks them."""
    wanted = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.explode(F.sequence(F.lit(1), (F.col("o_orderkey") % 7 + 1).cast("int"))).alias("line"), F.lit(1).alias("w"))
    there = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line")).distinct().withColumn("t", F.lit(1))
    kind = F.when(F.col("t").isNull(), "missing").when(F.col("w").isNull(), "extra").otherwise("present")
    return wanted.join(there, ["orderkey", "line"], "full_outer").select("orderkey", "line", kind.alias("kind"))


@query("""
    SELECT conv_id, bool_or(role = 'system') AS has_stem, count(*) FILTER (role <> 'system') AS n_children,
        CASE WHEN NOT bool_or(role = 'system') THEN 'dangling' WHEN count(*) FILTER (role <> 'system') = 0 THEN 'childless' ELSE 'ok' END AS status
    FROM conversations GROUP BY conv_id""")
def stem_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of each stem, stems without children and children without a stem."""
    system = F.col("role") == "system"
    found = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.bool_or(system).alias("has_stem"), F.count_if(~system).alias("n_children"))
    return found.withColumn("status", F.when(~F.col("has_stem"), "dangling").when(F.col("n_children") == 0, "childless").otherwise("ok"))


@query("""
    WITH s AS (SELECT conv_id, min(turn) AS turn FROM conversations WHERE role = 'system' GROUP BY conv_id), g AS (SELECT conv_id % 10 AS grp, min(conv_id) AS stem FROM s GROUP BY ALL)
    SELECT c.conv_id, c.turn, CASE WHEN s.conv_id IS NOT NULL THEN 'error' WHEN g.stem IS NOT NULL THEN 'warning' ELSE 'none' END AS severity, coalesce(s.conv_id, g.stem) AS stem
    FROM conversations c LEFT JOIN s ON c.conv_id = s.conv_id LEFT JOIN g ON c.conv_id % 10 = g.grp WHERE c.role <> 'system' AND c.turn % 3 = 0""")
def orphan_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children that name no parent: an error if their own part has a stem, a warning if their group has one."""
    turns = table(spark, sf_dir, "conversations")
    own = turns.filter("role = 'system'").select("conv_id", F.col("conv_id").alias("own")).distinct()
    group = own.groupBy((F.col("conv_id") % 10).alias("grp")).agg(F.min("conv_id").alias("stem"))
    child = turns.filter("role <> 'system' AND turn % 3 = 0").withColumn("grp", F.col("conv_id") % 10)
    joined = child.join(own, "conv_id", "left").join(group, "grp", "left")
    severity = F.when(F.col("own").isNotNull(), "error").when(F.col("stem").isNotNull(), "warning").otherwise("none")
    return joined.select("conv_id", "turn", severity.alias("severity"), F.coalesce("own", "stem").alias("stem"))


@query("""
    SELECT DISTINCT r.doc_id, r.ref FROM (SELECT doc_id, CAST(unnest(list_filter(regexp_extract_all(text, '[0-9]+'), lambda x: length(x) <= 9)) AS BIGINT) AS ref FROM documents) r
    WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = r.ref)""")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in texts that name no document."""
    docs = table(spark, sf_dir, "documents")
    numbers = F.filter(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)), lambda x: F.length(x) <= 9)
    refs = docs.select("doc_id", F.explode(F.transform(numbers, lambda x: x.cast("long"))).alias("ref")).distinct()
    return refs.join(docs.select(F.col("doc_id").alias("ref")), "ref", "left_anti").select("doc_id", "ref")


@query("""
    SELECT event_id, user_id, last AS last_event_id FROM (SELECT *, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last FROM events)
    WHERE event_type = 'error'""")
def asof_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section that is open at each place: the last heading at or before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    found = J.asof_last(events.filter("event_type = 'error'"), events.filter("event_type = 'signup'"), ["user_id"], ["ts", "event_id"], "event_id")
    return found.select("event_id", "user_id", "last_event_id")


@query("""
    WITH g AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM events)
    SELECT event_id, user_id, CAST(grp AS BIGINT) AS grp, part FROM (SELECT *, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS part FROM g)
    WHERE event_type = 'error'""")
def asof_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part that is open at each place, where a new section closes all parts."""
    from itemforge.operators import windows as W

    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    grouped = rows.withColumn("grp", W.running_count(F.col("event_type") == "signup", ["user_id"], ["ts", "event_id"]))
    part = W.carried(F.when(F.col("event_type") == "click", F.col("event_id")), ["user_id", "grp"], ["ts", "event_id"])
    return grouped.withColumn("part", part).filter("event_type = 'error'").select("event_id", "user_id", "grp", "part")


_NEAREST = """
    SELECT s_suppkey, c_custkey, round(d, 2) AS distance FROM (
        SELECT s_suppkey, c_custkey, abs(s_acctbal - c_acctbal) AS d, row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(s_acctbal - c_acctbal), c_custkey) AS rn
        FROM supplier JOIN customer ON s_nationkey = c_nationkey) WHERE rn = 1"""


@query(_NEAREST)
def nearest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest row of the same group, from the neighbours in one sorted union: no pairs are made."""
    left = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("at"))
    right = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("at"))
    return J.nearest_in_order(left, right, "nation", "at", "s_suppkey", "c_custkey", width=500.0).select("s_suppkey", "c_custkey", F.round("distance", 2).alias("distance"))


@query(f"SELECT s_suppkey, CASE WHEN distance <= 10 THEN c_custkey END AS c_custkey, distance FROM ({_NEAREST})")
def nearest_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As nearest_match; what is too far away has no match, but stays."""
    return nearest_match(spark, sf_dir).withColumn("c_custkey", F.when(F.col("distance") <= 10, F.col("c_custkey")))


@query("""
    SELECT c_custkey, k, s_suppkey FROM (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer)
        LEFT JOIN (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS j FROM supplier) ON c_nationkey = s_nationkey AND k = j""")
def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey")
    right = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey")
    return J.positional_join(left, right, "nation", "c_custkey", "s_suppkey", width=1000).select("c_custkey", F.col("k").cast("long").alias("k"), "s_suppkey")


@query("""
    WITH d AS (SELECT DISTINCT 'old-' || p_brand AS id, p_brand FROM part WHERE p_partkey < 10)
    SELECT * FROM d UNION ALL SELECT DISTINCT sha256('{"k0":"' || p_brand || '"}'), p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM d)""")
def get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    known = part.filter("p_partkey < 10").select(F.concat(F.lit("old-"), "p_brand").alias("id"), "p_brand").distinct()
    return J.get_or_create(known, part, ["p_brand"], "id")


@query("""
    SELECT o_orderkey, CASE WHEN o_custkey + 2 IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) THEN o_custkey + 2 WHEN o_custkey + 1 IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) THEN o_custkey + 1
        WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) THEN o_custkey END AS parent FROM orders""")
def last_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of several parents that exists."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.array(*(F.col("o_custkey") + k for k in range(3))).alias("parents"))
    valid = table(spark, sf_dir, "customer").filter("c_nationkey < 5").select(F.col("c_custkey").alias("parent_key"))
    return J.last_valid(rows, "parents", valid, "parent_key", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_LINE = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
_ONE = "SELECT l_orderkey, l_linenumber, {0} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {1}) AS rn FROM lineitem) WHERE rn = 1"


@query(_ONE.format(", ".join(_LINE), ", ".join(f"{c} DESC" for c in _LINE)))
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of rows that share a key the last; a maximum of structs, so rows combine before the shuffle."""
    best = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.struct(*_LINE)).alias("r"))
    return best.select("l_orderkey", "l_linenumber", "r.*")


@query(_ONE.format(", ".join(_LINE), ", ".join(_LINE)))
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct(*_LINE)).alias("r"))
    return best.select("l_orderkey", "l_linenumber", "r.*")


@query("SELECT l_orderkey, string_agg(l_linenumber, ',' ORDER BY l_linenumber) AS lines FROM lineitem GROUP BY l_orderkey")
def group_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(A.ordered_concat("l_linenumber", ["l_linenumber"]).alias("lines"))


@query("SELECT l_orderkey, l_linenumber, l_linenumber - min(l_linenumber) OVER (PARTITION BY l_orderkey) + 1 AS rebased FROM lineitem")
def rebase_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    least = F.min("l_linenumber").over(Window.partitionBy("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") - least + 1).alias("rebased"))


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_values FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
def single_source_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose rows should share one value but don't."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderstatus").alias("n_values")).filter("n_values > 1")


@query("SELECT c_nationkey, count(*) AS n, list_aggregate(list_slice(list(c_custkey ORDER BY c_custkey), 1, 3), 'string_agg', ',') AS first_keys FROM customer GROUP BY c_nationkey")
def exemplars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.exemplars(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey")


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS n_final, count(*) FILTER (o_orderstatus = 'O') AS n_open, count(*) FILTER (o_orderpriority = '1-URGENT') AS n_urgent, count(*) FILTER (o_totalprice > 400000) AS n_warn, count(*) AS total FROM orders")
def status_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "orders").agg(F.count_if(c("o_orderstatus") == "F").alias("n_final"), F.count_if(c("o_orderstatus") == "O").alias("n_open"), F.count_if(c("o_orderpriority") == "1-URGENT").alias("n_urgent"), F.count_if(c("o_totalprice") > 400000).alias("n_warn"), F.count("*").alias("total"))


@query("""
    SELECT count(*) FILTER (o_orderstatus = 'F') AS rejected, count(*) FILTER (o_orderstatus = 'P') AS pending,
        count(*) FILTER (o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS silent_drop, count(*) AS total FROM orders""")
def exclusion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left out and why; rows that are in no set at all were dropped silently."""
    final = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("final")).distinct()
    rows, status = table(spark, sf_dir, "orders").join(final, "o_orderkey", "left"), F.col("o_orderstatus")
    return rows.agg(F.count_if(status == "F").alias("rejected"), F.count_if(status == "P").alias("pending"), F.count_if((status == "O") & F.col("final").isNull()).alias("silent_drop"), F.count("*").alias("total"))


@query("""
    SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS expected, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal >= 0) AS upserted,
        (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal < 0) AS skipped FROM nation""")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("expected"), F.count_if(F.col("c_acctbal") >= 0).alias("upserted"), F.count_if(F.col("c_acctbal") < 0).alias("skipped"))
    return table(spark, sf_dir, "nation").join(counts, "n_nationkey", "left").select("n_nationkey", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("expected", "upserted", "skipped")))


@query("""
    WITH b AS (SELECT c_nationkey, CAST('0x' || substr(sha256(c_name), 1, 8) AS BIGINT) % 64 AS b, c_name FROM customer), d AS (SELECT c_nationkey, b, sha256(string_agg(c_name, ',' ORDER BY c_name)) AS d FROM b GROUP BY ALL)
    SELECT c_nationkey, sha256(string_agg(d, ',' ORDER BY b)) AS digest FROM d GROUP BY c_nationkey""")
def canonical_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each group that no order of rows changes."""
    return A.canonical_hash(table(spark, sf_dir, "customer"), "c_nationkey", "c_name")


@query("SELECT r_name, string_agg(n_nationkey, ',' ORDER BY n_nationkey) AS children, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def struct_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(A.ordered_concat("n_nationkey", ["n_nationkey"]).alias("children"), F.count("*").alias("n"))


@query("SELECT o_custkey, string_agg(DISTINCT o_orderstatus, '+' ORDER BY o_orderstatus) AS combo FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
def combo_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted combinations of two parents or more."""
    found = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s")).filter(F.size("s") > 1)
    return found.select("o_custkey", F.array_join(F.array_sort("s"), "+").alias("combo"))


@query("""
    SELECT 'union' AS op, count(*) AS n FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)
    UNION ALL SELECT 'except', count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 EXCEPT SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)
    UNION ALL SELECT 'intersect', count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 INTERSECT SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)
    UNION ALL SELECT 'except_lines', count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_linenumber < 3 EXCEPT SELECT l_partkey FROM lineitem WHERE l_linenumber > 5)""")
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    a, b = keys.filter("o_orderkey % 2 = 0"), keys.filter("o_orderkey % 3 = 0")
    named = lambda df, op: df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber")
    repeated = named(lines.filter("l_linenumber < 3").select("l_partkey").subtract(lines.filter("l_linenumber > 5").select("l_partkey")), "except_lines")
    return repeated.unionByName(named(a.unionByName(b), "union")).unionByName(named(a.subtract(b), "except")).unionByName(named(a.intersect(b), "intersect"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200")
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").offset(200).limit(100)


@query("SELECT p_partkey, p_name, (SELECT count(*) FROM part WHERE p_size > 40) AS total FROM part WHERE p_size > 40 ORDER BY p_partkey LIMIT 3")
def dry_run_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").filter("p_size > 40")
    return rows.select("p_partkey", "p_name").orderBy("p_partkey").limit(3).join(F.broadcast(rows.agg(F.count("*").alias("total"))))  # one row is broadcast
