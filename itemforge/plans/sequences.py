"""Ordered sequences: checks, fills, numbering, frames, retention, natural order; bound to conversations, events and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itemforge.operators import windows as W
from itemforge.plans.registry import query, table

CONV, TURN = ["conv_id"], ["turn"]
USER, TIME = ["user_id"], ["ts", "event_id"]


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")


@query("SELECT conv_id, turn, turn <> lag(turn) OVER w + 1 AS breaks FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def seq_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a row's number doesn't follow its predecessor's; null for the first."""
    return _turns(spark, sf_dir).select("conv_id", "turn", (F.col("turn") != F.lag("turn").over(Window.partitionBy(*CONV).orderBy(*TURN)) + 1).alias("breaks"))


@query("""
    WITH s AS (SELECT event_id, user_id, ts, event_id AS first, CASE WHEN event_id % 4 > 0 THEN event_id + CAST(floor(value * 20) AS BIGINT) END AS last FROM events)
    SELECT event_id, before, coalesce(first < before, false) AS overlaps FROM (SELECT *, last_value(last IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)""")
def span_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a span begins before the last known end."""
    rows = _events(spark, sf_dir).withColumn("last", F.when(F.col("event_id") % 4 > 0, F.col("event_id") + F.floor(F.col("value") * 20)))
    return rows.withColumn("before", W.previous("last", USER, TIME)).select("event_id", "before", F.coalesce(F.col("event_id") < F.col("before"), F.lit(False)).alias("overlaps"))


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS stem FROM conversations")
def ffill_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).select("conv_id", "turn", W.carried(F.when(F.col("role") == "user", F.col("turn")), CONV, TURN).alias("stem"))


@query("""
    WITH x AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pos FROM lineitem),
        n AS (SELECT *, CAST(pos + max(l_linenumber - pos) OVER (PARTITION BY l_orderkey ORDER BY pos ROWS UNBOUNDED PRECEDING) AS INT) AS n FROM x)
    SELECT l_orderkey, CAST(pos - 1 AS INT) AS pos, n, coalesce(l_linenumber <= lag(n) OVER (PARTITION BY l_orderkey ORDER BY pos), false) AS reset FROM n""")
def renumber_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers made ascending; a number that falls back is reset, the first one never is."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    numbers = rows.withColumn("pos", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")) - 1)
    return W.renumbered_rows(numbers, "l_linenumber", ["l_orderkey"], ["pos"]).select("l_orderkey", "pos", "n", "reset")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY role, turn) AS n FROM conversations")
def resequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).select("conv_id", "turn", F.row_number().over(Window.partitionBy(*CONV).orderBy("role", "turn")).cast("long").alias("n"))


@query("""
    SELECT l_orderkey, CAST(missing AS INT) AS missing FROM (SELECT l_orderkey, unnest(range(1, max(l_linenumber) + 1)) AS missing FROM lineitem GROUP BY l_orderkey) g
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = g.l_orderkey AND l.l_linenumber = g.missing)""")
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.gaps(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("""
    SELECT conv_id, turn, next, CASE WHEN next > 1 THEN next - 1 END AS inferred
    FROM (SELECT *, first_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM conversations)""")
def lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next number that is known, and the one inferred from it."""
    found = _turns(spark, sf_dir).withColumn("next", W.following(F.when(F.col("role") == "assistant", F.col("turn")), CONV, TURN))
    return found.select("conv_id", "turn", "next", F.when(F.col("next") > 1, F.col("next") - 1).alias("inferred"))


@query("SELECT event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS DISTINCT FROM event_type")
def adjacent_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.adjacent_distinct(_events(spark, sf_dir), "event_type", USER, TIME).select("event_id", "event_type")


@query("""
    WITH x AS (SELECT *, CASE WHEN event_id % 5 > 0 THEN value END AS v FROM events)
    SELECT event_id, round(coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 5,
        first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - 5), 4) AS value FROM x""")
def impute_prev_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing value from the one before, else from the one after."""
    rows = _events(spark, sf_dir).withColumn("v", F.when(F.col("event_id") % 5 > 0, F.col("value")))
    return rows.select("event_id", F.round(F.coalesce("v", W.previous("v", USER, TIME) + 5, W.following("v", USER, TIME) - 5), 4).alias("value"))


@query("""
    SELECT event_id, coalesce(bool_or(event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND 8 FOLLOWING), false) AS soon FROM events""")
def range_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a mark stands among the next eight rows."""
    near = F.bool_or(F.col("event_type") == "purchase").over(Window.partitionBy(*USER).orderBy(*TIME).rowsBetween(1, 8))
    return _events(spark, sf_dir).select("event_id", F.coalesce(near, F.lit(False)).alias("soon"))


@query("""
    SELECT conv_id, turn, least(coalesce(next, top + 1), turn + 2) AS ends FROM (
        SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS top FROM conversations) WHERE role = 'user')""")
def segment_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment ends where the next begins, or at a nearer boundary."""
    rows = _turns(spark, sf_dir).withColumn("top", F.max("turn").over(Window.partitionBy(*CONV))).filter("role = 'user'")
    after = F.lead("turn").over(Window.partitionBy(*CONV).orderBy(*TURN))
    return rows.select("conv_id", "turn", F.least(F.coalesce(after, F.col("top") + 1), F.col("turn") + 2).alias("ends"))


@query("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 5")
def retention5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.retained(_events(spark, sf_dir), USER, [F.col(c).desc() for c in TIME], 5).select("event_id", "user_id")


@query("""
    SELECT conv_id, n_assistant, n_total, least(greatest(1, n_total - n_short), n_total) AS useful FROM (
        SELECT conv_id, count(*) FILTER (role = 'assistant') AS n_assistant, count(*) AS n_total, count(*) FILTER (length(trim(text)) < 40) AS n_short FROM conversations GROUP BY conv_id)""")
def page_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a kind, and pages that are of use."""
    found = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "assistant").alias("n_assistant"), F.count("*").alias("n_total"), F.count_if(F.length(F.trim("text")) < 40).alias("n_short"))
    return found.select("conv_id", "n_assistant", "n_total", F.least(F.greatest(F.lit(1), F.col("n_total") - F.col("n_short")), "n_total").alias("useful"))


@query("""
    SELECT brand, row_number() OVER (ORDER BY lpad(regexp_extract(brand, '[0-9]+'), 8, '0'), brand) AS n FROM (SELECT DISTINCT p_brand AS brand FROM part)""")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in natural order: runs of digits compare as numbers. Distinct ids alone are numbered."""
    key = F.array_join(F.transform(F.regexp_extract_all("brand", F.lit(r"\d+|\D+"), F.lit(0)), lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 8, "0")).otherwise(x)), "")
    ids = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand")).distinct()
    return W.ranked(ids.withColumn("_key", key), ["_key", "brand"]).select("brand", "n")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 9 END AS place FROM orders")
def roman_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group's place from a fixed order; 9 for others."""
    places = F.create_map(*(F.lit(x) for k, g in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM")) for x in (g, k)))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.try_element_at(places, "o_orderpriority"), F.lit(9)).alias("place"))


@query("SELECT o_custkey, o_orderkey, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 3")
def topk_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", rank.cast("long").alias("n")).filter("n <= 3")
