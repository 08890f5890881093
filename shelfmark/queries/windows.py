"""Sequences over events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as ops
from . import Registry, table

register = Registry()


@register("""WITH s AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM s)
SELECT user_id, session, count(*) AS n, min(ts) AS first_at, max(ts) AS last_at FROM t GROUP BY ALL""")
def session_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return ops.session_summary(ops.sessions(events, ["user_id"], "ts", F.col("step") > 6 * 3600), ["user_id"], "ts")


@register("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'purchase') AS promo FROM events GROUP BY ALL),
s AS (SELECT *, promo AND NOT coalesce(lag(promo) OVER (PARTITION BY user_id ORDER BY day), false) AS st FROM d),
g AS (SELECT *, date_diff('day', lag(day) OVER (PARTITION BY user_id ORDER BY day), day) AS gap FROM s WHERE st),
r AS (SELECT user_id, count(*) AS episodes, median(gap) AS median_gap, max(day) AS last_start FROM g GROUP BY 1),
f AS (SELECT user_id, count(*) FILTER (promo) AS flagged_days, max(day) AS last_day FROM d GROUP BY 1)
SELECT user_id, flagged_days, coalesce(episodes, 0) AS episodes, median_gap, last_start, coalesce(date_diff('day', last_start, last_day) >= 0.8 * median_gap, false) AS likely_soon FROM f LEFT JOIN r USING (user_id)""")
def promo_episodes(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.bool_or(F.col("event_type") == "purchase").alias("promo"))
    return ops.episodes(days, ["user_id"], "day", "promo")


@register("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS event_type, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 5 <> 0 THEN props END AS props FROM events)
SELECT user_id, arg_max(event_type, event_id) FILTER (event_type <> '') AS event_type, arg_max(value, event_id) FILTER (value IS NOT NULL) AS value, arg_max(props, event_id) FILTER (props IS NOT NULL) AS props, max(event_id) AS event_id FROM e GROUP BY 1""")
def fold_latest_nonempty(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 4 == 0, None).otherwise(F.col("value")).alias("value"), F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("props"),
    )
    return ops.fold_latest(e, ["user_id"], "event_id", ["event_type", "value", "props"])


@register("""WITH m AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS q FROM orders),
s AS (SELECT o_custkey, unnest(generate_series(min(q), max(q))) AS q FROM m GROUP BY 1)
SELECT o_custkey, CAST(q AS INTEGER) AS q FROM s WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.o_custkey = s.o_custkey AND m.q = s.q)""")
def dq_interior_gaps(spark, sf_dir):
    held = table(spark, sf_dir, "orders").select("o_custkey", (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).alias("q"))
    return ops.interior_gaps(held, ["o_custkey"], "q")


@register("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def latest_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ops.latest(orders, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey"))


@register("SELECT p_brand, p_partkey, p_retailprice, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 5")
def topk_per_group(spark, sf_dir):
    return ops.top_per_group(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], 5, F.desc("p_retailprice"), F.col("p_partkey"))


@register("SELECT p_partkey, p_name, p_size, (SELECT count(*) FROM part) AS total FROM part ORDER BY p_size DESC NULLS LAST, p_partkey LIMIT 50 OFFSET 100")
def paging(spark, sf_dir):
    return ops.page(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), 100, 50, F.desc_nulls_last("p_size"), F.col("p_partkey"))


@register("""WITH b AS (SELECT o_custkey, o_orderpriority AS priority, max(o_totalprice) AS price, max(o_orderstatus) AS status FROM orders WHERE year(o_orderdate) = 1996 GROUP BY ALL),
a AS (SELECT o_custkey, o_orderpriority AS priority, max(o_totalprice) AS price, max(o_orderstatus) AS status FROM orders WHERE year(o_orderdate) = 1997 GROUP BY ALL),
j AS (SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.priority, b.priority) AS priority, a.status AS s1, b.status AS s0, a.o_custkey IS NOT NULL AS ia, b.o_custkey IS NOT NULL AS ib
  FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.priority = b.priority),
e AS (SELECT o_custkey, priority, 'new' AS event, NULL AS old, NULL AS new FROM j WHERE NOT ib UNION ALL SELECT o_custkey, priority, 'delist', NULL, NULL FROM j WHERE NOT ia
  UNION ALL SELECT o_custkey, priority, 'status', s0, s1 FROM j WHERE ia AND ib AND s0 IS DISTINCT FROM s1)
SELECT *, sha1(o_custkey || '|' || priority || '|' || event || '|' || coalesce(old, '') || '|' || coalesce(new, '')) AS event_id FROM e""")
def event_diff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    snap = lambda y: orders.filter(F.year("o_orderdate") == y).groupBy("o_custkey", F.col("o_orderpriority").alias("priority")).agg(F.max("o_orderstatus").alias("status"))
    return ops.snapshot_diff(snap(1996), snap(1997), ["o_custkey", "priority"], ["status"])


@register("SELECT CAST(date_trunc('week', ts) AS DATE) AS window_start, event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 2) AS value FROM events GROUP BY ALL")
def tumbling_week(spark, sf_dir):
    weekly = ops.as_microbatch_window(table(spark, sf_dir, "events"), "ts", 7)
    return weekly.groupBy("window_start", "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 2).alias("value"))


@register("SELECT n_regionkey AS k FROM nation EXCEPT SELECT r_regionkey FROM region WHERE r_regionkey < 3")
def set_difference(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k"))
    return n.distinct().subtract(table(spark, sf_dir, "region").filter("r_regionkey < 3").select(F.col("r_regionkey").alias("k")))


@register("SELECT n_nationkey AS id, n_name AS name, n_regionkey, NULL AS extra FROM nation UNION ALL BY NAME SELECT r_regionkey AS id, 'R' AS extra, r_name AS name FROM region")
def union_by_name(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), "n_regionkey")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.lit("R").alias("extra"), F.col("r_name").alias("name"))
    return n.unionByName(r, allowMissingColumns=True)
