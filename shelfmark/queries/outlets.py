"""Outlets and items of many sources brought together."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities, outlets as ops
from . import Registry, table

register = Registry()


@register("""WITH u AS (SELECT trim(c_name) AS name, CAST(c_nationkey AS VARCHAR) AS place, c_mktsegment AS kind, 'customers' AS _source, 0 AS r FROM customer UNION ALL SELECT replace(s_name, 'Supplier', 'CUSTOMER'), CAST(s_nationkey AS VARCHAR), NULL, 'suppliers', 1 FROM supplier),
k AS (SELECT *, md5(lower(coalesce(name, '')) || '|' || lower(coalesce(place, ''))) AS outlet_id FROM u), o AS (SELECT *, row_number() OVER (PARTITION BY outlet_id ORDER BY r, name NULLS LAST, place NULLS LAST, kind NULLS LAST) AS rn FROM k)
SELECT name, place, kind, _source, outlet_id FROM o WHERE rn = 1""")
def outlet_union(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("n", F.replace("s_name", F.lit("Supplier"), F.lit("CUSTOMER")))
    sources = {"customers": (table(spark, sf_dir, "customer"), {"name": "c_name", "place": "c_nationkey", "kind": "c_mktsegment"}), "suppliers": (s, {"name": "n", "place": "s_nationkey"})}
    return ops.union_sources(sources, ["name", "place", "kind"], ["name", "place"])


@register("""WITH RECURSIVE k AS (SELECT s_suppkey AS id, s_suppkey % 31 AS phone, CAST(floor(s_acctbal / 300) AS BIGINT) AS addr FROM supplier), e AS (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON a.id <> b.id AND (a.addr = b.addr OR a.phone = b.phone AND a.phone > 24)),
r(id, c) AS (SELECT id, id FROM k UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id WHERE r.c < e.b) SELECT k.id, k.phone, k.addr, min(r.c) AS outlet FROM k JOIN r USING (id) GROUP BY ALL""")
def outlet_identity(spark, sf_dir):
    k = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 31).alias("phone"), F.floor(F.col("s_acctbal") / 300).alias("addr"))
    return ops.identify(k, "id", {"p": F.when(F.col("phone") > 24, F.col("phone")), "a": F.col("addr")})


@register()
def outlet_identity_fuzzy(spark, sf_dir):
    """Exact phones, and alike names in a cell; DuckDB has no Ratcliff-Obershelp ratio, a test holds it against brute force."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat("c_mktsegment", F.lit(" "), (F.col("c_custkey") % 13).cast("string")).alias("name"), F.floor(F.col("c_acctbal") / 40).alias("cell"), (F.col("c_custkey") % 400).alias("phone"))
    return ops.identify_fuzzily(c, "id", {"p": F.when(F.col("phone") > 390, F.col("phone"))}, F.col("cell"), "name")


@register("""WITH p AS (SELECT p_partkey, p_brand, p_name, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS kind, CAST(p_size // 10 AS VARCHAR) AS size FROM part), j AS (SELECT a.p_partkey AS a, b.p_partkey AS b, CASE WHEN a.kind = '' OR b.kind = '' THEN 0 WHEN a.kind = b.kind THEN 1 ELSE -1 END AS k,
  CASE WHEN a.size = b.size THEN 1 ELSE -1 END AS s FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_name = b.p_name AND a.p_partkey < b.p_partkey),
v AS (SELECT CASE WHEN k = -1 OR s = -1 THEN 'apart' WHEN (k = 1)::INT + (s = 1)::INT >= 1 THEN 'same' ELSE 'unknown' END AS verdict FROM j) SELECT verdict, count(*) AS n FROM v GROUP BY 1""")
def tri_state_compare(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", F.when(F.col("p_partkey") % 4 == 0, F.lit("")).otherwise(F.col("p_type")).alias("kind"), F.expr("cast(p_size div 10 as string)").alias("size"))
    pairs = entities.class_counts(p, "p_partkey", ["p_brand", "p_name"], ["kind", "size"])
    return ops.compare(pairs, ["kind", "size"]).groupBy("verdict").agg(F.sum("n").alias("n"))


@register("""WITH c AS (SELECT p_partkey AS member, p_partkey - p_partkey % 5 AS cluster FROM part), d AS (SELECT p_partkey AS member, CASE WHEN p_size > 45 THEN 'split' ELSE 'move' END AS decision, 7::BIGINT AS target FROM part WHERE p_size > 40)
SELECT member, CASE decision WHEN 'move' THEN target WHEN 'split' THEN member ELSE cluster END AS cluster, decision IS NOT NULL AS decided FROM c LEFT JOIN d USING (member)""")
def cluster_decisions(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    c = part.select(F.col("p_partkey").alias("member"), (F.col("p_partkey") - F.col("p_partkey") % 5).alias("cluster"))
    d = part.filter("p_size > 40").select(F.col("p_partkey").alias("member"), F.when(F.col("p_size") > 45, "split").otherwise("move").alias("decision"), F.lit(7).cast("long").alias("target"))
    return ops.apply_decisions(c, d)


@register("""WITH g AS (SELECT p_brand, max(p_size) - min(p_size) AS d FROM part WHERE p_type <> 'SMALL' GROUP BY 1) SELECT p_partkey, CASE WHEN d > 20 THEN p_brand || '#' || CAST(floor(p_size / 20.0 + 0.5) AS BIGINT) ELSE p_brand END AS split_group FROM part JOIN g USING (p_brand) WHERE p_type <> 'SMALL'""")
def value_split(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter("p_type <> 'SMALL'").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("p_size"))
    return ops.split_by_value(p, "p_brand", "p_size", 20.0).select("p_partkey", "split_group")


@register("""WITH o AS (SELECT s_nationkey, CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_acctbal > 5000 END AS f FROM supplier)
SELECT coalesce(CAST(n_regionkey AS VARCHAR), '(unknown)') AS metro, count(*) AS doors, count(*) FILTER (f) AS yes, count(*) FILTER (NOT f) AS no, count(*) FILTER (f IS NULL) AS unknown FROM o LEFT JOIN nation ON n_nationkey = s_nationkey GROUP BY 1""")
def metro_counts(spark, sf_dir):
    o = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.when(F.col("s_acctbal") >= 1000, F.col("s_acctbal") > 5000).alias("f"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_regionkey")
    return ops.metro_counts(o, n, "k", "n_regionkey", "f")


@register("""WITH l AS (SELECT l_suppkey, l_partkey, max(CAST(l_shipdate AS DATE)) AS day FROM lineitem GROUP BY ALL), v AS (SELECT l_partkey, sum(l_quantity) AS sold FROM lineitem GROUP BY 1)
SELECT l.l_partkey, l.l_suppkey, l.day, s_nationkey, v.sold, p_brand FROM l LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN v USING (l_partkey) LEFT JOIN part ON p_partkey = l_partkey""")
def offers_assembly(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    latest = l.groupBy("l_suppkey", "l_partkey").agg(F.max(F.to_date("l_shipdate")).alias("day"))
    geo = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    sold = l.groupBy("l_partkey").agg(F.sum("l_quantity").alias("sold"))
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return ops.assemble_offers(latest, (geo, ["l_suppkey"]), (sold, ["l_partkey"]), (names, ["l_partkey"]))


@register("""WITH r AS (SELECT event_type AS build, max(ts) FILTER (value < 30) AS last_try, max(ts) FILTER (value > 80) AS fresh FROM events GROUP BY 1)
SELECT build, 1.0::DOUBLE AS gap_hours, last_try, fresh, coalesce(fresh IS NOT NULL AND (last_try IS NULL OR (fresh > last_try AND (floor(epoch(fresh)) - floor(epoch(last_try))) / 3600 >= 1)), false) AS due FROM r""")
def due_builds(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("build"), F.col("ts").cast("timestamp").alias("ts"), "value")
    builds = e.select("build").distinct().withColumn("gap_hours", F.lit(1.0))
    d = ops.due(builds, e.filter("value < 30").select("build", F.col("ts").alias("at")), e.filter("value > 80").select("build", F.col("ts").alias("ok_at")))
    return d.select("build", "gap_hours", F.col("last_try").cast("timestamp_ntz").alias("last_try"), F.col("fresh").cast("timestamp_ntz").alias("fresh"), "due")


@register("""WITH f AS (SELECT o_orderpriority AS "check", CASE WHEN o_orderpriority < '3' THEN 0.5 ELSE round(o_totalprice / 500000, 1) END AS confidence FROM orders)
SELECT "check", count(*) AS hits, count(DISTINCT confidence) AS levels, count(*) > 0.05 * (SELECT count(*) FROM orders) AND count(DISTINCT confidence) = 1 AS misfire FROM f GROUP BY 1""")
def misfire_guard(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    f = o.select(F.col("o_orderpriority").alias("check"), F.when(F.col("o_orderpriority") < "3", 0.5).otherwise(F.round(F.col("o_totalprice") / 500000, 1)).alias("confidence"))
    return ops.misfires(f, o.count())


def fuzzy_item_scores(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    likely = lambda names: ops.item_score(names, "p_name_a", "p_name_b").filter("score >= 0.5")
    return entities.class_pairs(p, "p_partkey", ["p_brand", "p_type"], "p_name", likely)


register()(fuzzy_item_scores)
