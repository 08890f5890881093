"""Names and accounts resolved against masters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import products
from ..operators import matching as ops
from ..operators.windows import numbered
from . import Registry, table

register = Registry()


@register("""WITH m AS (SELECT DISTINCT p_brand, p_name, p_type, dense_rank() OVER (ORDER BY p_name) AS cluster FROM part), f AS (SELECT p_partkey AS id, p_brand, replace(p_name, 'e', '') AS p_name FROM part),
s AS (SELECT f.id, m.cluster, jaro_winkler_similarity(f.p_name, m.p_name) AS s FROM f JOIN (SELECT DISTINCT p_brand, p_name, cluster FROM m) m USING (p_brand)), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, cluster) AS rn FROM s WHERE s >= 0.9)
SELECT f.id, f.p_brand, f.p_name, r.cluster, round(r.s, 4) AS similarity FROM f LEFT JOIN r ON r.id = f.id AND rn = 1""")
def incremental_assignment(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    # Names' places in their order name the clusters.
    m = part.select("p_brand", "p_name").distinct().join(numbered(part.select("p_name").distinct(), F.col("p_name"), name="cluster"), "p_name")
    fresh = part.select(F.col("p_partkey").alias("id"), "p_brand", F.replace("p_name", F.lit("e"), F.lit("")).alias("p_name"))
    return ops.assign_to_clusters(fresh, m, "p_brand", "p_name")


@register("""SELECT p_brand, p_name, count(*) AS n, count(DISTINCT nullif(code, '')) AS codes, count(*) FILTER (code = '') AS blank, CASE WHEN count(DISTINCT nullif(code, '')) <= 1 THEN 'high' WHEN count(DISTINCT nullif(code, '')) = 2 THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT p_brand, p_name, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_partkey % 7 AS VARCHAR) END AS code FROM part) GROUP BY ALL HAVING count(*) > 1 AND (count(DISTINCT nullif(code, '')) > 1 OR count(*) FILTER (code = '') > 0)""")
def merge_candidates(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_name", F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise((F.col("p_partkey") % 7).cast("string")).alias("code"))
    return ops.merge_candidates(p, ["p_brand", "p_name"], "code")


@register("""WITH c AS (SELECT p_partkey, p_brand AS brand, p_size AS size FROM part), m AS (SELECT p_brand AS brand, p_size AS size, max(CAST(l_shipdate AS DATE)) AS seen FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand <> 'Brand#2' AND p_type <> 'SMALL' GROUP BY ALL),
j AS (SELECT c.*, m.seen AS e, (SELECT max(seen) FROM m x WHERE x.brand = c.brand) AS l FROM c LEFT JOIN m USING (brand, size)),
s AS (SELECT p_partkey, brand, size, round(CASE WHEN e IS NOT NULL THEN 0.9 WHEN l IS NOT NULL THEN 0.65 ELSE 0.0 END * coalesce(pow(0.5, greatest(date_diff('day', coalesce(e, l), DATE '2001-12-31'), 0) / 180.0), 0.0), 4)::DOUBLE AS score FROM j)
SELECT *, CASE WHEN score >= 0.6 THEN 1 WHEN score > 0 THEN 2 ELSE 3 END AS tier FROM s""")
def market_tiering(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    c = part.select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    sold = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("seen"))
    m = part.filter("p_brand <> 'Brand#2' and p_type <> 'SMALL'").join(sold, "p_partkey").select(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), "seen")
    return ops.corroborate(c, m, "brand", "size", F.lit("2001-12-31").cast("date"), "seen").select("p_partkey", "brand", "size", "score", "tier")


@register("""WITH d AS (SELECT unnest(['red', 'red widget', 'widget', 'bolt', 'small ring']) AS term), j AS (SELECT p_partkey, p_name, term, row_number() OVER (PARTITION BY p_partkey ORDER BY length(term) DESC, term DESC) AS rn FROM part LEFT JOIN d ON ' ' || p_name || ' ' LIKE '% ' || term || ' %')
SELECT p_partkey, p_name, term AS match FROM j WHERE rn = 1""")
def longest_dictionary_match(spark, sf_dir):
    d = spark.createDataFrame([(t,) for t in ("red", "red widget", "widget", "bolt", "small ring")], "term string")
    return ops.longest_dictionary_match(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", d, "term")


@register("""WITH f AS (SELECT c_nationkey AS account, CASE WHEN c_nationkey < 12 AND o_totalprice > 60000 THEN '5-LOW' ELSE o_orderpriority END AS owner, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY n DESC, owner DESC) AS rn FROM f)
SELECT account, CASE WHEN max(n) FILTER (rn = 1) >= 20 AND max(n) FILTER (rn = 1) >= 0.6 * sum(n) AND max(n) FILTER (rn = 1) >= 3 * coalesce(max(n) FILTER (rn > 1), 0) THEN max(owner) FILTER (rn = 1) END AS scope, max(n) FILTER (rn = 1) AS votes, CAST(sum(n) AS BIGINT) AS "all", coalesce(max(n) FILTER (rn > 1), 0) AS next FROM r GROUP BY 1""")
def distributor_scope(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    owner = F.when((F.col("c_nationkey") < 12) & (F.col("o_totalprice") > 60000), "5-LOW").otherwise(F.col("o_orderpriority"))
    return ops.scope(o.select(F.col("c_nationkey").alias("account"), owner.alias("owner")), "account", "owner")


@register("""WITH o AS (SELECT c_acctbal % 50 > 25 AS x, substr(c_name, 16, 3) AS k, c_custkey FROM customer WHERE c_acctbal > 0), g AS (SELECT k, count(DISTINCT c_custkey) AS n, min(c_custkey) AS o FROM o GROUP BY 1)
SELECT s_suppkey, substr(s_name, 16, 3) AS k, CASE WHEN n = 1 THEN 'located' WHEN n > 1 THEN 'ambiguous' ELSE 'unlocated' END AS status, CASE WHEN n = 1 THEN o END AS outlet FROM supplier LEFT JOIN g ON g.k = substr(s_name, 16, 3)""")
def venue_resolution(spark, sf_dir):
    outlets = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.substring("c_name", 16, 3).alias("k"), "c_custkey")
    return ops.venue_resolution(table(spark, sf_dir, "supplier").select("s_suppkey", F.substring("s_name", 16, 3).alias("k")), outlets, "k", "c_custkey")


@register("""WITH a AS (SELECT p_brand, p_size, min(p_partkey) AS sku FROM part WHERE p_type = 'SMALL' GROUP BY ALL), b AS (SELECT p_name, min(p_partkey) AS sku FROM part WHERE p_size > 25 GROUP BY ALL)
SELECT p.p_partkey, p.p_brand, p.p_size, p.p_name, coalesce(a.sku, b.sku) AS sku, CASE WHEN a.sku IS NOT NULL THEN 'first' WHEN b.sku IS NOT NULL THEN 'second' END AS via FROM part p LEFT JOIN a USING (p_brand, p_size) LEFT JOIN b USING (p_name)""")
def facts_dual_lookup(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_name", "p_type")
    a = p.filter("p_type = 'SMALL'").groupBy("p_brand", "p_size").agg(F.min("p_partkey").alias("sku"))
    b = p.filter("p_size > 25").groupBy("p_name").agg(F.min("p_partkey").alias("sku"))
    return ops.dual_lookup(p.drop("p_type"), a, ["p_brand", "p_size"], b, ["p_name"], "sku")


@register("SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders JOIN (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS m FROM orders GROUP BY 1) USING (o_custkey) WHERE CAST(o_orderdate AS DATE) = m")
def latest_menu_rows(spark, sf_dir):
    return ops.latest_of_group(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day")), ["o_custkey"], "day")


@register("""WITH p AS (SELECT s_suppkey AS id, s_suppkey % 3 AS src, floor((s_suppkey * 37 % 2000) / 200.0) AS cx, floor((s_suppkey * 91 % 4000) / 400.0) AS cy FROM supplier), c AS (SELECT cx, cy FROM p GROUP BY ALL HAVING count(DISTINCT src) >= 2) SELECT id, src FROM p JOIN c USING (cx, cy)""")
def cells_seen_by_many(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 3).alias("src"))
    cell = F.concat_ws(":", F.floor((F.col("id") * 37 % 2000) / 200.0), F.floor((F.col("id") * 91 % 4000) / 400.0))
    return ops.cells_of_many(p, cell, "src")


@register("""WITH a AS (SELECT c_nationkey AS k, count(*) AS customers, max(c_acctbal) AS top FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS suppliers, max(s_acctbal) AS top FROM supplier GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, customers, coalesce(a.top, b.top) AS top, suppliers FROM a FULL JOIN b ON a.k = b.k""")
def census_pack_merge(spark, sf_dir):
    a = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"), F.max("c_acctbal").alias("top"))
    b = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers"), F.max("s_acctbal").alias("top"))
    return ops.merge_packs([a, b], "k")


@register("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS bal FROM customer), k AS (SELECT o_custkey AS c_custkey, max(o_totalprice) AS bal FROM orders GROUP BY 1) SELECT r.c_custkey, coalesce(r.bal, k.bal) AS bal FROM r LEFT JOIN k USING (c_custkey)""")
def cache_fill(spark, sf_dir):
    r = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    k = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("bal"))
    return ops.fill_once(r, k, ["c_custkey"], ["bal"])


@register("""WITH u AS (SELECT c_custkey, md5(c_name) AS h FROM customer) SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid FROM u""")
def token_to_uuid(spark, sf_dir):
    token = F.translate(F.substring(F.base64(F.unhex(F.md5("c_name"))), 1, 22), "+/", "-_")
    return table(spark, sf_dir, "customer").select("c_custkey", products.uuid_of_token(token).alias("uuid"))


def spelling_merges(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    n = part.groupBy("p_brand", F.when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit("s"))).otherwise(F.col("p_name")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return ops.spelling_merges(n, ["p_brand"], "name", "n", 0.6)


register()(spelling_merges)
