"""Landing, samples, rules on values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import landing as ops
from ..sources.reference import real_index
from . import Registry, table

register = Registry()


@register("""SELECT '2024-05-01' AS date, 'web' AS source, CAST(l_suppkey AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS product_id, l_extendedprice AS price, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS qty,
  CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS promo, CASE WHEN l_linenumber % 2 = 1 THEN '2 for 1' END AS promo_text, CASE l_linestatus WHEN 'O' THEN true WHEN 'F' THEN false END AS in_stock FROM lineitem""")
def typed_observations(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    raw = l.select(
        F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"), F.concat(F.lit("$"), F.col("l_extendedprice").cast("string")).alias("price"), F.when(F.col("l_linenumber") == 1, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("qty"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount").cast("string")).otherwise(F.lit("2 for 1")).alias("promo"), F.when(F.col("l_linestatus") == "O", "Yes").when(F.col("l_linestatus") == "F", "0").alias("in_stock"),
    )
    return ops.typed_observations(raw, "web", "2024-05-01")


@register("SELECT c_custkey, c_name FROM customer WHERE ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 10 = 0")
def stride_sample(spark, sf_dir):
    return ops.stride_sample(table(spark, sf_dir, "customer"), "c_custkey", 10).select("c_custkey", "c_name")


@register("SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 25")
def fixed_sample(spark, sf_dir):
    return ops.fixed_sample(table(spark, sf_dir, "customer"), "c_custkey", 25).select("c_custkey", "c_name")


@register("SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 4")
def field_query_top(spark, sf_dir):
    return ops.field_query(table(spark, sf_dir, "part"), "top", "p_type", 4)


@register("""WITH c AS (SELECT p_partkey, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS code FROM (SELECT p_partkey, ['A' || (p_size % 9) || '-' || (p_partkey % 5) || '-' || p_size, 'odd', 'B-1-' || p_size] AS l FROM part))
SELECT p_partkey, CAST(pos AS INTEGER) AS pos, code, nullif(regexp_extract(code, '^([A-Z]+[0-9]*)-([0-9]+)-([0-9]+)$', 1), '') AS aisle, TRY_CAST(nullif(regexp_extract(code, '^([A-Z]+[0-9]*)-([0-9]+)-([0-9]+)$', 2), '') AS INTEGER) AS shelf, TRY_CAST(nullif(regexp_extract(code, '^([A-Z]+[0-9]*)-([0-9]+)-([0-9]+)$', 3), '') AS INTEGER) AS place FROM c""")
def shelf_positions(spark, sf_dir):
    code = F.concat(F.lit("A"), F.col("p_size") % 9, F.lit("-"), F.col("p_partkey") % 5, F.lit("-"), "p_size", F.lit("|odd|B-1-"), "p_size")
    return ops.shelf_positions(table(spark, sf_dir, "part").select("p_partkey", code.alias("codes")), "p_partkey", "codes")


@register("WITH e AS (SELECT p_brand, unnest(string_split(p_type || ',' || p_name || ', ', ',')) AS x FROM part) SELECT p_brand, string_agg(DISTINCT trim(x), ',' ORDER BY trim(x)) AS l FROM e WHERE trim(x) <> '' GROUP BY 1")
def merge_lists(spark, sf_dir):
    return ops.merge_lists(table(spark, sf_dir, "part").select("p_brand", F.concat("p_type", F.lit(","), "p_name", F.lit(", ")).alias("l")), ["p_brand"], "l")


@register("""WITH g AS (SELECT l_suppkey AS s_suppkey, bool_or(lower(p_name) LIKE '%widget%') AS widgets, bool_or(regexp_matches(lower(p_name), '^blue ring')) AS rings FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT s_suppkey, coalesce(widgets, false) AS widgets, coalesce(rings, false) AS rings FROM supplier LEFT JOIN g USING (s_suppkey)""")
def carried_flags(spark, sf_dir):
    goods = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("s_suppkey"), "p_name")
    return ops.carried_flags(table(spark, sf_dir, "supplier").select("s_suppkey"), goods, "s_suppkey", "p_name", {"widgets": "widget", "rings": "^blue ring"})


@register("SELECT regexp_extract(p_name, '([a-z]+)$', 1) AS image, count(DISTINCT p_partkey) AS products FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) >= 8")
def placeholder_images(spark, sf_dir):
    return ops.repeated_images(table(spark, sf_dir, "part").select(F.regexp_extract("p_name", "([a-z]+)$", 1).alias("image"), "p_partkey"), "image", "p_partkey")


@register("""WITH r AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN '036000291452' ELSE '036000291451' END AS code, p_size * 3.0 AS abv, p_retailprice AS price, 1000.0 AS lp, CASE p_partkey % 3 WHEN 0 THEN 'beer' WHEN 1 THEN 'wine' ELSE 'tea' END AS kind FROM part),
v AS (SELECT unnest(list_filter([CASE WHEN code <> '036000291452' THEN 'code' END, CASE WHEN abv > 100 THEN 'abv_range' END, CASE WHEN kind = 'beer' AND NOT abv BETWEEN 0.5 AND 20 OR kind = 'wine' AND NOT abv BETWEEN 5 AND 24 THEN 'abv_class' END, CASE WHEN price > lp THEN 'above_list' END], lambda x: x IS NOT NULL)) AS rule FROM r)
SELECT rule, count(*) AS n, round(1000 * count(*) / (SELECT count(*) FROM part)::DOUBLE, 3) AS per_1000 FROM v GROUP BY 1""")
def value_rules(spark, sf_dir):
    k = F.col("p_partkey")
    r = table(spark, sf_dir, "part").select(
        F.when(k % 2 == 0, "036000291452").otherwise("036000291451").alias("code"), (F.col("p_size") * 3.0).alias("abv"), F.col("p_retailprice").alias("price"), F.lit(1000.0).alias("lp"), F.when(k % 3 == 0, "beer").when(k % 3 == 1, "wine").otherwise("tea").alias("kind")
    )
    return ops.violation_rates(ops.value_rules(r, "code", "abv", "price", "lp", "kind"))


@register("""SELECT how, count(*) AS n FROM (SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'point' WHEN s_suppkey % 4 = 1 THEN 'address' WHEN s_suppkey % 4 = 2 THEN 'zip' ELSE 'none' END AS how FROM supplier) GROUP BY 1""")
def mappability(spark, sf_dir):
    k = F.col("s_suppkey") % 4
    lat = F.when(k == 0, F.lit(40.0)).when(k == 3, F.lit(0.0))
    how = ops.mappable(lat, lat, F.when(k == 1, F.lit("1 Main St")), F.when(k.isin(1, 2), F.lit("12345")).otherwise(F.lit("")))
    return table(spark, sf_dir, "supplier").groupBy(how.alias("how")).agg(F.count(F.lit(1)).alias("n"))


@register("""WITH u AS (SELECT user_id, max(ts) AS last FROM events GROUP BY 1), h AS (SELECT *, epoch(TIMESTAMP '2024-01-31 00:00:00' - last) / 3600 AS h FROM u) SELECT state, count(*) AS n FROM (SELECT CASE WHEN h <= 6 THEN 'fresh' WHEN h <= 12 THEN 'late' ELSE 'stale' END AS state FROM h) GROUP BY 1""")
def freshness_sla(spark, sf_dir):
    u = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    return u.groupBy(ops.freshness(F.col("last"), F.lit("2024-01-31 00:00:00"), F.lit(6)).alias("state")).agg(F.count(F.lit(1)).alias("n"))


@register("WITH g AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) SELECT o_orderstatus, o_orderpriority, n, round(n / (SELECT count(*) FROM orders)::DOUBLE, 5) AS share FROM g WHERE n < 0.065 * (SELECT count(*) FROM orders)")
def rare_combinations(spark, sf_dir):
    return ops.rare_combinations(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], 0.065)


@register("""WITH s AS (SELECT o_orderpriority AS series, CAST(year(o_orderdate) AS INTEGER) AS year, avg(o_totalprice) AS m FROM orders GROUP BY ALL) SELECT a.series, a.year, round(100 * a.m / b.m, 2) AS "index" FROM s a JOIN s b ON a.series = b.series AND b.year = 1996""")
def real_price_index(spark, sf_dir):
    s = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("value"))
    return real_index(s, 1996)


@register("SELECT n_nationkey, n_name, NULL::VARCHAR AS payload, 'Nation ' || n_name AS moved FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_nationkey, n_name, NULL, NULL FROM nation WHERE n_nationkey % 2 = 1")
def evacuated_column(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("Nation "), "n_name")).otherwise("").alias("payload"))
    slim, fat = ops.evacuate(rows, "n_nationkey", "payload")
    return slim.join(fat.withColumnRenamed("payload", "moved"), "n_nationkey", "left")
