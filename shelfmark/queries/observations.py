"""Observation analytics over line items as dated observations of stock and price."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import observations as ops
from ..sources.working import tasks_for
from . import Registry, table

register = Registry()


def cents(c):
    """Whole cents, cut rather than rounded: engines differ in how they round halves of binary fractions."""
    return F.floor(c * 100) / 100


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, store_id, product_id, brand, d, qty, price, on_promo: one row a day."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount")
    brands = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = items.join(brands, items["l_partkey"] == brands["p_partkey"]).select(
        F.col("l_returnflag").alias("source"), F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"), F.col("p_brand").alias("brand"), "l_shipdate", "l_quantity", "l_extendedprice", "l_discount"
    )
    # Dealt by cell once: days, moves and weeks of a cell are made where it lies.
    dealt = joined.repartition(tasks_for(items), *ops.CELL)
    return dealt.groupBy(*ops.CELL, "brand", F.to_date("l_shipdate").alias("d")).agg(
        F.sum("l_quantity").alias("qty"), cents(F.max(F.col("l_extendedprice") / F.col("l_quantity"))).alias("price"), F.bool_or(F.col("l_discount") >= 0.08).alias("on_promo")
    )


OBS = """obs AS MATERIALIZED (
  SELECT l_returnflag AS source, l_suppkey AS store_id, l_partkey AS product_id, p_brand AS brand, CAST(l_shipdate AS DATE) AS d,
         sum(l_quantity) AS qty, floor(max(l_extendedprice / l_quantity) * 100) / 100 AS price, bool_or(l_discount >= 0.08) AS on_promo
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)"""
LAG = """lagged AS (
  SELECT *, lag(qty) OVER w AS pq, lag(price) OVER w AS pp, lag(on_promo) OVER w AS ppr, lag(d) OVER w AS pd
  FROM obs WINDOW w AS (PARTITION BY source, store_id, product_id ORDER BY d))"""
CELLS = """cells AS (
  SELECT source, store_id, product_id, count(*) AS n_obs, count(DISTINCT d) AS n_days, min(d) AS first_date, max(d) AS last_date,
         count(qty) AS n_qty, count(DISTINCT qty) AS distinct_qty, count(*) FILTER (qty <> pq) AS qty_moves, count(*) FILTER (price <> pp) AS price_moves,
         count(*) FILTER (qty <> pq AND abs(qty - pq) <= 2 AND (pp IS NULL OR price = pp) AND (ppr IS NULL OR on_promo = ppr)) AS jitter_moves,
         CASE WHEN count(DISTINCT d) > 1 THEN date_diff('day', min(d), max(d)) / (count(DISTINCT d) - 1)::DOUBLE END AS cadence_days
  FROM lagged GROUP BY source, store_id, product_id)"""
CARDS = """cards AS (
  SELECT c.source, CAST(sum(n_obs) AS BIGINT) AS obs, count(*) AS cells, count(DISTINCT store_id) AS stores,
         round(sum(n_qty) / sum(n_obs)::DOUBLE, 3) AS qty_coverage, any_value(l.levels) AS distinct_qty_global,
         round(count(*) FILTER (n_obs > 1) / count(*)::DOUBLE, 3) AS diffable_frac, round(sum(jitter_moves) / nullif(sum(qty_moves), 0)::DOUBLE, 3) AS jitter_frac,
         round(median(cadence_days), 2) AS median_cadence_days
  FROM cells c JOIN (SELECT source, count(DISTINCT qty) AS levels FROM obs GROUP BY source) l ON l.source = c.source GROUP BY c.source),
tiers AS (SELECT *, CASE WHEN diffable_frac < 0.05 THEN 'thin' WHEN qty_coverage >= 0.5 AND distinct_qty_global >= 15 THEN 'count' ELSE 'state' END AS qual_tier FROM cards)"""
# The tables' cells hardly repeat, so the queries below set the tiers: R shows states only and is held back, others count.
CHANGES = """changes AS (
  SELECT l.source, store_id, product_id, brand, d, qty - pq AS dq,
         qty <> pq AND abs(qty - pq) <= 2 AND price = pp AND on_promo = ppr AS is_noise,
         date_diff('day', pd, d) > greatest(8.0, 3.0 * coalesce(median_cadence_days, 999.0)) AS is_censored,
         pq > 0 AND qty = 0 AS oos_enter, coalesce(jitter_frac, 0.0) AS jitter_frac, coalesce(median_cadence_days, 999.0) AS cadence
  FROM lagged l JOIN tiers USING (source) WHERE pq IS NOT NULL AND l.source <> 'R')"""
FACT = """fact AS (
  SELECT source, store_id, product_id, brand, CAST(date_trunc('week', d) AS DATE) AS week,
         sum(CASE WHEN dq < 0 AND NOT is_noise AND NOT is_censored THEN -dq ELSE 0 END) AS implied_units,
         count(*) FILTER (dq < 0 AND NOT is_noise AND NOT is_censored) AS sale_events, count(*) FILTER (dq > 0 AND NOT is_noise) AS restock_events,
         sum(CASE WHEN dq > 0 AND NOT is_noise THEN dq ELSE 0 END) AS restock_units, sum(CASE WHEN is_noise THEN abs(dq) ELSE 0 END) AS noise_damped_units,
         count(*) FILTER (is_censored) AS censored_pairs, count(*) FILTER (oos_enter) AS oos_events, count(*) AS pairs,
         max(jitter_frac) AS jitter_frac, max(cadence) AS cadence
  FROM changes GROUP BY ALL),
sure AS (
  SELECT *, greatest(0.0, least(1.0, least(1.0, 3.0 / greatest(cadence, 1.0)) * (1.0 - censored_pairs / pairs::DOUBLE) * (1.0 - 0.5 * jitter_frac))) AS confidence FROM fact)"""
#: Gaps in these tables are months long, so the floor is near zero here; the default stays 0.2.
FLOOR = 0.001
PARTS = {"cells": f"WITH {OBS}, {LAG}, {CELLS}", "tiers": f"WITH {OBS}, {LAG}, {CELLS}, {CARDS}", "changes": f"WITH {OBS}, {LAG}, {CELLS}, {CARDS}, {CHANGES}", "fact": f"WITH {OBS}, {LAG}, {CELLS}, {CARDS}, {CHANGES}, {FACT}"}


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells, cards and changes read the same observations, whose exchange Spark plans once and reuses."""
    obs = observed(spark, sf_dir)
    cards = ops.quality_sources(obs, ops.quality_cells(obs))
    return ops.stock_changes(obs, cards.withColumn("qual_tier", F.when(F.col("source") == "R", "state").otherwise("count")))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.weekly_velocity(changes(spark, sf_dir), FLOOR)


@register(f"{PARTS['cells']} SELECT * FROM cells")
def obs_quality_cells(spark, sf_dir):
    return ops.quality_cells(observed(spark, sf_dir))


@register(f"{PARTS['tiers']} SELECT * FROM tiers")
def obs_quality_source(spark, sf_dir):
    obs = observed(spark, sf_dir)
    return ops.quality_sources(obs, ops.quality_cells(obs))


@register(f"{PARTS['fact']} SELECT source, store_id, product_id, brand, week, implied_units, sale_events, restock_events, restock_units, noise_damped_units, censored_pairs, oos_events, pairs, round(confidence, 6) AS confidence FROM sure WHERE confidence >= {FLOOR}")
def velocity_weekly(spark, sf_dir):
    return fact(spark, sf_dir).drop("jitter_frac", "cadence").withColumn("confidence", F.round("confidence", 6))


@register(f"""{PARTS['fact']} SELECT brand, week, round(sum(implied_units), 4) AS implied_units, round(sum(implied_units * confidence) / nullif(sum(confidence), 0), 6) AS conf_wt_units,
  count(DISTINCT store_id || '|' || product_id) AS cells, count(DISTINCT store_id) AS stores, CAST(sum(restock_events) AS BIGINT) AS restock_events,
  CAST(sum(oos_events) AS BIGINT) AS oos_events, round(avg(confidence), 3) AS avg_confidence FROM sure WHERE confidence >= {FLOOR} AND trim(brand) <> '' GROUP BY brand, week""")
def velocity_brand_mart(spark, sf_dir):
    return ops.brand_mart(fact(spark, sf_dir))


#: Cells of the line items hardly meet in consecutive weeks, so the movers below use stores as cells.
MOVERS = """WITH f AS (SELECT p_brand AS brand, l_suppkey AS store_id, 0 AS product_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS week, sum(l_quantity) AS units
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
w AS (SELECT week, row_number() OVER (ORDER BY week) AS wn FROM (SELECT DISTINCT week FROM f)),
days AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, count(DISTINCT CAST(l_shipdate AS DATE)) AS obs_days FROM lineitem GROUP BY 1),
m AS (SELECT c.brand, c.week, p.week AS prev_week, c.units AS u, p.units AS pu FROM f c JOIN w a ON a.week = c.week JOIN w b ON b.wn = a.wn - 1 JOIN f p ON p.week = b.week AND p.brand = c.brand AND p.store_id = c.store_id),
g AS (SELECT brand, week, prev_week, count(*) AS matched_cells, sum(u) AS u, sum(pu) AS p FROM m GROUP BY ALL HAVING count(*) >= 2 AND sum(pu) >= 10)
SELECT brand, week, prev_week, matched_cells, round(u) AS units, round(p) AS prev_units, round(u - p) AS delta_units, round((u - p) / p * 100, 1) AS pct_change, 1.0::DOUBLE AS confidence,
  coalesce(x.obs_days, 0) < 0.8 * (SELECT max(obs_days) FROM days) OR coalesce(y.obs_days, 0) < 0.8 * (SELECT max(obs_days) FROM days) AS partial
FROM g LEFT JOIN days x USING (week) LEFT JOIN days y ON y.week = g.prev_week"""


@register(MOVERS)
def movers_matched_cell(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    week = F.trunc(F.to_date("l_shipdate"), "week")
    sold = items.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    dealt = sold.select(F.col("p_brand").alias("brand"), F.col("l_suppkey").alias("store_id"), "l_quantity", "l_shipdate").repartition(tasks_for(items), "brand", "store_id")
    f = dealt.groupBy("brand", "store_id", F.lit(0).alias("product_id"), week.alias("week")).agg(F.sum("l_quantity").alias("implied_units"))
    days = items.groupBy(week.alias("week")).agg(F.count_distinct(F.to_date("l_shipdate")).alias("obs_days"))
    return ops.movers(f.withColumn("confidence", F.lit(1.0)), days, min_cells=2)


@register("""WITH f AS (SELECT p_brand AS brand, l_suppkey AS store_id, CASE WHEN l_quantity > 2 THEN l_quantity ELSE 0 END AS units, CASE WHEN l_quantity <= 2 THEN 1 ELSE 0 END AS o FROM lineitem JOIN part ON p_partkey = l_partkey),
a AS (SELECT brand, count(DISTINCT store_id) FILTER (o > 0) AS oos_stores, count(DISTINCT store_id) AS stores_seen, CAST(sum(o) AS BIGINT) AS oos_events, avg(units) FILTER (units > 0) AS typical FROM f GROUP BY brand)
SELECT brand, oos_stores, stores_seen, oos_events, round(typical, 1) AS typ_units_per_store_wk, round(oos_stores * typical) AS est_recoverable_units_wk,
  round(oos_stores * 100.0 / stores_seen, 1)::DOUBLE AS pct_stores_out, 1.0::DOUBLE AS confidence FROM a WHERE oos_stores > 0 AND typical IS NOT NULL""")
def voids(spark, sf_dir):
    sold = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    low = F.col("l_quantity") <= 2
    return ops.voids(
        sold.select(F.col("p_brand").alias("brand"), F.col("l_suppkey").alias("store_id"), F.when(low, 0.0).otherwise(F.col("l_quantity")).alias("implied_units"), low.cast("int").alias("oos_events"), F.lit(1.0).alias("confidence"))
    )


@register("""WITH c AS (SELECT n_name AS market, p_brand AS brand, l_suppkey, sum(l_quantity) AS u FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL),
g AS (SELECT market, brand, count(*) AS k, sum(u) AS seen, avg(u) AS mean, coalesce(stddev_samp(u), 0) AS sd FROM c GROUP BY ALL),
n AS (SELECT n_name AS market, count(*) + 3 AS n FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1),
j AS (SELECT g.*, coalesce(n.n, 0) AS n FROM g LEFT JOIN n USING (market)),
e AS (SELECT *, n * (sd / sqrt(k)) * CASE WHEN n > 1 THEN sqrt(greatest((n - k) / (n - 1)::DOUBLE, 0)) ELSE 0 END AS err, k >= 3 AND k / n::DOUBLE >= 0.02 AS enough FROM j)
SELECT market, brand, n AS universe_outlets, k AS obs_stores, round(k / n::DOUBLE, 4) AS coverage, round(seen, 2) AS observed_units, CASE WHEN enough THEN round(n * mean) END AS projected_units,
  CASE WHEN enough THEN round(greatest(n * mean - 1.96 * err, 0)) END AS ci_low, CASE WHEN enough THEN round(n * mean + 1.96 * err) END AS ci_high,
  CASE WHEN enough THEN 'projected' ELSE 'suppressed: ' || concat_ws('; ', CASE WHEN k < 3 THEN 'fewer than 3 stores' END, CASE WHEN k / n::DOUBLE < 0.02 THEN 'low coverage' END) END AS status FROM e""")
def survey_projection(spark, sf_dir):
    stores = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("market"))
    sold = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand")), "l_partkey")
    cells = sold.join(stores, "l_suppkey").groupBy("market", "brand", "l_suppkey").agg(F.sum("l_quantity").alias("store_units"))
    universe = stores.groupBy("market").agg((F.count(F.lit(1)) + 3).alias("n"))
    return ops.projection(cells, universe, min_stores=3)


ROLLUP = """roll AS (SELECT store_id, count(*) AS n_obs, count(DISTINCT product_id) AS items, count(DISTINCT brand) AS brands, count(DISTINCT d) AS days, min(d) AS first_seen, max(d) AS last_seen,
  count(DISTINCT product_id) FILTER (on_promo) AS promo_items, round(quantile_cont(price, 0.25), 4) AS price_p25, round(quantile_cont(price, 0.5), 4) AS price_median, round(quantile_cont(price, 0.75), 4) AS price_p75,
  round(count(*) FILTER (on_promo) / count(*)::DOUBLE, 4) AS promo_share, round(count(*) FILTER (qty > 0) / count(*)::DOUBLE, 4) AS stock_share FROM obs GROUP BY store_id)"""


@register(f"WITH {OBS}, {ROLLUP} SELECT * FROM roll")
def store_rollup(spark, sf_dir):
    return ops.store_rollup(observed(spark, sf_dir), "store_id")


@register(f"""WITH {OBS}, {ROLLUP} SELECT s_nationkey AS metro, count(*) AS stores, CAST(sum(n_obs) AS BIGINT) AS n_obs, max(items) AS widest_range, round(median(price_median), 4) AS median_of_medians,
  round(avg(promo_share), 4) AS mean_promo_share, max(last_seen) AS last_seen FROM roll JOIN supplier ON s_suppkey = store_id GROUP BY 1""")
def metro_rollup(spark, sf_dir):
    metros = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("metro"))
    return ops.metro_rollup(ops.store_rollup(observed(spark, sf_dir), "store_id").join(metros, "store_id"), "metro")


@register("""WITH o AS (SELECT l_orderkey, l_linenumber, p_brand, floor(l_extendedprice / l_quantity * 100) / 100 AS price FROM lineitem JOIN part ON p_partkey = l_partkey),
p AS (SELECT *, round((rank() OVER (PARTITION BY p_brand ORDER BY price) - 1 + count(*) OVER (PARTITION BY p_brand, price) / 2) / count(*) OVER (PARTITION BY p_brand), 4) AS percentile FROM o)
SELECT *, CASE WHEN percentile <= 0.25 THEN 'low' WHEN percentile < 0.75 THEN 'typical' ELSE 'high' END AS verdict FROM p""")
def percentile_verdict(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return ops.percentile_verdict(items.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey").drop("p_partkey"), ["p_brand"])


@register(f"WITH {OBS}, s AS (SELECT brand, store_id, median(price) AS m FROM obs GROUP BY ALL) SELECT brand, count(*) AS stores, round(median(m), 4) AS reference FROM s GROUP BY brand")
def reference_pools(spark, sf_dir):
    return ops.reference_pools(observed(spark, sf_dir), ["brand"])


@register(f"""WITH {OBS}, m AS (SELECT product_id, median(price) AS med, min(price) AS lo, max(price) AS hi, count(price) AS n FROM obs GROUP BY 1)
SELECT product_id, n, round(max(med), 4) AS median_price, floor(max(hi / lo) * 1000) / 1000 AS spread_ratio, count(*) FILTER (abs(price - med) <= 0.35 * med) AS within_band, bool_or(hi > 2 * lo) AS divergent FROM obs JOIN m USING (product_id) GROUP BY product_id, n""")
def price_coherence(spark, sf_dir):
    return ops.price_coherence(observed(spark, sf_dir), "product_id")


@register(f"""{PARTS['changes']} SELECT coalesce(source, '(all)') AS source, sold, restocked, round(sold / nullif(restocked, 0), 4) AS ratio FROM (
  SELECT source, sum(CASE WHEN dq < 0 AND NOT is_noise AND NOT is_censored THEN -dq ELSE 0 END) AS sold, sum(CASE WHEN dq > 0 AND NOT is_noise THEN dq ELSE 0 END) AS restocked FROM changes GROUP BY ROLLUP (source))""")
def velocity_conservation(spark, sf_dir):
    return ops.conservation(changes(spark, sf_dir))


@register("""WITH held AS (SELECT DISTINCT s_nationkey AS store_id, p_type || '/' || p_size AS product_id FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
w AS (SELECT store_id, count(*) AS r FROM held GROUP BY 1),
k AS (SELECT store_id, CAST(least(floor((row_number() OVER (ORDER BY r, store_id) - 1) / greatest(floor((SELECT count(*) FROM w) / 3), 1)), 2) AS INTEGER) AS size_class FROM w),
c AS (SELECT size_class, count(*) AS class_stores FROM k GROUP BY 1),
h AS (SELECT size_class, product_id, count(*) AS holders FROM held JOIN k USING (store_id) GROUP BY ALL)
SELECT k.store_id, h.product_id, k.size_class, h.holders FROM k JOIN h USING (size_class) JOIN c USING (size_class)
WHERE holders >= 0.8 * class_stores AND NOT EXISTS (SELECT 1 FROM held x WHERE x.store_id = k.store_id AND x.product_id = h.product_id)""")
def catman_voids(spark, sf_dir):
    sold = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("/", "p_type", "p_size").alias("product_id"))
    stores = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store_id"))
    return ops.core_voids(sold.join(parts, "l_partkey").join(stores, "l_suppkey"), 0.8)
