"""Offers, product attributes and markets over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import products, text
from ..operators import masters, offers as ops, quality
from . import Registry, table

register = Registry()

NAMES = """nm AS (SELECT p_partkey, p_name, p_size, p_retailprice, p_name || ' bourbon ' || p_size || ' yr ' || (p_size + 30) || '% 750ml ' || (1 + p_partkey % 6) || ' pack' AS label FROM part)"""


def named(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return p.withColumn("label", F.concat(F.col("p_name"), F.lit(" bourbon "), F.col("p_size"), F.lit(" yr "), F.col("p_size") + 30, F.lit("% 750ml "), 1 + F.col("p_partkey") % 6, F.lit(" pack")))


@register(f"""WITH {NAMES} SELECT p_partkey, CAST(1 + p_partkey % 6 AS INTEGER) AS pack, (p_size + 30)::DOUBLE AS abv, CASE WHEN p_size < 100 THEN CAST(p_size AS INTEGER) END AS age, 750::BIGINT AS ml, 'whiskey' AS class,
  round(p_retailprice * 750.0 / (750 * (1 + p_partkey % 6)), 4) AS unit_price FROM nm""")
def product_attributes(spark, sf_dir):
    c = F.col("label")
    df = named(spark, sf_dir).select("p_partkey", "p_retailprice", products.pack_count(c).alias("pack"), products.abv(c).alias("abv"), products.age(c).alias("age"), text.size_to_ml(F.regexp_extract(c, "([0-9]+ml)", 1)).alias("ml"), products.classify(c).alias("class"))
    return df.select("p_partkey", "pack", "abv", "age", "ml", "class", F.round(products.unit_price(F.col("p_retailprice"), F.col("ml"), F.col("pack")), 4).alias("unit_price"))


@register("""WITH s AS (SELECT p_partkey, (p_partkey % 2000)::DOUBLE AS ml FROM part), b AS (SELECT unnest([50, 100, 187, 200, 250, 330, 355, 375, 473, 500, 700, 720, 750, 1000, 1500, 1750, 3000]) AS size),
r AS (SELECT p_partkey, ml, size, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(size - ml), size) AS rn FROM s, b) SELECT p_partkey, ml, CASE WHEN abs(size - ml) <= 0.03 * size THEN CAST(size AS INTEGER) END AS bucket FROM r WHERE rn = 1""")
def size_buckets(spark, sf_dir):
    ml = (F.col("p_partkey") % 2000).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", ml.alias("ml"), products.size_bucket(ml).alias("bucket"))


@register("""WITH p AS (SELECT p_partkey, p_retailprice AS base, p_size / 10.0 AS gallons FROM part) SELECT p_partkey, round((base + gallons * 15.5) * 1.07, 4) AS landed, round(base / 1.07 - gallons * 15.5, 4) AS pretax,
  round(base - base * 0.6, 4) AS margin, CAST(floor(ceil(1000 / (base - base * 0.6)) / 10) AS BIGINT) AS tens FROM p""")
def tax_and_break_even(spark, sf_dir):
    base, gallons, federal, state, sales = F.col("p_retailprice"), F.col("p_size") / 10.0, F.lit(13.5), F.lit(2.0), F.lit(0.07)
    even = products.break_even(base, base * 0.6, F.lit(1000))
    taxed = (gallons, federal, state, sales)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.round(products.landed_cost(base, *taxed), 4).alias("landed"), F.round(products.pretax_price(base, *taxed), 4).alias("pretax"), F.round(even["margin"], 4).alias("margin"), F.floor(even["units"] / 10).alias("tens"),
    )


@register("""WITH o AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount * 100 AS age, l_tax FROM lineitem)
SELECT signal, count(*) AS n FROM (SELECT CASE WHEN l_tax > 0.06 OR age > 14 THEN 'unknown' WHEN l_quantity <= 0 THEN 'out' WHEN l_quantity / 2.0 < 3 THEN 'hurry' WHEN l_quantity / 2.0 < 10 THEN 'low' ELSE 'ample' END AS signal FROM o) GROUP BY 1""")
def stock_signals(spark, sf_dir):
    s = ops.stock_signal(F.col("l_quantity"), F.lit(14.0), F.col("l_discount") * 100, F.col("l_tax") <= 0.06)
    return table(spark, sf_dir, "lineitem").groupBy(s.alias("signal")).agg(F.count(F.lit(1)).alias("n"))


@register("""WITH o AS (SELECT p_partkey, p_retailprice AS price, (p_partkey % 40)::DOUBLE AS miles, (p_size % 5) / 4.0 AS stock FROM part), e AS (SELECT min(price) AS lo, max(price) AS hi FROM o)
SELECT p_partkey, round(0.5 * (1 - (price - lo) / (hi - lo)) + 0.3 * (1 - least(miles / 25.0, 1.0)) + 0.2 * stock, 6) AS score FROM o, e""")
def blended_ranking(spark, sf_dir):
    o = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"), (F.col("p_partkey") % 40).cast("double").alias("miles"), ((F.col("p_size") % 5) / 4.0).alias("stock"))
    return ops.blend(o, "price", "miles", "stock").select("p_partkey", "score")


@register("""WITH o AS (SELECT p_brand, p_type, 's' || (p_partkey % 4) AS source, p_retailprice AS price, p_partkey FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY price, p_partkey) AS rn FROM o),
a AS (SELECT p_brand, p_type, list_sort(list_distinct(list(source))) AS l FROM o GROUP BY ALL)
SELECT r.p_brand, r.p_type, r.source, r.price, r.p_partkey, array_to_string(list_filter(l, lambda x: x <> r.source), ',') AS also_seen FROM r JOIN a USING (p_brand, p_type) WHERE rn = 1""")
def offer_dedupe(spark, sf_dir):
    o = table(spark, sf_dir, "part").select("p_brand", "p_type", F.concat(F.lit("s"), F.col("p_partkey") % 4).alias("source"), F.col("p_retailprice").alias("price"), "p_partkey")
    return ops.pick_best(o, ["p_brand", "p_type"], [F.col("price"), F.col("p_partkey")], "source")


@register("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS bal, c_nationkey FROM customer),
s AS (SELECT c_nationkey, max(nullif(seg, '')) AS s1, max(bal) AS b1 FROM r GROUP BY 1)
SELECT c_custkey, CASE WHEN seg = '' THEN s1 ELSE seg END AS seg, coalesce(bal, b1) AS bal, r.c_nationkey, concat_ws(',', CASE WHEN bal IS NULL AND b1 IS NOT NULL THEN 'bal:sibling' END, CASE WHEN seg = '' AND s1 IS NOT NULL THEN 'seg:sibling' END) AS _derived FROM r JOIN s USING (c_nationkey)""")
def sibling_backfill(spark, sf_dir):
    r = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("seg"), F.when(F.col("c_custkey") % 4 == 0, None).otherwise(F.col("c_acctbal")).alias("bal"), "c_nationkey")
    return ops.sibling_backfill(r, r, ["c_nationkey"], ["seg", "bal"])


@register("SELECT o_custkey, count(*) AS tries FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'P') = 0")
def unresolved_backlog(spark, sf_dir):
    return ops.unresolved(table(spark, sf_dir, "orders").withColumn("x", F.when(F.col("o_orderstatus") == "P", F.lit("y"))), ["o_custkey"], "x")


@register("""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type = 'error' AS bad FROM events), g AS (SELECT user_id, count(DISTINCT CASE WHEN bad THEN day END) AS bad_days, max(CASE WHEN NOT bad THEN day END) AS last_ok, max(CASE WHEN bad THEN day END) AS last_bad FROM e GROUP BY 1)
SELECT * FROM g WHERE bad_days >= 3 AND (last_ok IS NULL OR last_ok < last_bad)""")
def strike_count(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), (F.col("event_type") == "error").alias("bad"))
    return ops.strikes(e, "user_id", "day", "bad")


@register("""WITH r AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, bool_or(value > 50) AS ok FROM events GROUP BY ALL),
g AS (SELECT event_type, max(day) AS last_try, max(CASE WHEN ok THEN day END) AS last_ok, max(n) AS high_water, arg_max(n, day) AS last_volume FROM r GROUP BY 1)
SELECT *, round(last_volume / high_water::DOUBLE, 4) AS coverage, CASE WHEN high_water = 0 THEN 'baseline' WHEN last_volume >= 0.9 * high_water THEN 'complete' ELSE 'partial' END AS state FROM g""")
def run_ledger(spark, sf_dir):
    r = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("value") > 50).alias("ok"))
    return ops.run_ledger(r, "event_type", "day", "ok", "n")


@register("""WITH i AS (SELECT l_suppkey AS k, sum(l_quantity) AS implied FROM lineitem GROUP BY 1), a AS (SELECT l_suppkey AS k, sum(l_extendedprice) / 100 AS actual FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
j AS (SELECT * FROM i JOIN a USING (k)), s AS (SELECT sum(actual) / sum(implied) AS scale, count(*) AS cells FROM j)
SELECT round(any_value(scale), 6) AS scale, any_value(cells) AS cells, round(avg(abs(actual - scale * implied) / actual), 6) AS mape FROM j, s""")
def velocity_calibration(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    implied = l.groupBy(F.col("l_suppkey").alias("k")).agg(F.sum("l_quantity").alias("implied"))
    anchor = l.filter("l_linestatus = 'O'").groupBy(F.col("l_suppkey").alias("k")).agg((F.sum("l_extendedprice") / 100).alias("actual"))
    return ops.calibrate(implied, anchor, ["k"])


@register("""WITH h AS (SELECT c_nationkey, c_mktsegment AS bracket, count(*) AS households FROM customer GROUP BY ALL), s AS (SELECT o_c.c_mktsegment AS bracket, round(avg(o_totalprice), 2) AS spend FROM orders JOIN customer o_c ON c_custkey = o_custkey GROUP BY 1),
g AS (SELECT c_nationkey, sum(households * spend) AS demand, sum(households) AS households, count(DISTINCT bracket) AS n FROM h JOIN s USING (bracket) GROUP BY 1), c AS (SELECT * FROM g WHERE n = (SELECT count(*) FROM s))
SELECT c_nationkey, round(demand, 2) AS demand, round(demand / households, 4) AS per_household, round(100 * demand / households / (SELECT sum(demand) / sum(households) FROM c), 2) AS "index" FROM c""")
def demand_model(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    h = c.groupBy("c_nationkey", F.col("c_mktsegment").alias("bracket")).agg(F.count(F.lit(1)).alias("households"))
    s = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("bracket")).agg(F.round(F.avg("o_totalprice"), 2).alias("spend"))
    return ops.demand(h, s, "c_nationkey", s.count())


@register("""WITH d AS (SELECT c_nationkey AS place, n_regionkey AS area, sum(c_acctbal) AS demand, count(*) AS doors FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL), p AS (SELECT *, demand / doors AS per_door FROM d WHERE doors >= 1),
u AS (SELECT area, list_sort(list(per_door))[count(*) // 2 + 1] AS typical FROM p GROUP BY 1) SELECT place, area, round(demand, 2) AS demand, doors, round(100 * per_door / typical, 2) AS "index" FROM p JOIN u USING (area)""")
def whitespace_index(spark, sf_dir):
    d = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("c_nationkey").alias("place"), F.col("n_regionkey").alias("area")).agg(F.sum("c_acctbal").alias("demand"), F.count(F.lit(1)).alias("doors"))
    return ops.whitespace(d, "area", "demand", "doors").select("place", "area", F.round("demand", 2).alias("demand"), "doors", "index")


@register("""WITH r AS (SELECT l_suppkey, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS sku, p_brand, CAST(l_shipdate AS DATE) AS day, l_quantity, l_extendedprice FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_suppkey AS outlet, CASE WHEN sku <> '' THEN sku ELSE p_brand END AS product_ref, CASE WHEN sku <> '' THEN 'sku' ELSE 'brand' END AS grain, day AS obs_date, round(sum(l_quantity), 4) AS l_quantity, round(max(l_extendedprice), 4) AS l_extendedprice FROM r GROUP BY ALL""")
def fact_build(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    r = r.select("l_suppkey", F.when(F.col("l_partkey") % 3 == 0, F.lit("")).otherwise(F.col("l_partkey").cast("string")).alias("sku"), "p_brand", F.to_date("l_shipdate").alias("day"), "l_quantity", "l_extendedprice")
    return ops.fact_build(r, "l_suppkey", [("sku", "sku"), ("p_brand", "brand")], "day", {"l_quantity": "sum", "l_extendedprice": "max"})


@register("""WITH t AS (SELECT *, 'rich' AS territory FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT *, 'north' FROM customer WHERE c_nationkey < 8 UNION ALL SELECT *, 'autos' FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
SELECT territory, count(*) AS members, round(sum(c_acctbal), 2) AS balance FROM t GROUP BY 1""")
def territory_groups(spark, sf_dir):
    groups = {"rich": F.col("c_acctbal") > 5000, "north": F.col("c_nationkey") < 8, "autos": F.col("c_mktsegment") == "AUTOMOBILE"}
    return ops.territories(table(spark, sf_dir, "customer"), groups).groupBy("territory").agg(F.count(F.lit(1)).alias("members"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@register("""SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 10 THEN '4-10' ELSE '11+' END AS size, count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL) GROUP BY 1""")
def cluster_histogram(spark, sf_dir):
    g = table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.count(F.lit(1)).alias("n"))
    size = F.when(F.col("n") == 1, "1").when(F.col("n") <= 3, "2-3").when(F.col("n") <= 10, "4-10").otherwise("11+")
    return g.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"))


@register("""SELECT n_name, count(*) FILTER (c_mktsegment = 'BUILDING') AS building, count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS household, count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD')) AS other FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def rolling_coverage(spark, sf_dir):
    j = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    s = F.col("c_mktsegment")
    return j.groupBy("n_name").agg(F.count_if(s == "BUILDING").alias("building"), F.count_if(s == "HOUSEHOLD").alias("household"), F.count_if(~s.isin("BUILDING", "HOUSEHOLD")).alias("other"))


@register("""SELECT CAST(conv_hex % 20 AS INTEGER) AS split, count(*) AS n, count(DISTINCT p_brand) AS brands FROM (SELECT p_brand, ('0x' || substr(md5(p_brand), 1, 8))::BIGINT AS conv_hex FROM part) GROUP BY 1""")
def brand_disjoint_split(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(products.split_of(F.col("p_brand")).alias("split")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_brand").alias("brands"))


@register("""WITH p AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT p_brand, p_name, n, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_name) AS rn, sum(n) OVER (PARTITION BY p_brand) AS a FROM p)
SELECT p_brand, p_name, n AS votes, round(n / a, 4) AS share FROM r WHERE rn = 1""")
def display_name_vote(spark, sf_dir):
    return masters.majority(table(spark, sf_dir, "part"), ["p_brand"], "p_name")


@register("""WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '036000291452' WHEN p_partkey % 5 = 0 THEN '111111111111' ELSE '36000291452' END AS code FROM part)
SELECT CAST(length(code) AS INTEGER) AS length, count(*) AS n, count(*) FILTER (code = '036000291452') AS valid, count(*) FILTER (code IN ('036000291452', '36000291452')) AS valid_padded, count(*) FILTER (code = '111111111111') AS placeholders FROM c GROUP BY 1""")
def dq_code_scout(spark, sf_dir):
    k = F.col("p_partkey")
    c = table(spark, sf_dir, "part").select(F.when(k % 2 == 0, "036000291452").when(k % 5 == 0, "111111111111").otherwise("36000291452").alias("code"))
    return quality.code_scout(c, "code")


@register("""WITH s AS (SELECT event_type, count(*) AS rows, count(*) FILTER (event_id % 11 = 0) AS pending, date_diff('hour', max(ts), TIMESTAMP '2024-01-31 06:00:00') AS age FROM events GROUP BY 1)
SELECT event_type, CASE WHEN rows = 0 THEN 'never' WHEN pending > 0 AND age > 8 THEN 'stalled' WHEN pending > 0 THEN 'waiting' WHEN age <= 8 THEN 'flowing' ELSE 'idle' END AS state FROM s""")
def stage_states(spark, sf_dir):
    hour = lambda c: F.floor(F.unix_seconds(c.cast("timestamp")) / 3600)
    s = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_id") % 11 == 0).alias("pending"), (hour(F.lit("2024-01-31 06:00:00")) - hour(F.max("ts"))).alias("age"))
    return s.select("event_type", quality.stage_state(F.col("rows"), F.col("pending"), F.col("age"), 8).alias("state"))
