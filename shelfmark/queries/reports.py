"""Reports over masters, outlets and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import book, joins, landing
from ..operators import reports as ops
from . import Registry, table
from .joins import HAVERSINE, PLACES, places
from .masters import GRAINS, KEYS, NAMED, STAGED, staged

register = Registry()


@register("SELECT DISTINCT CAST(p_type AS VARCHAR) AS value FROM part")
def field_query_distinct(spark, sf_dir):
    return landing.field_query(table(spark, sf_dir, "part"), "distinct", "p_type")


@register("SELECT count(p_brand) AS n, count(DISTINCT p_brand) AS \"distinct\" FROM part")
def field_query_count(spark, sf_dir):
    return landing.field_query(table(spark, sf_dir, "part"), "count", "p_brand")


@register(f"WITH {STAGED} SELECT {KEYS['sku']} AS sku_key, min(brand) AS brand, min(name) AS name, count(*) AS source_rows FROM st GROUP BY 1")
def hierarchy_chain(spark, sf_dir):
    """A sku's brand and name, by way of its item, product and brand."""
    from ..operators import masters

    s = staged(spark, sf_dir)
    grain = {g: masters.shred(s, GRAINS, g, NAMED) for g, _ in GRAINS}
    names = [g for g, _ in GRAINS]
    leaf = grain[names[-1]].select(f"{names[-1]}_key", f"{names[-2]}_key", "source_rows")
    levels = [(grain[g].select(f"{g}_key", *([f"{names[i - 1]}_key"] if i else []), *(["brand"] if g == "brand" else ["name"] if g == "product" else [])), f"{g}_key") for i, g in reversed(list(enumerate(names[:-1])))]
    return ops.chain(levels, leaf, "brand").select("sku_key", "brand", "name", "source_rows")


@register("SELECT DISTINCT c_nationkey AS k FROM customer INTERSECT SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_intersection(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select("s_nationkey"))


@register(f"""WITH {PLACES}, n AS (SELECT p.*, s_name AS name FROM pts p JOIN supplier ON s_suppkey = id), d AS (SELECT x.id AS a, y.id AS b, x.name AS na, y.name AS nb, x.lat, x.lng, y.lat AS a_lat, y.lng AS a_lng FROM n x JOIN n y ON x.id < y.id),
m AS (SELECT a, b, round({HAVERSINE}, 6) AS miles, round(jaro_winkler_similarity(na, nb), 6) AS similarity FROM d) SELECT * FROM m WHERE miles <= 60 AND similarity >= 0.9""")
def near_namesakes(spark, sf_dir):
    pts, _ = places(spark, sf_dir)
    named = pts.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), "id")
    return ops.near_namesakes(named, "id", "name", "lat", "lng", geo.haversine_miles, 60.0, 0.9, 2.0)


@register(f"""WITH {PLACES}, c AS (SELECT c_custkey, lat, lng FROM customer LEFT JOIN pts ON id = c_custkey % 120), d AS (SELECT DISTINCT lat, lng FROM c), e AS (SELECT d.lat, d.lng, place, round({HAVERSINE}, 6) AS miles FROM d, anchors),
r AS (SELECT *, row_number() OVER (PARTITION BY lat, lng ORDER BY miles, place) AS rn FROM e WHERE miles IS NOT NULL) SELECT c_custkey, place FROM c LEFT JOIN r ON r.lat = c.lat AND r.lng = c.lng AND rn = 1""")
def coordinate_fan_out(spark, sf_dir):
    """Each distinct coordinate is resolved once; customers without one stay."""
    pts, anchors = places(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 120).alias("id")).join(pts, "id", "left").drop("id")
    miles = geo.haversine_miles(F.col("lat"), F.col("lng"), F.col("a_lat"), F.col("a_lng"))
    return ops.fan_out(c, ["lat", "lng"], lambda d: joins.nearest(d, anchors, miles, ["lat", "lng"], "place").drop("miles")).select("c_custkey", "place")


@register("""WITH d AS (SELECT n_name AS zcta, r_name AS county, sum(o_totalprice) AS demand FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL)
SELECT 'county' AS level, county AS geo, round(sum(demand), 2) AS demand FROM d GROUP BY county UNION ALL SELECT 'zcta', zcta, round(demand, 2) FROM d""")
def geography_demand(spark, sf_dir):
    """Demand by county and by postal area, each from one aggregate of orders."""
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("demand"))
    g = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("zcta"), F.col("r_name").alias("county"))
    d = per.join(table(spark, sf_dir, "customer"), "c_custkey").groupBy("c_nationkey").agg(F.sum("demand").alias("demand")).join(g, "c_nationkey")
    level = lambda c: d.groupBy(F.lit(c).alias("level"), F.col(c).alias("geo")).agg(F.round(F.sum("demand"), 2).alias("demand"))
    return level("county").unionByName(level("zcta"))


@register("""WITH r AS (SELECT s_suppkey, s_nationkey AS city, s_suppkey % 3 AS state, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey / 100.0::DOUBLE END AS lat, CASE WHEN s_suppkey % 4 > 0 THEN -s_acctbal / 100 END AS lng FROM supplier),
c AS (SELECT city, state, round(avg(lat), 6) AS la, round(avg(lng), 6) AS lo FROM r WHERE lat IS NOT NULL GROUP BY ALL) SELECT s_suppkey, city, state, coalesce(lat, la) AS lat, coalesce(lng, lo) AS lng, lat IS NULL AND la IS NOT NULL AS filled FROM r LEFT JOIN c USING (city, state)""")
def centroid_fill(spark, sf_dir):
    known = F.col("s_suppkey") % 4 > 0
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("city"), (F.col("s_suppkey") % 3).alias("state"), F.when(known, F.col("s_suppkey") / 100.0).alias("lat"), F.when(known, -F.col("s_acctbal") / 100).alias("lng"))
    return ops.centroid_fill(rows, ["city", "state"], "lat", "lng")


@register(f"WITH {PLACES} SELECT DISTINCT id FROM pts, anchors WHERE {HAVERSINE} <= 120")
def places_near_anchors(spark, sf_dir):
    pts, anchors = places(spark, sf_dir)
    miles = geo.haversine_miles(F.col("lat"), F.col("lng"), F.col("a_lat"), F.col("a_lng"))
    return joins.nearest(pts, anchors, miles, ["id"], "place").filter("miles <= 120").select("id")


@register("""WITH o AS (SELECT n_regionkey AS metro, count(*) AS outlets FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey <> 2 GROUP BY 1), h AS (SELECT n_regionkey AS metro, CAST(sum(c_custkey % 50) AS BIGINT) AS households FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 3 GROUP BY 1)
SELECT metro, coalesce(outlets, 0) AS outlets, households, round(1000.0::DOUBLE * coalesce(outlets, 0) / households, 4) AS per_1000 FROM o FULL JOIN h USING (metro)""")
def metro_household_ratios(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("metro"))
    o = table(spark, sf_dir, "supplier").join(n, F.col("n_nationkey") == F.col("s_nationkey")).filter("metro <> 2")
    h = table(spark, sf_dir, "customer").join(n, F.col("n_nationkey") == F.col("c_nationkey")).filter("metro <> 3").select("metro", (F.col("c_custkey") % 50).alias("households"))
    return ops.per_household(o, h, "metro")


@register(f"WITH {STAGED}, v AS (SELECT *, CAST(1990 + p_partkey % 6 AS VARCHAR) AS vintage FROM st) SELECT {KEYS['sku']} AS sku_key, vintage, count(*) AS source_rows, string_agg(DISTINCT _source, ',' ORDER BY _source) AS source_list FROM v GROUP BY 1, 2")
def sku_vintage_association(spark, sf_dir):
    from ..operators import masters

    rows = staged(spark, sf_dir).withColumn("vintage", (1990 + F.col("p_partkey") % 6).cast("string"))
    return masters.association(rows, masters.grain_keys(GRAINS, NAMED)["sku"], "sku_key", "vintage")


_FEED = """f AS (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS period, o_orderpriority AS market, p_brand AS brand, p_type AS category, l_suppkey AS distributor, l_quantity AS cases, l_extendedprice AS revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""


def _mart(name: str, mart_keys: list[str], carried: list[str]) -> None:
    def query(spark, sf_dir):
        lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
        feed = lines.select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long").alias("period"), F.col("o_orderpriority").alias("market"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("l_suppkey").alias("distributor"), F.col("l_quantity").alias("cases"), F.col("l_extendedprice").alias("revenue"))
        got = book.bounded_mart(feed, mart_keys, ["cases", "revenue"], carried)
        return got.select(*mart_keys, *carried, F.round("cases", 2).alias("cases"), F.round("revenue", 2).alias("revenue"))

    query.__name__ = name
    kept = "".join(f"min({c}) AS {c}, " for c in carried)
    register(f"WITH {_FEED} SELECT {', '.join(mart_keys)}, {kept}round(sum(cases), 2) AS cases, round(sum(revenue), 2) AS revenue FROM f GROUP BY {', '.join(mart_keys)}")(query)


_mart("mart_market", ["period", "market"], [])
_mart("mart_brand", ["period", "brand"], ["category"])
_mart("mart_distributor", ["period", "distributor"], [])
_mart("mart_category", ["period", "market", "category"], [])


@register("""SELECT CAST(s_suppkey % 3 AS INTEGER) AS source, s_nationkey AS state, count(*) AS rows, count(*) FILTER (s_acctbal > 0) AS with_lat, count(*) FILTER (s_suppkey % 5 <> 0) AS with_phone FROM supplier GROUP BY ALL""")
def coverage_by_source_state(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 3).cast("int").alias("source"), F.col("s_nationkey").alias("state"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("lat"), F.when(F.col("s_suppkey") % 5 != 0, "555").otherwise("").alias("phone"))
    return ops.coverage(rows, ["source", "state"], ["lat", "phone"])


@register("""WITH l AS (SELECT user_id % 30 AS t, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL), g AS (SELECT t, max(n) AS high_water, arg_max(n, d) AS last_rows, max(d) AS last_at, count(*) AS runs FROM l GROUP BY 1)
SELECT *, CASE WHEN runs = 1 THEN 'baseline' WHEN last_rows >= 0.5 * high_water THEN 'complete' ELSE 'partial' END AS verdict FROM g""")
def coverage_verdicts(spark, sf_dir):
    log = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 30).alias("t"), F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return ops.coverage_verdict(log, "t", "d", "n", 0.5)


@register("SELECT o_custkey, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) GROUP BY 1")
def accounts_on_latest_day(spark, sf_dir):
    return ops.on_latest(table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate")), "d", "o_custkey")


@register("""SELECT c_mktsegment, count(*) AS rows, count(*) FILTER (c_acctbal < 0) AS flagged, count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS orphans FROM customer GROUP BY 1""")
def chain_rollup(spark, sf_dir):
    known = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return ops.chain_rollup(table(spark, sf_dir, "customer"), known, "c_mktsegment", "c_custkey", F.col("c_acctbal") < 0)


@register("""WITH n AS (SELECT p_size % 9 AS aisle, p_brand, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT *, round(n / sum(n) OVER (PARTITION BY aisle), 4) AS share, row_number() OVER (PARTITION BY aisle ORDER BY n DESC, p_brand) AS place FROM n) SELECT aisle, p_brand, n, share, CAST(place AS INTEGER) AS place FROM r WHERE place <= 3""")
def shelf_brand_shares(spark, sf_dir):
    return ops.top_shares(table(spark, sf_dir, "part").withColumn("aisle", F.col("p_size") % 9), ["aisle"], "p_brand")


@register("""WITH m AS (SELECT CASE WHEN p_size > 30 THEN 'exact' WHEN p_size > 15 THEN 'name' ELSE 'unmatched' END AS tier, CASE WHEN p_size < 5 THEN 'no code' ELSE 'no name' END AS reason FROM part)
SELECT tier, CASE WHEN tier = 'unmatched' THEN reason END AS why, count(*) AS n, round(count(*) / (SELECT count(*) FROM part)::DOUBLE, 4) AS rate FROM m GROUP BY 1, 2""")
def tier_rates(spark, sf_dir):
    z = F.col("p_size")
    m = table(spark, sf_dir, "part").select(F.when(z > 30, "exact").when(z > 15, "name").otherwise("unmatched").alias("tier"), F.when(z < 5, "no code").otherwise("no name").alias("reason"))
    return ops.tier_rates(m, "tier", "reason")


@register("WITH r AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE p_brand END AS b FROM part) SELECT p_partkey, b, row_number() OVER (ORDER BY (b IS NULL OR b = ''), b NULLS FIRST, p_partkey) AS place FROM r")
def empties_last(spark, sf_dir):
    k = F.col("p_partkey") % 5
    return ops.empties_last(table(spark, sf_dir, "part").select("p_partkey", F.when(k == 0, "").when(k > 1, F.col("p_brand")).alias("b")), "b", "p_partkey")


@register("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(p_name || ' 750 The ' || p_brand), '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t NOT IN ('', 'the', 'widget') AND NOT regexp_full_match(t, '[0-9]+')))), ' ') AS core FROM part")
def core_keys(spark, sf_dir):
    name = F.concat("p_name", F.lit(" 750 The "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", ops.core_key(name, ("the", "widget")).alias("core"))


@register("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS v FROM events GROUP BY ALL)
SELECT user_id, day, v, round(sum(v) OVER w, 4) AS trailing_sum, round(avg(v) OVER w, 6) AS trailing_mean FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW)""")
def trailing_quarter(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum("value").alias("v"))
    return ops.trailing(days, ["user_id"], "day", "v", 90)


@register("""WITH r AS (SELECT CASE WHEN c_custkey % 6 = 0 THEN '9999' WHEN c_custkey % 9 = 1 THEN 'n/a' WHEN c_custkey % 4 = 1 THEN '' WHEN c_custkey % 3 = 1 THEN '0' ELSE CAST(c_custkey % 150 AS VARCHAR) END AS t FROM customer), v AS (SELECT t, TRY_CAST(t AS DOUBLE) AS x FROM r),
n AS (SELECT count(*) AS n, count(x) AS h, count(*) FILTER (t <> '') AS f, max(x) AS hi, min(x) AS lo FROM v),
c AS (SELECT 'type' AS "check", count(*) FILTER (t <> '' AND x IS NULL) AS hits, any_value(f) AS o, 0.0 AS bar FROM v, n UNION ALL SELECT 'negative', count(*) FILTER (x < 0), any_value(h), 0 FROM v, n UNION ALL SELECT 'percent', count(*) FILTER (x > 100), any_value(h), 0 FROM v, n
UNION ALL SELECT 'cap', count(*) FILTER (x = hi), any_value(h), 0.15 FROM v, n UNION ALL SELECT 'floor', count(*) FILTER (x = lo), any_value(h), 0.15 FROM v, n UNION ALL SELECT 'cap_band', count(*) FILTER (x >= hi - 0.02 * abs(hi) AND x < hi), any_value(h), 0.15 FROM v, n
UNION ALL SELECT 'nulls', count(*) FILTER (t = ''), any_value(n.n), 0.2 FROM v, n UNION ALL SELECT 'zeros', count(*) FILTER (x = 0), any_value(h), 0.3 FROM v, n
UNION ALL SELECT 'scale', coalesce(max(CASE WHEN g >= 1.7 AND k >= 30 THEN least(i, k - i) ELSE 0 END), 0), max(k), 0.05 FROM (SELECT *, row_number() OVER (ORDER BY g DESC, i) AS w FROM (SELECT row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS k, lead(log10(x)) OVER (ORDER BY x) - log10(x) AS g FROM v WHERE x > 0)) WHERE w = 1)
SELECT "check", hits, round(hits / o::DOUBLE, 4) AS share, hits > 0 AND hits / o::DOUBLE >= bar AS failed FROM c""")
def dq_measure_checks(spark, sf_dir):
    k = F.col("c_custkey")
    t = F.when(k % 6 == 0, "9999").when(k % 9 == 1, "n/a").when(k % 4 == 1, "").when(k % 3 == 1, "0").otherwise((k % 150).cast("string"))
    return ops.measure_checks(table(spark, sf_dir, "customer").select(t.alias("t")), "t", True)


@register("""SELECT * FROM (VALUES ('n_nationkey', 'n_name', 'one_to_one'), ('n_nationkey', 'again', 'mirror'), ('n_name', 'again', 'one_to_one')) AS t(a, b, kind)""")
def dq_covariation(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").withColumn("again", F.col("n_nationkey"))
    return ops.covariation(rows, ["n_nationkey", "n_name", "n_regionkey", "again"])
