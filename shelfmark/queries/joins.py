"""Joins: as-of, upsert, probes, cascades, crosswalks, nearest places."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import joins as ops
from . import Registry, table

register = Registry()

RATES = """rates AS (SELECT c_nationkey AS nation, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS effective, round(avg(o_totalprice) / 1000, 2) AS rate
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"""


def rates(spark, sf_dir):
    j = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy(F.col("c_nationkey").alias("nation"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("effective")).agg(F.round(F.avg("o_totalprice") / 1000, 2).alias("rate"))


@register(f"""WITH {RATES}, s AS (SELECT s_suppkey, s_nationkey AS nation, DATE '1997-02-15' + CAST(s_suppkey AS INTEGER) * 7 AS day FROM supplier)
SELECT s.s_suppkey, s.nation, s.day, r.effective, r.rate FROM s ASOF LEFT JOIN rates r ON s.nation = r.nation AND s.day >= r.effective""")
def asof_rate(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.expr("date_add(date'1997-02-15', cast(s_suppkey * 7 as int))").alias("day"))
    return ops.asof(s, rates(spark, sf_dir), ["nation"], "day", "effective", ["rate"])


BANDS = "(1, 0.0, 15.0, DATE '1995-06-01', 0.05), (1, 0.0, 15.0, DATE '1998-06-01', 0.07), (1, 15.0, 99.0, DATE '1996-01-01', 0.11), (0, 0.0, 99.0, DATE '1995-01-01', 0.02)"


@register(f"""WITH b(k, low, high, effective, tax) AS (VALUES {BANDS}), l AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_partkey % 2 AS k, l_quantity, CAST(l_shipdate AS DATE) AS day FROM lineitem),
j AS (SELECT l.*, b.effective, b.low, b.high, b.tax, row_number() OVER (PARTITION BY rid ORDER BY b.effective DESC) AS rn
  FROM l LEFT JOIN b ON b.k = l.k AND b.effective <= l.day AND l_quantity >= low AND l_quantity < high)
SELECT l_orderkey, l_linenumber, k, l_quantity, day, effective, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, CAST(tax AS DOUBLE) AS tax FROM j WHERE rn = 1""")
def asof_tax_band(spark, sf_dir):
    b = spark.sql(f"SELECT CAST(k AS BIGINT) AS k, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, effective, CAST(tax AS DOUBLE) AS tax FROM VALUES {BANDS} AS t(k, low, high, effective, tax)")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 2).alias("k"), "l_quantity", F.to_date("l_shipdate").alias("day"))
    return ops.asof_band(l, b, ["k"], "day", "effective", "l_quantity", "low", "high")


@register("""WITH batch AS (SELECT o_orderkey, 'Z' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT o_orderkey + 100000000, 'N', o_totalprice FROM orders WHERE o_totalprice > 400000)
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch) UNION ALL SELECT * FROM batch""")
def merge_upsert_antijoin(spark, sf_dir):
    whole = table(spark, sf_dir, "orders")
    orders = whole.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = whole.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("Z").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    fresh = orders.filter("o_totalprice > 400000").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice")
    return ops.upsert(orders, changed.unionByName(fresh), ["o_orderkey"])


@register("SELECT count(*) AS keys, count(o.k) AS matched, round(count(o.k) / count(*)::DOUBLE, 4) AS rate FROM (SELECT DISTINCT c_custkey AS k FROM customer) c LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o USING (k)")
def anti_semi_probe(spark, sf_dir):
    return ops.probe(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), [("c_custkey", "o_custkey")])


@register("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@register("""WITH s AS (SELECT s_suppkey, right(s_name, 3) AS tail, s_nationkey FROM supplier), c AS (SELECT c_custkey, right(c_name, 3) AS tail, c_nationkey FROM customer),
m1 AS (SELECT s_suppkey, min(c_custkey) AS c_custkey FROM s JOIN c ON s.tail = c.tail AND s_nationkey = c_nationkey GROUP BY 1 HAVING count(DISTINCT c_custkey) = 1),
m2 AS (SELECT s_suppkey, min(c_custkey) AS c_custkey FROM s JOIN c ON c_custkey = s_suppkey * 7 GROUP BY 1 HAVING count(DISTINCT c_custkey) = 1)
SELECT s_suppkey, method, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY method) AS rn FROM (SELECT s_suppkey, 1 AS method, c_custkey FROM m1 UNION ALL SELECT s_suppkey, 2, c_custkey FROM m2)) WHERE rn = 1""")
def crosswalk_best_method(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.right("s_name", F.lit(3)).alias("tail"), F.col("s_nationkey").alias("nation"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.right("c_name", F.lit(3)).alias("tail"), F.col("c_nationkey").alias("nation"))
    by_name = s.join(c, ["tail", "nation"]).select("s_suppkey", "c_custkey")
    by_id = s.join(c, F.col("c_custkey") == F.col("s_suppkey") * 7).select("s_suppkey", "c_custkey")
    return ops.best_method([(1, by_name), (2, by_id)], ["s_suppkey"], "c_custkey")


@register("""WITH p AS (SELECT p_partkey, p_brand, p_name, p_size FROM part), a AS (SELECT p_brand, p_name, p_size, min(p_partkey) AS t FROM p WHERE p_size > 30 GROUP BY ALL),
b AS (SELECT p_brand, p_name, min(p_partkey) AS t FROM p WHERE p_size <= 20 GROUP BY ALL)
SELECT p.p_partkey, p.p_brand, p.p_name, p.p_size, CASE WHEN a.t IS NOT NULL THEN 'exact' WHEN b.t IS NOT NULL THEN 'name' ELSE 'unmatched' END AS tier, CAST(coalesce(a.t, b.t) AS VARCHAR) AS t
FROM p LEFT JOIN a USING (p_brand, p_name, p_size) LEFT JOIN b ON b.p_brand = p.p_brand AND b.p_name = p.p_name""")
def tiered_match_cascade(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    exact = p.filter("p_size > 30").groupBy("p_brand", "p_name", "p_size").agg(F.min("p_partkey").alias("t"))
    name = p.filter("p_size <= 20").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("t"))
    return ops.cascade(p, [("exact", exact, ["p_brand", "p_name", "p_size"]), ("name", name, ["p_brand", "p_name"])], "t")


PLACES = """pts AS (SELECT s_suppkey AS id, 25 + (s_suppkey * 37 % 2000) / 100.0::DOUBLE AS lat, -120 + (s_suppkey * 91 % 4000) / 100.0::DOUBLE AS lng FROM supplier),
anchors AS (SELECT n_name AS place, 25 + (n_nationkey * 83 % 20)::DOUBLE AS a_lat, -120 + (n_nationkey * 29 % 40)::DOUBLE AS a_lng FROM nation)"""


def places(spark, sf_dir):
    pts = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (25 + (F.col("s_suppkey") * 37 % 2000) / 100.0).alias("lat"), (-120 + (F.col("s_suppkey") * 91 % 4000) / 100.0).alias("lng"))
    anchors = table(spark, sf_dir, "nation").select(F.col("n_name").alias("place"), (25 + (F.col("n_nationkey") * 83 % 20)).cast("double").alias("a_lat"), (-120 + (F.col("n_nationkey") * 29 % 40)).cast("double").alias("a_lng"))
    return pts, anchors


HAVERSINE = "2 * 3958.8 * asin(least(1.0, sqrt(pow(sin((radians(a_lat) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(a_lat)) * pow(sin(radians(a_lng - lng) / 2), 2))))"


@register(f"""WITH {PLACES}, d AS (SELECT id, place, round({HAVERSINE}, 6) AS miles FROM pts, anchors)
SELECT id, place, miles FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY miles, place) AS rn FROM d) WHERE rn = 1""")
def nearest_place_by_cells(spark, sf_dir):
    """The same without a broadcast, as if anchors were many."""
    pts, anchors = places(spark, sf_dir)
    return ops.nearest(pts, anchors, geo.haversine_miles(F.col("lat"), F.col("lng"), F.col("a_lat"), F.col("a_lng")), ["id"], "place", 4.0, 0)


@register(f"""WITH {PLACES}, d AS (SELECT id, place, round({HAVERSINE}, 6) AS miles FROM pts, anchors)
SELECT id, place, miles FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY miles, place) AS rn FROM d) WHERE rn = 1""")
def nearest_place(spark, sf_dir):
    pts, anchors = places(spark, sf_dir)
    return ops.nearest(pts, anchors, geo.haversine_miles(F.col("lat"), F.col("lng"), F.col("a_lat"), F.col("a_lng")), ["id"], "place")


@register(f"WITH {PLACES} SELECT id, lat, lng FROM pts WHERE lat BETWEEN 35 - 300 / 69.0 AND 35 + 300 / 69.0 AND lng BETWEEN -100 - 300 / 27.3 AND -100 + 300 / 27.3 AND 2 * 3958.8 * asin(least(1.0, sqrt(pow(sin((radians(35.0) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(35.0)) * pow(sin(radians(-100.0 - lng) / 2), 2)))) <= 300")
def radius_search(spark, sf_dir):
    pts, _ = places(spark, sf_dir)
    lat, lng = F.col("lat"), F.col("lng")
    return pts.filter(geo.in_box(lat, lng, (35.0, -100.0), 300)).filter(geo.haversine_miles(lat, lng, F.lit(35.0), F.lit(-100.0)) <= 300)


@register(f"""WITH {PLACES}, c AS (SELECT place AS code, a_lng AS x0, a_lat AS y0 FROM anchors)
SELECT p.id, p.lng AS x, p.lat AS y, min(c.code) AS code FROM pts p LEFT JOIN c ON p.lng >= x0 - 2 AND p.lng <= x0 + 2 AND p.lat >= y0 - 1.5 AND p.lat <= y0 + 1.5 GROUP BY ALL""")
def point_in_polygon(spark, sf_dir):
    pts, anchors = places(spark, sf_dir)
    corner = lambda dx, dy: F.struct((F.col("a_lng") + dx).alias("x"), (F.col("a_lat") + dy).alias("y"))
    squares = anchors.select(F.col("place").alias("code"), F.array(corner(-2, -1.5), corner(2, -1.5), corner(2, 1.5), corner(-2, 1.5)).alias("ring"))
    return ops.point_in_polygon(pts.select("id", F.col("lng").alias("x"), F.col("lat").alias("y")), squares)


@register("""WITH c AS (SELECT c_custkey AS id, (c_custkey * 7919 % 50000) / 1000.0::DOUBLE + 0.00037 AS x, (c_custkey * 104729 % 50000) / 1000.0::DOUBLE + 0.00059 AS y FROM customer),
n AS (SELECT n_nationkey, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_nationkey % 5 * 10.0 AS x0, n_nationkey // 5 * 10.0 AS y0 FROM nation),
j AS (SELECT c.id, n.code FROM c JOIN n ON x > x0 AND x < x0 + 8 AND y > y0 AND y < y0 + 8 AND (NOT (x > x0 + 2 AND x < x0 + 6 AND y > y0 + 2 AND y < y0 + 6) OR (x > x0 + 3 AND x < x0 + 5 AND y > y0 + 3 AND y < y0 + 5))
  OR x > x0 + 8.5 AND x < x0 + 9.5 AND y > y0 + 1 AND y < y0 + 9)
SELECT c.id, min(j.code) AS code FROM c LEFT JOIN j USING (id) GROUP BY c.id""")
def polygon_regions(spark, sf_dir):
    """Regions with a hole, an island in it and a second part, written as polygon files and read back by ranges of records."""
    from ..sources import shapes
    from ..sources.working import shared_dir

    def box(x0: float, y0: float, x1: float, y1: float):
        at = lambda x, y: F.struct((F.col("x0") + x).alias("x"), (F.col("y0") + y).alias("y"))
        return F.array(at(x0, y0), at(x0, y1), at(x1, y1), at(x1, y0), at(x0, y0))

    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    n = n.select(F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0")).alias("code"), (k % 5 * 10.0).alias("x0"), (F.floor(k / 5) * 10.0).alias("y0"))
    regions = n.select("code", F.array(box(0.0, 0.0, 8.0, 8.0), box(2.0, 2.0, 6.0, 6.0), box(3.0, 3.0, 5.0, 5.0), box(8.5, 1.0, 9.5, 9.0)).alias("rings"))
    place = f"{shared_dir(spark)}/regions-{uuid.uuid4().hex}"
    shapes.write_polygons(regions.repartition(3, "code"), place, {"code": ("C", 8)})
    key = F.col("c_custkey")
    points = table(spark, sf_dir, "customer").select(key.alias("id"), ((key * 7919 % 50000) / 1000.0 + 0.00037).alias("x"), ((key * 104729 % 50000) / 1000.0 + 0.00059).alias("y"))
    return ops.point_in_polygon(points, shapes.read_polygons(spark, place, 4), 2.0).select("id", "code")
