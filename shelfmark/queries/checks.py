"""Checks against rules, rosters and histories, and what kind of table one is."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ..functions import products
from ..operators import checks as ops
from . import Registry, table

register = Registry()


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), F.year("o_orderdate").cast("string").alias("year"), F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_orderstatus", "o_totalprice")


_CELLS = "r AS (SELECT CAST(o_custkey AS VARCHAR) AS e, CAST(year(o_orderdate) AS VARCHAR) AS p, CASE WHEN o_custkey % 3 = 0 THEN 'g' || o_custkey % 5 || o_orderstatus ELSE 'h' || o_orderstatus END AS g FROM orders)"


@register(f"""WITH {_CELLS}, c AS (SELECT e, p, count(*) AS n, max(g) AS g FROM r GROUP BY ALL), m AS (SELECT e, count(*) AS events, sum(n) AS volume, arg_max(g, p) AS g FROM c GROUP BY e)
SELECT m.e AS customer, t.p AS year, m.g AS team, CAST(volume AS BIGINT) AS volume, CASE WHEN volume / (SELECT max(volume) FROM m) >= 0.5 THEN 'high' WHEN volume / (SELECT max(volume) FROM m) >= 0.2 THEN 'medium' ELSE 'low' END AS severity
FROM m JOIN (SELECT DISTINCT p, g FROM r) t ON t.g = m.g WHERE events >= 2 AND NOT EXISTS (SELECT 1 FROM c WHERE c.e = m.e AND c.p = t.p)""")
def dq_event_gaps(spark, sf_dir):
    """Years in which an active customer's group ordered and the customer did not."""
    o = table(spark, sf_dir, "orders")
    team = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("g"), (F.col("o_custkey") % 5).cast("string"), "o_orderstatus")).otherwise(F.concat(F.lit("h"), "o_orderstatus"))
    return ops.event_gaps(o.select(F.col("o_custkey").cast("string").alias("customer"), F.year("o_orderdate").cast("string").alias("year"), team.alias("team")), "customer", "year", "team")


@register("""WITH c AS (SELECT DISTINCT o_custkey AS e, year(o_orderdate) AS p FROM orders), k AS (SELECT count(*) AS n, count(DISTINCT e) AS entities, count(DISTINCT p) AS periods FROM c)
SELECT entities, periods, round(n / (entities * periods)::DOUBLE, 3) AS coverage, CASE WHEN n / (entities * periods)::DOUBLE >= 0.6 THEN 'panel' ELSE 'event' END AS kind FROM k""")
def dq_coverage_kind(spark, sf_dir):
    return ops.coverage_kind(_orders(spark, sf_dir), "customer", "year")


_ALLOWED = [("1995", "1-URGENT"), ("1995", "2-HIGH"), ("1996", "1-URGENT"), ("1996", "3-MEDIUM"), ("1997", "5-LOW")]


@register(f"""WITH rules AS (SELECT * FROM (VALUES {", ".join(f"('{w}', '{p}')" for w, p in _ALLOWED)}) AS t("when", "where")), c AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS "when", o_orderpriority AS "where", count(*) AS n FROM orders GROUP BY ALL)
SELECT * FROM c WHERE "when" IN (SELECT "when" FROM rules) AND ("when", "where") NOT IN (SELECT "when", "where" FROM rules)""")
def dq_ruled_places(spark, sf_dir):
    return ops.ruled_places(_orders(spark, sf_dir), spark.createDataFrame(_ALLOWED, "`when` string, `where` string"), "year", "o_orderpriority")


@register("""WITH s AS (SELECT * FROM (VALUES ('c_nationkey', '0'), ('c_nationkey', '99'), ('c_mktsegment', 'MACHINERY'), ('no_such', 'x')) AS t("column", value)),
c AS (SELECT 'c_nationkey' AS "column", CAST(c_nationkey AS VARCHAR) AS value, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*) FROM customer GROUP BY 2) SELECT c.* FROM c JOIN s USING ("column", value)""")
def dq_ruled_sentinels(spark, sf_dir):
    declared = spark.createDataFrame([("c_nationkey", "0"), ("c_nationkey", "99"), ("c_mktsegment", "MACHINERY"), ("no_such", "x")], "column string, value string")
    return ops.ruled_sentinels(table(spark, sf_dir, "customer"), declared)


@register("""WITH j AS (SELECT o_orderstatus AS source, CAST(o_orderdate AS DATE) AS day, list_filter([CASE WHEN o_totalprice > 400000 OR day(o_orderdate) = 15 THEN 'dear' END, CASE WHEN o_orderkey % 50 = 0 THEN 'code' END], lambda x: x IS NOT NULL) AS v FROM orders),
d AS (SELECT source, day, count(*) AS rows FROM j GROUP BY ALL), b AS (SELECT source, day, rule, count(*) AS n FROM (SELECT source, day, unnest(v) AS rule FROM j) GROUP BY ALL),
r AS (SELECT d.source, d.day, u.rule, rows, round(1000.0::DOUBLE * coalesce(n, 0) / rows, 2) AS rate FROM d JOIN (SELECT DISTINCT source, rule FROM b) u USING (source) LEFT JOIN b ON b.source = d.source AND b.day = d.day AND b.rule = u.rule),
w AS (SELECT *, median(rate) OVER (PARTITION BY source, rule ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS m FROM r)
SELECT source, day, rule, rate, round(m, 4) AS baseline, rows >= 2 AND CASE WHEN m IS NULL THEN rate >= 20 ELSE rate >= greatest(5, 3 * m) END AS spike FROM w""")
def dq_rate_spikes(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    broken = F.array_compact(F.array(F.when((F.col("o_totalprice") > 400000) | (F.dayofmonth("o_orderdate") == 15), F.lit("dear")), F.when(F.col("o_orderkey") % 50 == 0, F.lit("code"))))
    judged = o.select(F.col("o_orderstatus").alias("source"), F.to_date("o_orderdate").alias("day"), broken.alias("violations"))
    return ops.rate_spikes(judged, "day", ["source"], least_rows=2)


_GRAIN = ("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus")
_COUNTS = " UNION ALL ".join(
    f"SELECT '{','.join(s)}' AS columns, {len(s)} AS size, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM g)) AS n_distinct" for n in (1, 2) for s in itertools.combinations(_GRAIN, n)
)


@register(f"""WITH g AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 211 = 0), c AS ({_COUNTS}), k AS (SELECT *, n_distinct / (SELECT count(*) FROM g)::DOUBLE AS share FROM c WHERE n_distinct >= 0.98 * (SELECT count(*) FROM g))
SELECT columns, n_distinct, round(share, 6) AS share FROM k WHERE size = 1 OR NOT EXISTS (SELECT 1 FROM k o WHERE o.size = 1 AND list_contains(string_split(k.columns, ','), o.columns))""")
def dq_grain(spark, sf_dir):
    """Orders, some of them twice, and what identifies them nearly always."""
    o = table(spark, sf_dir, "orders")
    return ops.grain(o.unionByName(o.filter("o_orderkey % 211 = 0")), list(_GRAIN), 0.98)


@register("SELECT 'fact' AS grain, 'customer' AS entity, 'day' AS axis")
def dq_entity_axis(spark, sf_dir):
    """Orders by customer and day, without the order's own key."""
    o = _orders(spark, sf_dir).groupBy("customer", "day").agg(F.max("o_orderstatus").alias("status"), F.max("o_orderpriority").alias("priority"))
    return ops.entity_and_axis(o, ["customer", "day", "status", "priority"], ["day"])


_LABEL = """p_name || CASE p_partkey % 10 WHEN 0 THEN ' Delta-8 gummies' WHEN 1 THEN ' 0.0 lager' WHEN 2 THEN ' 0% sugar Kentucky cans' WHEN 3 THEN ' N.A. beer' WHEN 4 THEN ' 0 % red, Napa' WHEN 5 THEN ' Heineken 0' WHEN 6 THEN ' Product of Italy keg'
  WHEN 7 THEN ' imported, bag-in-box' WHEN 8 THEN ' lyres dry, plastic' ELSE ' hempire state' END"""
_TRAILING = "(?i)\\b0(?:\\.\\d)?\\s*%\\s*(sugar|carb|fat|sodium|juice|added)?"


@register(f"""WITH n AS (SELECT p_partkey, {_LABEL} AS label, p_size * 50 AS ml FROM part), t AS (SELECT *, lower(label) AS l FROM n)
SELECT p_partkey, regexp_matches(l, '\\b(?:hemp|cbd|thc|thca|delta[\\s-]?(?:8|9|10)|d8|d9|hhc|cbn|cbg|cbc|cannabis|cannabinoid|marijuana|edible|full[\\s-]?spectrum)\\b') AS hemp,
  regexp_matches(l, '\\b(?:non[\\s-]?alcoholic|alcohol[\\s-]?free|de[\\s-]?alcoholi[sz]ed|zero[\\s-]?proof|non[\\s-]?alc|n\\.?a\\.?\\s+beer|n\\.?a\\.?\\s+(?:i\\.?)?p\\.?a)\\b|\\b0\\.0\\b')
    OR len(list_filter(regexp_extract_all(l, '{_TRAILING}', 1), lambda x: coalesce(x, '') = '')) > 0 OR regexp_matches(l, '\\b(?:athletic|heineken\\s*0\\.?0?|seedlip|lyre''?s|ghia|partake|gruvi|surely)\\b') AS non_alcoholic,
  CASE WHEN regexp_matches(l, '\\b(?:u\\.?s\\.?a?|kentucky|napa|domestic|america)\\b') THEN 'domestic' WHEN regexp_matches(l, '\\b(?:italy|france|import(?:ed)?)\\b') THEN 'import' END AS origin,
  CASE WHEN ml <= 355 THEN 'single-serve' WHEN ml <= 1000 THEN 'standard' WHEN ml < 1500 THEN 'large' ELSE 'magnum+' END AS tier,
  CASE WHEN regexp_matches(l, '\\bcans?\\b') THEN 'can' WHEN regexp_matches(l, '\\bkeg\\b') THEN 'keg' WHEN regexp_matches(l, '\\bbox\\b|bag.?in.?box') THEN 'box' WHEN regexp_matches(l, 'plastic') THEN 'pet' ELSE 'bottle' END AS container FROM t""")
def product_flags(spark, sf_dir):
    label = F.expr(_LABEL)
    ml = (F.col("p_size") * 50).cast("double")
    return table(spark, sf_dir, "part").select(
        "p_partkey", products.is_hemp(label).alias("hemp"), products.is_non_alcoholic(label).alias("non_alcoholic"), products.origin_class(label).alias("origin"), products.volume_tier(ml).alias("tier"), products.container(label).alias("container"),
    )
