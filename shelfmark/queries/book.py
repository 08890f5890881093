"""Book cuts and marts over orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import book as ops
from . import Registry, table

register = Registry()

FACTS = """f AS (SELECT p_brand AS brand, o_custkey AS account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, l_extendedprice AS revenue, l_quantity AS cases
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""


def facts(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").alias("revenue"), F.col("l_quantity").alias("cases"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("account_id"), F.trunc(F.to_date("o_orderdate"), "month").alias("month"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    return items.join(orders, "l_orderkey").join(parts, "l_partkey").drop("l_orderkey", "l_partkey")


def _cut(kind, sql, of="revenue"):
    def query(spark, sf_dir):
        return ops.cuts(facts(spark, sf_dir), "brand", kind, of)

    query.__name__ = f"book_cuts_{kind}"
    register(f"WITH {FACTS} {sql}")(query)


_cut("sum", "SELECT brand AS name, round(sum(revenue), 1) AS value FROM f GROUP BY 1")
_cut("distinct", "SELECT brand AS name, count(DISTINCT account_id) AS value FROM f GROUP BY 1", "account_id")
_cut("share", "SELECT brand AS name, round(100.0 * sum(revenue) / (SELECT sum(revenue) FROM f), 2) AS value FROM f GROUP BY 1")
_cut("rate", "SELECT brand AS name, round(sum(revenue) / count(DISTINCT account_id), 2) AS value FROM f GROUP BY 1")
_cut("index", "SELECT brand AS name, round(100.0 * (sum(revenue) / sum(cases)) / (SELECT sum(revenue) / sum(cases) FROM f), 1) AS value FROM f GROUP BY 1")
_cut("yoy", """, m AS (SELECT month, row_number() OVER (ORDER BY month DESC) AS rn FROM (SELECT DISTINCT month FROM f)),
g AS (SELECT brand, sum(CASE WHEN rn <= 12 THEN revenue ELSE 0 END) AS n, sum(CASE WHEN rn > 12 THEN revenue ELSE 0 END) AS t FROM f JOIN m USING (month) WHERE rn <= 24 GROUP BY 1)
SELECT brand AS name, round(100.0 * (n - t) / nullif(t, 0), 1) AS value FROM g WHERE t <> 0""")


@register("""WITH m AS (SELECT o_orderpriority AS market, o_orderstatus AS status, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, round(sum(o_totalprice), 2) AS revenue, count(*) AS n FROM orders GROUP BY ALL)
SELECT a.market, a.status, a.period, a.revenue, a.n, b.revenue AS prior, round(100.0 * (a.revenue - b.revenue) / nullif(b.revenue, 0), 2) + 0.0 AS yoy_pct
FROM m a LEFT JOIN m b ON b.market = a.market AND b.status = a.status AND b.period = a.period - 100""")
def mart_yoy_selfjoin(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("market"), F.col("o_orderstatus").alias("status"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("period"), F.col("o_totalprice").alias("revenue"),
    )
    mart = orders.groupBy("market", "status", "period").agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))
    return ops.year_over_year(mart, ["market", "status"], "period", "revenue")


@register("""WITH s AS (SELECT p_type, p_brand, count(*) AS share, 40 AS total FROM part GROUP BY ALL),
e AS (SELECT *, share / sum(share) OVER (PARTITION BY p_type) * total AS exact FROM s), b AS (SELECT *, floor(exact) AS base FROM e),
r AS (SELECT *, total - sum(base) OVER (PARTITION BY p_type) AS rest, row_number() OVER (PARTITION BY p_type ORDER BY round(exact - base, 9) DESC, p_type, p_brand) AS rn FROM b)
SELECT p_type, p_brand, share, total, CAST(base + CASE WHEN rn <= rest THEN 1 ELSE 0 END AS BIGINT) AS units FROM r""")
def largest_remainder_allocation(spark, sf_dir):
    shares = table(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("share")).withColumn("total", F.lit(40))
    return ops.largest_remainder(shares, ["p_type"], "share", "total")


@register("""SELECT coalesce(r_name, '(all)') AS region, coalesce(n_name, '(all)') AS nation, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def rollup_totals(spark, sf_dir):
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")).select(
        F.coalesce("r_name", F.lit("(all)")).alias("region"), F.coalesce("n_name", F.lit("(all)")).alias("nation"), "customers", "balance"
    )
