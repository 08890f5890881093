"""Curation of products, outlets and runs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as keys
from ..functions import products
from ..functions.keys import bigint_code
from ..operators import curation as ops
from ..operators import entities
from ..sources.working import spread
from . import Registry, table

register = Registry()

_GENERIC = ", ".join(f"'{w}'" for w in keys.GENERIC)


def _brand_key_sql(c: str) -> str:
    """The brand key in DuckDB."""
    words = f"list_filter(string_split(trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')), '''s\\b', '', 'g'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: len(w) > 1 AND w NOT IN ({_GENERIC}))"
    return f"(SELECT CASE WHEN len(k) = 0 THEN '' WHEN k[-1][-1:] = 's' AND len(k[-1]) > 3 THEN array_to_string(list_append(k[:-2], k[-1][:-2]), ' ') ELSE array_to_string(k, ' ') END FROM (SELECT {words} AS k))"


_SPELT = """CASE p_partkey % 6 WHEN 0 THEN 'Château ' || upper(p_brand) || '''s Winery' WHEN 1 THEN 'CHATEAU ' || upper(p_brand) || '''S' WHEN 2 THEN 'chateau ' || lower(p_brand) || ' Wines'
  WHEN 3 THEN 'The Rémy ' || p_type WHEN 4 THEN 'remy ' || p_type || ' Co.' ELSE 'Ale & Ale' END"""


@register(f"SELECT p_partkey, {_SPELT} AS spelt, {_brand_key_sql(_SPELT)} AS brand_key FROM part")
def brand_keys(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.expr(_SPELT.replace("''''s", "'\\'s").replace("'''s", "'\\'s").replace("'''S", "'\\'S")).alias("spelt"))
    return p.withColumn("brand_key", keys.brand_key(F.col("spelt")))


@register(f"""WITH s AS (SELECT CASE p_partkey % 4 WHEN 0 THEN upper(p_brand) WHEN 1 THEN p_brand WHEN 2 THEN p_brand ELSE lower(p_brand) END AS b FROM part UNION ALL SELECT 'ACME' FROM part WHERE p_partkey % 10 = 0),
c AS (SELECT b, count(*) AS n, {_brand_key_sql('b')} AS k FROM s GROUP BY b),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY (upper(b) = b AND regexp_matches(b, '[A-Za-z]')), n DESC, length(b), b) AS rn, count(*) OVER (PARTITION BY k) AS spellings, sum(n) OVER (PARTITION BY k) AS all_rows FROM c WHERE k <> '')
SELECT k AS brand_key, CASE WHEN upper(b) = b AND regexp_matches(b, '[A-Za-z]') THEN upper(b[1]) || lower(b[2:]) ELSE b END AS display, spellings, CAST(all_rows AS BIGINT) AS rows FROM r WHERE rn = 1""")
def brand_displays(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    s = p.select(F.when(k == 0, F.upper("p_brand")).when(k == 3, F.lower("p_brand")).otherwise(F.col("p_brand")).alias("b"))
    return ops.brand_displays(s.unionByName(p.filter("p_partkey % 10 = 0").select(F.lit("ACME").alias("b"))), "b")


@register("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Rosé & Año ' || c_name WHEN 1 THEN 'D''Aquino' WHEN 2 THEN c_name ELSE 'Ã alone' END AS name FROM customer")
def repaired_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 4
    damaged = F.when(k == 0, F.concat(F.lit("RosÃ© &amp; AÃ±o "), F.col("c_name"))).when(k == 1, "D&#39;Aquino").when(k == 2, F.col("c_name")).otherwise("Ã alone")
    return c.select("c_custkey", keys.repaired(damaged).alias("name"))


_STREET = "CAST(c_custkey % 900 + 1 AS VARCHAR) || CASE c_custkey % 3 WHEN 0 THEN ' N Main Street' WHEN 1 THEN ' Oak Avenue Suite 5' ELSE ' W 5th Elmwood Rd' END"
_PHONE = "CASE c_custkey % 3 WHEN 0 THEN '(407) 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') WHEN 1 THEN '1-305-5550' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') ELSE '012345678' || c_custkey % 10 END"
_OUTLET = "CASE c_custkey % 2 WHEN 0 THEN 'The Corner Store #' || c_custkey || ', Inc.' ELSE 'ABC Liquor & Wine No. 12 LLC' END"


@register(f"""WITH o AS (SELECT c_custkey, {_STREET} AS street, {_PHONE} AS phone, {_OUTLET} AS name, c_acctbal / 100 AS lat, -c_acctbal / 77 AS lng FROM customer),
k AS (SELECT *, regexp_extract(lower(street), '^\\s*(\\d+)', 1) AS num, regexp_extract(regexp_replace(lower(street), '\\b(?:{"|".join(keys.STREET_WORDS)})\\b', ' ', 'g'), '([a-z]+)', 1) AS core, right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) AS d FROM o)
SELECT c_custkey, 'ad:' || num || left(core, 8) || '|fl' AS address_key, CASE WHEN length(d) = 10 AND d[1] NOT IN ('0', '1') THEN 'ph:' || d END AS phone_key,
  trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(name), '#\\s*\\w+|\\bno\\.?\\s*\\d+|\\b\\d{{2,}}\\b', ' ', 'g'), '\\b(?:{"|".join(keys.COMPANY_FORMS)})\\b\\.?|&', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS name_key FROM k""")
def outlet_keys(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    name = F.expr(_OUTLET.replace("VARCHAR", "STRING"))
    street, phone = F.expr(_STREET.replace("VARCHAR", "STRING")), F.expr(_PHONE.replace("VARCHAR", "STRING"))
    return c.select("c_custkey", keys.address_key(street, F.lit("Orlando"), F.lit("FL")).alias("address_key"), keys.phone_key(phone).alias("phone_key"), keys.name_key(name).alias("name_key"))


@register("""WITH r AS (SELECT l_suppkey AS code, l_orderkey, l_linenumber, [lead({'o': l_orderkey, 'l': l_linenumber}, 1) OVER w, lead({'o': l_orderkey, 'l': l_linenumber}, 2) OVER w, lead({'o': l_orderkey, 'l': l_linenumber}, 3) OVER w] AS n FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber)),
u AS (SELECT code, l_orderkey, l_linenumber, unnest(n) AS b FROM r) SELECT code, l_orderkey AS a_l_orderkey, l_linenumber AS a_l_linenumber, b.o AS b_l_orderkey, b.l AS b_l_linenumber FROM u WHERE b IS NOT NULL""")
def capped_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "code")
    return ops.capped_pairs(rows, "code", 3, ["l_orderkey", "l_linenumber"], F.col("l_orderkey"), F.col("l_linenumber"))


@register("""WITH a AS (SELECT p_partkey AS a_id, p_brand AS a_brand, row_number() OVER (ORDER BY md5('a' || p_partkey), p_partkey) AS rn FROM part), b AS (SELECT p_partkey AS b_id, p_brand AS b_brand, row_number() OVER (ORDER BY md5('b' || p_partkey), p_partkey) AS rn FROM part)
SELECT rn, a_id, a_brand, b_id, b_brand FROM a JOIN b USING (rn) WHERE a_brand <> b_brand""")
def zipped_negatives(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    side = lambda s: p.select(F.col("p_partkey").alias(f"{s}_id"), F.col("p_brand").alias(f"{s}_brand"), F.md5(F.concat(F.lit(s), F.col("p_partkey").cast("string"))).alias(f"{s}_h"))
    both = ops.zipped(side("a"), side("b"), F.struct("a_h", "a_id"), F.struct("b_h", "b_id"))
    return both.filter("a_brand <> b_brand").select("rn", "a_id", "a_brand", "b_id", "b_brand")


@register("""WITH i AS (SELECT p_partkey, p_size % 7 AS canon FROM part WHERE p_partkey % 3 = 0)
SELECT p_partkey, coalesce('c:' || canon, md5(p_brand || '|' || p_name)) AS identity FROM part LEFT JOIN i USING (p_partkey)""")
def identity_overlay(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    canon = p.filter("p_partkey % 3 = 0").select("p_partkey", (F.col("p_size") % 7).alias("canon"))
    rows = p.select("p_partkey", F.md5(F.concat_ws("|", "p_brand", "p_name")).alias("item_key"))
    return ops.overlay(rows, canon, ["p_partkey"], "canon", "item_key").select("p_partkey", "identity")


@register("SELECT l_partkey, count(DISTINCT l_suppkey % 20) AS n_sources, string_agg(DISTINCT 's' || l_suppkey % 20, ',' ORDER BY 's' || l_suppkey % 20) AS source_list FROM lineitem GROUP BY 1")
def canon_corroboration(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", F.concat(F.lit("s"), (F.col("l_suppkey") % 20).cast("string")).alias("s"))
    return ops.ordered_sources(rows, ["l_partkey"], "s")


@register("SELECT count(*) AS staged, count(*) FILTER (trim(b) <> '') AS qualified, count(*) - count(*) FILTER (trim(b) <> '') AS excluded FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE p_brand END AS b FROM part)")
def brand_gate(spark, sf_dir):
    k = F.col("p_partkey") % 5
    return ops.gate_counts(table(spark, sf_dir, "part").select(F.when(k == 0, "").when(k == 1, None).otherwise(F.col("p_brand")).alias("b")), "b")


@register("SELECT DISTINCT 's' || l_suppkey % 10 AS source, CAST(l_partkey AS VARCHAR) AS product_id, md5(p_brand) AS brand_key, md5(p_brand || '|' || p_name) AS product_key, md5(p_brand || '|' || p_name || '|' || p_size) AS item_key FROM lineitem JOIN part ON p_partkey = l_partkey")
def source_crosswalk(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 10).alias("s"), F.col("l_partkey").alias("p_partkey")).distinct()
    met = rows.join(table(spark, sf_dir, "part"), "p_partkey")
    return met.select(
        F.concat(F.lit("s"), F.col("s").cast("string")).alias("source"), F.col("p_partkey").cast("string").alias("product_id"),
        *[F.md5(F.concat_ws("|", *c)).alias(n) for n, c in (("brand_key", ["p_brand"]), ("product_key", ["p_brand", "p_name"]), ("item_key", ["p_brand", "p_name", F.col("p_size").cast("string")]))],
    )


@register("""SELECT p_type || '/' || p_size // 10 AS category_key, count(*) AS members, count(DISTINCT p_brand) AS n_sources, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS sources, min(p_name) AS sample_name, count(DISTINCT p_brand) >= 2 AS corroborated FROM part GROUP BY 1""")
def category_clusters(spark, sf_dir):
    return ops.category_clusters(table(spark, sf_dir, "part"), F.concat(F.col("p_type"), F.lit("/"), F.floor(F.col("p_size") / 10).cast("string")), "p_brand", "p_name")


@register("SELECT * EXCLUDE (props) FROM events")
def without_raw(spark, sf_dir):
    return table(spark, sf_dir, "events").drop("props")


@register("""WITH m AS (SELECT p_partkey, p_name, p_brand, list_sort(list(DISTINCT 'src_' || l_suppkey % 9)) AS source_list FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL)
SELECT p_partkey, p_name, p_brand, len(source_list) AS sources FROM m WHERE len(source_list) >= 2 AND (lower(p_name) LIKE '%src%7%' OR lower(p_brand) LIKE '%src%7%' OR replace(lower(array_to_string(source_list, ' ')), '_', ' ') LIKE '%src%7%')""")
def master_search(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array_sort(F.collect_set(F.concat(F.lit("src_"), (F.col("l_suppkey") % 9).cast("string")))).alias("source_list"))
    m = table(spark, sf_dir, "part").join(lines, "p_partkey").filter(F.size("source_list") >= 2)
    text = F.replace(F.lower(F.array_join("source_list", " ")), F.lit("_"), F.lit(" "))
    hit = F.lower("p_name").like("%src%7%") | F.lower("p_brand").like("%src%7%") | text.like("%src%7%")
    return m.filter(hit).select("p_partkey", "p_name", "p_brand", F.size("source_list").cast("long").alias("sources"))


@register("""SELECT o_orderkey, status FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'EXPIRED 2020' WHEN 1 THEN 'Surrendered' WHEN 2 THEN NULL ELSE 'approved' END AS status FROM orders) WHERE NOT regexp_matches(coalesce(lower(status), ''), 'expired|surrendered|revoked')""")
def live_filings(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 0, "EXPIRED 2020").when(k == 1, "Surrendered").when(k > 2, "approved").alias("status"))
    return rows.filter(~F.coalesce(F.lower("status"), F.lit("")).rlike("expired|surrendered|revoked"))


@register("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem WHERE (l_suppkey, l_returnflag) IN (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'R' END FROM supplier WHERE s_acctbal > 0)")
def row_value_members(spark, sf_dir):
    wanted = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_suppkey") % 2 == 0, "A").otherwise("R").alias("l_returnflag"))
    return ops.within(table(spark, sf_dir, "lineitem"), wanted, ["l_suppkey", "l_returnflag"]).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")


@register("SELECT count(*) AS fact_rows, round(sum(l_extendedprice), 2) AS revenue, round(sum(l_quantity), 1) AS cases, (SELECT count(*) FROM part) AS products, (SELECT count(*) FROM customer) AS accounts FROM lineitem")
def book_summary(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("fact_rows"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.round(F.sum("l_quantity"), 1).alias("cases"))
    one = lambda name, as_: F.broadcast(table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias(as_)))  # noqa: E731  one row
    return facts.join(one("part", "products")).join(one("customer", "accounts"))


@register("WITH s AS (SELECT p_brand || p_type AS b, count(*) AS n FROM part GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS blocks, min(n) AS min_per_block, max(n) AS max_per_block, median(n) AS median_per_block, count(*) FILTER (n > 1) AS multi_record_blocks FROM s")
def block_report(spark, sf_dir):
    return ops.block_report(table(spark, sf_dir, "part").withColumn("b", F.concat("p_brand", "p_type")), "b")


@register("""WITH r AS (SELECT 'src' || user_id % 25 AS source, CASE WHEN user_id % 25 % 3 = 0 THEN 'proxy' ELSE 'free' END AS kind, abs(value) * 60 AS secs, CAST(event_id % 11 AS BIGINT) - 3 AS added FROM events),
u AS (SELECT source, kind, count(*) AS runs, sum(secs) / 3600 AS hours, sum(greatest(added, 0)) AS rows_added FROM r GROUP BY ALL), k AS (SELECT * FROM (VALUES ('proxy', 0.5::DOUBLE, 12, 0.002::DOUBLE), ('free', 0.1, 0, 0.0)) AS t(kind, usd, calls, per_call))
SELECT source, kind, runs, round(hours, 2) AS machine_hours, CAST(rows_added AS BIGINT) AS rows_added, round(hours * usd, 2) AS compute_usd_mo, round(calls * runs * per_call, 2) AS infra_usd_mo, round(hours * usd + calls * runs * per_call, 2) AS total_usd_mo FROM u JOIN k USING (kind)""")
def cost_ledger(spark, sf_dir):
    n = F.col("user_id") % 25
    runs = table(spark, sf_dir, "events").select(F.concat(F.lit("src"), n.cast("string")).alias("source"), F.when(n % 3 == 0, "proxy").otherwise("free").alias("kind"), (F.abs("value") * 60).alias("secs"), (F.col("event_id") % 11 - 3).alias("added"))
    rates = spark.createDataFrame([("proxy", 0.5, 12, 0.002), ("free", 0.1, 0, 0.0)], "kind string, usd_per_hr double, calls int, usd_per_call double")
    return ops.costs(runs, rates, "source", "secs", "added", "kind")


@register("""WITH s AS (SELECT DISTINCT l_suppkey, l_partkey % 50 AS store, n_name AS city FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
SELECT city, count(*) AS shelves, (SELECT count(*) FROM s) AS all_shelves FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def market_breadth(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 50).alias("store")).distinct().join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return ops.breadth(rows.withColumnRenamed("n_name", "city"), ["l_suppkey", "store"], "city")


@register("""WITH n AS (SELECT p_brand, o_orderpriority AS serve, count(*) AS items FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL), t AS (SELECT *, sum(items) OVER (PARTITION BY p_brand) AS total FROM n)
SELECT p_brand, serve, items, round(100 * items / total, 2) AS share_pct FROM t WHERE total >= 8""")
def serve_shares(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return ops.shares(lines.select("p_brand", F.col("o_orderpriority").alias("serve")), "p_brand", "serve", 8)


@register("""SELECT p_partkey, p_retailprice AS price, CAST(count(*) AS BIGINT) AS reference_points, round(100.0 * count(*) FILTER (l_extendedprice / l_quantity < p_retailprice) / count(*), 2) AS percentile FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2 HAVING count(*) >= 3""")
def price_positions(spark, sf_dir):
    own = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return ops.price_percentiles(own, seen, "p_partkey", "price")


@register("""SELECT strftime(o_orderdate, '%Y-%m') AS month, l_partkey AS item, min(p_name) AS item_description, min(p_type) AS category, sum(l_quantity) AS bottles_sold, round(sum(l_extendedprice), 2) AS sale_dollars, round(sum(l_quantity * p_size) / 1000, 1) AS volume_liters
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def monthly_item_sales(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("o_orderkey") == F.col("l_orderkey"))
    sums = lines.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("l_partkey").alias("item")).agg(F.sum("l_quantity").alias("bottles_sold"), F.round(F.sum("l_extendedprice"), 2).alias("sale_dollars"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("item_description"), F.col("p_type").alias("category"), "p_size")
    return sums.join(p, "item").select("month", "item", "item_description", "category", "bottles_sold", "sale_dollars", F.round(F.col("bottles_sold") * F.col("p_size") / 1000, 1).alias("volume_liters"))


@register("""SELECT s_suppkey AS store_number, min(s_name) AS store_name, min(n_name) AS county, count(*) AS txns, round(sum(l_extendedprice), 0) AS total_sales FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1""")
def store_slices(spark, sf_dir):
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("store_number")).agg(F.count(F.lit(1)).alias("txns"), F.round(F.sum("l_extendedprice"), 0).alias("total_sales"))
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("store_number"), F.col("s_name").alias("store_name"), F.col("n_name").alias("county"))
    return sums.join(s, "store_number")


@register("""WITH m AS (SELECT l_partkey AS sku, count(DISTINCT l_suppkey % 4) AS sources, count(*) AS source_rows FROM lineitem GROUP BY 1), v AS (SELECT *, CASE WHEN sources >= 2 THEN 'master' ELSE 'queue' END AS view FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY view ORDER BY sources DESC, source_rows DESC, sku) AS place FROM v) SELECT sku, sources, source_rows, view, CAST(place AS INTEGER) AS place FROM r WHERE place <= 400""")
def workbench_views(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("sku")).agg(F.count_distinct(F.col("l_suppkey") % 4).alias("sources"), F.count(F.lit(1)).alias("source_rows"))
    return ops.queues(m, "sources", "source_rows", "sku", 400)


@register("""WITH m AS (SELECT l_partkey AS sku, list(DISTINCT l_suppkey % 4) AS s FROM lineitem GROUP BY 1) SELECT source, count(*) AS n, (SELECT count(*) FROM m) AS total, (SELECT count(*) FROM m WHERE len(s) >= 2) AS multi FROM (SELECT unnest(s) AS source FROM m) GROUP BY 1""")
def workbench_funnel(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sku"), (F.col("l_suppkey") % 4).alias("source")).distinct()
    sizes = m.groupBy("sku").agg(F.count(F.lit(1)).alias("k")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("k") >= 2).alias("multi"))
    return m.groupBy("source").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(sizes))  # one row


@register("""SELECT n_name AS geo, CAST(year(o_orderdate) AS INTEGER) AS vintage, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS F, sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS O, sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS P
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def wide_profile(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("n_name").alias("geo"))
    rows = table(spark, sf_dir, "orders").join(c, F.col("c_custkey") == F.col("o_custkey")).select("geo", F.year("o_orderdate").alias("vintage"), "o_orderstatus", "o_totalprice")
    return ops.wide_profile(rows, ["geo", "vintage"], "o_orderstatus", "o_totalprice", ["F", "O", "P"])


@register("""WITH y AS (SELECT p_type AS dim, p_brand AS member, sum(CASE WHEN year(l_shipdate) % 2 = 0 THEN l_quantity ELSE 0 END) AS v, sum(CASE WHEN year(l_shipdate) % 2 = 1 THEN l_quantity ELSE 0 END) AS b FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
s AS (SELECT *, v / sum(v) OVER (PARTITION BY dim) AS share, CASE WHEN b <> 0 THEN (v - b) / b END AS change FROM y), c AS (SELECT *, abs(change) * sqrt(share) AS score FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY dim ORDER BY v DESC, member) AS place, row_number() OVER (PARTITION BY dim ORDER BY round(score, 9) DESC NULLS LAST, member) AS move_place FROM c)
SELECT dim, member, v, b, round(share, 9) AS share, round(change, 9) AS change, round(score, 9) AS score, CAST(place AS INTEGER) AS place FROM p WHERE place <= 3""")
def movers_feed(spark, sf_dir):
    odd = F.year("l_shipdate") % 2
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum(F.when(odd == 0, F.col("l_quantity")).otherwise(0.0)).alias("v"), F.sum(F.when(odd == 1, F.col("l_quantity")).otherwise(0.0)).alias("b"))
    y = lines.join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).groupBy(F.col("p_type").alias("dim"), F.col("p_brand").alias("member")).agg(F.sum("v").alias("v"), F.sum("b").alias("b"))
    got = ops.movers_feed(y, "dim", "member", "v", "b", 3).filter("place <= 3")
    return got.select("dim", "member", "v", "b", *[F.round(c, 9).alias(c) for c in ("share", "change", "score")], "place")


@register("""WITH a AS (SELECT n_regionkey AS metro, n_nationkey AS area, count(DISTINCT c_custkey) AS stores, median(o_totalprice) AS area_median FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_totalprice > 1000 GROUP BY 1, 2 HAVING count(DISTINCT c_custkey) >= 3)
SELECT *, median(area_median) OVER (PARTITION BY metro) AS metro_median, round(100 * area_median / median(area_median) OVER (PARTITION BY metro), 2) AS "index" FROM a""")
def metro_price_areas(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("n_regionkey").alias("metro"), F.col("n_nationkey").alias("area"))
    rows = table(spark, sf_dir, "orders").filter("o_totalprice > 1000").join(c, F.col("c_custkey") == F.col("o_custkey"))
    return ops.floored_areas(rows, "area", "c_custkey", "o_totalprice", "metro")


@register("""WITH r AS (SELECT p_partkey AS id, p_brand AS b, p_type AS t, p_size AS z, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey % 3 AS VARCHAR) END AS code FROM part),
g AS (SELECT b, t, z, min(id) AS merged FROM r GROUP BY ALL HAVING count(DISTINCT id) > 1 AND count(DISTINCT code) <= 1) SELECT id, merged FROM r JOIN g USING (b, t, z)""")
def signature_merge_veto(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("b"), F.col("p_type").alias("t"), F.col("p_size").alias("z"), F.when(F.col("p_partkey") % 4 == 0, (F.col("p_partkey") % 3).cast("string")).alias("code"))
    return ops.signature_merge(rows, ["b", "t", "z"], "id", "code")


@register("""WITH g AS (SELECT p_brand, p_type, p_size, min(p_partkey) AS a FROM part GROUP BY ALL), m AS (SELECT a, p_partkey AS b FROM part JOIN g USING (p_brand, p_type, p_size) WHERE p_partkey <> a),
j AS (SELECT a, b, CASE WHEN b % 97 = 0 THEN 0 ELSE 1 END AS same FROM m WHERE b % 2 = 1), s AS (SELECT avg(same) AS precision, count(*) AS measured FROM j)
SELECT rule, a, b, round(precision, 6) AS precision, measured FROM (SELECT 'good' AS rule, m.*, s.* FROM m, s WHERE precision >= 0.98 UNION ALL SELECT 'strict', m.*, s.* FROM m, s WHERE precision >= 0.9999)""")
def gated_merges(spark, sf_dir):
    """Merges land only if their measured precision is at the bar."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    least = p.groupBy("p_brand", "p_type", "p_size").agg(F.min("p_partkey").alias("a"))
    merges = p.join(least, ["p_brand", "p_type", "p_size"]).filter("p_partkey <> a").select("a", F.col("p_partkey").alias("b"))
    labelled = merges.filter("b % 2 = 1").withColumn("same", F.when(F.col("b") % 97 == 0, 0).otherwise(1))
    landed = [ops.gated_merges(merges, labelled, bar).withColumn("rule", F.lit(rule)) for rule, bar in (("good", 0.98), ("strict", 0.9999))]
    return landed[0].unionByName(landed[1]).select("rule", "a", "b", F.round("precision", 6).alias("precision"), "measured")


@register("""WITH s AS (SELECT p_type AS stratum, p_partkey, p_size % 3 = 0 AS truth, row_number() OVER (PARTITION BY p_type ORDER BY md5(CAST(p_partkey AS VARCHAR))) AS pick FROM part)
SELECT stratum, count(*) AS n, round(avg(CASE WHEN truth THEN 1.0 ELSE 0.0 END), 4) AS share FROM s WHERE pick <= 12 GROUP BY 1""")
def gold_strata(spark, sf_dir):
    picked = ops.stratified(table(spark, sf_dir, "part").withColumnRenamed("p_type", "stratum"), "stratum", F.col("p_partkey"), 12)
    return picked.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.when(F.col("p_size") % 3 == 0, 1.0).otherwise(0.0)), 4).alias("share"))


@register("""WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n, vec_id % 4 AS cls, CASE WHEN vec_id % 3 = 0 THEN vec_id % 2 END AS var, vec_id % 5 AS size, [vec_id % 2, vec_id % 3 + 10] AS name FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.e, b.e) / (a.n * b.n), 4) * 2.2 AS cosine, CASE WHEN a.cls = b.cls THEN 1 ELSE -1 END AS c, CASE WHEN a.var IS NULL OR b.var IS NULL THEN 0 WHEN a.var = b.var THEN 1 ELSE -1 END AS r, CASE WHEN a.size = b.size THEN 1 ELSE -1 END AS s,
  len(list_intersect(a.name, b.name)) / (4 - len(list_intersect(a.name, b.name)))::DOUBLE AS overlap FROM v a JOIN v b ON a.vec_id < b.vec_id AND a.label <> b.label WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.35)
SELECT a, b, round(cosine, 4) AS cosine, CASE WHEN least(c, r) < 0 THEN 'look_alike' WHEN cosine >= 0.9 AND overlap >= 0.5 THEN 'same_item' WHEN cosine >= 0.9 OR overlap >= 0.4 THEN 'review' ELSE 'weak' END AS verdict FROM p""")
def image_verdicts(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    pairs = entities.cosine_at_least(e, "vec_id", "embedding", "label", 0.35)
    a, b = pairs.columns[0], pairs.columns[1]
    v = e.select(F.col("vec_id").alias("id"), "label", (F.col("vec_id") % 4).alias("cls"), F.when(F.col("vec_id") % 3 == 0, F.col("vec_id") % 2).alias("var"), (F.col("vec_id") % 5).alias("size"), F.array(F.col("vec_id") % 2, F.col("vec_id") % 3 + 10).alias("name"))
    side = lambda s: v.select(*[F.col(c).alias(f"{s}_{c}") for c in v.columns])
    met = pairs.join(side("x"), F.col(a) == F.col("x_id")).join(side("y"), F.col(b) == F.col("y_id")).filter("x_label <> y_label")
    shared = F.size(F.array_intersect("x_name", "y_name"))
    scored = met.select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), (F.round("s", 4) * 2.2).alias("cosine"), (shared / (4 - shared)).alias("overlap"),
        *[ops.agreement(F.col(f"x_{c}"), F.col(f"y_{c}")).alias(c) for c in ("cls", "var", "size")],
    )
    return ops.cross_match(scored, "cosine", "overlap", ["cls", "var"], "size").select("a", "b", F.round("cosine", 4).alias("cosine"), "verdict")


_CODE = "CASE p_partkey % 6 WHEN 0 THEN '0' || CAST(8500001949 + p_partkey AS VARCHAR) WHEN 1 THEN '2' || lpad(CAST(p_partkey AS VARCHAR), 12, '7') WHEN 2 THEN '1111111111' WHEN 3 THEN CAST(99 + p_partkey AS VARCHAR) WHEN 4 THEN '085000019498' ELSE '00' || CAST(78012345000 + p_partkey AS VARCHAR) END"


@register(f"""WITH c AS (SELECT p_partkey, {_CODE} AS d FROM part),
b AS (SELECT *, regexp_replace(d, '^0+', '') AS bare, right(lpad(d, 14, '0'), 12) AS frame FROM c),
k AS (SELECT *, (10 - list_sum(list_transform(generate_series(1, len(bare) - 1), lambda i: CAST(bare[len(bare) - i] AS INTEGER) * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END)) % 10) % 10 AS check_digit FROM b),
o AS (SELECT *, CASE WHEN len(bare) >= 9 AND check_digit = CAST(bare[-1] AS INTEGER) THEN bare[:-2] ELSE bare END AS core FROM k)
SELECT p_partkey, CASE WHEN len(d) BETWEEN 8 AND 14 AND d <> repeat(d[1], len(d)) AND NOT regexp_matches(d, '^0*123456789') AND frame[1] NOT IN ('2', '4', '5') AND NOT (len(d) = 13 AND d[1] = '2') AND len(core) >= 5 THEN core END AS core, TRY_CAST(d AS BIGINT) AS number FROM o""")
def significant_codes(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.expr(_CODE.replace("VARCHAR", "STRING")).alias("d"))
    return p.select("p_partkey", ops.significant_code(F.col("d")).alias("core"), bigint_code(F.col("d")).alias("number"))


@register("""WITH s AS (SELECT p_partkey, upper(left(replace(p_brand, '#', ''), 5)) || '00' AS code FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY p_partkey) - 2 AS n FROM s)
SELECT p_partkey, code, CASE WHEN n < 0 THEN code ELSE code[:-3] || substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST((n // 36) % 36 + 1 AS INTEGER), 1) || substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(n % 36 + 1 AS INTEGER), 1) END AS unique_code FROM r""")
def unique_mnemonics(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.upper(F.substring(F.replace("p_brand", F.lit("#"), F.lit("")), 1, 5)), F.lit("00")).alias("code"))
    return ops.unique_codes(rows, "code", "p_partkey", 2)


@register("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN round(value, 2) END AS number, CASE WHEN event_id % 3 = 1 THEN 'buy 2 get ' || user_id % 3 || ' free' END AS words FROM events""")
def promo_split(spark, sf_dir):
    k = F.col("event_id") % 3
    raw = F.when(k == 0, F.concat(F.lit("$ "), F.round("value", 2).cast("decimal(20,2)").cast("string"))).when(k == 1, F.concat(F.lit("buy 2 get "), (F.col("user_id") % 3).cast("string"), F.lit(" free"))).otherwise("  ")
    number, words = products.split_promo(raw)
    return table(spark, sf_dir, "events").select("event_id", number.alias("number"), words.alias("words"))


@register("""WITH f AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size || ' ml' END AS net FROM part), l AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN '750 ml' WHEN 1 THEN '' END AS net FROM part WHERE p_partkey % 2 = 0),
m AS (SELECT f.id, name, CASE WHEN l.net <> '' THEN l.net ELSE f.net END AS net FROM f LEFT JOIN l USING (id)) SELECT id, name, net FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id) AS n FROM m) WHERE n = 1""")
def filing_details(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_size")
    rows = p.select("id", "name", F.when(F.col("id") % 3 != 0, F.concat(F.col("p_size").cast("string"), F.lit(" ml"))).alias("net"))
    labels = p.filter("id % 2 = 0").select("id", F.when(F.col("id") % 4 == 0, "750 ml").when(F.col("id") % 4 == 1, "").alias("label_net"))
    return ops.details(rows, labels, "id", {"net": "label_net"}, ["name"], F.col("id"))


@register("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE left(md5(CAST(o_custkey AS VARCHAR)), 16) = left(md5(CAST(c_custkey AS VARCHAR)), 16)) AS known FROM customer")
def digest_members(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").select(ops.digest64(F.col("o_custkey")).alias("d")).distinct().withColumn("known", F.lit(True))
    asked = table(spark, sf_dir, "customer").select("c_custkey", ops.digest64(F.col("c_custkey")).alias("d"))
    return asked.join(seen, "d", "left").select("c_custkey", F.coalesce("known", F.lit(False)).alias("known"))


@register("""WITH p AS (SELECT regexp_replace(lower(s_name), '[^a-z0-9]', '', 'g') AS k, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip, s_acctbal / 1000 AS lng, s_suppkey / 100.0 AS lat, min_by(s_suppkey, s_suppkey) OVER (PARTITION BY s_name, s_nationkey) AS first FROM supplier WHERE s_acctbal / 1000 BETWEEN -1 AND 8 AND s_suppkey / 100.0 BETWEEN 0 AND 5)
SELECT s_suppkey, p.lat, p.lng FROM supplier s JOIN p ON p.k = regexp_replace(lower('  ' || upper(s_name)), '[^a-z0-9]', '', 'g') AND p.zip = lpad(CAST(s_nationkey AS VARCHAR), 5, '0')""")
def open_place_match(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    zip5 = F.lpad(F.col("s_nationkey").cast("string"), 5, "0")
    # The box is a filter on plain columns, so a scan of a public file is pruned by it.
    places = s.withColumns({"lng": F.col("s_acctbal") / 1000, "lat": F.col("s_suppkey") / 100.0}).filter("lng between -1 and 8 and lat between 0 and 5").select(F.regexp_replace(F.lower("s_name"), "[^a-z0-9]", "").alias("k"), zip5.alias("zip"), "lat", "lng")
    return s.select("s_suppkey", F.regexp_replace(F.lower(F.upper("s_name")), "[^a-z0-9]", "").alias("k"), zip5.alias("zip")).join(places, ["k", "zip"]).select("s_suppkey", "lat", "lng")


@register("""WITH a AS (SELECT DISTINCT coalesce(d.rid, x.item) AS resolved_id, p_brand AS brand, p_name AS name, CAST(p_size AS VARCHAR) AS size, 'a' AS source FROM part JOIN (SELECT p_partkey AS id, md5(p_name) AS item FROM part WHERE p_partkey % 5 <> 0) x ON x.id = p_partkey LEFT JOIN (SELECT md5(p_name) AS item, min('r' || p_size) AS rid FROM part WHERE p_size < 25 GROUP BY 1) d USING (item)),
b AS (SELECT DISTINCT 'b' || l_suppkey AS resolved_id, NULL AS brand, l_returnflag AS name, NULL AS size, 'b' AS source FROM lineitem) SELECT * FROM a UNION ALL SELECT * FROM b""")
def match_queue_rows(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("item", F.md5("p_name"))
    dim = p.filter("p_size < 25").groupBy("item").agg(F.min(F.concat(F.lit("r"), F.col("p_size").cast("string"))).alias("rid"))
    a = p.filter("p_partkey % 5 <> 0").join(dim, "item", "left").select(F.coalesce("rid", "item").alias("resolved_id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("size"), F.lit("a").alias("source")).distinct()
    b = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("b"), F.col("l_suppkey").cast("string")).alias("resolved_id"), F.lit(None).cast("string").alias("brand"), F.col("l_returnflag").alias("name"), F.lit(None).cast("string").alias("size"), F.lit("b").alias("source")).distinct()
    return a.unionByName(b)


@register("""SELECT p_partkey, CAST(CASE WHEN p_size < 3 THEN 0 WHEN p_partkey % 4 = 0 AND p_size % 2 = 0 THEN 1 WHEN p_size >= 40 THEN 2 ELSE 3 END AS INTEGER) AS priority FROM part""")
def queue_priorities(spark, sf_dir):
    p = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", ops.queue_priority(p[1] < 3, p[0] % 4 == 0, p[1] % 2 == 0, F.when(p[1] >= 40, 4).otherwise(1)).alias("priority"))


@register("""SELECT row_number() OVER (ORDER BY p_retailprice DESC NULLS LAST, p_partkey) AS place, p_partkey, p_name, p_retailprice FROM part WHERE lower(concat_ws(chr(31), p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)) LIKE '%brand#1%'""")
def grid_view(spark, sf_dir):
    return ops.grid(table(spark, sf_dir, "part"), "brand#1", ["p_partkey", "p_name", "p_retailprice"], "p_retailprice", True, True)


@register("""WITH r AS (SELECT user_id, CASE max(event_id) % 4 WHEN 0 THEN 'running' WHEN 1 THEN 'queued' WHEN 2 THEN 'ok' ELSE 'failed' END AS s, max(ts) AS beat FROM events GROUP BY 1), n AS (SELECT max(ts) AS now FROM events)
SELECT user_id, CAST(date_diff('second', date_trunc('second', beat), date_trunc('second', now)) AS BIGINT) AS heartbeat_age_s, CASE WHEN s IN ('running', 'queued') AND date_diff('second', date_trunc('second', beat), date_trunc('second', now)) > 900 THEN s END AS reported_status,
  CASE WHEN s IN ('running', 'queued') AND date_diff('second', date_trunc('second', beat), date_trunc('second', now)) > 900 THEN 'lost' ELSE s END AS status FROM r, n""")
def run_liveness(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.max("event_id") % 4
    runs = e.groupBy("user_id").agg(F.when(k == 0, "running").when(k == 1, "queued").when(k == 2, "ok").otherwise("failed").alias("status"), F.max("ts").alias("beat"))
    now = F.broadcast(e.agg(F.max("ts").alias("now")))  # one row
    return ops.liveness(runs.join(now), "status", "beat", F.col("now")).select("user_id", "heartbeat_age_s", "reported_status", "status")


@register("""WITH k AS (SELECT 'varietal' AS kind, 'merlot' AS match, 'Merlot (seed)' AS value, 'contains' AS mode), t AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN 'Varietal' WHEN 1 THEN 'type' ELSE 'other' END AS axis, CASE WHEN p_partkey % 11 = 0 THEN 'Shop All ' || p_type WHEN p_partkey % 7 = 0 THEN 'Merlot' ELSE p_type END AS value FROM part),
f AS (SELECT CASE lower(axis) WHEN 'varietal' THEN 'varietal' WHEN 'type' THEN CASE WHEN lower(value) = 'small' OR lower(value) LIKE 'zzz%' THEN 'class' END END AS kind, lower(value) AS match, min(value) AS value, 'contains' AS mode FROM t WHERE value NOT LIKE 'Shop All%' GROUP BY 1, 2)
SELECT * FROM k UNION ALL SELECT f.* FROM f WHERE kind IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k WHERE k.kind = f.kind AND k.match = f.match)""")
def dictionary_extension(spark, sf_dir):
    known = spark.createDataFrame([("varietal", "merlot", "Merlot (seed)", "contains")], "kind string, match string, value string, mode string")
    k = F.col("p_partkey")
    facets = table(spark, sf_dir, "part").select(F.when(k % 3 == 0, "Varietal").when(k % 3 == 1, "type").otherwise("other").alias("axis"), F.when(k % 11 == 0, F.concat(F.lit("Shop All "), F.col("p_type"))).when(k % 7 == 0, "Merlot").otherwise(F.col("p_type")).alias("value"))
    return ops.extend_dictionary(known, facets, {"small": "SMALL"})


_UPLOAD = {
    "UPC Code": "CASE p_partkey % 10 WHEN 0 THEN '12' WHEN 1 THEN NULL ELSE '085000019498' END", "Item Size": "p_size || ' ml'", "Retail": "'$' || p_retailprice", "Year": "CAST(1990 + p_size % 30 AS VARCHAR)",
    "Contact": "'a' || p_partkey || '@b.com'", "Brand Name": "p_brand", "Notes": "p_type", "Qty Sold": "CAST(p_size * 1000 + 500 AS VARCHAR)",
    "ITM_DSC_2": "p_name", "Alc Pct": "CAST(12.5 + p_size % 3 AS VARCHAR)", "Buyer": "p_name", "Vend Nm": "p_brand", "Image": "p_name", "Blank": "' '", "Brand": "p_brand", "Cs Pack": "concat(1 + p_size % 24, ' pk')",
    "Call": "concat('(212) 555-', 1000 + p_partkey % 9000)",
}


@register("""WITH u AS (SELECT round((SELECT count(*) FILTER (p_partkey % 10 > 1) / count(*) FILTER (p_partkey % 10 <> 1)::DOUBLE FROM part), 3) AS s)
SELECT * FROM (VALUES ('UPC Code', 'mapped', 'upc', 'values', (SELECT s FROM u)), ('Item Size', 'mapped', 'size_raw', 'values', 1.0::DOUBLE), ('Retail', 'mapped', 'price', 'values', 1.0), ('Year', 'mapped', 'vintage', 'values', 1.0),
('Contact', 'pii', NULL, NULL, NULL), ('Brand Name', 'mapped', 'brand', 'header', 0.9), ('Notes', 'mapped', 'description', 'header', 0.9), ('Qty Sold', 'proprietary', NULL, NULL, NULL), ('ITM_DSC_2', 'mapped', 'product_name', 'header', 0.9),
('Alc Pct', 'mapped', 'abv', 'values', 1.0), ('Buyer', 'pii', NULL, NULL, NULL), ('Vend Nm', 'mapped', 'supplier', 'header', 0.9), ('Image', 'derivable', NULL, NULL, NULL), ('Blank', 'empty', NULL, NULL, NULL), ('Brand', 'proprietary', NULL, NULL, NULL),
('Cs Pack', 'mapped', 'pack', 'values', 1.0), ('Call', 'pii', NULL, NULL, NULL)) AS t(header, bucket, field, how, share)""")
def header_mapping(spark, sf_dir):
    return ops.map_headers(spread(table(spark, sf_dir, "part")).select(*[F.expr(x.replace("VARCHAR", "STRING")).alias(c) for c, x in _UPLOAD.items()]))


_PRODUCTS = """SELECT CASE p_partkey % 8 WHEN 0 THEN '10850000194980' WHEN 1 THEN '85000019498' WHEN 2 THEN '085000019499' WHEN 3 THEN '1111111111' WHEN 4 THEN '8.5E+10' WHEN 5 THEN NULL ELSE '085000019498' END AS upc,
 CASE p_partkey % 40 WHEN 0 THEN 'RosÃ©' WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || ' 2015' WHEN 3 THEN p_brand || ' ' || p_name ELSE p_name END AS product_name, p_brand AS brand, CASE p_partkey % 50 WHEN 0 THEN '750' ELSE p_size || ' ml' END AS size,
 CAST(CASE p_partkey % 45 WHEN 0 THEN 120.0 WHEN 1 THEN 80.0 WHEN 2 THEN -1.0 ELSE 12.5 END AS DOUBLE) AS abv, CASE p_partkey % 60 WHEN 0 THEN 0.0 ELSE p_retailprice END AS price, CASE p_partkey % 35 WHEN 0 THEN p_retailprice - 1 ELSE p_retailprice END AS list_price FROM part"""


@register(f"""WITH p AS ({_PRODUCTS}), n AS (SELECT count(*) AS n, count(upc) AS u FROM p), h AS (
SELECT 'upc_is_gtin' AS detector, count(*) FILTER (length(upc) = 14) AS hits, 3.0::DOUBLE AS sev, (SELECT u FROM n) AS eligible, NULL::DOUBLE AS prec, false AS sys FROM p UNION ALL SELECT 'upc_zero_strip', count(*) FILTER (upc = '85000019498'), 3.0, (SELECT u FROM n), 0.97, true FROM p
UNION ALL SELECT 'upc_bad_check', count(*) FILTER (upc IN ('085000019499', '10850000194980')), 3.0, (SELECT u FROM n), 0.99, true FROM p UNION ALL SELECT 'upc_placeholder', count(*) FILTER (upc = '1111111111'), 3.0, (SELECT u FROM n), 0.5, true FROM p
UNION ALL SELECT 'upc_scientific', count(*) FILTER (upc = '8.5E+10'), 3.0, (SELECT u FROM n), 1.0, false FROM p UNION ALL SELECT 'abv_range', count(*) FILTER (abv > 96 OR abv < 0), 2.0, (SELECT n FROM n), 1.0, true FROM p UNION ALL SELECT 'abv_is_proof', count(*) FILTER (abv BETWEEN 76 AND 96), 2.0, (SELECT n FROM n), NULL, false FROM p
UNION ALL SELECT 'price_below_zero', count(*) FILTER (price <= 0), 2.0, (SELECT n FROM n), 1.0, false FROM p UNION ALL SELECT 'price_above_list', count(*) FILTER (price > list_price), 2.0, (SELECT n FROM n), 1.0, false FROM p UNION ALL SELECT 'size_without_unit', count(*) FILTER (size = '750'), 2.0, (SELECT n FROM n), 0.95, false FROM p
UNION ALL SELECT 'damaged_encoding', count(*) FILTER (product_name LIKE '%Ã%'), 1.0, (SELECT n FROM n), 1.0, true FROM p UNION ALL SELECT 'vintage_in_name', count(*) FILTER (product_name LIKE '% 2015'), 2.0, (SELECT n FROM n), 1.0, true FROM p
UNION ALL SELECT 'brand_repeated', count(*) FILTER (starts_with(lower(product_name), lower(brand) || ' ')), 1.0, (SELECT n FROM n), 1.0, true FROM p UNION ALL SELECT 'name_in_capitals', count(*) FILTER (upper(product_name) = product_name AND regexp_matches(product_name, '[A-Z]')), 1.0, (SELECT n FROM n), 1.0, true FROM p),
s AS (SELECT *, CASE WHEN NOT sys AND hits > 20 AND hits / eligible::DOUBLE > 0.05 THEN 'withheld' WHEN prec >= 0.9 THEN 'shown' ELSE 'silent' END AS state FROM h WHERE hits > 0)
SELECT detector, hits, eligible, state, CASE WHEN state = 'shown' THEN round(sev * greatest(0.2, 1 - hits / eligible::DOUBLE), 6) END AS rank FROM s""")
def upload_detectors(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    rows = spark.sql(_PRODUCTS)
    spark.catalog.dropTempView("part")
    known = {k: 1.0 for k in ops.detectors()} | {"upc_is_gtin": None, "upc_zero_strip": 0.97, "upc_bad_check": 0.99, "upc_placeholder": 0.5, "abv_is_proof": None, "size_without_unit": 0.95}
    conventions = ("upc_zero_strip", "upc_bad_check", "upc_placeholder", "abv_range", "damaged_encoding", "vintage_in_name", "brand_repeated", "name_in_capitals")
    return ops.inspect(rows, known, systematic=conventions)


@register("""SELECT 'orders' AS "table", count(*) AS rows, 0 AS empty_columns, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS duplicate_rows, count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS clean FROM orders
UNION ALL SELECT 'blown', count(*), 1, count(*) - count(DISTINCT p_size), false FROM part UNION ALL SELECT 'nation', count(*), 0, 0, true FROM nation""")
def table_scores(spark, sf_dir):
    blown = table(spark, sf_dir, "part").select("p_size", F.lit(None).cast("string").alias("gone"))
    return ops.table_scores({"orders": table(spark, sf_dir, "orders"), "blown": blown, "nation": table(spark, sf_dir, "nation")})
