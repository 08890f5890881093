"""Data quality over orders, customers, parts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as ops
from . import Registry, table

register = Registry()


def _profile_sql(columns):
    rows = []
    for c, kind, number in columns:
        n = f"count(*) FILTER ({c} = 0), count(*) FILTER ({c} < 0), min({c})::DOUBLE, max({c})::DOUBLE" if number else "NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE, NULL::DOUBLE"
        rows.append(f"SELECT '{c}', '{kind}', count(*) FILTER ({c} IS NULL), count(*) FILTER (CAST({c} AS VARCHAR) = ''), count(DISTINCT {c}), {n}, round(count(*) FILTER ({c} IS NULL) / count(*)::DOUBLE, 4) FROM customer")
    return 'SELECT * FROM (' + " UNION ALL ".join(rows) + ') AS t("column", type, nulls, blanks, "distinct", zeros, negatives, least, largest, null_rate)'


@register(_profile_sql([("c_custkey", "bigint", True), ("c_name", "string", False), ("c_nationkey", "int", True), ("c_acctbal", "double", True), ("c_mktsegment", "string", False)]))
def dq_profile(spark, sf_dir):
    return ops.profile(table(spark, sf_dir, "customer"))


@register("""WITH l AS (SELECT 'p_type' AS "column", p_type AS value FROM part UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part), c AS (SELECT "column", value, count(*) AS n FROM l GROUP BY ALL)
SELECT "column", value, n, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rn FROM c) WHERE rn <= 8""")
def dq_top_values(spark, sf_dir):
    return ops.top_values(table(spark, sf_dir, "part"), ["p_type", "p_size"])


@register("WITH d AS (SELECT p_brand, p_type, p_size FROM part) SELECT (SELECT count(*) FROM d) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS distinct_rows, round(1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) / (SELECT count(*) FROM d)::DOUBLE, 6) AS dup_rate")
def dq_duplicates(spark, sf_dir):
    return ops.duplicates(table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size"))


def _fd(a, b):
    return f"SELECT '{a}' AS determinant, '{b}' AS dependent, count(*) AS groups, count(*) FILTER (d > 1) AS violations, count(*) FILTER (d > 1) = 0 AS holds FROM (SELECT {a}, count(DISTINCT {b}) AS d FROM t GROUP BY 1)"


_FD = ["n_name", "n_nationkey", "n_regionkey", "r_name"]


@register("WITH t AS (SELECT n_name, n_nationkey, n_regionkey, r_name FROM nation JOIN region ON r_regionkey = n_regionkey) " + " UNION ALL ".join(_fd(a, b) for a in _FD for b in _FD if a != b))
def dq_fd(spark, sf_dir):
    t = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(*_FD)
    return ops.dependencies(t, _FD)


@register("""SELECT * FROM (SELECT 'c_custkey' AS "columns", 1 AS width, count(DISTINCT c_custkey) AS "distinct", round(count(DISTINCT c_custkey) / count(*)::DOUBLE, 6) AS uniqueness FROM customer
  UNION ALL SELECT 'c_nationkey', 1, count(DISTINCT c_nationkey), round(count(DISTINCT c_nationkey) / count(*)::DOUBLE, 6) FROM customer UNION ALL SELECT 'c_acctbal', 1, count(DISTINCT c_acctbal), round(count(DISTINCT c_acctbal) / count(*)::DOUBLE, 6) FROM customer
  UNION ALL SELECT 'c_custkey,c_nationkey', 2, count(DISTINCT (c_custkey, c_nationkey)), round(count(DISTINCT (c_custkey, c_nationkey)) / count(*)::DOUBLE, 6) FROM customer
  UNION ALL SELECT 'c_custkey,c_acctbal', 2, count(DISTINCT (c_custkey, c_acctbal)), round(count(DISTINCT (c_custkey, c_acctbal)) / count(*)::DOUBLE, 6) FROM customer
  UNION ALL SELECT 'c_nationkey,c_acctbal', 2, count(DISTINCT (c_nationkey, c_acctbal)), round(count(DISTINCT (c_nationkey, c_acctbal)) / count(*)::DOUBLE, 6) FROM customer) WHERE uniqueness >= 0.99""")
def dq_candidate_key(spark, sf_dir):
    return ops.candidate_keys(table(spark, sf_dir, "customer"), ["c_custkey", "c_nationkey", "c_acctbal"])


@register("""WITH s AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', '  ') ELSE p_name END AS v FROM part)
SELECT lower(trim(regexp_replace(v, '\\s+', ' ', 'g'))) AS folded, count(DISTINCT v) AS spellings, count(*) AS n FROM s GROUP BY 1 HAVING count(DISTINCT v) > 1""")
def dq_fragmentation(spark, sf_dir):
    k = F.col("p_partkey") % 3
    s = table(spark, sf_dir, "part").select(F.when(k == 0, F.upper("p_name")).when(k == 1, F.replace("p_name", F.lit(" "), F.lit("  "))).otherwise(F.col("p_name")).alias("v"))
    return ops.fragmentation(s, "v")


@register("""WITH e AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_id % 7 = 0 OR (day(ts) > 20 AND event_id % 2 = 0) THEN '' ELSE event_type END AS kind, props FROM events),
r AS (SELECT day, count(*) AS rows, round(count(*) FILTER (kind <> '') / count(*)::DOUBLE, 6) AS kind, round(count(*) FILTER (props <> '') / count(*)::DOUBLE, 6) AS props FROM e GROUP BY 1),
l AS (SELECT day, rows, 'kind' AS "column", kind AS rate FROM r UNION ALL SELECT day, rows, 'props', props FROM r),
b AS (SELECT *, round(median(rate) OVER (PARTITION BY "column" ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS baseline FROM l)
SELECT *, coalesce(rate < baseline - 0.15, false) AS drifted FROM b""")
def fill_drift(spark, sf_dir):
    gap = (F.col("event_id") % 7 == 0) | ((F.dayofmonth("ts") > 20) & (F.col("event_id") % 2 == 0))
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.when(gap, F.lit("")).otherwise(F.col("event_type")).alias("kind"), "props")
    return ops.fill_drift(e, "day", ["kind", "props"])


@register("""WITH v AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN 99999.0 ELSE c_acctbal END AS x FROM customer), c AS (SELECT x, count(*) AS n FROM v GROUP BY 1)
SELECT x AS value, n, round(n / (SELECT count(*) FROM v)::DOUBLE, 4) AS share FROM c WHERE n / (SELECT count(*) FROM v)::DOUBLE >= 0.15 AND (x = (SELECT max(x) FROM v) OR x = (SELECT min(x) FROM v))""")
def dq_sentinel(spark, sf_dir):
    return ops.sentinel(table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 5 == 0, F.lit(99999.0)).otherwise(F.col("c_acctbal")).alias("x")), "x")


@register("""SELECT d.detector, CASE d.detector WHEN 'negative' THEN a WHEN 'huge' THEN b WHEN 'urgent_open' THEN c END AS hits, d.severity, n AS rows, round(d.severity * CASE d.detector WHEN 'negative' THEN a WHEN 'huge' THEN b WHEN 'urgent_open' THEN c END / n, 6) AS score
FROM (SELECT count(*) AS n, count(*) FILTER (o_totalprice < 0) AS a, count(*) FILTER (o_totalprice > 400000) AS b, count(*) FILTER (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') AS c FROM orders), (VALUES ('negative', 3.0::DOUBLE), ('huge', 2.0::DOUBLE), ('urgent_open', 1.0::DOUBLE)) AS d(detector, severity)""")
def dq_detectors(spark, sf_dir):
    conditions = {"negative": F.col("o_totalprice") < 0, "huge": F.col("o_totalprice") > 400000, "urgent_open": (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")}
    return ops.detect(table(spark, sf_dir, "orders"), conditions, {"negative": 3.0, "huge": 2.0})


@register("SELECT to_json_row.c_custkey, to_json_row.c_name FROM (SELECT * FROM customer) AS to_json_row WHERE CAST(c_custkey AS VARCHAR) || ' ' || c_name || ' ' || c_mktsegment ILIKE '%household%'")
def all_column_search(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.filter(F.to_json(F.struct("*")).ilike("%household%")).select("c_custkey", "c_name")
