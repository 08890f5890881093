"""Strings, arrays and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from . import Registry, table

register = Registry()


@register("""SELECT source, lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars, max(n_chars) AS longest, count(DISTINCT md5(text)) AS distinct_texts, count(*) - count(DISTINCT md5(text)) AS copies FROM documents GROUP BY ALL""")
def document_profile(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("h", F.md5("text"))
    return d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"), F.max("n_chars").alias("longest"), F.count_distinct("h").alias("distinct_texts"), (F.count(F.lit(1)) - F.count_distinct("h")).alias("copies"))


@register("""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, octet_length(encode(html)) AS bytes, (length(html) - length(replace(html, '<p>', ''))) // 3 AS paragraphs FROM pages""")
def page_fields(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.octet_length("html").cast("long").alias("bytes"), F.floor((F.length("html") - F.length(F.replace("html", F.lit("<p>"), F.lit("")))) / 3).alias("paragraphs"))


@register("""SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS path, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM conversations GROUP BY 1""")
def conversation_lineage(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    path = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">")
    return c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), path.alias("path"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


@register("""SELECT p_brand, len(list_distinct(list(p_type))) AS types, array_to_string(list_sort(list_distinct(list(p_type))), ',') AS type_list, list_contains(list(p_type), 'SMALL') AS has_small FROM part GROUP BY 1""")
def array_functions(spark, sf_dir):
    s = F.sort_array(F.collect_set("p_type"))
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.size(s).cast("long").alias("types"), F.array_join(s, ",").alias("type_list"), F.array_contains(s, "SMALL").alias("has_small"))


@register("""WITH u AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) SELECT w, count(*) AS n, count(DISTINCT p_partkey) AS parts FROM u GROUP BY 1""")
def explode_tokens(spark, sf_dir):
    u = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("w"))
    return u.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_partkey").alias("parts"))


@register("""SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, round(stddev_samp(value), 4) AS sd, round(quantile_cont(value, 0.9), 4) AS p90 FROM events GROUP BY 1""")
def json_and_quantiles(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("long")).alias("k_sum"), F.round(F.stddev_samp("value"), 4).alias("sd"), F.round(F.percentile("value", 0.9), 4).alias("p90"))


@register("""SELECT c_custkey, CAST(c_custkey * 104729 % 1000000000 AS VARCHAR) AS raw, nullif(substr(CAST(c_custkey * 104729 % 1000000000 AS VARCHAR), 1, 5), '') AS zip5,
  CASE WHEN length(CAST(c_custkey * 104729 % 1000000000 AS VARCHAR)) >= 9 THEN substr(CAST(c_custkey * 104729 % 1000000000 AS VARCHAR), 6, 4) END AS zip4, upper(c_mktsegment) AS name, nullif(regexp_extract(c_name, '(19[0-9]{2}|20[0-9]{2})'), '') AS vintage FROM customer""")
def normalizers(spark, sf_dir):
    raw = (F.col("c_custkey") * 104729 % 1000000000).cast("string")
    c = table(spark, sf_dir, "customer").withColumn("raw", raw)
    return c.select("c_custkey", "raw", text.normalize("zip5", F.col("raw")).alias("zip5"), text.normalize("zip4", F.col("raw")).alias("zip4"), text.normalize("name", F.col("c_mktsegment")).alias("name"), text.normalize("vintage", F.col("c_name")).alias("vintage"))
