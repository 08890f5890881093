"""Entity resolution and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, keys, text, vectors
from ..operators import assets, digests
from ..operators import entities as ops
from . import Registry, table

register = Registry()


@register("""WITH RECURSIVE k AS (SELECT c_custkey, c_custkey % 97 AS phone, c_custkey // 40 AS addr FROM customer),
e AS (SELECT a.c_custkey AS a, b.m AS b FROM k a JOIN (SELECT phone, min(c_custkey) AS m FROM k GROUP BY 1) b ON a.phone = b.phone
  UNION SELECT a.c_custkey, b.m FROM k a JOIN (SELECT addr, min(c_custkey) AS m FROM k GROUP BY 1) b ON a.addr = b.addr),
u AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
r(n, c) AS (SELECT a, a FROM u GROUP BY a HAVING min(b) > a UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.n WHERE r.c < u.b)
SELECT n AS node, min(c) AS component FROM r GROUP BY 1""")
def connected_components(spark, sf_dir):
    k = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 97).alias("phone"), F.expr("c_custkey div 40").alias("addr"))
    return ops.components(ops.strong_key_edges(k, "c_custkey", {"p": F.col("phone"), "a": F.col("addr")}), "a", "b")


@register("""WITH p AS (SELECT p_partkey, p_name, p_type, p_brand, p_size FROM part), j AS (
  SELECT a.p_partkey AS a, b.p_partkey AS b, jaro_winkler_similarity(a.p_name, b.p_name) AS s FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
SELECT a, b, round(s, 4) AS similarity, CASE WHEN s >= 0.95 THEN 'high' WHEN s >= 0.9 THEN 'medium' ELSE 'low' END AS confidence FROM j WHERE s >= 0.6""")
def blocked_fuzzy_pairs(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    alike = lambda names: names.withColumn("s", text.jaro_winkler("p_name_a", "p_name_b")).filter("s >= 0.6")
    scored = ops.class_pairs(part, "p_partkey", ["p_brand", "p_type", "p_size"], "p_name", alike)
    return scored.select("a", "b", F.round("s", 4).alias("similarity"), F.when(F.col("s") >= 0.95, "high").when(F.col("s") >= 0.9, "medium").otherwise("low").alias("confidence"))


@register("""WITH d AS (SELECT l.doc_id, toxic AS t, CASE WHEN regexp_matches(lower(text), '(idiot|moron|stupid|loser|trash)') THEN 1 ELSE 0 END AS g FROM labels l JOIN documents USING (doc_id)),
c AS (SELECT count(*) FILTER (t = 1 AND g = 1) AS tp, count(*) FILTER (t <> 1 AND g = 1) AS fp, count(*) FILTER (t = 1 AND g <> 1) AS fn, count(*) FILTER (t <> 1 AND g <> 1) AS tn FROM d)
SELECT *, round(tp / nullif(tp + fp, 0)::DOUBLE, 4) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 4) AS recall, round(2.0 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 4) AS f1 FROM c""")
def confusion_counts(spark, sf_dir):
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return ops.confusion(d.withColumn("g", F.lower("text").rlike("(idiot|moron|stupid|loser|trash)").cast("int")), "toxic", "g")


@register("""WITH r AS (SELECT p_brand || p_type AS gold, p_brand || p_size AS got FROM part), t AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT count(*) AS n FROM r GROUP BY gold, got)),
g AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT count(*) AS n FROM r GROUP BY gold)), a AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT count(*) AS n FROM r GROUP BY got))
SELECT CAST(t.s AS BIGINT) AS tp, round(t.s / a.s, 4) AS precision, round(t.s / g.s, 4) AS recall FROM t, g, a""")
def pair_precision_recall(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.concat("p_brand", "p_type").alias("gold"), F.concat("p_brand", "p_size").alias("got"))
    return ops.pair_quality(part, "gold", "got")


@register("""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), j AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label IS DISTINCT FROM b.label AS across, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON a.vec_id < b.vec_id)
SELECT a, b, across, round(s, 4) AS cosine, CASE WHEN s >= 0.5 THEN 'same' ELSE 'review' END AS verdict FROM j WHERE s >= 0.35 AND NOT isnan(s)""")
def cosine_pairs(spark, sf_dir):
    s = ops.cosine_at_least(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.35)
    return s.select("a", "b", "across", F.round("s", 4).alias("cosine"), F.when(F.col("s") >= 0.5, "same").otherwise("review").alias("verdict"))


@register("""WITH h AS (SELECT vec_id, label, list_sum([CASE WHEN embedding[i] > 0 THEN (1::UBIGINT << (i - 1)) ELSE 0 END for i in range(1, 65)])::UBIGINT AS h FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, a.label IS DISTINCT FROM b.label AS across, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS bits FROM h a JOIN h b ON a.vec_id < b.vec_id WHERE bit_count(xor(a.h, b.h)) <= 16""")
def hamming_pairs(spark, sf_dir):
    return ops.hamming_at_most(table(spark, sf_dir, "embeddings"), "vec_id", vectors.sign_bits(F.col("embedding")), "label", 16)


@register("""WITH p AS (SELECT p_partkey, p_name, p_brand, array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t <> ''))), ' ') AS sig FROM part)
SELECT p_brand, sig, min(p_partkey) AS kept, count(*) AS n, count(DISTINCT p_name) AS names FROM p GROUP BY ALL HAVING count(*) > 1""")
def signature_merge(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("sig", text.signature(F.col("p_name")))
    return p.groupBy("p_brand", "sig").agg(F.min("p_partkey").alias("kept"), F.count(F.lit(1)).alias("n"), F.count_distinct("p_name").alias("names")).filter("n > 1")


@register("""WITH t AS (SELECT p_partkey, p_brand, list_sort(list_distinct(string_split(lower(p_name || ' ' || p_type), ' '))) AS t FROM part)
SELECT a.p_partkey AS a, b.p_partkey AS b, round(len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t)))::DOUBLE, 4) AS jaccard FROM t a JOIN t b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey
WHERE len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t)))::DOUBLE >= 0.9""")
def token_overlap_pairs(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", text.tokens(F.concat_ws(" ", "p_name", "p_type")).alias("t"))
    near = lambda sets: sets.withColumn("jaccard", text.jaccard(F.col("t_a"), F.col("t_b"))).filter("jaccard >= 0.9")
    pairs = ops.class_pairs(p, "p_partkey", ["p_brand"], "t", near, ops.shared_start(["p_brand"], "t", 0.9))
    return pairs.select("a", "b", F.round("jaccard", 4).alias("jaccard"))


@register("""WITH p AS (SELECT s_suppkey AS id, 25 + (s_suppkey * 37 % 2000) / 100.0::DOUBLE AS lat, -120 + (s_suppkey * 91 % 4000) / 100.0::DOUBLE AS lng FROM supplier)
SELECT a.id AS a, b.id AS b, round(sqrt(pow((a.lat - b.lat) * 69.0, 2) + pow((a.lng - b.lng) * 54.6, 2)), 4) AS miles FROM p a JOIN p b ON floor(a.lat / 2) = floor(b.lat / 2) AND floor(a.lng / 2) = floor(b.lng / 2) AND a.id < b.id
WHERE sqrt(pow((a.lat - b.lat) * 69.0, 2) + pow((a.lng - b.lng) * 54.6, 2)) < 80""")
def geo_cell_candidates(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (25 + (F.col("s_suppkey") * 37 % 2000) / 100.0).alias("lat"), (-120 + (F.col("s_suppkey") * 91 % 4000) / 100.0).alias("lng"))
    pairs = ops.blocked_pairs(p, "id", [geo.cell(F.col("lat"), F.col("lng"), 2.0)], ["lat", "lng"])
    d = pairs.withColumn("miles", geo.planar_miles(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b")))
    return d.filter("miles < 80").select("a", "b", F.round("miles", 4).alias("miles"))


@register("SELECT CAST(substr(md5(CAST(c_custkey AS VARCHAR) || '|' || c_mktsegment), 1, 2) AS VARCHAR) AS b, count(*) AS n, min(c_custkey) AS least FROM customer GROUP BY 1")
def md5_buckets(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.groupBy(keys.bucket([F.col("c_custkey"), F.col("c_mktsegment")]).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("least"))


_LEADERS = """v AS (SELECT {item} AS item, vec_id AS id, {value} AS v, row_number() OVER (PARTITION BY {item} ORDER BY vec_id) AS n FROM embeddings),
r AS (SELECT item, 1::BIGINT AS n, [v] AS leaders, [0] AS clusters FROM v WHERE n = 1
  UNION ALL SELECT item, n, CASE WHEN fits THEN leaders ELSE list_append(leaders, v) END, list_append(clusters, CASE WHEN fits THEN list_position(near, best) - 1 ELSE len(leaders) END)
  FROM (SELECT *, {best}(near) AS best, coalesce({best}(near) {bar}, false) AS fits FROM (SELECT v.item, v.n, v.v, leaders, clusters, list_transform(leaders, lambda l: {measure}) AS near FROM r JOIN v ON v.item = r.item AND v.n = r.n + 1))),
f AS (SELECT item, arg_max(clusters, n) AS c FROM r GROUP BY item), a AS (SELECT v.item, v.id, CAST(f.c[v.n] AS INTEGER) AS cluster FROM v JOIN f USING (item))"""
_BY_COSINE = _LEADERS.format(item="vec_id % 60", value="embedding::DOUBLE[]", best="list_max", bar=">= 0.3", measure="list_cosine_similarity(l, v.v)")
_BY_BITS = _LEADERS.format(
    item="vec_id % 40", value="list_sum([CASE WHEN embedding[i] > 0 THEN (1::UBIGINT << (64 - i)) ELSE 0 END for i in range(1, 65)])::UBIGINT", best="list_min", bar="<= 24", measure="CAST(bit_count(xor(l, v.v)) AS INTEGER)"
)


@register(f"WITH RECURSIVE {_BY_COSINE} SELECT item, id, cluster FROM a")
def divergence_clusters(spark, sf_dir):
    """Vectors of an item, each by the nearest leader that is near enough."""
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 60).alias("item"), F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return assets.greedy_clusters(e, "item", "id", "v", least=0.3)


@register(f"""WITH RECURSIVE {_BY_BITS}, s AS (SELECT *, id % 7 AS source FROM a), w AS (SELECT item, count(DISTINCT source) AS total_sources, count(DISTINCT cluster) AS n_clusters FROM s GROUP BY item),
p AS (SELECT item, cluster, count(DISTINCT source) AS n_sources FROM s GROUP BY ALL)
SELECT item, cluster, CAST(row_number() OVER (PARTITION BY item ORDER BY n_sources DESC, CAST(cluster AS VARCHAR)) - 1 AS INTEGER) AS rank, n_clusters, n_sources, total_sources, round(n_sources / total_sources::DOUBLE, 3) AS share, CASE WHEN n_clusters = 1 THEN 'aligned' ELSE 'divergent_unconfirmed' END AS verdict
FROM p JOIN w USING (item) WHERE total_sources >= 5 UNION ALL SELECT item, NULL, NULL, NULL, total_sources, total_sources, NULL, 'insufficient_data' FROM w WHERE total_sources < 5""")
def asset_divergence(spark, sf_dir):
    """Looks of an item by hashes of 64 bits, ranked by the sources that show them."""
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 40).alias("item"), F.col("vec_id").alias("id"), assets.sign_hash(F.col("embedding")).alias("h"))
    found = assets.greedy_clusters(e, "item", "id", "h", hashes=True, most=24).withColumn("source", F.col("id") % 7)
    return assets.divergence(found, "item", "cluster", "source", hashes=True, sources=5)


@register("""WITH m AS (SELECT DISTINCT 'id-' || l_partkey AS k FROM lineitem WHERE l_quantity > 45) SELECT 'member' AS side, count(*) AS n FROM orders WHERE 'id-' || o_custkey IN (SELECT k FROM m) UNION ALL SELECT 'other', count(*) FROM orders WHERE 'id-' || o_custkey NOT IN (SELECT k FROM m)""")
def digest_filter(spark, sf_dir):
    """Membership by digests, with a filter before the shuffle, and its complement."""
    ids = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.concat(F.lit("id-"), F.col("l_partkey").cast("string")).alias("k"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("id-"), F.col("o_custkey").cast("string")).alias("k"))
    count = lambda side, df: df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n"))
    return count("member", digests.members(rows, ids, "k")).unionByName(count("other", digests.members(rows, ids, "k", anti=True)))


@register("""WITH p AS (SELECT p_partkey, p_name, p_brand AS block FROM part), s AS (SELECT block FROM p GROUP BY 1 HAVING count(*) > 20), f AS (SELECT p_partkey, p_name, CASE WHEN block IN (SELECT block FROM s) THEN block || '|' || p_name[1:4] ELSE block END AS block FROM p),
l AS (SELECT block FROM f GROUP BY 1 HAVING count(*) > 20), n AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY p_name, p_partkey) AS rn FROM f)
SELECT x.p_partkey AS a, y.p_partkey AS b, x.block FROM f x JOIN f y USING (block) WHERE x.p_partkey < y.p_partkey AND block NOT IN (SELECT block FROM l)
UNION ALL SELECT least(x.p_partkey, y.p_partkey), greatest(x.p_partkey, y.p_partkey), x.block FROM n x JOIN n y USING (block) WHERE y.rn > x.rn AND y.rn <= x.rn + 10 AND block IN (SELECT block FROM l)""")
def pairs_of_large_blocks(spark, sf_dir):
    return ops.blocked_pairs(table(spark, sf_dir, "part"), "p_partkey", [F.col("p_brand")], ["p_name"], 20).select("a", "b", "block")
