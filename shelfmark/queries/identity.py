"""Identity by discriminators, near names, spoken names and lineage."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import products
from ..operators import alike, identity as ops
from ..sources.working import shared_dir, spread
from . import Registry, table

register = Registry()

_RECORDS = """p AS (SELECT p_partkey, lower(p_brand) AS brand, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE lower(p_type) END AS kind, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_size // 10 AS VARCHAR) END AS size,
  'src' || p_partkey % 5 AS source, CASE WHEN p_partkey % 7 < 2 THEN CAST(p_partkey % 61 AS VARCHAR) END AS code, p_retailprice AS price FROM part)"""
_KEYS = _RECORDS + """,
k AS MATERIALIZED (SELECT md5(concat_ws('|', 'brand=' || brand, CASE WHEN kind <> '' THEN 'kind=' || kind END, CASE WHEN size <> '' THEN 'size=' || size END)) AS category_key, brand, kind, size,
  count(*) AS members, list(DISTINCT source) AS sources, list(DISTINCT code) FILTER (code IS NOT NULL) AS codes, median(price) AS price FROM p GROUP BY ALL),
m AS (SELECT a.category_key AS a, b.category_key AS b, a.brand, CASE WHEN len(list_intersect(a.codes, b.codes)) > 0 THEN 2 WHEN abs(a.price - b.price) <= 0.02 * greatest(a.price, b.price) THEN 1 ELSE 0 END AS strength
  FROM k a JOIN k b ON a.brand = b.brand AND a.category_key < b.category_key WHERE (a.kind = '' OR b.kind = '' OR a.kind = b.kind) AND (a.size = '' OR b.size = '' OR a.size = b.size))"""


def _records(spark, sf_dir):
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key, F.lower("p_brand").alias("brand"), F.when(key % 4 == 0, "").otherwise(F.lower("p_type")).alias("kind"), F.when(key % 3 == 0, "").otherwise(F.expr("cast(p_size div 10 as string)")).alias("size"),
        F.concat(F.lit("src"), (key % 5).cast("string")).alias("source"), F.when(key % 7 < 2, (key % 61).cast("string")).alias("code"), F.col("p_retailprice").alias("price"),
    )


@register(f"WITH {_KEYS} SELECT a, b, CASE strength WHEN 2 THEN 'code' ELSE 'price' END AS why FROM m WHERE strength > 0")
def confirmed_keys(spark, sf_dir):
    """Keys of a brand that disagree on nothing and share a code or a price."""
    keys = ops.category_keys(_records(spark, sf_dir), ["brand"], ["kind", "size"], "source", "code", "price")
    return ops.confirmed_edges(keys, ["brand"], ["kind", "size"], 0.02).select("a", "b", "why")


@register(f"""WITH RECURSIVE {_KEYS},
i AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY category_key) AS i FROM k),
e AS (SELECT m.brand, x.i AS u, y.i AS v, row_number() OVER (PARTITION BY m.brand ORDER BY strength DESC, a, b) AS n FROM m JOIN i x ON x.category_key = a JOIN i y ON y.category_key = b WHERE strength > 0),
r AS (SELECT brand, 0::BIGINT AS n, list(i ORDER BY i) AS g, list(kind ORDER BY i) AS kinds, list(size ORDER BY i) AS sizes FROM i GROUP BY brand
  UNION ALL SELECT brand, n, CASE WHEN ok THEN list_transform(g, lambda x: CASE WHEN x = hi THEN lo ELSE x END) ELSE g END,
    CASE WHEN ok THEN list_transform(kinds, lambda x, j: CASE WHEN j = lo THEN CASE WHEN x = '' THEN kinds[hi] ELSE x END ELSE x END) ELSE kinds END,
    CASE WHEN ok THEN list_transform(sizes, lambda x, j: CASE WHEN j = lo THEN CASE WHEN x = '' THEN sizes[hi] ELSE x END ELSE x END) ELSE sizes END
  FROM (SELECT *, (kinds[lo] = '' OR kinds[hi] = '' OR kinds[lo] = kinds[hi]) AND (sizes[lo] = '' OR sizes[hi] = '' OR sizes[lo] = sizes[hi]) AS ok
        FROM (SELECT r.brand, e.n, g, kinds, sizes, least(g[u], g[v]) AS lo, greatest(g[u], g[v]) AS hi FROM r JOIN e ON e.brand = r.brand AND e.n = r.n + 1))),
f AS (SELECT brand, arg_max(g, n) AS g FROM r GROUP BY brand),
c AS (SELECT i.*, z.category_key AS resolved FROM i JOIN f USING (brand) JOIN i z ON z.brand = i.brand AND z.i = f.g[i.i])
SELECT category_key, resolved, members, CAST(sum(members) OVER (PARTITION BY resolved) AS BIGINT) AS group_members, CAST(len(list_distinct(flatten(list(sources) OVER (PARTITION BY resolved)))) AS INTEGER) AS n_sources FROM c""")
def discriminator_clusters(spark, sf_dir):
    """Keys that say less join those that say more where a code or a price confirms it, the surest first; no group holds two kinds
    or two sizes."""
    return ops.resolved_identities(_records(spark, sf_dir), ["brand"], ["kind", "size"], "source", "code", "price", 0.02)


_SOUND = "x"
for _many, _one in (("[aeiou]", "a"), ("ph|f", "f"), ("ck|k|q|c", "k"), ("s|z|x", "s"), ("d|t", "t"), ("g|j", "j"), ("v|b", "v"), *[(f"{c}{c}+", c) for c in "abcdefghijklmnopqrstuvwxyz0123456789"]):
    _SOUND = f"regexp_replace({_SOUND}, '{_many}', '{_one}', 'g')"
_NAMES = "CASE p_partkey % 5 WHEN 0 THEN 'Ridenhouse ' WHEN 1 THEN 'The Rittenhouse ' WHEN 2 THEN 'Chibas ' WHEN 3 THEN 'Chivas ' ELSE 'Phyllis & Co. ' END || p_name || CASE WHEN p_size % 3 = 0 THEN ' twelve' ELSE ' 1100' END"


@register(f"""WITH w AS (SELECT p_partkey, list_filter(list_transform(string_split(trim(regexp_replace(lower({_NAMES}), '[^a-z0-9]+', ' ', 'g')), ' '),
  lambda x: coalesce(map {{'eight': '8', 'ten': '10', 'twelve': '12', 'fifteen': '15', 'eighteen': '18', 'twenty': '20', 'twentyone': '21', 'twentyfive': '25', 'thirty': '30', 'ocho': '8', 'diez': '10', 'doce': '12'}}[x], x)),
  lambda x: x NOT IN ('the', 'a', 'an', 'of', 'and', 'by', 'brand', 'wine', 'spirits', 'co', 'company', 'inc', 'ltd', '')) AS w FROM part)
SELECT p_partkey, array_to_string(w, ' ') AS spoken, array_to_string(list_transform(w, lambda x: CASE WHEN regexp_matches(x, '^[0-9]+$') THEN x ELSE {_SOUND} END), ' ') AS sound FROM w""")
def spoken_keys(spark, sf_dir):
    """Names as they are compared and as they sound."""
    name = F.expr(_NAMES.replace("VARCHAR", "STRING"))
    return table(spark, sf_dir, "part").select("p_partkey", products.spoken(name).alias("spoken"), products.phonetic(name).alias("sound"))


_SIGHTINGS = """s AS (SELECT d, 'st' || p_partkey % 7 AS store, CAST(p_partkey AS VARCHAR) AS item, TIMESTAMP '2024-03-01 06:00:00' + CAST(d AS INTEGER) * INTERVAL 1 DAY AS "at",
  CAST(1000 + p_partkey % 900 + CASE WHEN p_partkey % 4 = d THEN 50 ELSE 0 END AS VARCHAR) AS price, CASE WHEN p_partkey % 6 = d THEN '10' END AS discount, CASE WHEN p_partkey % 9 = 4 AND d = 2 THEN 'b' ELSE 'a' END AS section
  FROM part, range(3) t(d) WHERE (p_partkey + d) % 11 <> 0)"""


@register(f"""WITH {_SIGHTINGS},
l AS (SELECT *, lag(d) OVER w AS d0, lag(price) OVER w AS price0, lag(discount) OVER w AS discount0, lag(section) OVER w AS section0, lag("at") OVER w AS at0 FROM s WINDOW w AS (PARTITION BY store, item ORDER BY d)),
e AS (
  SELECT "at", store, item, 'new_item' AS event, '' AS was, price || '/' AS now FROM l WHERE d0 IS NULL OR d - d0 > 1
  UNION ALL SELECT "at", store, item, 'price', price0 || '/', price || '/' FROM l WHERE d - d0 = 1 AND price <> price0
  UNION ALL SELECT "at", store, item, 'discount', CASE WHEN discount0 IS NULL THEN 'false' ELSE 'true' END || '/' || coalesce(discount0, ''), CASE WHEN discount IS NULL THEN 'false' ELSE 'true' END || '/' || coalesce(discount, '') FROM l WHERE d - d0 = 1 AND discount IS DISTINCT FROM discount0
  UNION ALL SELECT "at", store, item, 'attr', 'n/' || section0, 'n/' || section FROM l WHERE d - d0 = 1 AND section <> section0
  UNION ALL SELECT "at" + INTERVAL 36 HOUR AS "at", store, item, 'delist', price || '/', '' FROM (SELECT *, lead(d) OVER (PARTITION BY store, item ORDER BY d) AS d1 FROM s) WHERE d1 - d > 1 OR (d1 IS NULL AND d < 2)),
h AS (SELECT left(sha1(store || '|' || item || '|' || event || '|' || epoch_ms("at") || '|' || now), 16) AS event_id, * FROM e)
SELECT *, lag(event_id) OVER (PARTITION BY store, item, event ORDER BY "at") AS supersedes FROM h""")
def item_lineage(spark, sf_dir):
    """Three daily sightings of a catalogue and a last row that moves the watermark on, as a stream with timers that is started
    for each day and goes on from its checkpoint."""
    from ..streaming import lineage

    place = f"{shared_dir(spark)}/lineage-{uuid.uuid4().hex}"
    part = table(spark, sf_dir, "part").select("p_partkey")
    items = part.count()
    buckets = max(1, items // 1000)
    states = min(buckets, max(spark.sparkContext.defaultParallelism, items // 50_000))  # a task of state costs its start in each batch
    day = F.timestamp_add("DAY", "d", F.lit(dt.datetime(2024, 3, 1, 6)))
    discount = F.when(F.col("p_partkey") % 6 == F.col("d"), "10")
    price = (1000 + F.col("p_partkey") % 900 + F.when(F.col("p_partkey") % 4 == F.col("d"), 50).otherwise(0)).cast("string")
    section = F.when((F.col("p_partkey") % 9 == 4) & (F.col("d") == 2), "b").otherwise("a")
    seen = lambda p: p.select(
        F.concat(F.lit("st"), (F.col("p_partkey") % 7).cast("string")).alias("store"), F.col("p_partkey").cast("string").alias("item"), day.alias("at"), price.alias("price"), F.lit(None).cast("string").alias("list_price"),
        discount.isNotNull().alias("on_promo"), discount.alias("discount"), F.lit("n").alias("name"), section.alias("section"),
    )
    last = spark.range(1).select(F.lit(dt.datetime(2024, 3, 4, 0)).alias("at"))
    days = [seen(spread(part).withColumn("d", F.lit(d)).filter("(p_partkey + d) % 11 <> 0")) for d in range(3)]
    for landed in (*days, last):
        landed.write.mode("append").parquet(f"{place}/landed")
        stream = spark.readStream.schema(days[0].schema).parquet(f"{place}/landed")
        events = lineage.lineage_events(stream, dt.timedelta(hours=36), buckets=buckets)
        lineage.write_lineage(events, f"{place}/events", f"{place}/checkpoint", states).awaitTermination()
    return spark.read.schema(lineage.EVENT_SCHEMA).parquet(f"{place}/events").withColumn("at", F.col("at").cast("timestamp_ntz"))


_ALIKE = """n AS (SELECT p_partkey AS id, p_brand AS block, p_name || ' ' || lower(p_type) || CASE WHEN p_partkey % 3 = 0 THEN ' x' || p_size % 7 ELSE '' END AS name FROM part),
d AS MATERIALIZED (SELECT block, name, min(id) AS node, count(*) AS rows FROM n GROUP BY ALL)"""


def _alike(spark, sf_dir):
    label = F.concat("p_name", F.lit(" "), F.lower("p_type"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" x"), (F.col("p_size") % 7).cast("string"))).otherwise(""))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("block"), label.alias("name"))


@register(f"""WITH {_ALIKE} SELECT least(x.node, y.node) AS a, greatest(x.node, y.node) AS b, round(jaro_winkler_similarity(x.name, y.name), 6) AS s FROM d x JOIN d y ON x.block = y.block AND x.name < y.name WHERE jaro_winkler_similarity(x.name, y.name) >= 0.93""")
def alike_name_pairs(spark, sf_dir):
    """Every two names of a brand above the bar, with units so small that blocks are cut."""
    nodes = alike._blocks(_alike(spark, sf_dir), "id", [F.col("block")], "name")
    return alike.alike_names(nodes, 0.93, unit=64).select("a", "b", F.round("s", 6).alias("s"))


@register(f"""WITH RECURSIVE {_ALIKE}, m AS MATERIALIZED (SELECT x.node AS a, y.node AS b, jaro_winkler_similarity(x.name, y.name) AS s FROM d x JOIN d y ON x.block = y.block AND x.name <> y.name WHERE jaro_winkler_similarity(x.name, y.name) >= 0.97),
r(node, c) AS (SELECT node, node FROM d UNION SELECT m.b, r.c FROM r JOIN m ON m.a = r.node WHERE r.c < m.b), k AS (SELECT node, min(c) AS cluster FROM r GROUP BY node),
e AS (SELECT a AS node, max(s) AS s, min(s) < 0.985 AS loose FROM m GROUP BY a),
i AS (SELECT n.id, k.cluster, round(CASE WHEN d.rows > 1 THEN 1.0 ELSE coalesce(e.s, 1.0) END, 4) AS match_confidence, coalesce(loose, false) AS loose FROM n JOIN d USING (block, name) JOIN k ON k.node = d.node LEFT JOIN e ON e.node = d.node)
SELECT cluster, count(*) AS members, min(match_confidence) AS confidence, bool_or(loose) OR count(*) > 20 AS flagged FROM i GROUP BY cluster""")
def name_clusters(spark, sf_dir):
    return alike.name_clusters(_alike(spark, sf_dir), "id", [F.col("block")], "name", 0.97, 0.985)[1]


@register(f"""WITH {_ALIKE}, q AS (SELECT *, ('0x' || substr(md5(block || '|' || name), 1, 8))::BIGINT % 20 = 0 AS drawn FROM d),
p AS (SELECT least(x.node, y.node) AS a, greatest(x.node, y.node) AS b, jaro_winkler_similarity(x.name, y.name) AS s, x.block FROM q x JOIN q y ON x.block = y.block AND x.name < y.name AND (x.drawn OR y.drawn)),
t AS (SELECT CASE WHEN s >= 0.86 THEN 'merged' ELSE 'near_miss' END AS stratum, CASE WHEN (a + b) % 5 = 0 THEN NULL WHEN u.p_type = v.p_type THEN 1 ELSE 0 END AS truth, CASE WHEN s >= 0.86 THEN 1 ELSE 0 END AS guess
  FROM p JOIN part u ON u.p_partkey = a JOIN part v ON v.p_partkey = b WHERE s >= 0.6),
c AS (SELECT stratum, count(*) AS pairs, count(truth) AS labelled, count(*) FILTER (truth = 1 AND guess = 1) AS tp, count(*) FILTER (truth = 0 AND guess = 1) AS fp, count(*) FILTER (truth = 1 AND guess = 0) AS fn
  FROM (SELECT * FROM t UNION ALL SELECT 'all', truth, guess FROM t) GROUP BY stratum)
SELECT *, round(tp / nullif(tp + fp, 0)::DOUBLE, 4) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 4) AS recall FROM c""")
def gold_scores(spark, sf_dir):
    """Strata of gold pairs above the bar and near below it, and how a rule does in each."""
    rows = _alike(spark, sf_dir)
    pairs = alike.near_misses(rows, "id", [F.col("block")], "name", 0.6, 1.01)
    kinds = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    p = pairs.join(kinds.toDF("a", "kind_a"), "a").join(kinds.toDF("b", "kind_b"), "b")
    truth = F.when((F.col("a") + F.col("b")) % 5 != 0, (F.col("kind_a") == F.col("kind_b")).cast("int"))
    labelled = p.select(F.when(F.col("s") >= 0.86, "merged").otherwise("near_miss").alias("stratum"), truth.alias("truth"), (F.col("s") >= 0.86).cast("int").alias("guess"))
    return alike.stratum_scores(labelled, "stratum", "truth", "guess")
