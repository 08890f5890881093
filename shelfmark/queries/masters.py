"""Field rules and master data over parts as a catalog of three sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import gs1, text
from ..operators import masters as ops
from ..plans import rules
from . import Registry, table

register = Registry()

GRAINS = [("brand", ["brand"]), ("product", ["name"]), ("item", ["kind"]), ("sku", ["size"])]
NAMED = {"brand", "name"}
STAGED = """st AS (SELECT p_brand AS brand, p_name AS name, p_type AS kind, CAST(p_size AS VARCHAR) AS size, 'src' || (p_partkey % 3) AS _source, p_partkey FROM part)"""
_ID = "trim(regexp_replace(regexp_replace(lower({}), '(19[0-9]{{2}}|20[0-9]{{2}}|christmas|holiday|seasonal|limited edition|limited|special edition|gift set|gift pack|gift|anniversary|collector|commemorative)', '', 'g'), ' +', ' ', 'g'))"
KEYS = {}
_parts: list[str] = []
for _g, _fields in GRAINS:
    _parts = _parts + [f"coalesce({_ID.format(f) if f in NAMED else f'lower({f})'}, '')" for f in _fields]
    KEYS[_g] = "md5(" + " || '|' || ".join(_parts) + ")"


def staged(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_size").cast("string").alias("size"), F.concat(F.lit("src"), F.col("p_partkey") % 3).alias("_source"), "p_partkey")


def _shred(at):
    grain, fields = GRAINS[at]
    parent = f"min({KEYS[GRAINS[at - 1][0]]}) AS {GRAINS[at - 1][0]}_key, " if at else ""

    def query(spark, sf_dir):
        return ops.shred(staged(spark, sf_dir), GRAINS, grain, NAMED)

    query.__name__ = f"hierarchy_shred_{grain}"
    register(f"""WITH {STAGED} SELECT {KEYS[grain]} AS {grain}_key, {parent}{', '.join(f'min({f}) AS {f}' for f in fields)}, count(*) AS source_rows, count(DISTINCT _source) AS sources,
  string_agg(DISTINCT _source, ',' ORDER BY _source) AS source_list FROM st GROUP BY 1""")(query)


for _i in range(4):
    _shred(_i)


@register(f"WITH {STAGED} SELECT {KEYS['brand']} AS brand_key, kind, count(*) AS source_rows, string_agg(DISTINCT _source, ',' ORDER BY _source) AS source_list FROM st WHERE kind <> '' GROUP BY ALL")
def brand_supplier_association(spark, sf_dir):
    return ops.association(staged(spark, sf_dir), ops.grain_keys(GRAINS, NAMED)["brand"], "brand_key", "kind")


@register(f"""WITH {STAGED}, c AS (SELECT brand, kind, count(*) AS n FROM st GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY brand) AS a, row_number() OVER (PARTITION BY brand ORDER BY n DESC, kind) AS rn FROM c)
SELECT brand, kind, n AS votes, round(n / a, 4) AS share FROM r WHERE rn = 1""")
def majority_vote(spark, sf_dir):
    return ops.majority(staged(spark, sf_dir), ["brand"], "kind")


@register(f"""WITH {STAGED}, k AS (SELECT *, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_partkey // 8 AS VARCHAR) END AS code FROM st)
SELECT CASE WHEN code <> '' THEN 'S:' || code ELSE 'N:' || md5(lower(brand) || '|' || lower(name)) END AS entity_key, min(brand) AS brand, min(name) AS name, count(*) AS source_rows, count(DISTINCT _source) AS sources FROM k GROUP BY 1""")
def entity_resolve(spark, sf_dir):
    rows = staged(spark, sf_dir).withColumn("code", F.when(F.col("p_partkey") % 4 == 0, F.lit("")).otherwise(F.expr("cast(p_partkey div 8 as string)")))
    return ops.entity_resolve(rows, "code", ["brand", "name"])


@register(f"""WITH {STAGED}, k AS (SELECT *, CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS code FROM st),
o AS (SELECT brand, name, size, min(code) AS c FROM k WHERE code <> '' GROUP BY ALL HAVING count(DISTINCT code) = 1)
SELECT p_partkey, k.brand, k.name, k.size, CASE WHEN code = '' AND c IS NOT NULL THEN c ELSE code END AS code, code = '' AND c IS NOT NULL AS healed FROM k LEFT JOIN o ON o.brand = k.brand AND o.name = k.name AND o.size = k.size""")
def propagate_codes(spark, sf_dir):
    rows = staged(spark, sf_dir).select("p_partkey", "brand", "name", "size", F.when(F.col("p_partkey") % 5 == 0, F.col("p_partkey").cast("string")).otherwise(F.lit("")).alias("code"))
    return ops.propagate_unique(rows, ["brand", "name", "size"], "code")


@register(f"WITH {STAGED}, p AS (SELECT {KEYS['sku']} AS k, count(*) AS n, count(DISTINCT _source) AS s FROM st GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS entities, count(*) FILTER (s >= 2) AS corroborated, round(count(*) FILTER (s >= 2) / count(*)::DOUBLE, 4) AS rate FROM p")
def corroboration(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return ops.corroboration(rows.withColumn("k", ops.grain_keys(GRAINS, NAMED)["sku"]), "k")


@register(f"WITH {STAGED} SELECT brand, kind, name, size, _source, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY brand, kind ORDER BY _source, p_partkey) AS rn FROM st) WHERE rn = 1")
def first_writer_wins(spark, sf_dir):
    return ops.first_writer(staged(spark, sf_dir), ["brand", "kind"], F.col("_source"), F.col("p_partkey")).select("brand", "kind", "name", "size", "_source", "p_partkey")


@register("""WITH e AS (SELECT user_id, event_type AS s, CAST(event_id AS VARCHAR) AS idt, CASE WHEN event_id % 3 = 0 THEN '' ELSE props END AS props, value FROM events), t AS (SELECT *, lpad(idt, 10, '0') AS a FROM e)
SELECT user_id, arg_max(props, (a, s)) FILTER (props <> '') AS props, arg_max(value, (a, s)) AS value, arg_max(s, (a, s)) AS freshest_source, string_agg(DISTINCT s, ',' ORDER BY s) AS sources FROM t GROUP BY 1""")
def freshest_pick(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("s"), F.lpad(F.col("event_id").cast("string"), 10, "0").alias("a"), F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("props")).alias("props"), "value")
    return ops.freshest(e, ["user_id"], "a", ["props", "value"], "s")


@register("""WITH k AS (SELECT DISTINCT p_brand AS brand FROM part WHERE p_type = 'SMALL' AND p_size < 3), s AS (SELECT DISTINCT p_brand AS brand FROM part WHERE p_size > 5)
SELECT brand, 'B' || upper(substr(md5(brand), 1, 10)) AS id, '2024-01-01' AS first_seen, CASE WHEN brand IN (SELECT brand FROM s) THEN '2024-02-01' ELSE '2024-01-01' END AS last_seen FROM k
UNION ALL SELECT brand, 'B' || upper(substr(md5(brand), 1, 10)), '2024-02-01', '2024-02-01' FROM s WHERE brand NOT IN (SELECT brand FROM k)""")
def id_registry(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), "p_type", "p_size")
    start = spark.createDataFrame([], "brand string, id string, first_seen string, last_seen string")
    known = ops.register_ids(start, part.filter("p_type = 'SMALL' and p_size < 3"), "brand", "B", "2024-01-01")
    return ops.register_ids(known, part.filter("p_size > 5"), "brand", "B", "2024-02-01")


@register("""WITH r AS (SELECT p_partkey, p_name, p_type, p_size || ' oz' AS size_text FROM part)
SELECT p_partkey, upper(trim(p_name)) AS name, regexp_extract(p_name, '^([a-z]+) ', 1) AS colour, CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'LARGE' THEN 'L' ELSE p_type END AS kind,
  CASE WHEN p_name ILIKE '%widget%' THEN 'Widgets' WHEN p_name ILIKE '%bolt%' THEN 'Hardware' END AS family, CAST(round(CAST(regexp_extract(size_text, '([0-9.]+)', 1) AS DOUBLE) * 29.5735) AS BIGINT) AS ml, p_partkey * 2 AS twice FROM r""")
def map_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.concat("p_size", F.lit(" oz")).alias("size_text"))
    declared = {
        "name": {"source_field": "p_name", "pre": "trim", "post": "upper"},
        "colour": {"mode": "regex", "source_field": "p_name", "pattern": "^([a-z]+) "},
        "kind": {"mode": "map", "source_field": "p_type", "map": {"SMALL": "S", "LARGE": "L"}},
        "family": {"mode": "dict", "source_field": "p_name", "dict_entries": [{"match": "bolt", "value": "Hardware"}, {"match": "widget", "value": "Widgets"}], "dict_fallback": "null"},
        "ml": {"source_field": "size_text", "pre": "size_to_ml"},
        "twice": {"mode": "expr", "expr": "p_partkey * 2"},
    }
    return rows.select("p_partkey", *[rules.compile_rule(r).alias(n) for n, r in declared.items()])


@register("""SELECT CASE WHEN p_name ILIKE '%widget%' THEN 'Widgets' WHEN p_name ILIKE '%bolt%' THEN 'Hardware' END AS value, count(*) AS n, count(DISTINCT p_name) AS distinct_raw FROM part GROUP BY 1""")
def dict_coverage(spark, sf_dir):
    return rules.coverage(table(spark, sf_dir, "part"), "p_name", [{"match": "bolt", "value": "Hardware"}, {"match": "widget", "value": "Widgets"}])


@register("""WITH b AS (SELECT p_partkey, lpad(CAST(p_partkey * 7919 % 100000000000 AS VARCHAR), 11, '0') AS body FROM part),
d AS (SELECT *, list_sum([CAST(substr(body, 12 - i, 1) AS INTEGER) * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END for i in range(1, 12)]) AS t FROM b)
SELECT p_partkey, body || ((10 - t % 10) % 10) AS code, true AS ok, (10 - t % 10) % 10 = 0 AS zero_ok, lpad(body || ((10 - t % 10) % 10), 14, '0') AS gtin FROM d""")
def gs1_codes(spark, sf_dir):
    body = F.lpad((F.col("p_partkey") * 7919 % 100000000000).cast("string"), 11, "0")
    rows = table(spark, sf_dir, "part").select("p_partkey", body.alias("body")).withColumn("code", gs1.with_check_digit(F.col("body")))
    return rows.select("p_partkey", "code", gs1.valid(F.col("code")).alias("ok"), gs1.valid(F.concat("body", F.lit("0"))).alias("zero_ok"), text.upc14(F.col("code")).alias("gtin"))


@register("""WITH c AS (SELECT substr(lpad(CAST(p_partkey * 1000 AS VARCHAR), 12, '0'), 1, 8) AS prefix, p_brand, count(*) AS n FROM part GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY prefix) AS a, row_number() OVER (PARTITION BY prefix ORDER BY n DESC, p_brand) AS rn FROM c) SELECT prefix, p_brand, n AS votes, round(n / a, 4) AS share FROM r WHERE rn = 1""")
def prefix_owner_crosswalk(spark, sf_dir):
    codes = table(spark, sf_dir, "part").select((F.col("p_partkey") * 1000).alias("code"), "p_brand")
    return ops.prefix_owners(codes, "code", "p_brand", 8)
