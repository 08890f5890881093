"""Tables that are written, merged, folded, repaired and read back, and statements that the console runs.

Each query has a catalog of its own in the shared folder and returns what a reader finds there in the end.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators import offers
from ..operators import quality, rollups
from ..plans import compose, console, rules
from ..sources import footers, places, reference, stores, uploads
from ..sources.catalog import Catalog, Conflict
from ..sources.working import shared_dir, spread
from ..streaming import folds
from . import Registry, table

register = Registry()


def _catalog(spark: SparkSession) -> Catalog:
    return Catalog(spark, f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}")


def _parts(spark: SparkSession, sf_dir: str) -> tuple[Catalog, DataFrame]:
    """Customers' orders in three parts: each knows some customers' balance, name or neither."""
    c = _catalog(spark)
    rows = table(spark, sf_dir, "customer")
    c.write_part("landed", "2024-01-01_a", rows.select("c_custkey", "c_name", "c_acctbal"))
    c.write_part("landed", "2024-01-02_a", rows.filter("c_custkey % 2 = 0").select("c_custkey", F.lit("").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal")))
    c.write_part("landed", "2024-01-03_a", rows.filter("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("new "), F.col("c_name")).alias("c_name"), F.lit(None).cast("double").alias("c_acctbal")))
    return c, rows


@register("SELECT p_brand, count(*) AS n, max(p_retailprice) AS dearest FROM part WHERE p_size >= 20 GROUP BY 1")
def catalog_query(spark, sf_dir):
    c = _catalog(spark)
    c.write("part", table(spark, sf_dir, "part"), ["p_partkey", "p_brand", "p_size", "p_retailprice"])
    return c.query("part", "SELECT p_brand, count(*) AS n, max(p_retailprice) AS dearest FROM t WHERE p_size >= :least GROUP BY p_brand", {"least": 20})


@register("SELECT year(o_orderdate)::VARCHAR AS part, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders WHERE year(o_orderdate) >= 1995 GROUP BY 1")
def catalog_parts_scan(spark, sf_dir):
    c = _catalog(spark)
    orders = table(spark, sf_dir, "orders")
    for y in [r["y"] for r in orders.select(F.year("o_orderdate").alias("y")).distinct().collect()]:  # a few years
        c.write_part("orders", str(y), orders.filter(F.year("o_orderdate") == y))
    chosen = [p for p in c.parts("orders") if p >= "1995"]
    rows = c.read_parts("orders", chosen).withColumn("file", F.col("_metadata.file_path"))
    return rows.groupBy(F.regexp_extract("file", "part=([^/]+)/", 1).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


@register("SELECT '2024-05-0' || (1 + event_id % 2) || '_s0' || event_id % 3 || '_b0000' AS part, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1")
def catalog_land(spark, sf_dir):
    c = _catalog(spark)
    schema = StructType([StructField("event_id", LongType()), StructField("value", DoubleType()), StructField("missing", StringType())])
    e = table(spark, sf_dir, "events")
    for day in range(2):
        for shard in range(3):
            c.land("events", e.filter((F.col("event_id") % 2 == day) & (F.col("event_id") % 3 == shard)), schema, f"2024-05-0{1 + day}", shard)
    return c.table("events").groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


@register("SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, CAST(NULL AS VARCHAR) AS note FROM nation")
def catalog_from_csv(spark, sf_dir):
    c = _catalog(spark)
    path = f"{c.root}/_upload"
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("note")).write.option("header", "true").csv(path)
    c.from_csv("nation", path, ["key", "name", "note"])
    return c.table("nation")


_MERGED = """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 5 ELSE p_retailprice END AS price, CASE WHEN p_partkey % 3 = 0 THEN 'b2' END AS batch FROM part WHERE p_partkey % 5 <> 0 OR p_partkey % 3 = 0"""


def _merged(c: Catalog, spark: SparkSession, sf_dir: str) -> None:
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    c.merge("prices", p.filter("p_partkey % 5 <> 0"))
    c.merge("prices", p.filter("p_partkey % 3 = 0").withColumn("price", F.col("price") + 5).withColumn("batch", F.lit("b2")))


@register(_MERGED)
def catalog_merge_buckets(spark, sf_dir):
    """Rows of the second batch replace and add, and its new column widens the table."""
    c = _catalog(spark)
    c.create_bucketed("prices", ["p_partkey"], StructType([StructField("p_partkey", LongType()), StructField("price", DoubleType())]), 1)
    _merged(c, spark, sf_dir)
    return c.table("prices")


@register("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 5 ELSE p_retailprice END AS price FROM part")
def catalog_migrate_and_back(spark, sf_dir):
    """Single, then bucketed, merged, and single again."""
    c = _catalog(spark)
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    c.write("prices", p)
    c.migrate("prices", ["p_partkey"], 1)
    c.merge("prices", p.filter("p_partkey % 3 = 0").withColumn("price", F.col("price") + 5))
    c.rollback("prices")
    return c.table("prices")


@register("""WITH b AS (SELECT p_partkey, left(md5(CAST(p_partkey AS VARCHAR)), 1) AS b FROM part) SELECT CAST(v AS BIGINT) AS version, n AS buckets FROM (SELECT 2 AS v, count(DISTINCT b) FILTER (p_partkey % 3 = 0) AS n FROM b UNION ALL SELECT 3, count(DISTINCT b) FILTER (p_partkey < 4) FROM b)""")
def catalog_changes(spark, sf_dir):
    c = _catalog(spark)
    c.create_bucketed("prices", ["p_partkey"], StructType([StructField("p_partkey", LongType()), StructField("price", DoubleType())]), 1)
    _merged(c, spark, sf_dir)
    c.merge("prices", table(spark, sf_dir, "part").filter("p_partkey < 4").select("p_partkey", F.lit(1.0).alias("price")))
    return spark.createDataFrame([(e["version"], len(e["buckets"])) for e in c.changes("prices", 1)], "version long, buckets long")


@register("SELECT p_partkey, p_retailprice AS price FROM part WHERE p_size < 10")
def catalog_rebuild(spark, sf_dir):
    c = _catalog(spark)
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"), "p_size")
    c.create_bucketed("prices", ["p_partkey"], p.drop("p_size").schema, 1)
    c.merge("prices", p.drop("p_size"))
    c.rebuild("prices", p.filter("p_size < 10"))
    return c.table("prices")


@register("SELECT * FROM (VALUES ('first', true, (SELECT count(*) FROM nation)), ('second', false, (SELECT count(*) FROM nation))) AS t(writer, won, rows)")
def catalog_conflict(spark, sf_dir):
    """Two writers that start from one version: the second is refused and leaves nothing behind."""
    c = _catalog(spark)
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c.create_bucketed("nation", ["n_nationkey"], n.schema, 1)
    seen = c.manifest("nation")
    c.merge("nation", n)
    try:
        c._commit("nation", seen, c._write_buckets("nation", n.limit(1), seen, 1), [])
        second = True
    except Conflict:
        second = False
    rows = c.row_count("nation")
    return spark.createDataFrame([("first", True, rows), ("second", second, rows)], "writer string, won boolean, rows long")


@register("""SELECT 'nation' AS name, 'single' AS layout, count(*) AS rows, 3 AS columns FROM nation UNION ALL SELECT 'orders', 'parts', count(*), 3 FROM orders UNION ALL SELECT 'supplier', 'bucketed', count(*), 2 FROM supplier""")
def catalog_listing(spark, sf_dir):
    c = _catalog(spark)
    c.write("nation", table(spark, sf_dir, "nation"))
    for k in range(2):
        c.write_part("orders", f"p{k}", table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == k).select("o_orderkey", "o_custkey"))
    c.write("supplier", table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))
    c.migrate("supplier", ["s_suppkey"], 1)
    return spark.createDataFrame([(n, c.layout(n), c.row_count(n), len(c.columns(n))) for n in c.names()], "name string, layout string, rows long, columns int")


@register("""SELECT CASE p_partkey % 2 WHEN 0 THEN 'good' ELSE 'drifted' END AS part, p_partkey, CASE WHEN p_partkey % 2 = 1 AND p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS price, CASE WHEN p_partkey % 2 = 1 AND p_partkey % 7 = 0 THEN 'call us' END AS price_text FROM part""")
def catalog_repair(spark, sf_dir):
    """A part whose price became text is put on the declared schema; what is no number goes to the column beside it."""
    c = _catalog(spark)
    schema = StructType([StructField("p_partkey", LongType()), StructField("price", DoubleType()), StructField("price_text", StringType())])
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    c.write_part("prices", "good", p.filter("p_partkey % 2 = 0"), schema)
    c.write_part("prices", "drifted", p.filter("p_partkey % 2 = 1").select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, "call us").otherwise(F.col("price").cast("string")).alias("price")))
    for drifted in [ps for kinds, ps in c.audit_parts("prices").items() if "price:string" in kinds]:
        for part in drifted:
            c.repair_part("prices", part, schema, {"price": "price_text"})
    return c.table("prices").select("part", "p_partkey", "price", "price_text")


_FOLDED = "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new ' || c_name ELSE c_name END AS c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer"


@register(_FOLDED)
def catalog_fold(spark, sf_dir):
    c, _ = _parts(spark, sf_dir)
    c.fold("landed", "folded", ["c_custkey"], ["c_name", "c_acctbal"], 2, digits=1)
    c.fold("landed", "folded", ["c_custkey"], ["c_name", "c_acctbal"], digits=1)
    c.fold("landed", "folded", ["c_custkey"], ["c_name", "c_acctbal"], digits=1)
    return c.table("folded")


@register("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new ' || c_name ELSE c_name END AS c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT -1, 'late', 5.0")
def catalog_fold_late_part(spark, sf_dir):
    """A part that arrives late with an earlier name fills gaps but overwrites nothing newer."""
    c, rows = _parts(spark, sf_dir)
    keys, columns = ["c_custkey"], ["c_name", "c_acctbal"]
    c.fold("landed", "folded", keys, columns, digits=1)
    late = rows.filter("c_custkey % 5 = 0").select("c_custkey", F.lit("old").alias("c_name"), F.lit(-9.0).alias("c_acctbal"))
    c.write_part("landed", "2023-12-31_a", late.unionByName(spark.createDataFrame([(-1, "late", 5.0)], late.schema)))
    c.fold("landed", "folded", keys, columns, digits=1)
    return c.table("folded")


@register(_FOLDED)
def stream_fold(spark, sf_dir):
    """The same by a stream of files, two batches and a restart."""
    c = _catalog(spark)
    rows = table(spark, sf_dir, "customer")
    schema = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()), StructField("c_acctbal", DoubleType())])
    path, mark = f"{c.root}/_landing", f"{c.root}/_checkpoint"
    batches = [
        rows.select("c_custkey", "c_name", "c_acctbal"),
        rows.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("new "), F.col("c_name"))).otherwise("").alias("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal") + 1).alias("c_acctbal")),
    ]
    for k, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(path)
        # Files get names in the order of arrival, which is the order of the fold.
        for f in [f for f in c.store.names(path) if f.startswith("part-")]:
            c.store.move(f"{path}/{f}", f"{path}/b{k}-{f}")
        folds.fold_stream(folds.parts_stream(spark, path, schema), c, "folded", ["c_custkey"], ["c_name", "c_acctbal"], mark, 1).awaitTermination()
    return c.table("folded")


@register("SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 0 GROUP BY 1")
def console_query(spark, sf_dir):
    c = _catalog(spark)
    c.write("supplier", table(spark, sf_dir, "supplier"))
    c.write("nation", table(spark, sf_dir, "nation"))
    df, _ = console.Console(c).plan("SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 0 GROUP BY n_name")
    return df


@register("SELECT * FROM (VALUES ('select', 7, true, ''), ('newest', 1, false, 'p2024-01-02'), ('drop', 0, false, 'refused'), ('two', 0, false, 'refused'), ('literal', 1, false, '')) AS t(statement, rows, truncated, note)")
def console_guard(spark, sf_dir):
    """Caps with a flag, newest parts, and statements that are refused; words in literals are not."""
    c = _catalog(spark)
    c.write("nation", table(spark, sf_dir, "nation"))
    for day in ("2024-01-01", "2024-01-02"):
        c.write_part("days", f"{day}_s00_b0000", spark.createDataFrame([(f"p{day}",)], "p string"))
    shell = console.Console(c, cap=7, parts=1)
    out = []
    for name, sql in (("select", "SELECT * FROM nation"), ("newest", "SELECT p FROM days"), ("drop", "DROP TABLE nation"), ("two", "SELECT 1; SELECT 2"), ("literal", "SELECT 'drop table' AS x")):
        try:
            r = shell.run(sql)
            out.append((name, len(r.rows), r.truncated, r.rows[0][0] if name == "newest" else ""))
        except console.Refused:
            out.append((name, 0, False, "refused"))
    return spark.createDataFrame(out, "statement string, rows int, truncated boolean, note string")


@register("SELECT o_orderkey, o.o_custkey AS orders_o_custkey, c_name, m.o_custkey AS marks_o_custkey FROM orders o JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12) m ON m.o_custkey = o.o_custkey")
def composed_join(spark, sf_dir):
    """A canvas of three tables: links are found, shared column names get their table's."""
    frames = {"orders": table(spark, sf_dir, "orders"), "customer": table(spark, sf_dir, "customer")}
    frames["marks"] = frames["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 12")
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    known = {k: v.columns for k, v in frames.items()}
    found = {frozenset((x.left, x.right)): x for x in compose.links(known, [("orders", "customer", [("o_custkey", "c_custkey")])], ("custkey",))}
    first, second = found[frozenset(("orders", "customer"))], found[frozenset(("orders", "marks"))]
    joins = [{"left": first.left, "right": first.right, "on": first.on}, {"left": second.right if second.right == "orders" else second.left, "right": "marks", "on": second.on, "kind": "LEFT"}]
    out = spark.sql(compose.build_sql(known, joins, {"orders": ["o_orderkey", "o_custkey"], "customer": ["c_name"], "marks": ["o_custkey"]}))
    out.schema  # names are bound before the views go
    return out


_RULES = {
    "upc": {"source_field": "p_partkey", "mode": "transform", "pre": "digits_only"},
    "name": {"source_field": "p_name", "mode": "transform", "pre": "upper"},
    "tier": {"source_field": "p_type", "mode": "map", "map": {"ECONOMY": "low", "PROMO": "low"}},
    "price": {"mode": "expr", "expr": "round(p_retailprice, 1)"},
}


@register("SELECT CAST(p_partkey AS VARCHAR) AS upc, upper(p_name) AS name, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'low' ELSE p_type END AS tier, round(p_retailprice, 1) AS price, CAST(NULL AS VARCHAR) AS origin, 'part' AS _source FROM part WHERE p_size > 5")
def rules_source_select(spark, sf_dir):
    fields = [{"name": n} for n in ("upc", "name", "tier")] + [{"name": "price", "type": "double"}, {"name": "origin"}]
    return rules.source_select(table(spark, sf_dir, "part"), "part", _RULES, fields, "p_size > 5")


@register("SELECT DISTINCT p_type AS raw, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'low' ELSE p_type END AS derived FROM part ORDER BY raw LIMIT 12")
def rules_preview(spark, sf_dir):
    return rules.preview(table(spark, sf_dir, "part"), _RULES["tier"])


@register("SELECT p_partkey, p_name, CAST(NULL AS DOUBLE) AS p_retailprice, p_size FROM part")
def claims_by_audience(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    return offers.strip_claims(rows, "brand", {"p_retailprice": ("consumer",), "p_size": ("consumer", "brand")})


@register("SELECT CAST(r_regionkey AS VARCHAR) AS \"key\", r_name AS \"name\", r_name || ', again' AS name_2, '' AS column_4 FROM region")
def parsed_upload(spark, sf_dir):
    """A semicolon-delimited upload with a title, repeated names, an unnamed column and a repeated header."""
    lines = ["Our regions;;;", "key;name;name;"]
    for r in table(spark, sf_dir, "region").collect():  # five rows
        lines += [f'{r["r_regionkey"]};{r["r_name"]};"{r["r_name"]}, again";']
    return uploads.parse_upload(spark, "\n".join([*lines[:3], lines[1], *lines[3:]]).encode("utf-8-sig"))


@register("SELECT 'N' || n_regionkey AS series, 2000 + n_nationkey AS year, 'M01' AS period, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey * 1000.5::DOUBLE END AS value FROM nation")
def reference_series(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    value = F.when(F.col("n_nationkey") % 4 == 0, "-").otherwise(F.format_number(F.col("n_nationkey") * 1000.5, 1))
    data = F.struct((2000 + F.col("n_nationkey")).cast("string").alias("year"), F.lit("M01").alias("period"), F.lit("January").alias("periodName"), value.alias("value"))
    series = n.groupBy(F.concat(F.lit("N"), F.col("n_regionkey").cast("string")).alias("seriesID")).agg(F.collect_list(data).alias("data"))
    payload = series.select(F.to_json(F.struct(F.struct(F.array(F.struct("seriesID", "data")).alias("series")).alias("Results"))).alias("payload"))
    return reference.labour_series(payload)


@register("SELECT p_partkey AS key, octet_length(encode(p_name || p_type)) AS bytes, sha256(p_name || p_type) AS digest FROM part")
def blob_round_trip(spark, sf_dir):
    """A document a part, written by tasks and read back."""
    place = f"{shared_dir(spark)}/blobs-{uuid.uuid4().hex}"
    parts = table(spark, sf_dir, "part")
    folders = -(-parts.count() // 1000) or 1  # so that no folder is large, and tasks list and read folders
    p = spread(parts.select("p_partkey", "p_name", "p_type"), 20_000).select(
        F.format_string("%d/%d.bin", F.pmod(F.xxhash64("p_partkey"), F.lit(folders)), "p_partkey").alias("name"), F.concat("p_name", "p_type").cast("binary").alias("content")
    )
    stores.put_all(p, place)
    every = spark.range(0, folders, 1, max(spark.sparkContext.defaultParallelism, -(-folders // 20))).select(F.format_string(f"{place}/%d", "id").alias("folder"))
    blobs = stores.get_all(every, ".bin")
    return blobs.select(F.regexp_extract("path", r"(\d+)\.bin$", 1).cast("long").alias("key"), F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("digest"))


@register("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS p_name, CASE WHEN p_partkey % 2 = 1 THEN p_size END AS p_size FROM part")
def scan_by_name(spark, sf_dir):
    """Parts of different columns, read as one table with all of them."""
    c = _catalog(spark)
    p = table(spark, sf_dir, "part")
    c.write_part("part", "even", p.filter("p_partkey % 2 = 0").select("p_partkey", "p_name"))
    c.write_part("part", "odd", p.filter("p_partkey % 2 = 1").select("p_size", "p_partkey"))
    return c.table("part").select("p_partkey", "p_name", "p_size")


@register("SELECT * FROM (VALUES ('kept', true), ('lost', false), ('empty', false)) AS t(step, written)")
def degrade_guards(spark, sf_dir):
    """A step that keeps too few rows, or none over some, is refused before it replaces anything."""
    c = _catalog(spark)
    p = table(spark, sf_dir, "part").select("p_partkey")
    c.write("kept", p)
    out = []
    for step, rows in (("kept", p), ("lost", p.filter("p_partkey % 2 = 0")), ("empty", p.limit(0))):
        try:
            if step != "empty":
                quality.require_kept(c.row_count("kept"), rows.count())
            c.write("kept", rows)
            out.append((step, True))
        except ValueError:
            out.append((step, False))
    return spark.createDataFrame(out, "step string, written boolean")


@register("SELECT p_partkey, p_brand, p_name, lower(p_brand) AS brand_lc FROM part")
def presorted_catalog(spark, sf_dir):
    """A flat table in the order in which it is paged: ranges of the order are files, sorted within."""
    c = _catalog(spark)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", F.lower("p_brand").alias("brand_lc"))
    order = [F.col("p_brand").isNull() | (F.col("p_brand") == ""), F.col("p_brand"), F.col("p_name"), F.col("p_partkey")]
    c.write("flat", p.repartitionByRange(*order).sortWithinPartitions(*order))
    return c.table("flat")


@register("SELECT n_name AS dataset, CAST(n_nationkey AS VARCHAR) AS key, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey + 0.5::DOUBLE END AS value FROM nation")
def dated_series(spark, sf_dir):
    """A full stop stands for what is not published."""
    k = F.col("n_nationkey")
    value = F.when(k % 3 == 0, ".").otherwise((k + 0.5).cast("string"))
    payload = F.to_json(F.struct(F.array(F.struct(k.cast("string").alias("date"), value.alias("value"))).alias("observations")))
    payloads = table(spark, sf_dir, "nation").select("n_name", payload.alias("payload"))
    return reference.dated_observations(payloads, F.col("n_name")).select(F.col("series").alias("dataset"), F.col("date").alias("key"), "value")


@register("SELECT 'single' AS layout, count(*) AS rows FROM nation UNION ALL SELECT 'bucketed', count(*) FROM supplier UNION ALL SELECT 'parts', count(*) FROM region")
def catalog_expressions(spark, sf_dir):
    """Tables of all layouts, read by the text of an expression."""
    c = _catalog(spark)
    c.write("nation", table(spark, sf_dir, "nation"))
    c.write("supplier", table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))
    c.migrate("supplier", ["s_suppkey"], 1)
    c.write_part("region", "all", table(spark, sf_dir, "region"))
    layouts = {"nation": "single", "supplier": "bucketed", "region": "parts"}
    counts = [f"SELECT '{k}' AS layout, count(*) AS rows FROM ({c.read_expr(n)})" if "SELECT" in c.read_expr(n) else f"SELECT '{k}' AS layout, count(*) AS rows FROM {c.read_expr(n)}" for n, k in layouts.items()]
    return spark.sql(" UNION ALL ".join(counts))


@register("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_partkey % 3 <> 0) AS a FROM lineitem)
SELECT * FROM (VALUES ('l_orderkey', (SELECT n FROM c), 0::BIGINT, 0.0::DOUBLE), ('flag', (SELECT n FROM c), (SELECT a FROM c), (SELECT round(a / n::DOUBLE, 6) FROM c))) AS t("column", rows, nulls, null_share)""")
def catalog_footers(spark, sf_dir):
    """Counts and null shares of a table of many files from their footers."""
    c = _catalog(spark)
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.col("l_returnflag")).alias("flag"))
    c.write("lines", l.repartition(40))
    return footers.column_profile(c.row_groups("lines")).select("column", "rows", "nulls", "null_share")


_CENSUS = "CASE WHEN n_nationkey % 5 = 0 THEN '-888888888' WHEN n_nationkey % 7 = 0 THEN 'N' ELSE CAST(n_nationkey * 10 AS VARCHAR) END"


@register(f"""WITH n AS (SELECT *, {_CENSUS} AS v, CASE WHEN n_nationkey % 4 = 0 THEN 'D' ELSE '' END AS f FROM nation), m AS (
  SELECT n_regionkey AS year, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '001' AS geo, 'estab' AS metric, TRY_CAST(v AS DOUBLE) AS x, false AS flag FROM n
  UNION ALL SELECT n_regionkey, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '001', 'emp', n_nationkey + 0.5::DOUBLE, f <> '' FROM n)
SELECT year, geo, metric, CASE WHEN x > -1e8 THEN x END AS value, flag OR x IS NULL OR x <= -1e8 AS suppressed FROM m""")
def census_figures(spark, sf_dir):
    """Payloads of a census service, one a region: rows of text below a row of names, with flags and codes for what is suppressed."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    row = F.array(F.expr(_CENSUS.replace("VARCHAR", "STRING")), (k + 0.5).cast("string"), F.when(k % 4 == 0, "D").otherwise(""), F.lpad(k.cast("string"), 2, "0"), F.lit("001"))
    header = F.array(*[F.lit(c) for c in ("ESTAB", "EMP", "EMP_F", "state", "county")])
    payloads = n.groupBy(F.col("n_regionkey").alias("year")).agg(F.to_json(F.concat(F.array(header), F.collect_list(row))).alias("payload"))
    return reference.census_rows(payloads, ["ESTAB", "EMP"], ["state", "county"], ["year"])


@register("""SELECT n_regionkey AS region, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geo, CAST(2000 + n_nationkey AS INTEGER) AS year, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE n_nationkey * 1234.0::DOUBLE END AS value FROM nation WHERE n_regionkey <> 2 AND n_nationkey % 9 <> 1""")
def account_figures(spark, sf_dir):
    """Payloads of an accounts service; one region's says why it holds nothing, and counties are among the states."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    code = F.concat(F.lpad(k.cast("string"), 2, "0"), F.when(k % 9 == 1, "013").otherwise("000"))
    value = F.when(k % 6 == 0, "(NA)").otherwise(F.format_number(k * 1234.0, 0))
    data = F.struct(code.alias("GeoFips"), F.col("n_name").alias("GeoName"), (2000 + k).cast("string").alias("TimePeriod"), value.alias("DataValue"))
    held = n.groupBy(F.col("n_regionkey").alias("region")).agg(F.collect_list(data).alias("Data"))
    error = F.struct(F.lit("4").alias("APIErrorCode"), F.lit("not active").alias("APIErrorDescription"))
    results = F.struct(F.when(F.col("region") == 2, error).alias("Error"), F.when(F.col("region") != 2, F.col("Data")).alias("Data"))
    payloads = held.select("region", F.to_json(F.struct(F.struct(results.alias("Results")).alias("BEAAPI"))).alias("payload"))
    return reference.account_rows(payloads, "state", ["region"])


@register("""WITH c AS (SELECT c_custkey, 24 + (c_custkey * 7919 % 25000) / 1000.0::DOUBLE AS lat, -125 + (c_custkey * 104729 % 58000) / 1000.0::DOUBLE AS lng FROM customer) SELECT * FROM c WHERE lat BETWEEN 30 AND 33.5 AND lng BETWEEN -100 AND -92""")
def places_in_box(spark, sf_dir):
    """Places laid out by a curve, of which a box reads a few row groups."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k, (24 + (k * 7919 % 25000) / 1000.0).alias("lat"), (-125 + (k * 104729 % 58000) / 1000.0).alias("lng"))
    place = f"{shared_dir(spark)}/places-{uuid.uuid4().hex}"
    places.write_places(c, place, files=8)
    return places.read_places(spark, place, (30.0, -100.0, 33.5, -92.0))


@register("""SELECT CAST(l_returnflag AS VARCHAR) AS flag, count(*) AS n, round(sum(l_quantity), 2) AS total, min(l_quantity) AS least, max(l_quantity) AS most, true AS ids_near, true AS quartiles_near FROM lineitem GROUP BY 1""")
def kept_rollup(spark, sf_dir):
    """A rollup kept by day and flag, merged over its days, beside the exact figures: distinct parts within 3 %, and quartiles
    within 2 % of the ranks."""
    c = _catalog(spark)
    l = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("y"), F.year("l_shipdate").cast("string")).alias("day"), F.col("l_returnflag").alias("flag"), "l_partkey", F.col("l_quantity").cast("double").alias("q"))
    rollups.keep_days(c, "kept", l, "day", ["flag"], "q", "l_partkey")
    kept = rollups.merged(c.table("kept"), "flag")
    ranks = [f"percentile(q, {p})" for p in (0.23, 0.27, 0.48, 0.52, 0.73, 0.77)]
    exact = l.groupBy("flag").agg(F.count_distinct("l_partkey").alias("_ids"), *[F.expr(r).alias(f"_r{i}") for i, r in enumerate(ranks)])
    within = [F.col(name).between(F.floor(f"_r{2 * i}"), F.ceil(f"_r{2 * i + 1}")) for i, name in enumerate(("p25", "median", "p75"))]
    j = kept.join(exact, "flag")
    near = F.abs(F.col("ids") - F.col("_ids")) <= 0.03 * F.col("_ids")
    return j.select("flag", "n", F.round("total", 2).alias("total"), "least", "most", near.alias("ids_near"), (within[0] & within[1] & within[2]).alias("quartiles_near"))
