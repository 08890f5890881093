import pytest
from pyspark.sql import functions as F

from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfmark.sources import footers, uploads
from shelfmark.sources.catalog import Catalog, Conflict, declared
from shelfmark.sources.files import Store
from shelfmark.sources.reference import dated_observations, labour_series

FIELDS = {"sku": "string", "store": "string", "price": "float64", "stock": "int64"}


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, f"file://{tmp_path}")


def base(spark, n=1000):
    return spark.range(n).select(F.concat(F.lit("s"), "id").alias("sku"), (F.col("id") % 7).cast("string").alias("store"), (F.col("id") / 2).alias("price"), F.col("id").alias("stock"))


def test_layouts_agree_after_a_merge(spark, catalog):
    rows = base(spark)
    batch = rows.filter("stock < 50").withColumn("price", F.lit(9.0)).unionByName(base(spark, 25).withColumn("sku", F.concat(F.lit("new"), "sku")))
    catalog.write("single", rows)
    catalog.create_bucketed("cut", ["sku", "store"], declared(FIELDS), 1)
    catalog.rebuild("cut", rows)
    catalog.merge("single", batch, ["sku", "store"])
    catalog.merge("cut", batch)
    one, two = (sorted(tuple(r) for r in catalog.table(n).select("sku", "store", "price", "stock").collect()) for n in ("single", "cut"))
    assert one == two and len(one) == 1025
    assert catalog.manifest("cut")["version"] == 2 and len(catalog.changes("cut", 1)) == 1
    assert catalog.layout("cut") == "bucketed" and catalog.names() == ["cut", "single"]


def test_merge_widens_and_never_drops(spark, catalog):
    catalog.create_bucketed("t", ["sku"], declared(FIELDS), 1)
    catalog.rebuild("t", base(spark, 10))
    catalog.merge("t", spark.createDataFrame([("s1", "x")], "sku string, colour string"))
    got = {r["sku"]: r for r in catalog.table("t").collect()}
    assert len(got) == 10 and got["s1"]["colour"] == "x" and got["s1"]["price"] is None and got["s2"]["price"] == 1.0


def test_only_one_writer_wins(catalog, spark):
    catalog.create_bucketed("t", ["sku"], declared(FIELDS))
    m = catalog.manifest("t")
    catalog.rebuild("t", base(spark, 3))
    with pytest.raises(Conflict):
        catalog._swap("t", m, m["version"])


def test_empty_does_not_replace(spark, catalog):
    catalog.write("t", base(spark, 3))
    with pytest.raises(ValueError):
        catalog.write("t", base(spark, 3).limit(0))
    assert catalog.row_count("t") == 3 and catalog.row_count("none") == 0


def test_migrate_and_roll_back(spark, catalog):
    catalog.write("t", base(spark, 40))
    catalog.migrate("t", ["sku"], 1)
    assert catalog.layout("t") == "bucketed" and catalog.table("t").count() == 40
    catalog.rollback("t")
    assert catalog.layout("t") == "single" and catalog.table("t").count() == 40


def test_parts_fold_by_part_name(spark, catalog):
    schema = declared({"k": "string", "name": "string", "price": "float64", "ok": "bool"})
    row = lambda *v: spark.createDataFrame([v], "k string, name string, price double, ok boolean")
    catalog.land("p", row("a", "first", 1.0, True), schema, "2024-01-02")
    catalog.land("p", row("a", "", 0.0, False), schema, "2024-01-03")
    assert len(catalog.fold("p", "t", ["k"], ["name", "price", "ok"])) == 2
    assert catalog.table("t").first().asDict() == {"k": "a", "name": "first", "price": 0.0, "ok": False}
    catalog.land("p", row("a", "late", 7.0, None), schema, "2024-01-01")
    catalog.fold("p", "t", ["k"], ["name", "price", "ok"])
    assert catalog.table("t").first().asDict() == {"k": "a", "name": "first", "price": 0.0, "ok": False}
    assert catalog.fold("p", "t", ["k"], ["name", "price", "ok"]) == []
    catalog.store.delete(catalog._path("_doc", "fold-p-t.json"))
    catalog.fold("p", "t", ["k"], ["name", "price", "ok"])
    assert catalog.table("t").count() == 1 and catalog.table("t").first()["name"] == "first"


def test_newest_parts_keep_whole_days_and_undated(spark, catalog):
    for p in ("2024-01-01_a", "2024-01-01_b", "2024-01-02_a", "2024-01-02_b", "seed"):
        catalog.write_part("p", p, base(spark, 1))
    assert catalog.newest_parts("p", 3) == ["2024-01-02_a", "2024-01-02_b", "seed"]
    assert catalog.table("p").count() == 5


def test_repair_moves_what_does_not_convert(spark, catalog):
    catalog.write_part("p", "x", spark.createDataFrame([("1", "2.5"), ("2", "2 for 5")], "k string, promo string"))
    catalog.write_part("p", "y", spark.createDataFrame([("3", 1.5)], "k string, promo double"))
    assert len(catalog.audit_parts("p")) == 2
    schema = declared({"k": "string", "promo": "float64", "promo_text": "string"})
    for p in catalog.parts("p"):
        catalog.repair_part("p", p, schema, {"promo": "promo_text"})
    assert len(catalog.audit_parts("p")) == 1
    assert {tuple(r) for r in catalog.table("p").select("k", "promo", "promo_text").collect()} == {("1", 2.5, None), ("2", None, "2 for 5"), ("3", 1.5, None)}


def test_uploads(spark):
    raw = b"Report;;\n\nName;Price;Price\nA;1;2\nName;Price;Price\nB;3\n"
    df = uploads.parse_upload(spark, raw)
    assert df.columns == ["Name", "Price", "Price_2"] and [tuple(r) for r in df.collect()] == [("A", "1", "2"), ("B", "3", "")]


def test_reference_series(spark):
    a = spark.createDataFrame([('{"Results": {"series": [{"seriesID": "S", "data": [{"year": "2020", "period": "M01", "value": "1,5"}]}]}}',)], ["payload"])
    assert [tuple(r) for r in labour_series(a).collect()] == [("S", 2020, "M01", 15.0)]
    b = spark.createDataFrame([('{"observations": [{"date": "2020-01-01", "value": "."}, {"date": "2020-02-01", "value": "2.5"}]}',)], ["payload"])
    assert [tuple(r) for r in dated_observations(b, "X").collect()] == [("X", "2020-01-01", None), ("X", "2020-02-01", 2.5)]


def test_large_buckets_have_several_files(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/cat")
    df = spark.range(300_000).selectExpr("id as k", "uuid() as payload")
    c.create_bucketed("big", ["k"], df.schema, 1)
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        c.merge("big", df)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    files = [f for f, _ in footers.files_of(spark, c._folders("big"))]
    assert len(c.manifest("big")["files"]) == 16 and len(files) > 32
    assert c.row_count("big") == c.table("big").count() == 300_000


def test_a_merge_leaves_one_row_a_key(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/cat")
    schema = StructType([StructField("k", StringType()), StructField("v", LongType())])
    c.create_bucketed("t", ["k"], schema, 1)
    c.merge("t", spark.createDataFrame([("", 1), (None, 2), ("a", 3), ("a", 9), ("a", 4)], schema))
    assert {tuple(r) for r in c.table("t").collect()} == {("", 1), (None, 2), ("a", 9)}
    c.merge("t", spark.createDataFrame([(None, 7)], schema))
    assert {tuple(r) for r in c.table("t").collect()} == {("", 1), (None, 7), ("a", 9)}


def test_the_watermark_is_bounded_by_days(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/cat")
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    mark = c._path("_doc", "fold-p-t.json")
    for day in ("2024-01-01", "2024-01-02"):
        for seq in range(4):
            c.land("p", spark.createDataFrame([("a", f"{day}/{seq}"), (f"k{seq}", day)], schema), schema, day, 0, seq)
    assert len(c.fold("p", "t", ["k"], ["v"], limit=6)) == 6
    assert c.store.read_json(mark) == {"days": {"2024-01-01": c.store.read_json(mark)["days"]["2024-01-01"]}, "parts": ["2024-01-02_s00_b0000", "2024-01-02_s00_b0001"]}
    assert len(c.fold("p", "t", ["k"], ["v"])) == 2 and c.fold("p", "t", ["k"], ["v"]) == []
    assert c.store.read_json(mark)["parts"] == [] and len(c.store.read_json(mark)["days"]) == 2
    # A late part opens its day; what is newer stays.
    c.land("p", spark.createDataFrame([("a", "late"), ("z", "late")], schema), schema, "2024-01-01", 3, 0)
    assert len(c.fold("p", "t", ["k"], ["v"])) == 5 and c.fold("p", "t", ["k"], ["v"]) == []
    got = {r["k"]: r["v"] for r in c.table("t").collect()}
    assert got["a"] == "2024-01-02/3" and got["z"] == "late" and len(got) == 6


def test_two_writers_of_a_document_leave_one_whole(spark, tmp_path):
    store = Store(spark)
    place = f"file://{tmp_path}/doc.json"
    store.write_json(place, {"a": 1})
    store.write_json(place, {"b": 2})
    assert store.read_json(place) == {"b": 2} and store.names(f"file://{tmp_path}") == ["doc.json"]
