"""Digests, places along a curve, clusters of pictures, kept rollups, reference payloads and files of tasks."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.functions import products
from shelfmark.operators import assets, curation, digests, rollups
from shelfmark.sources import footers, places, reference, stores
from shelfmark.sources.catalog import Catalog


@pytest.mark.parametrize("most", [26, 15, 3])
def test_members_are_exact_at_any_size_of_the_filter(spark, most):
    rows = spark.createDataFrame([(i, f"id{i % 900}") for i in range(2000)] + [(-1, None), (-2, "")], "n long, k string")
    ids = spark.createDataFrame([(f"id{i}",) for i in range(0, 5000, 3)] + [(None,), ("",), ("id3",)], "k string")
    held = {f"id{i}" for i in range(0, 5000, 3)} | {""}
    want = {r["n"] for r in rows.collect() if r["k"] in held}
    assert sorted(r["n"] for r in digests.members(rows, ids, "k", most).collect()) == sorted(want)
    rest = [r["n"] for r in digests.members(rows, ids, "k", most, anti=True).collect()]
    assert sorted(rest) == sorted(({-1, -2} | set(range(2000))) - want)
    assert digests.members(rows, ids.limit(0), "k", most).count() == 0


def test_the_filter_lets_few_others_through(spark):
    ids = spark.range(4000).select(F.concat(F.lit("m"), "id").alias("k")).withColumn("d", digests.digest(F.col("k")))
    bloom = digests.Bloom.of(ids, "d", 4000)
    others = spark.range(20_000).select(digests.digest(F.concat(F.lit("o"), "id")).alias("d"))
    assert ids.filter(bloom.may_hold(F.col("d"))).count() == 4000
    assert others.filter(bloom.may_hold(F.col("d"))).count() < 200
    assert digests.Bloom.of(ids, "d", 1 << 28) is None


def test_the_filter_is_no_part_of_the_plan(spark):
    ids = spark.range(2000).select(digests.digest(F.concat(F.lit("m"), "id")).alias("d"))
    plan = ids.filter(digests.Bloom.of(ids, "d", 2000).may_hold(F.col("d")))._jdf.queryExecution().optimizedPlan()
    assert len(plan.toString()) < 3_000  # a filter of 4 KB stood in it four times


def test_the_curve_interleaves(spark):
    rng = random.Random(2)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)] + [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0)]
    got = [r[0] for r in spark.createDataFrame(points, "a double, b double").select(places.curve(F.col("a"), F.col("b"))).collect()]
    for (lat, lng), z in zip(points, got):
        x, y = (min(int((v + w) / (2 * w) * 65536), 65535) for v, w in ((lng, 180.0), (lat, 90.0)))
        assert z == sum((x >> k & 1) << 2 * k | (y >> k & 1) << 2 * k + 1 for k in range(16))


@pytest.mark.parametrize("most", [1, 8, 64])
def test_ranges_hold_the_box(spark, most):
    box = (30.2, -99.9, 33.7, -92.1)
    ranges = places.box_ranges(*box, most)
    assert 1 <= len(ranges) <= most and all(a <= b for a, b in ranges) and ranges == sorted(ranges)
    rng = random.Random(3)
    inside = [(rng.uniform(box[0], box[2]), rng.uniform(box[1], box[3])) for _ in range(300)] + [(30.2, -99.9), (33.7, -92.1)]
    for (z,) in spark.createDataFrame(inside, "a double, b double").select(places.curve(F.col("a"), F.col("b"))).collect():
        assert any(a <= z <= b for a, b in ranges)
    assert places.box_ranges(5, 5, 4, 6) == []


def test_a_small_box_reads_few_row_groups(spark, tmp_path):
    df = spark.range(200_000).select("id", (25 + F.rand(1) * 25).alias("lat"), (-125 + F.rand(2) * 60).alias("lng")).unionByName(spark.createDataFrame([(-1, None, 1.0)], "id long, lat double, lng double"))
    place = f"file://{tmp_path}/p"
    places.write_places(df, place, files=16, row_group=64 << 10)
    box = (35.0, -100.0, 37.5, -94.0)  # one in a hundred
    ranges = places.box_ranges(*box)
    groups = footers.row_groups(spark, [place]).filter("column = 'z'").collect()
    read = [g for g in groups if g["least"] is not None and any(int(g["least"]) <= b and int(g["most"]) >= a for a, b in ranges)]
    assert len(groups) > 60 and len(read) < 0.05 * len(groups)
    got = places.read_places(spark, place, box)
    want = df.filter(F.col("lat").between(35.0, 37.5) & F.col("lng").between(-100.0, -94.0))
    assert got.count() == want.count() > 1000 and "z" not in got.columns
    assert "(Or(" in got._jdf.queryExecution().toString()  # ranges reach the scan


def test_clusters_join_the_nearest_leader(spark):
    rows = [("i", 1, [1.0, 0.0]), ("i", 2, [0.8, 0.6]), ("i", 3, [0.0, 1.0]), ("i", 4, [0.5, 0.87]), ("i", 5, [0.0, 0.0]), ("i", 6, None), ("j", 1, [0.0, 3.0])]
    got = assets.greedy_clusters(spark.createDataFrame(rows, "item string, n int, v array<double>"), "item", "n", "v", least=0.75).collect()
    # 4 is near 3 (0.87) and not near 1; 2 is near 1 (0.8); zeros lead a cluster of their own.
    assert {(r["item"], r["n"]): r["cluster"] for r in got} == {("i", 1): 0, ("i", 2): 0, ("i", 3): 1, ("i", 4): 1, ("i", 5): 2, ("j", 1): 0}
    hashes = [("i", 1, 0b1111), ("i", 2, 0b0111), ("i", 3, -1), ("i", 4, 0b0011)]
    got = assets.greedy_clusters(spark.createDataFrame(hashes, "item string, n int, h long"), "item", "n", "h", hashes=True, most=2).collect()
    assert {r["n"]: r["cluster"] for r in got} == {1: 0, 2: 0, 3: 1, 4: 0}


def test_divergence_verdicts(spark):
    rows = [("a", 0, s) for s in "xyz"] + [("b", 0, "x"), ("b", 0, "y"), ("b", 1, "z")] + [("c", 0, "x"), ("c", 1, "y")]
    df = spark.createDataFrame(rows, "item string, cluster int, source string")
    got = sorted(tuple(r) for r in assets.divergence(df, "item", "cluster", "source").collect())
    assert got == [("a", 0, 0, 1, 3, 3, 1.0, "aligned"), ("b", 0, 0, 2, 2, 3, 0.667, "divergent"), ("b", 1, 1, 2, 1, 3, 0.333, "divergent"), ("c", None, None, None, 2, 2, None, "insufficient_data")]
    assert {r["verdict"] for r in assets.divergence(df, "item", "cluster", "source", hashes=True).collect()} == {"aligned", "divergent_unconfirmed", "insufficient_data"}


def test_a_new_day_reads_that_day_only(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/cat")
    rng = np.random.default_rng(4)
    rows = [(f"2024-01-0{1 + i % 3}", f"s{i % 4}", i % 700, float(rng.gamma(2.0, 5.0))) for i in range(12_000)]
    df = spark.createDataFrame(rows, "day string, store string, item long, price double")
    first = df.filter("day < '2024-01-03'")
    assert rollups.keep_days(c, "r", first, "day", ["store"], "price", "item") == ["2024-01-01", "2024-01-02"]
    # Rows of days that are kept are not looked at again, even if they are gone or broken.
    late = df.filter("day = '2024-01-03'").unionByName(spark.createDataFrame([("2024-01-01", "s0", 1, 1e9)], df.schema))
    assert rollups.keep_days(c, "r", late, "day", ["store"], "price", "item") == ["2024-01-03"]
    assert rollups.keep_days(c, "r", late, "day", ["store"], "price", "item") == []
    got = {r["store"]: r for r in rollups.merged(c.table("r"), "store").collect()}
    for s, r in got.items():
        own = [x for x in rows if x[1] == s]
        prices = sorted(x[3] for x in own)
        assert r["n"] == len(own) and abs(r["total"] - sum(prices)) < 1e-6 and (r["least"], r["most"]) == (prices[0], prices[-1])
        exact = len({x[2] for x in own})
        assert abs(r["ids"] - exact) <= 0.03 * exact
        for p, q in ((0.25, "p25"), (0.5, "median"), (0.75, "p75")):
            assert prices[int((p - 0.02) * len(prices))] <= r[q] <= prices[int((p + 0.02) * len(prices))]


def test_census_payloads(spark):
    table = [["NAME", "ESTAB", "EMP", "EMP_F", "state", "county"], ["A", "10", "5", "", "01", "003"], ["B", "-999999999", "7", "D", "02", "001"], ["C", None, "x", "", "03", "001"], ["short"]]
    payloads = spark.createDataFrame([(2021, json.dumps(table)), (2022, "[]"), (2023, "<html>"), (2024, None)], "year int, payload string")
    got = sorted(tuple(r) for r in reference.census_rows(payloads, ["ESTAB", "EMP"], ["state", "county"], ["year"]).collect())
    assert got == [(2021, "01003", "emp", 5.0, False), (2021, "01003", "estab", 10.0, False), (2021, "02001", "emp", 7.0, True), (2021, "02001", "estab", None, True), (2021, "03001", "emp", None, True), (2021, "03001", "estab", None, True)]
    labels = spark.createDataFrame([(json.dumps({"variables": {"B01": {"label": "Total", "concept": "Age"}, "for": {"label": "geo"}}}),)], "payload string")
    assert sorted(tuple(r) for r in reference.census_labels(labels).collect()) == [("B01", "Total", "Age"), ("for", "geo", None)]
    groups = spark.createDataFrame([(json.dumps({"groups": [{"name": "B01", "description": "d"}]}),)], "payload string")
    assert [tuple(r) for r in reference.census_groups(groups).collect()] == [("B01", "d")]


def test_account_payloads(spark):
    good = {"BEAAPI": {"Results": {"Data": [{"GeoFips": "01000", "TimePeriod": "2020", "DataValue": "1,234"}, {"GeoFips": "01003", "TimePeriod": "2020", "DataValue": "(D)"}, {"GeoFips": "02000", "TimePeriod": "x", "DataValue": "1"}]}}}
    inner = {"BEAAPI": {"Results": {"Error": {"APIErrorCode": "4", "APIErrorDescription": "not active"}}}}
    outer = {"BEAAPI": {"Error": {"APIErrorCode": "9", "APIErrorDescription": "bad", "ErrorDetail": {"Description": " why "}}}}
    payloads = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate((good, inner, outer))], "i int, payload string")
    assert sorted(tuple(r) for r in reference.account_rows(payloads).collect()) == [("01000", 2020, 1234.0), ("01003", 2020, None)]
    assert [tuple(r) for r in reference.account_rows(payloads, "state", ["i"]).collect()] == [(0, "01", 2020, 1234.0)]
    assert {tuple(r) for r in reference.account_errors(payloads, ["i"]).collect()} == {(1, "not active (code 4)"), (2, "bad: why (code 9)")}


def test_headers_of_uploads(spark):
    rows = [(f"a{i}@b.co", "036000291452", f"{i + 3}.5", "750 ml", "Acme", "  ", str(40 + i % 3)) for i in range(20)]
    df = spark.createDataFrame(rows, "`Notes` string, `Code 1` string, `PRC` string, `x` string, `Sales Rep` string, `Empty` string, `Strength` string")
    got = {r["header"]: (r["bucket"], r["field"], r["how"]) for r in curation.map_headers(df).collect()}
    assert got == {
        "Notes": ("pii", None, None), "Code 1": ("mapped", "upc", "values"), "PRC": ("mapped", "price", "values"), "x": ("mapped", "size_raw", "values"), "Sales Rep": ("pii", None, None),
        "Empty": ("empty", None, None), "Strength": ("mapped", "abv", "values"),
    }


def test_flags_of_products(spark):
    say = lambda f, *texts: [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(f(F.col("t"))).collect()]
    assert say(products.is_hemp, "Delta 8 gummies", "hempire", "THC seltzer", None) == [True, False, True, False]
    assert say(products.is_non_alcoholic, "0% lager", "0% sugar", "Heineken 0.0", "N.A. beer", "Seedlip Garden", "10% abv", None) == [True, False, True, True, True, False, False]
    assert say(products.origin_class, "Napa red", "Italian of Italy", "imported from USA", "plain") == ["domestic", "import", "domestic", None]
    assert [r[0] for r in spark.createDataFrame([(50.0,), (750.0,), (1499.0,), (1500.0,), (None,)], "v double").select(products.volume_tier(F.col("v"))).collect()] == ["single-serve", "standard", "large", "magnum+", None]


def test_gated_merges(spark):
    merges = spark.createDataFrame([(1, 2), (4, 3)], "a int, b int")
    good = spark.createDataFrame([(2, 1, 1), (9, 8, 0)], "a int, b int, same int")
    assert {(r["a"], r["b"]) for r in curation.gated_merges(merges, good).collect()} == {(1, 2), (3, 4)}
    assert curation.gated_merges(merges, good.withColumn("same", F.lit(0))).count() == 0
    assert curation.gated_merges(merges, good.filter("a = 9")).count() == 0  # never measured


def test_files_are_written_by_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i}.bin", bytes([i])) for i in range(50)] + [("empty.bin", None), (None, b"x")], "name string, content binary").repartition(4)
    assert stores.put_all(rows, f"file://{tmp_path}/b") == 51
    assert len(stores.listed(f"file://{tmp_path}/b", ".bin")) == 51
    with stores.opened(f"file://{tmp_path}/b/7.bin") as f:
        assert f.read() == b"\x07"


def test_a_value_of_an_upload_is_tested_once(spark):
    df = spark.range(5000).selectExpr("'750 ml' AS size", "cast(id % 2 as string) AS n", "cast(null as string) AS gone")
    got = {r["header"]: (r["bucket"], r["share"]) for r in curation.map_headers(df).collect()}
    assert got["size"] == ("mapped", 1.0) and got["gone"] == ("empty", None)
    assert {r["bucket"] for r in curation.map_headers(df.limit(0)).collect()} == {"empty"}
    assert "Generate" in curation.map_headers(df)._jdf.queryExecution().optimizedPlan().toString().split("Join")[-1]


def test_tasks_list_and_read_folders(spark, tmp_path):
    rows = spark.range(300).select(F.format_string("%d/%d.bin", F.col("id") % 7, "id").alias("name"), F.col("id").cast("string").cast("binary").alias("content"))
    assert stores.put_all(rows, f"file://{tmp_path}/b") == 300
    folders = spark.range(8).select(F.format_string(f"file://{tmp_path}/b/%d", "id").alias("folder"))  # the last is not there
    got = {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in stores.get_all(folders, ".bin").collect()}
    assert got == {f"{i}.bin": str(i).encode() for i in range(300)}
