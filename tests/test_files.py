"""Polygon files, footers and checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import checks, joins
from shelfmark.sources import footers, shapes


def box(a, b, c, d):
    return [(float(x), float(y)) for x, y in ((a, b), (a, d), (c, d), (c, b), (a, b))]


RINGS = [
    ("A", [box(0, 0, 8, 8), box(2, 2, 6, 6), box(3, 3, 5, 5)], 1.5),
    ("B", [box(10, 0, 12, 2), box(20, 20, 21, 21)], None),
    ("C", None, -3.0),
    ("Ü", [box(-5, -5, -4, -4)], 0.0),
]
KIND = "code string, rings array<array<struct<x: double, y: double>>>, size double"


def test_polygons_come_back_as_written(spark, tmp_path):
    df = spark.createDataFrame(RINGS, KIND).repartition(2)
    assert shapes.write_polygons(df, f"file://{tmp_path}/p", {"code": ("C", 6), "size": ("N", 8)}) == 4
    got = shapes.read_polygons(spark, f"file://{tmp_path}/p", 1)
    assert got.rdd.getNumPartitions() == 4 and got.dtypes[1:] == [("code", "string"), ("size", "double")]
    held = {r["code"]: (r["size"], None if r["rings"] is None else [[tuple(p) for p in ring] for ring in r["rings"]]) for r in got.collect()}
    assert held == {c: (s, rings) for c, rings, s in RINGS}


def test_holes_are_outside_and_islands_inside(spark):
    points = [(1, 1.0, 1.0), (2, 3.0, 2.5), (3, 4.0, 4.0), (4, 2.0, 2.0), (5, 20.5, 20.5), (6, 11.0, 1.0), (7, 15.0, 15.0), (8, None, 1.0), (9, -4.5, -4.5), (10, 1.0, 1.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    for cell in (1.0, 50.0):
        got = {r["id"]: r["code"] for r in joins.point_in_polygon(df, spark.createDataFrame(RINGS, KIND).drop("size"), cell).collect()}
        assert got == {1: "A", 2: None, 3: "A", 4: "A", 5: "B", 6: "B", 7: None, 8: None, 9: "Ü", 10: "A"}


def test_crowded_cells_are_dealt_to_several_tasks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 8, (500, 2)))]
    df, polygons = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(RINGS, KIND)
    whole = sorted(map(tuple, joins.point_in_polygon(df, polygons, 10.0).collect()))
    monkeypatch.setattr(joins, "CELL_POINTS", 7)
    assert sorted(map(tuple, joins.point_in_polygon(df, polygons, 10.0).collect())) == whole


def test_other_shapes_are_refused():
    with pytest.raises(ValueError):
        shapes.rings_of((3).to_bytes(4, "little") + bytes(60))


def test_footers_count_without_reading_data(spark, tmp_path):
    place = f"file://{tmp_path}/t"
    rows = spark.range(5000).select("id", F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("some"), F.lit(None).cast("double").alias("none"))
    rows.repartition(20).write.parquet(place)
    groups = footers.row_groups(spark, [place], 3)
    assert footers.row_count(spark, [place]) == 5000
    got = {r["column"]: (r["rows"], r["nulls"], r["null_share"]) for r in footers.column_profile(groups).collect()}
    assert got == {"id": (5000, 0, 0.0), "some": (5000, 3750, 0.75), "none": (5000, 5000, 1.0)}
    per_file = footers.part_counts(groups).collect()
    assert len(per_file) == 20 and sum(r["rows"] for r in per_file) == 5000
    ids = groups.filter("column = 'id'").agg(F.min(F.col("least").cast("long")), F.max(F.col("most").cast("long"))).first()
    assert tuple(ids) == (0, 4999)
    # What a footer tells is all there is: a file whose data pages are gone still counts.
    path = next(f for f, _ in footers.files_of(spark, [place])).removeprefix("file:")
    raw = bytearray(open(path, "rb").read())
    raw[4:200] = bytes(196)
    open(path, "wb").write(bytes(raw))
    assert footers.row_count(spark, [place]) == 5000
    assert footers.row_count(spark, [f"file://{tmp_path}"]) == 5000
    (tmp_path / "empty").mkdir()
    assert footers.row_count(spark, [f"file://{tmp_path}/empty"]) == 0


def test_scale_gap_is_the_sorted_one(spark):
    rng = np.random.default_rng(5)
    for values in (rng.lognormal(3, 1, 400), np.concatenate([rng.uniform(1, 3, 50), rng.uniform(400, 900, 50)]), np.array([7.0]), np.array([1e-300, 1e300, 2e300]), np.array([-1.0, 0.0])):
        rows = [(float(v),) for v in values] + [(None,), (0.0,), (-4.0,)]
        r = checks.scale_gap(spark.createDataFrame(rows, "x double").repartition(3), "x").first()
        logs = np.sort(np.log10(values[values > 0]))
        steps = np.diff(logs)
        assert r["n"] == len(logs)
        if len(steps) and steps.max() >= 0.1:
            assert abs(r["gap"] - steps.max()) < 1e-9 and r["below"] == int(steps.argmax()) + 1


def test_event_gaps(spark):
    rows = [("a", "1", "g"), ("a", "3", "g"), ("b", "2", "g"), ("b", "3", "h"), ("c", "1", "g"), ("d", "2", ""), ("d", "4", None), ("", "1", "g"), ("e", None, "g")]
    got = checks.event_gaps(spark.createDataFrame(rows, "e string, p string, t string"), "e", "p", "t").collect()
    # a is of g, which took part in 1, 2 and 3; b is of h, which took part in 3 only; c is seen once; d has no group.
    assert [(r["e"], r["p"], r["t"], r["severity"]) for r in got] == [("a", "2", "g", "high")]


def test_spikes_need_history_or_noise(spark):
    days = [(f"2024-01-{d:02d}", 250, 1) for d in range(1, 9)] + [("2024-01-09", 250, 30), ("2024-01-10", 100, 50), ("2024-03-01", 300, 6)]
    rows = [("s", day, ["r"] if i < broken else []) for day, n, broken in days for i in range(n)]
    got = {r["day"]: (r["rate"], r["baseline"], r["spike"]) for r in checks.rate_spikes(spark.createDataFrame(rows, "source string, day string, violations array<string>"), "day", ["source"]).collect()}
    assert got["2024-01-01"] == (4.0, None, False) and got["2024-01-09"] == (120.0, 4.0, True)
    assert got["2024-01-10"] == (500.0, 4.0, False)  # too few rows
    assert got["2024-03-01"] == (20.0, None, True)


def test_grain(spark):
    rows = [(i, i % 10, i // 10, f"2024-01-{1 + i % 10:02d}", "x") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, a int, b int, day string, c string")
    assert {r["columns"] for r in checks.grain(df, ["id", "a", "b", "day", "c"]).collect()} == {"id", "a,b", "b,day"}
    assert tuple(checks.entity_and_axis(df, ["a", "b", "day", "c"], ["day"]).first()) == ("fact", "b", "day")
    assert tuple(checks.entity_and_axis(df, ["id", "c"], ["day"]).first()) == ("entity", "id", None)
    assert checks.grain(df.limit(0), ["id"]).count() == 0
