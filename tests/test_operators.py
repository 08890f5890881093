"""Small cases worked out by hand."""

import datetime as dt

from pyspark.sql import functions as F

from shelfmark.functions import geo, gs1, text, vectors
from shelfmark.operators import entities, joins, observations as obs

D = dt.date


def observed(spark, levels, start=1, step=1, price=10.0):
    rows = [("s", 1, 1, "b", D(2024, 1, start) + dt.timedelta(days=i * step), float(q), price, False) for i, q in enumerate(levels)]
    return spark.createDataFrame(rows, "source string, store_id long, product_id long, brand string, d date, qty double, price double, on_promo boolean")


def card(spark, cadence=1.0):
    return spark.createDataFrame([("s", 0.0, cadence, "count")], "source string, jitter_frac double, median_cadence_days double, qual_tier string")


def totals(spark, df, cadence=1.0):
    f = obs.weekly_velocity(obs.stock_changes(df, card(spark, cadence)), 0.0)
    return f.agg(F.sum("implied_units"), F.sum("restock_events"), F.sum("noise_damped_units"), F.sum("oos_events"), F.sum("censored_pairs")).first()


def test_sales_and_restock(spark):
    assert tuple(totals(spark, observed(spark, [50, 42, 30, 60, 55]))) == (25.0, 1, 0.0, 0, 0)


def test_recounts_are_no_sales(spark):
    r = totals(spark, observed(spark, [20, 21, 20, 19, 20]))
    assert r[0] == 0 and r[2] == 4


def test_long_gaps_are_censored(spark):
    assert totals(spark, observed(spark, [40, 5], step=12))[0] == 0


def test_out_of_stock(spark):
    assert totals(spark, observed(spark, [10, 0, 8]))[3] == 1


def test_unknown_price_leaves_small_moves_undecided(spark):
    assert totals(spark, observed(spark, [10, 9], price=None))[0] == 0


def test_projection(spark):
    cells = spark.createDataFrame([("IL", "b", i, 20.0) for i in range(10)] + [("WI", "b", i, 5.0) for i in range(3)], "market string, brand string, store_id int, store_units double")
    universe = spark.createDataFrame([("IL", 100), ("WI", 50)], "market string, n long")
    got = {r["market"]: r for r in obs.projection(cells, universe).collect()}
    assert got["IL"]["projected_units"] == 2000 and got["IL"]["ci_low"] == got["IL"]["ci_high"] == 2000
    assert got["WI"]["projected_units"] is None and got["WI"]["status"].startswith("suppressed")


def test_codes(spark):
    df = spark.createDataFrame([("036000291452",), ("036000291453",), ("12345",), (None,)], "c string")
    assert [r[0] for r in df.select(gs1.valid(F.col("c"))).collect()] == [True, False, False, False]
    assert df.select(gs1.with_check_digit(F.lit("03600029145"))).first()[0] == "036000291452"
    assert [r[0] for r in df.select(text.upc14(F.col("c"))).collect()] == ["00036000291452", "00036000291453", "12345", None]


def test_similarities(spark):
    df = spark.createDataFrame([("MARTHA", "MARHTA"), ("a", None)], "a string, b string")
    r = df.select(F.round(text.jaro_winkler("a", "b"), 4), F.round(text.sequence_ratio("a", "b"), 4)).collect()
    assert r[0][0] == 0.9611 and r[1][0] is None
    v = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [r[0] and round(r[0], 6) for r in v.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [None, 1.0]
    assert v.select(vectors.hamming_hex(F.lit("ff00000000000000"), F.lit("0f00000000000000"))).first()[0] == 4
    miles = v.select(geo.haversine_miles(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert abs(miles - 69.09) < 0.02


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)]
    got = entities.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["component"] for r in got} == {0, 100} and len(got) == 64


def test_polygon_borders_go_to_the_lowest_code(spark):
    square = lambda x: [{"x": x, "y": 0.0}, {"x": x + 1, "y": 0.0}, {"x": x + 1, "y": 1.0}, {"x": x, "y": 1.0}]
    polygons = spark.createDataFrame([("02", square(1.0)), ("01", square(0.0))], "code string, ring array<struct<x: double, y: double>>")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.0, 0.5), (3, 5.0, 5.0)], "id int, x double, y double")
    assert {r["id"]: r["code"] for r in joins.point_in_polygon(points, polygons, 0.5).collect()} == {1: "01", 2: "01", 3: None}


def test_every_pair_meets_across_groups_and_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    v = np.repeat(rng.normal(size=(8, 64)), 3, 0) + rng.normal(scale=0.3, size=(24, 64))
    rows = [(i, [float(x) for x in v[i]], "abc"[i % 3]) for i in range(24)]
    df = spark.createDataFrame([*rows, (90, None, "a"), (91, [0.0] * 64, "a"), (92, [float("nan")] * 64, "b"), (93, [1.0], "c")], "id long, v array<double>, g string")
    u = v / np.linalg.norm(v, axis=1)[:, None]
    pairs = [(i, j) for i in range(24) for j in range(i + 1, 24)]
    for block in (5, 1000):
        got = {(r["a"], r["b"]): r for r in entities.cosine_at_least(df, "id", "v", "g", 0.5, block).collect()}
        assert sorted(got) == [(i, j) for i, j in pairs if u[i] @ u[j] >= 0.5] and sum(r["across"] for r in got.values()) == len(got) > 20
        near = entities.hamming_at_most(df.filter("id < 24"), "id", vectors.sign_bits(F.col("v")), "g", 12, block)
        want = {(i, j): int(((v[i] > 0) != (v[j] > 0)).sum()) for i, j in pairs}
        assert {(r["a"], r["b"]): r["bits"] for r in near.collect()} == {k: n for k, n in want.items() if n <= 12} != {}


def test_whole_tables_take_part(spark, tmp_path):
    from shelfmark.queries import everything

    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    put("part", [(1, "red widget"), (2, "blue ring"), (3, "bolt")], "p_partkey long, p_name string")
    # Supplier 3 has no row, 4 a row without a part; 1 has its widget in a row of another flag and a small quantity.
    put("lineitem", [(1, 1, "N", 1.0), (1, 3, "A", 50.0), (2, 2, "R", 2.0), (4, 9, "A", 50.0)], "l_suppkey long, l_partkey long, l_returnflag string, l_quantity double")
    put("supplier", [(1, 2, 6000.0), (2, 22, 2000.0), (3, 99, 500.0), (4, None, 7000.0)], "s_suppkey long, s_nationkey int, s_acctbal double")
    put("nation", [(2, 7), (22, 8)], "n_nationkey int, n_regionkey int")
    # 1 and 98 share phone 1 (below 60), 40 and 41 address 1 (not a multiple of 3), 98 and 99 address 2; 200 is alone.
    put("customer", [(1, 22, 5.0), (98, 22, 9.0), (99, 3, 1.0), (40, 2, 4.0), (41, 2, 3.0), (200, None, 8.0)], "c_custkey long, c_nationkey int, c_acctbal double")
    get = lambda name: sorted((tuple(r) for r in everything().queries[name](spark, str(tmp_path)).collect()), key=str)
    assert get("carried_flags") == [(1, True, False), (2, False, True), (3, False, False), (4, False, False)]
    assert get("metro_counts") == sorted([("7", 1, 1, 0, 0), ("8", 1, 0, 1, 0), ("(unknown)", 2, 1, 0, 1)], key=str)
    assert get("connected_components") == [(1, 1), (40, 40), (41, 40), (98, 1), (99, 1)]
    packs = get("census_pack_merge")
    assert {r for r in packs if r[0] is not None} == {(22, 2, 9.0, 1), (2, 2, 4.0, 1), (3, 1, 1.0, None), (99, None, 500.0, 1)}
    assert sorted((r[1:] for r in packs if r[0] is None), key=str) == [(1, 8.0, None), (None, 7000.0, 1)]


def test_dictionary_terms_of_any_number_of_words(spark):
    from shelfmark.operators import matching

    terms = ["Old", "Old Tom", "the very old tom gin house of york", "gin house of york town hall", None]
    names = ["The Very OLD Tom Gin House of York, 70cl", "old tom gin", "very old", "none", ""]
    d, rows = spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["match"] for r in matching.longest_dictionary_match(rows, "name", d, "term").collect()}
    assert got == dict(zip(names, [terms[2], "Old Tom", "Old", None, None]))
    assert {r["match"] for r in matching.longest_dictionary_match(rows, "name", d.limit(0), "term").collect()} == {None}


def test_asof_carries_over_ranges(spark):
    """One key of many rows lies in several ranges; what it had before a range is carried in."""
    import random

    rng = random.Random(7)
    left = [("k" if i % 10 else "j", rng.randrange(1000), i) for i in range(600)] + [("none", 5, -1), (None, 5, -2), ("k", None, -3)]
    right = [("k", rng.randrange(0, 1000, 1), f"r{i}") for i in range(12)] + [("j", 500, "j"), ("k", None, "x"), (None, 1, "n")]
    right = list({(k, t): (k, t, v) for k, t, v in right}.values())
    l, r = spark.createDataFrame(left, "k string, at int, i int"), spark.createDataFrame(right, "k string, since int, v string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = {x["i"]: x["v"] for x in joins.asof(l, r, ["k"], "at", "since", ["v"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == len(left)
    for k, at, i in left:
        known = [(t, v) for q, t, v in right if k is not None and q == k and t is not None and at is not None and t <= at]
        assert got[i] == (max(known)[1] if known else None), (k, at, i)


def test_capped_pairs_meet_over_ranges(spark):
    from shelfmark.operators import curation

    rows = [("hot", i) for i in range(300)] + [(f"c{i % 20}", i) for i in range(90)] + [(None, 1), (None, 2)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = curation.capped_pairs(spark.createDataFrame(rows, "code string, i int"), "code", 3, ["i"], F.col("i")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by = {}
    for c, i in rows:
        if c:
            by.setdefault(c, []).append(i)
    want = [(c, a, b) for c, xs in by.items() for k, a in enumerate(sorted(xs)) for b in sorted(xs)[k + 1 : k + 4]]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert curation.capped_pairs(spark.createDataFrame([], "code string, i int"), "code", 3, ["i"], F.col("i")).count() == 0


def test_observations_are_not_dealt_by_source(spark):
    from shelfmark.operators import observations as ops

    rows = [("s", 1, 1, "b", d, q, 1.0, False) for d, q in ((1, 5.0), (2, 3.0), (2, 4.0), (9, 4.0), (None, 1.0))]
    obs = spark.createDataFrame(rows, "source string, store_id int, product_id int, brand string, n int, qty double, price double, on_promo boolean").withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n"))).drop("n")
    cells = ops.quality_cells(obs)
    assert cells.first()["n_days"] == 3 and cells.first()["cadence_days"] == 4.0
    cards = ops.quality_sources(obs, cells)
    assert (cards.first()["stores"], cards.first()["distinct_qty_global"], cards.first()["median_cadence_days"]) == (1, 4, 4.0)
    changes = ops.stock_changes(obs, spark.createDataFrame([("s", "count", 0.0, 1.0)], "source string, qual_tier string, jitter_frac double, median_cadence_days double"))
    assert "SortMergeJoin" not in changes._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_file_are_dealt_by_their_number(spark, tmp_path):
    from shelfmark.operators import quality
    from shelfmark.sources.working import spread, tasks_for

    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    assert spread(t, 50).rdd.getNumPartitions() == 20 and spread(t, 50).distinct().count() == 1000
    assert tasks_for(t, 50) == 20
    for d in (quality.profile(t), quality.candidate_keys(t, ["id"])):
        assert "_at#" in d._jdf.queryExecution().executedPlan().toString() and d.count() == 1
