"""Operators that SQL cannot express against brute force, and what catalogs keep beside tables."""

import difflib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import geo, names
from shelfmark.operators import curation, joins, matching, outlets, windows
from shelfmark.sources.catalog import Catalog, Conflict


def clusters(ids, edges):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fuzzy_outlets(spark):
    rng = random.Random(3)
    words = ["corner", "liquor", "store", "wine", "market", "barn", "depot"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 3))), rng.randint(0, 30) if i % 11 else None, rng.choice([None, "", f"p{rng.randint(0, 60)}"])) for i in range(300)]
    rows += [(1000 + i, "mall shop", 99, None) for i in range(30)]  # a cell of too many
    df = spark.createDataFrame(rows, "id long, name string, cell int, phone string")
    got = {r["id"]: r["cluster"] for r in outlets.identify_fuzzily(df, "id", {"p": F.col("phone")}, F.col("cell"), "name", most=25).collect()}
    edges = []
    for x, y in itertools.combinations(rows, 2):
        crowded = sum(1 for r in rows if r[2] == x[2]) > 25
        if x[3] and x[3] == y[3] or x[2] is not None and x[2] == y[2] and not crowded and difflib.SequenceMatcher(None, x[1], y[1]).ratio() >= 0.72:
            edges.append((x[0], y[0]))
    assert got == clusters([r[0] for r in rows], edges)


def test_spelling_merges_against_ratios(spark):
    rng = random.Random(4)
    rows = [(i % 5, "".join(rng.choice("abc") for _ in range(6)), rng.randint(1, 50)) for i in range(60)]
    got = matching.spelling_merges(spark.createDataFrame(rows, "b int, n string, w int"), ["b"], "n", "w", 0.6).collect()
    want = []
    for b in range(5):
        own = sorted(((n, w) for x, n, w in rows if x == b), key=lambda t: (-t[1], t[0]))
        want += [(b, n, own[0][0]) for n, _ in own if n != own[0][0] and difflib.SequenceMatcher(None, n, own[0][0]).ratio() >= 0.6]
    assert sorted((r["b"], r["n"], r["anchor"]) for r in got) == sorted(want)


def test_nearest_by_cells_loses_no_point(spark):
    rng = random.Random(5)
    points = [(i, rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(200)] + [(500, None, 1.0)]
    anchors = [(f"a{i}", rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(40)]
    p = spark.createDataFrame(points, "id int, lat double, lng double")
    a = spark.createDataFrame(anchors, "place string, a_lat double, a_lng double")
    miles = geo.haversine_miles(F.col("lat"), F.col("lng"), F.col("a_lat"), F.col("a_lng"))
    few, many = (sorted(map(tuple, joins.nearest(p, a, miles, ["id"], "place", 2.0, most).collect())) for most in (1000, 0))
    assert few == many and len(many) == 201 and many[-1] == (500, None, None)


def test_numbered_goes_on_over_ranges(spark):
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1009 as v").repartition(5)
    got = sorted((r["v"], r["rn"]) for r in windows.numbered(df, F.col("v")).collect())
    assert [n for _, n in got] == list(range(1, 1001))
    assert windows.numbered(df.limit(0), F.col("v")).count() == 0


@pytest.mark.parametrize(
    "raw,key",
    [("Tito's Handmade Vodka", "tito handmade"), ("TITO HANDMADE", "tito handmade"), ("Jack Daniels", "jack daniel"), ("Ch\u00e2teau Margaux", "chateau margaux"), ("The Wine Company", ""), ("", ""), (None, None)],
)
def test_brand_keys(spark, raw, key):
    assert spark.createDataFrame([(raw,)], "b string").select(names.brand_key(F.col("b"))).first()[0] == key


def test_text_is_repaired_only_where_that_helps(spark):
    raw = ["A\u00c3\u00b1ejo", "it\u00e2\u20ac\u2122s", "\u00c3lone", "Ros\u00e9", "D&#39;Aquino &amp; Fils", None, "\u00c3 alone, Ros\u00c3\u00a9", "\u00e2\u20ac\x9d"]
    got = [r[0] for r in spark.createDataFrame([(i, s) for i, s in enumerate(raw)], "i int, s string").orderBy("i").select(names.repaired("s")).collect()]
    assert got == ["A\u00f1ejo", "it\u2019s", "\u00c3lone", "Ros\u00e9", "D'Aquino & Fils", None, "\u00c3 alone, Ros\u00e9", "\u201d"]


def test_cross_match_verdicts(spark):
    rows = [(0.96, 0.6, 0, 0, 1), (0.95, 0.6, -1, 0, 1), (0.95, 0.1, 0, 0, 0), (0.5, 0.45, 1, 1, 0), (0.5, 0.1, 0, 0, -1)]
    df = spark.createDataFrame(rows, "c double, n double, k int, v int, s int")
    got = [(r["verdict"], r["confidence"]) for r in curation.cross_match(df, "c", "n", ["k", "v"], "s").collect()]
    assert got == [("same_item", 0.878), ("look_alike", 0.285), ("review", 0.505), ("review", 0.385), ("weak", 0.2)]


def test_samples_follow_their_table_and_versions_are_exclusive(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}")
    c.write("t", spark.range(3))
    assert len(c.cached_sample("t")) == 3
    c.migrate("t", ["id"], 1)
    c.merge("t", spark.range(5))
    assert len(c.cached_sample("t")) == 5 and c.manifest("t")["version"] == 2
    before = set(c.store.names(f"file://{tmp_path}/t"))
    old = c.manifest("t") | {"version": 1}
    with pytest.raises(Conflict):
        c._commit("t", old, c._write_buckets("t", spark.range(9), old, 2), [])
    assert c.row_count("t") == 5 and set(c.store.names(f"file://{tmp_path}/t")) == before
