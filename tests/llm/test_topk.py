import math
import random

import numpy as np
from pyspark.sql import functions as F

from shelfmark.llm import topk


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_exact_with_ties_and_copies(spark):
    rng = random.Random(7)
    rows = [(i, [rng.randint(-9, 9) / 4 for _ in range(6)]) for i in range(700)] + [(1000 + i, [0.5] * 6) for i in range(300)] + [(2000 + i, [0.0] * 6) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    v = topk.quantize(df)
    got = topk.top_k(v, v.filter(F.col("vec_id") % 50 == 0), 5, block=100, span=7, pilot=40).collect()
    ints = [(i, [math.floor(256 * x) for x in w]) for i, w in rows]
    assert sorted(map(tuple, got)) == brute(ints, [x for x in ints if x[0] % 50 == 0], 5)


def test_reading_stops_early():
    rng = np.random.default_rng(8)
    vectors = rng.integers(0, 3, (5000, 4))
    vectors[:20, 0] = 500
    block = topk.SortedBlock(np.arange(5000), vectors)
    best, score, entries, scored = block.search(np.array([10, 0, 0, 0]), -1, 5)
    assert entries < 5000 and list(best) == [0, 1, 2, 3, 4] and set(score) == {5000}


def test_less_than_half_is_scored_where_dimensions_differ(spark):
    """Vectors whose dimensions weigh less and less, as after a rotation to principal axes."""
    rng = np.random.default_rng(9)
    data = rng.normal(size=(3000, 16)) * 0.6 ** np.arange(16)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "vec_id long, embedding array<double>")
    v = topk.quantize(df)
    got = topk.top_k(v, v.filter("vec_id % 50 = 0"), 5, block=1000, pilot=500, effort=True)
    share = got.selectExpr("sum(scored) / sum(candidates)", "sum(entries) / sum(16 * candidates)").first()
    assert share[0] < 0.5 and share[1] < 0.25, share
    ints = [(i, np.floor(256 * x).astype(int)) for i, x in enumerate(data)]
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(ints, [x for x in ints if x[0] % 50 == 0], 5)


def test_a_floor_only_leaves_out_what_is_below_it():
    rng = np.random.default_rng(10)
    vectors = rng.integers(-99, 99, (700, 8))
    block = topk.SortedBlock(np.arange(700), vectors)
    for q in rng.integers(-99, 99, (30, 8)):
        want = sorted((-int(s), i) for i, s in enumerate(vectors @ q))[:5]
        for floor in (None, -want[4][0], -want[2][0], -want[0][0] + 1):
            best, score, *_ = block.search(q, -1, 5, floor)
            assert [(-s, i) for s, i in zip(score, best)] == [(s, i) for s, i in want if floor is None or -s >= floor]


def test_large_numbers_are_exact():
    vectors = np.array([[2**30, 1], [2**30, 2], [2**30, 3]], np.int64)
    best, score, *_ = topk.SortedBlock(np.arange(3), vectors).search(np.array([2**30, 1]), -1, 2)
    assert list(best) == [2, 1] and list(score) == [2**60 + 3, 2**60 + 2]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (100, [3.0]), (7, [1e300, 1.0])]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], "vec_id long, embedding array<double>, rank int, score string")
    v = topk.quantize(df)
    got = sorted(map(tuple, topk.top_k(v, v.filter("vec_id % 50 = 0")).collect()))
    assert got == [(0, 1, 50, 327680), (50, 1, 0, 327680)]
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_large_components_take_part(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1.0, 1.0]) * rng.choice([8388608.0, 1.1e7, 0.5, 2.0]), rng.uniform(-2, 2)]) for i in range(100)] + [(100, [2.0**40, 1.0]), (101, [-(2.0**40), 1.0])]
    small = [(i, v) for i, v in rows if i >= 100 or abs(v[0]) < 3]
    for data in (rows[:100], small):
        v = topk.quantize(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
        ints = [(i, [math.floor(256 * x) for x in e]) for i, e in data]
        asks = [x for x in ints if x[0] % 10 < 3 and x[0] < 100]  # the last two overflow with each other only
        score = lambda a, b: sum(x * y for x, y in zip(a, b))
        want = sorted((q, r + 1, i, s) for q, a in asks for r, (s, i) in enumerate(sorted(((score(a, b), i) for i, b in ints if i != q), key=lambda t: (-t[0], t[1]))[:5]))
        got = topk.top_k(v, v.filter(F.col("vec_id").isin([q for q, _ in asks])), 5, block=16, span=3, pilot=8)
        assert sorted(map(tuple, got.collect())) == want


def test_a_score_that_overflows_is_reported():
    block = topk.SortedBlock(np.array([1, 2]), np.array([[2**48], [3]]))
    assert list(block.search(np.array([2**14]), 9, 1)[1]) == [2**62]
    try:
        block.search(np.array([2**48]), 9, 1)
    except OverflowError as e:
        assert "vector 9" in str(e)
    else:
        raise AssertionError
