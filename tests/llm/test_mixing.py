import random
import re
from collections import defaultdict

from shelfmark.llm import mixing

from .fixtures import edge_docs, no_docs


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Shares by weight; what lies above the cap goes to the others, one round after the other."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(ordered)}
    size, out = dict(ordered), {}
    active = list(size)
    while active:
        share = (sum(size.values()) - sum(out.values())) / sum(weight[n] for n in active)
        over = [n for n in active if share * weight[n] > cap * size[n]]
        if not over:
            return out | {n: share * weight[n] for n in active}
        out |= {n: float(cap * size[n]) for n in over}
        active = [n for n in active if n not in out]
    return out


def test_targets_fill_like_water(spark):
    rng = random.Random(4)
    for sizes in ([("a", 100), ("b", 10), ("c", 1000)], [(None, 5), ("z", 5)], [("a", 0)], [(f"s{i}", int(10 ** rng.uniform(0, 5))) for i in range(500)] + [(None, 77), ("", 3)]):
        planned, n = mixing.plan(spark.createDataFrame([(s, w, i) for i, (s, w) in enumerate(sizes)], "_source string, size long, h long").repartition(3))
        want = targets(sizes)
        assert n == len(sizes)
        for r in planned.collect():
            assert abs(r["target"] - want[r["_name"]]) <= 1e-6 * (1 + want[r["_name"]])


def test_very_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1000)
    docs = spark.range(60_000).selectExpr("id as doc_id", "concat('w ', repeat('x ', cast(id % 7 as int))) as text", "concat('s', id % 20000) as source")
    r = mixing.mix(docs).selectExpr("count(*)", "count(distinct source)", "sum(taken) / sum(size)", "max(taken - 3 * size)").first()
    assert r[0] == 60_000 and r[1] == 20_000 and r[3] <= 0 and 0.5 < r[2] <= 1.0


def brute(rows):
    """Targets by raising a water level in small steps are matched by shares; sizes by a plain pattern."""
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return size


def test_taken_comes_near_the_target(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.choice((1, 5, 50, 400)))), rng.choice(("a", "b", "b", "b", "c", None)), i) for i in range(3000)]
    rows += [(9000, "w " * 20_000, "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(7)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    size, goal = brute([r[:3] for r in rows]), targets(list(brute([r[:3] for r in rows]).items()))
    taken = defaultdict(int)
    for r in got:
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - goal[r["source"]]) < 1e-6
        taken[r["source"]] += r["taken"]
    for s in size:
        assert abs(taken[s] - goal[s]) <= max(5, 0.01 * goal[s]), s
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_the_largest_hashes_that_fit_are_taken_by_threshold(spark):
    rows = [(i, "w " * (1 + i % 9), "a" if i % 3 else "b") for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in ("a", "b"):
        own = sorted((r for r in got if r["source"] == s), key=lambda r: r["hash"])
        target, size = own[0]["target"], own[0]["source_size"]
        left = round(target - int(target // size) * size)
        want = {}
        for r in own:  # brute force: walk up the hashes and take what still fits
            want[r["doc_id"]] = r["size"] <= left
            left -= r["size"] if want[r["doc_id"]] else 0
            if left <= 0.0005 * target:
                left = 0
        extra = {r["doc_id"]: r["taken"] > r["size"] * int(target // size) for r in own}
        assert extra == want


def test_repeated_rows_come_near_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "UNROLL", 7)
    text = "w " * 100
    rows = [(0, text, "a", "x")] * 25 + [(0, text, "a", "y")] * 25 + [(1 + i, text, "a", "x") for i in range(10)] + [(100 + i, "v " * 10, "b", None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, other string").repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    goal = {s: w for s, w in targets([("a", 6000), ("b", 3000)]).items()}
    for s in goal:
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - goal[s]) <= 100, s
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    whole = mixing.mix(df, texts=True).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in whole) == sorted((r["doc_id"], r["taken"]) for r in got)
    again = mixing.mix(df.repartition(3), texts=True).collect()
    assert sorted(map(str, again)) == sorted(map(str, whole))
    # Of equal rows that differ in other columns the first are taken.
    some = {o: sorted(r["taken"] for r in whole if r["doc_id"] == 0 and r["other"] == o) for o in ("x", "y")}
    assert max(some["y"]) <= min(some["x"])


def test_one_row_repeated_is_a_whole_source(spark):
    rows = [(0, "w w w", "a")] * 1000 + [(i, "v", "b") for i in range(1, 3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    goal = targets([("a", 3000), ("b", 2999)])
    assert abs(sum(r["taken"] for r in got if r["source"] == "a") - goal["a"]) <= 6


def test_edges(spark):
    got = mixing.mix(edge_docs(spark, {"size": "x", "taken": 1})).collect()
    assert len(got) == 12 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(no_docs(spark)).count() == 0
    texts = mixing.mix(edge_docs(spark), texts=True)
    assert "text" in texts.columns and texts.count() == 12
