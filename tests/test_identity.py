"""Constrained components, near names, spoken names and lineage, held against plain versions."""

import datetime as dt
import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfmark.functions import products, text
from shelfmark.operators import alike, entities, identity, joins, matching, outlets
from shelfmark.streaming import lineage


def greedy(nodes, edges, attributes):
    """Edges one by one, the strongest first."""
    group = {n["id"]: n["id"] for n in nodes}
    values = {n["id"]: {a: {n[a]} - {None, ""} for a in attributes} for n in nodes}
    best = {}
    for a, b, s in edges:
        a, b = min(a, b), max(a, b)
        if a != b and a in group and b in group:
            best[a, b] = max(s, best.get((a, b), s))
    for (a, b), _ in sorted(best.items(), key=lambda e: (-e[1], e[0])):
        u, v = sorted((group[a], group[b]))
        if u != v and all(len(values[u][x] | values[v][x]) < 2 for x in attributes):
            values[u] = {x: values[u][x] | values[v][x] for x in attributes}
            group = {n: u if g == v else g for n, g in group.items()}
    return group


def some_graph(seed, n=120, m=260, kinds=3):
    rng = random.Random(seed)
    nodes = [{"id": i, "kind": rng.choice([None, "", None, *"xyz"[:kinds]]), "size": rng.choice([None, None, "1", "2"])} for i in range(n)]
    edges = [(rng.randrange(n), rng.randrange(n), float(rng.randint(1, 4))) for _ in range(m)]
    return nodes, edges + [(0, 0, 9.0), (5, 10_000, 9.0), edges[0]]


@pytest.mark.parametrize("walked", [10_000, 5, 0])
def test_constrained_components_are_the_greedy_ones(spark, walked):
    """Whole components, components walked by one task, and rounds give the same."""
    nodes, edges = some_graph(walked)
    df = spark.createDataFrame([tuple(n.values()) for n in nodes], "id long, kind string, size string")
    got = identity.constrained_components(df, spark.createDataFrame(edges, "a long, b long, strength double"), "id", ["kind", "size"], walked).collect()
    want = greedy(nodes, edges, ["kind", "size"])
    assert {r["id"]: r["component"] for r in got} == want
    kinds = {}
    for n in nodes:
        for a in ("kind", "size"):
            if n[a]:
                assert kinds.setdefault((want[n["id"]], a), n[a]) == n[a]


def test_no_edges_and_no_nodes(spark):
    none = spark.createDataFrame([], "a long, b long, strength double")
    df = spark.createDataFrame([(1, "x"), (None, "y"), (2, None)], "id long, kind string")
    assert {tuple(r) for r in identity.constrained_components(df, none, "id", ["kind"]).collect()} == {(1, 1), (2, 2)}
    assert identity.constrained_components(df.limit(0), none, "id", ["kind"]).count() == 0


def test_keys_that_say_less_join_where_confirmed(spark):
    rows = [
        ("m", "12", "750", "a", "u1", 62.0), ("m", None, "750", "b", None, 65.0), ("m", "18", "750", "a", None, 62.0),
        ("m", "", "700", "c", "u1", 300.0), ("k", None, "750", "a", None, 62.0),
    ]
    df = spark.createDataFrame(rows, "brand string, age string, size string, source string, code string, price double")
    got = identity.resolved_identities(df, ["brand"], ["age", "size"], "source", "code", "price").collect()
    sizes = sorted(r["group_members"] for r in got)
    # The key without an age joins one of the two ages, and never both; another size and another brand stay apart.
    assert len(got) == 5 and sizes == [1, 1, 1, 2, 2]


def test_alike_names_are_all_pairs(spark):
    rng = random.Random(1)
    names = ["".join(rng.choice("abcde ") for _ in range(rng.randint(1, 14))).strip() or "x" for _ in range(260)]
    names += [n[:-1] + "z" for n in names[:60]] + [n[1:] + n[:1] for n in names[:40]] + ["日本" + n for n in names[:30]] + ["aaaa" * k for k in range(1, 30)]
    rows = [(i, "b" if i % 4 else "c", n) for i, n in enumerate(names)] + [(9000, "b", ""), (9001, "b", None), (9002, None, "aaaa")]
    df = spark.createDataFrame(rows, "id long, block string, name string")
    nodes = alike._blocks(df, "id", [F.col("block")], "name")
    held = [(r["block"], r["name"], r["node"]) for r in nodes.collect()]
    for least, below in ((0.86, None), (0.6, 0.86)):
        want = set()
        for (b1, n1, i), (b2, n2, j) in itertools.combinations(held, 2):
            s = text._jaro_winkler(n1, n2)
            if b1 == b2 and least <= s and (below is None or s < below):
                want.add((min(i, j), max(i, j), round(s, 9)))
        for unit in (1024, 20):
            got = alike.alike_names(nodes, least, below, unit=unit).collect()
            assert len(got) == len(want) and {(r["a"], r["b"], round(r["s"], 9)) for r in got} == want


def test_only_names_that_ask_are_compared(spark, monkeypatch):
    rng = random.Random(8)
    names = sorted({" ".join(rng.choice(["red", "blue", "old", "new", "ring", "bolt", "rod"]) for _ in range(3)) for _ in range(120)})
    nodes = spark.createDataFrame([("b", n, i) for i, n in enumerate(names)], "block string, name string, node long")
    asked = {i for i in range(len(names)) if i % 20 == 0}
    for unit in (1024, 16):
        got = alike.alike_names(nodes, 0.6, unit=unit, asked=F.col("node") % 20 == 0).collect()
        want = {(i, j) for i, j in itertools.combinations(range(len(names)), 2) if asked & {i, j} and text._jaro_winkler(names[i], names[j]) >= 0.6}
        assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want
    compared = []
    monkeypatch.setattr(alike, "_jaro_winkler", lambda a, b: compared.append(1) or text._jaro_winkler(a, b))
    frame = pd.DataFrame({"name": names, "node": range(len(names)), "_q": [i in asked for i in range(len(names))]})
    alike._meet(0.6, None)(("b", "0", "0"), frame, frame)
    assert len(compared) <= len(asked) * len(names)


def test_a_name_that_many_rows_have_is_assigned_alike(spark):
    fresh = spark.createDataFrame([(i, "x" if i % 2 else "y", ("red ring", "red rng", "old bolt", None)[i % 4]) for i in range(80)] + [(99, None, "red ring")], "id long, k string, n string")
    members = spark.createDataFrame([(1, "x", "red ring"), (2, "y", "red ring"), (3, "y", "red rings"), (4, "x", None), (5, None, "red ring")], "cluster long, k string, n string")
    got = {r["id"]: (r["cluster"], r["similarity"]) for r in matching.assign_to_clusters(fresh, members, "k", "n").collect()}
    best = {}
    for r in fresh.collect():
        found = [(text._jaro_winkler(r["n"], m["n"]), -m["cluster"]) for m in members.collect() if None not in (r["n"], m["n"], r["k"]) and r["k"] == m["k"]]
        s, c = max((f for f in found if f[0] >= 0.9), default=(None, None))
        best[r["id"]] = (None, None) if s is None else (-c, round(s, 4))
    assert got == best


def test_name_clusters_keep_every_row(spark):
    rows = [(1, "b", "makers mark"), (2, "b", "makers mark"), (3, "b", "makers markk"), (4, "b", "quite other"), (5, "c", "makers mark"), (6, "b", None), (7, "b", "")]
    members, clusters = alike.name_clusters(spark.createDataFrame(rows, "id long, block string, name string"), "id", [F.col("block")], "name")
    got = {r["id"]: (r["cluster"], r["matched_on"]) for r in members.collect()}
    assert got == {1: (1, "name"), 2: (1, "name"), 3: (1, "name"), 4: (4, "singleton"), 5: (5, "singleton"), 6: (6, "singleton"), 7: (7, "singleton")}
    assert {r["cluster"]: r["members"] for r in clusters.collect()} == {1: 3, 4: 1, 5: 1, 6: 1, 7: 1}


def test_stratum_scores(spark):
    pairs = [("m", 1, 1), ("m", 0, 1), ("m", None, 1), ("n", 1, 0), ("n", 0, 0)]
    got = {r["stratum"]: tuple(r)[1:] for r in alike.stratum_scores(spark.createDataFrame(pairs, "s string, t int, g int"), "s", "t", "g").collect()}
    assert got["m"] == (3, 2, 1, 1, 0, 0.5, 1.0) and got["n"] == (2, 2, 0, 0, 1, None, 0.0) and got["all"] == (5, 4, 1, 1, 1, 0.5, 0.5)


def test_names_that_sound_alike_meet(spark):
    say = lambda *names: [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(products.phonetic(F.col("n"))).collect()]
    a, b, c, d, e, f = say("Rittenhouse", "Ridenhouse", "Chivas", "Chibas", "Phil Jacks", "the Fil Gacks")
    assert a == b and c == d and e == f
    assert say("Chivas Eighteen", "1100 Wine Co.", None, "&") == ["khavas 18", "1100", "", ""]


def test_item_scores(spark):
    pairs = [("chivas 18", "Chivas Regal 18 Year"), ("chivas 12", "chivas 18"), ("Makers Mark", "makers mark"), ("", "x"), (None, "x"), ("rittenhouse riot", "Rittenhouse Rye"), ("absolut", "zzz")]
    got = [r["score"] for r in outlets.item_score(spark.createDataFrame(pairs, "q string, c string"), "q", "c").collect()]
    assert got[:5] == [0.9, 0.0, 1.0, 0.0, 0.0] and got[5] >= 0.81 and got[6] < 0.3


def test_merge_keeps_null_and_empty_keys_apart(spark):
    old = spark.createDataFrame([("", 1), (None, 2), ("a", 3)], "k string, v int")
    for new, want in ((None, {("", 1), (None, 9), ("a", 3)}), ("", {("", 9), (None, 2), ("a", 3)})):
        batch = spark.createDataFrame([(new, 9)], "k string, v int")
        assert {tuple(r) for r in joins.upsert(old, batch, ["k"]).collect()} == want
    twice = spark.createDataFrame([("a", 4, 1), ("a", 5, 0), (None, 6, 0), (None, 7, 0)], "k string, v int, at int")
    assert {tuple(r)[:2] for r in joins.last_of_key(twice, ["k"], F.col("at")).collect()} == {("a", 4), (None, 7)}


DAY = dt.datetime(2024, 5, 1)
SIGHTING = "at timestamp, store string, item string, price string, list_price string, on_promo boolean, discount string, name string, section string"


def sighting(hours, item="i", price="10", promo=None, discount=None, name="n", section="s", store="s1"):
    return DAY + dt.timedelta(hours=hours), store, item, price, None, promo, discount, name, section


def test_lineage_restarts_without_repeating(spark, tmp_path):
    folder = f"{tmp_path}/landed"

    def go(rows):
        spark.createDataFrame(rows, SIGHTING).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SIGHTING).parquet(folder)
        lineage.write_lineage(lineage.lineage_events(stream, dt.timedelta(hours=30)), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        return spark.read.schema(lineage.EVENT_SCHEMA).parquet(f"{tmp_path}/out").orderBy("at", "event").collect()

    first = go([sighting(0), sighting(0, "j"), (DAY, None, "k", *[None] * 6), (None, "s", "l", *[None] * 6)])
    assert [(r["item"], r["event"]) for r in first] == [("i", "new_item"), ("j", "new_item")]
    second = go([sighting(24, price="11", promo=True, discount="5", section="t"), sighting(20, price="10"), sighting(-5, price="1")])
    events = {(r["item"], r["event"]): r for r in second}
    assert set(events) == {("i", "new_item"), ("j", "new_item"), ("i", "price"), ("i", "discount"), ("i", "attr")}
    assert (events["i", "price"]["was"], events["i", "price"]["now"]) == ("10/", "11/") and events["i", "price"]["supersedes"] is None
    # j is not seen again, and i comes back after its patience: both are delisted at their time, i is new once more.
    third = go([sighting(80, price="12")])
    third = third if any(r["event"] == "delist" and r["item"] == "j" for r in third) else go([sighting(81, "m")])
    told = [(r["item"], r["event"], r["at"]) for r in third if r["event"] == "delist"]
    assert told == [("j", "delist", DAY + dt.timedelta(hours=30)), ("i", "delist", DAY + dt.timedelta(hours=54))]
    again = [r for r in third if (r["item"], r["event"]) == ("i", "new_item")]
    assert len(again) == 2 and again[1]["supersedes"] == again[0]["event_id"]
    assert len({r["event_id"] for r in third}) == len(third)


def plain_lineage(rows, patience, until):
    """Each item by itself, its sightings by time; `until` is what the stream's time has come to."""
    out, spelled = [], lambda *v: "/".join("" if x is None else str(x).lower() if isinstance(x, bool) else x for x in v)
    for item in {r[2] for r in rows}:
        last, listed, ids = None, False, {}

        def tell(kind, at, was, now):
            made = lineage.event_id("s1", item, kind, (at - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1), now)
            out.append((made, at, "s1", item, kind, was, now, ids.get(kind)))
            ids[kind] = made

        for r in [*sorted((r for r in rows if r[2] == item), key=lambda r: r[0]), None]:
            if listed and (until if r is None else r[0]) > last["at"] + patience:
                tell("delist", last["at"] + patience, spelled(last["price"], None), "")
                listed = False
            if r is None:
                break
            now = dict(zip(("at", "store", "item", "price", "list_price", "promo", "discount", "name", "section"), r))
            if listed:
                now |= {c: last[c] for c in ("name", "section") if now[c] is None}
                if now["price"] != last["price"]:
                    tell("price", now["at"], spelled(last["price"], None), spelled(now["price"], None))
                if bool(now["promo"]) != bool(last["promo"]) or now["discount"] != last["discount"]:
                    tell("discount", now["at"], spelled(last["promo"], last["discount"]), spelled(now["promo"], now["discount"]))
                if (now["name"], now["section"]) != (last["name"], last["section"]):
                    changed = [c for c in ("name", "section") if r[7 if c == "name" else 8] is not None]
                    tell("attr", now["at"], spelled(last["name"], last["section"]), spelled(*[now[c] if c in changed else last[c] for c in ("name", "section")]))
            else:
                tell("new_item", now["at"], "", spelled(now["price"], None))
            last, listed = now, True
    return sorted(out)


def test_lineage_state_lies_by_buckets_of_items(spark, tmp_path):
    rng = random.Random(8)
    pick = lambda *v: rng.choice(v)
    cuts = [
        [sighting(h, f"i{i}", pick("10", "11", None), pick(True, False, None), pick(None, "5"), pick("n", "m", None), pick("s", None)) for i in range(60) for h in rng.sample(range(first, first + 24), rng.choice((0, 1, 1, 2)))]
        for first in (0, 24, 48, 72)
    ]
    cuts[-1].append(sighting(96, "end"))
    want = plain_lineage([r for rows in cuts for r in rows], dt.timedelta(hours=30, minutes=30), DAY + dt.timedelta(hours=96))
    assert {w[4] for w in want} == {"new_item", "price", "discount", "attr", "delist"} and any(w[4] == "delist" and w[-1] for w in want)
    for buckets, starts in ((1, [sum(cuts, [])]), (5, [cuts[0], cuts[1] + cuts[2], cuts[3]])):
        place = f"{tmp_path}/{buckets}"
        for rows in starts:
            spark.createDataFrame(rows, SIGHTING).repartition(2).write.mode("append").parquet(f"{place}/landed")
            stream = spark.readStream.schema(SIGHTING).parquet(f"{place}/landed")
            query = lineage.write_lineage(lineage.lineage_events(stream, dt.timedelta(hours=30, minutes=30), buckets=buckets), f"{place}/out", f"{place}/cp", partitions=2)
            query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]
        assert state["numRowsTotal"] == buckets and state["numShufflePartitions"] == 2
        assert sorted(tuple(r) for r in spark.read.schema(lineage.EVENT_SCHEMA).parquet(f"{place}/out").collect()) == want
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_item_lineage_lands_each_day_by_many_tasks(spark, sf_dir, monkeypatch):
    from shelfmark.queries import identity as queries

    seen, write = [], lineage.write_lineage
    monkeypatch.setattr(lineage, "write_lineage", lambda events, path, *rest: seen.append(path.removesuffix("/events")) or write(events, path, *rest))
    queries.item_lineage(spark, sf_dir)
    files = spark.read.parquet(f"{seen[0]}/landed").inputFiles()
    assert len(set(seen)) == 1 and len(files) > 4


def test_class_pairs_are_all_pairs_and_score_each_two_values_once(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["x", "y", None, "x|y"]), rng.choice(["red ring", "red rings", "old bolt", "", None])) for i in range(160)] + [(1000 + i, "big", "same") for i in range(60)]
    asked = []

    def score(values):
        asked.extend(tuple(r) for r in values.collect())
        return values.withColumn("s", text.jaro_winkler("v_a", "v_b")).filter("s >= 0.6")

    df = spark.createDataFrame(rows, "id long, k string, v string").repartition(3)
    for task in (1 << 21, 100):
        asked.clear()
        got = sorted((r["a"], r["b"], r["s"]) for r in entities.class_pairs(df, "id", ["k"], "v", score, task=task).collect())
        want = sorted((i, j, text._jaro_winkler(v, w)) for i, k, v in rows for j, l, w in rows if i < j and k is not None and k == l and v is not None and w is not None and text._jaro_winkler(v, w) >= 0.6)
        assert got == want
        assert len(asked) == len(set(asked)) <= 17


def test_pairs_that_share_no_early_token_do_not_overlap(spark):
    rng = random.Random(6)
    rows = [(i, "k", sorted(rng.sample("abcdefghijklmnopqrstuvwxyz", rng.choice([0, 1, 3, 10, 19, 20, 20, 21])))) for i in range(60)]
    rows += [(100 + i, "k", [c for c in "abcdefghijklmnopqrstuvwxyz" if c != d]) for i, d in enumerate("abz")]
    rows += [(200, "k", list("abcdefghijklmnopqrstuvwxyz")), (201, "k", list("abcdefghijklmnopqrstuvwxyz"))]
    over = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 0.0
    near = lambda sets: sets.withColumn("s", text.jaccard(F.col("t_a"), F.col("t_b"))).filter("s >= 0.9")
    got = entities.class_pairs(spark.createDataFrame(rows, "id long, k string, t array<string>"), "id", ["k"], "t", near, entities.shared_start(["k"], "t", 0.9)).collect()
    assert sorted((r["a"], r["b"]) for r in got) == sorted((i, j) for i, _, t in rows for j, _, u in rows if i < j and over(t, u) >= 0.9)


def test_counted_classes_are_counted_pairs(spark):
    rng = random.Random(7)
    rows = [(i % 110, rng.choice("xy"), rng.choice(["s", "S", "", None, "t"]), rng.choice(["1", "2", None])) for i in range(120)] + [(None, "x", "s", "1"), (500, None, "s", "1")]
    df = spark.createDataFrame(rows, "id long, k string, kind string, size string")
    plain = outlets.compare(entities.blocked_pairs(df.filter("k is not null"), "id", [F.col("k")], ["kind", "size"]), ["kind", "size"]).groupBy("verdict").count()
    counted = outlets.compare(entities.class_counts(df, "id", ["k"], ["kind", "size"]), ["kind", "size"]).groupBy("verdict").agg(F.sum("n").alias("n"))
    assert {tuple(r) for r in counted.collect()} == {tuple(r) for r in plain.collect()}
    many = spark.range(2_000_000).select("id", F.lit("k").alias("k"), (F.col("id") % 2).cast("string").alias("kind"))  # 2 * 10 ** 12 pairs
    got = {(r["kind_a"], r["kind_b"]): r["n"] for r in entities.class_counts(many, "id", ["k"], ["kind"]).collect()}
    assert got == {("0", "0"): 499_999_500_000, ("1", "1"): 499_999_500_000, ("0", "1"): 10**12}
