import random
import re

import numpy as np
import pytest

from shelfmark.llm import jaccard
from shelfmark.llm.shingles import Shingler, set_key

from .fixtures import EDGES, edge_docs, no_docs


def shingles(text, w):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    return {tuple(words[i : i + w]) for i in range(len(words) - w + 1)} if len(words) >= w else ({tuple(words)} if words else set())


def brute(rows, w, num, den):
    sets = [shingles(t, w) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and den * common >= num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d, links[i]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies(rng, n_groups, copies, words, edits):
    rows, k = [], 0
    passage = [f"p{j}" for j in range(30)]
    for g in range(n_groups):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(words)] + passage
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = f"e{rng.randint(0, 10**6)}"
            rows.append((k, " ".join(text)))
            k += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("w,num,den,edits", [(3, 90, 100, 4), (5, 8, 10, 5), (1, 7, 10, 40)])
def test_equals_brute_force(spark, monkeypatch, w, num, den, edits):
    monkeypatch.setattr(jaccard, "BUCKET_TOKENS", 5000)
    monkeypatch.setattr(jaccard, "BUFFER_TOKENS", 4000)
    rng = random.Random(w)
    rows = near_copies(rng, 12, 12, 80, edits) + [(500 + i, t) for i, t in enumerate(["a b", "A  B", "b a", "", " ", "x"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = jaccard.jaccard_join(df, w, num, den).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, w, num, den)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 20)
    rng = random.Random(1)
    rows = near_copies(rng, 2, 90, 60, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, jaccard.jaccard_join(df, 3, 85, 100).collect()), key=str) == brute(rows, 3, 85, 100)


def test_shingles_that_many_documents_of_a_batch_hold(spark):
    rng = random.Random(2)
    rows = near_copies(rng, 3, 60, 40, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert sorted(map(tuple, jaccard.jaccard_join(df, 2, 8, 10).collect()), key=str) == brute(rows, 2, 8, 10)


def test_a_loose_chain_is_cut_by_its_ties(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 10)
    kinds = []
    deal = jaccard.deal_groups
    monkeypatch.setattr(jaccard, "deal_groups", lambda *a: kinds.append(deal(*a)) or kinds[-1])
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 61))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, jaccard.jaccard_join(df, 1, 9, 10).collect()), key=str) == brute(rows, 1, 9, 10)
    assert {r["by_token"] for r in kinds[0].select("by_token").distinct().collect()} == {True}


def test_copies_of_a_long_chain_are_linear(spark):
    n = 100_000
    nodes = spark.range(n).selectExpr("id as node", "50L as n", "array(id, id + 1, id + 2) as lead")
    dealt = jaccard.deal_groups(nodes, spark.range(n).selectExpr("id as node", "0L as component"))
    assert dealt.selectExpr("sum(parts)").first()[0] <= 3 * n
    dense = spark.range(3000).selectExpr("id as node", "50L as n", "array(1L, 2L, 3L, 4L) as lead")
    dealt = jaccard.deal_groups(dense, spark.range(3000).selectExpr("id as node", "0L as component"))
    assert dealt.selectExpr("sum(parts)").first()[0] == 3 * 3000


def test_edges(spark):
    got = jaccard.jaccard_join(edge_docs(spark, {"n": 1, "node": 2, "component": "x"}), 3, 90, 100).collect()
    assert sorted(map(tuple, got), key=str) == brute([(i, t) for i, t, *_ in EDGES], 3, 90, 100)
    assert jaccard.jaccard_join(no_docs(spark)).count() == 0


def test_shingler_tells_sets_apart():
    texts = [t for t in ("a b c d", "A b C d", "a b c d ", "d c b a", "ab c d", "a", "b", "a b", "", "é x y", "É x y", "a\x0bb c d") if True]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    for w in (1, 2, 3, 5):
        tokens, sizes = Shingler(w).sets(data, offsets)
        keys = set_key(tokens, sizes)
        for i, a in enumerate(texts):
            assert sizes[i] == len(shingles(a, w))
            for j, b in enumerate(texts):
                assert (keys[i] == keys[j]) == (shingles(a, w) == shingles(b, w))


def test_estimated_cost_lengthens_frequent_prefixes():
    rare, frequent = np.full(60, 8.0), np.full(60, 80.0)
    assert jaccard.choose_matches(rare, 0, 600, 560) <= jaccard.choose_matches(frequent, 0, 600, 560)
    assert jaccard.choose_matches(frequent, 0, 600, 560) > 1
