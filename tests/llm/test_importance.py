import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from shelfmark.llm import importance

from .fixtures import LONG, edge_docs, no_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def brute(docs, target, share=(5, 100)):
    made = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in made for b in f), Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in s}
    rows = []
    for i, n, f in made:
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3:0:-1]))
    drawn = share[0] * len(fit) // share[1]
    return rows, fit, drawn


def test_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "Été", "ÀB", "日本", "x9", "A_B", "don't"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(400)]
    docs += [(1000 + i % 3, "same words " * 15) for i in range(30)] + [(5000, None), (5001, ""), (None, "a " * 25)]
    target = [" ".join(rng.choices(vocabulary[:40], k=30)) for _ in range(20)] + [None]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), share=(20, 100)).collect()
    rows, fit, drawn = brute(docs, target, (20, 100))
    key = lambda r: str(tuple(r))
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(rows, key=key)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, drawn + 1)) and drawn > 30
    assert [tuple(r)[:5] for r in ranked] == fit[:drawn]


def test_very_long_texts_go_in_pieces(spark, monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice(["ab", "É", "c,", "d ", "  ", "\x00", "efg ", "X"]) for _ in range(4000))
    whole = features(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(importance, "PIECE_BYTES", size)
        pieces = importance._pieces(text.encode(), 3)
        assert "".join(p for p, _ in pieces) == text and len(pieces) > 1
        got = []
        for own, ahead in pieces:
            words, more = WORD.findall(own.lower().replace("é", "É")), WORD.findall(ahead.lower().replace("é", "É"))
            every = words + more
            got += [zlib.crc32(" ".join(every[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words)) if i + n <= len(every)]
        assert Counter(got) == Counter(whole[1])
    monkeypatch.setattr(importance, "PIECE_BYTES", 1 << 20)
    spilled = importance.bucketed(spark.createDataFrame([(1, text * 300), (2, LONG * 9)], "doc_id long, text string")).filter("bucket is null").collect()
    for r, t in zip(sorted(spilled, key=lambda r: r["doc_id"]), (text * 300, LONG * 9)):
        n, f = features(t)
        assert (r["n_words"], r["n_features"]) == (n, len(f)) and Counter(np.frombuffer(bytes(r["buckets"]), "<u2").tolist()) == Counter(f)


def test_counts_of_partitions_add_up(spark):
    df = spark.createDataFrame([(i, f"a b{i % 5} c") for i in range(50)], "doc_id long, text string").repartition(4)
    spilled = importance.bucketed(df)
    got = {r["bucket"]: r["n"] for r in spilled.filter("bucket is not null").groupBy("bucket").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert got == Counter(b for i in range(50) for b in features(f"a b{i % 5} c")[1])


def test_ranks_unroll_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(importance, "UNROLL", 3)
    scored = spark.createDataFrame([(7, 30, 5, 9)] * 20 + [(i, 30, 5, 8) for i in range(20)] + [(99, 3, 5, 100)], "doc_id long, n_words long, n_features long, score long")
    got = importance.ranked(scored, (50, 100)).collect()
    assert len(got) == 41 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21))
    assert {r["doc_id"] for r in got if r["rank"]} == {7} and [r["rank"] for r in got if r["doc_id"] == 99] == [None]


def test_edges(spark):
    target = spark.createDataFrame([("the lazy dog",)], "text string")
    got = importance.resample(edge_docs(spark, {"score": 1, "rank": 2, "weight": "x", "bucket": 3}), target).collect()
    assert len(got) == 12 and {r["n_features"] for r in got if r["doc_id"] in (3, 4, 5)} == {0}
    assert importance.resample(no_docs(spark), target).count() == 0
    empty = importance.resample(edge_docs(spark), no_docs(spark)).collect()
    assert len(empty) == 12
