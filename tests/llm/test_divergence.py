import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import divergence
from shelfmark.llm.common import text_chunks

from .fixtures import edge_docs, no_docs

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, least=10):
    made = [(lang or "", source or "", TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))) for text, lang, source in docs]
    seen, count, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in made:
        seen[lang].update(set(terms))
        count[lang, source].update(terms)
        sources[lang].add(source)
    out = []
    for lang in sources:
        kept = [t for t, n in seen[lang].items() if n >= least]

        def share(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // total for t in kept}

        q = share(sum((count[lang, s] for s in sources[lang]), Counter()))
        p = {s: share(count[lang, s]) for s in sources[lang]}
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources[lang]:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources[lang] if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, k))
    return sorted(out)


def some_docs(n=600):
    rng = random.Random(12)
    words = {"en": [f"{a}{b}" for a in "abcdé" for b in ("", "x", "xy", "xyz", "ßq", "日")], "de": ["über", "Haus", "haus", "x1y", "straße"], "": ["only", "few"]}
    docs = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", None])
        source = rng.choice(["s1", "s1", "s1", "s2", None, "É", "z"])
        pool = words[lang or ""]
        docs.append((" ".join(rng.choices(pool, [1 + len(source or "") * k % 7 for k in range(len(pool))], k=rng.randint(0, 30))), lang, source))
    return docs + [(None, "en", "silent"), ("", "xx", "a"), ("rare words", "xx", "b"), ("RARE Words", "xx", None)]


def test_equals_brute_force(spark):
    docs = some_docs()
    df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(6)
    want = brute(docs)
    assert sorted(map(tuple, divergence.audit(df).collect())) == want
    # Many small ranges and blocks give the same.
    assert sorted(map(tuple, divergence.audit(df, range_rows=20).collect())) == want


def test_small_tries_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 5)
    monkeypatch.setattr(divergence, "LOOSE", 30)
    monkeypatch.setattr(divergence, "FULL", 40)
    monkeypatch.setattr(divergence, "text_chunks", lambda c: text_chunks(c, 300))
    docs = some_docs(200)
    df = spark.createDataFrame(docs, "text string, lang string, source string").coalesce(1)
    assert sorted(map(tuple, divergence.audit(df).collect())) == brute(docs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("abé日", max_size=6), st.integers(-3, 3), st.integers(1, 5)), max_size=40), st.integers(0, 40), st.integers(1, 30))
def test_trie_counts_and_walks_in_order(rows, at, most):
    want = defaultdict(Counter)
    for term, source, n in rows:
        want[term.encode()][source] += n

    def trie(some):
        counters = np.array([(s, n, 1) for _, s, n in some], divergence._COUNTER)
        return divergence.Trie.of(pa.array([t.encode() for t, _, _ in some], pa.large_binary()), counters)

    for t in (trie(rows), divergence.Trie.merged([trie(rows[:at]), trie(rows[at:])])):
        paths = t.paths.to_pylist()
        assert paths == sorted(want)
        for k, path in enumerate(paths):
            own = t.counters[t.first[k] : t.first[k + 1]]
            assert dict(zip(own["source"].tolist(), own["n"].tolist())) == dict(want[path])
            assert own["source"].tolist() == sorted(want[path])
        assert t.depths().tolist() == [0] * bool(paths) + [len(os.path.commonprefix([a, b])) for a, b in zip(paths, paths[1:])]
        assert t.sums("n").tolist() == [sum(want[p].values()) for p in paths]
        places = [x for a, b in t.runs(most) for x in range(a, b)]
        assert places == list(range(len(paths))) and all(0 < b - a <= most for a, b in t.runs(most))
        keep = np.array([len(p) % 2 == 0 for p in paths], bool)
        assert t.kept(keep).paths.to_pylist() == [p for p in paths if len(p) % 2 == 0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aB,é日 \n_9", max_size=8), max_size=12))
def test_terms_are_the_patterns(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    terms, of = divergence.terms_of(data, offsets)
    want = [(t.encode(), k) for k, text in enumerate(texts) for t in TERM.findall("".join(c.lower() if c.isascii() else c for c in text))]
    assert list(zip(terms.to_pylist(), of.tolist())) == want


def test_shares_are_exact_for_large_counts():
    counts = np.array([10, 10**12, 9_223_372_034], np.int64)
    want = [1 + (10**9 * (int(c) + 2)) // (10**13 + 7) for c in counts]
    assert divergence._shares(counts, np.array([10**13 + 7] * 3, np.int64)).tolist() == want
    one = np.array([10**9 + 1, 1], np.int64)
    assert divergence._apart(one, one[::-1]).tolist() == [(10**9) ** 2 // (10**9 + 2)] * 2


def test_edges(spark):
    got = divergence.audit(edge_docs(spark, {"part": 1, "item": "x", "range": 2, "n": 3})).collect()
    assert sorted(map(tuple, got)) == brute([(r["text"], r["lang"], r["source"]) for r in edge_docs(spark).collect()])
    assert divergence.audit(no_docs(spark)).count() == 0
