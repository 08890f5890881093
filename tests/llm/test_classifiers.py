"""Language and toxicity: held-out accuracy on made-up languages and insults, the methods' exactness, edge cases."""

import random
import zlib

import numpy as np
import pytest

from shelfmark.llm import langid, toxicity

from .fixtures import edge_docs, no_docs

SYLLABLES = {"en": ["th", "er", "ing", "on", "ea", "st"], "de": ["sch", "ein", "ung", "ber", "ä", "tz"], "fr": ["eau", "oi", "ç", "que", "é", "ment"]}


def word(rng, lang):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        rows.append((i, " ".join(word(rng, lang) for _ in range(rng.randint(3, 60))) + ".", lang, "s", 0))
    return rows


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_languages_of_held_out_texts(spark):
    rows = corpus(400)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = langid.identify(df, langid.train(df, sample_docs=60)).collect()
    right = [r["lang"] == r["lang_pred"] for r in got if held_out(r["doc_id"])]
    assert len(got) == 400 and sum(right) >= 0.98 * len(right)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_languages_are_never_learned(spark):
    rows = [(i, "aaa bbb", "odd" if held_out(i) else "en", "s", 0) for i in range(50)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert model.languages == ["en"]


def plain_code_length(counts, text, order=3):
    """Prediction by partial matching as told, byte by byte: escapes by method C, no exclusion."""
    data = b"\n" * order + text
    total = 0.0
    for i in range(order, len(data)):
        for k in range(order, -2, -1):
            if k < 0:
                total += 8.0
                break
            followers = counts[k].get(data[i - k : i])
            if not followers:
                continue
            n, q = sum(followers.values()), len(followers)
            if data[i] in followers:
                total -= np.log2(followers[data[i]] / (n + q))
                break
            total -= np.log2(q / (n + q))
    return total


def test_code_lengths_equal_the_plain_method():
    rng = random.Random(2)
    train = {k: [" ".join(word(rng, k) for _ in range(20)).encode() for _ in range(5)] for k in SYLLABLES}
    names, grams, ks, counts = sorted(train), [], [], {}
    for i, name in enumerate(names):
        trees = [{} for _ in range(4)]
        for t in train[name]:
            data = b"\n\n\n" + t
            for j in range(3, len(data)):
                grams.append(int.from_bytes(data[j - 3 : j + 1], "big"))
                ks.append(i)
                for k in range(4):
                    f = trees[k].setdefault(data[j - k : j], {})
                    f[data[j]] = f.get(data[j], 0) + 1
        counts[name] = trees
    pairs, n = np.unique(np.stack([ks, grams]), axis=1, return_counts=True)
    model = langid.build(names, pairs[0], pairs[1], n)
    texts = [b"the eau schein", b"zzz \xff\x00 q", b"", b"\xc3\xa9\xc3\xa4 ing", train["de"][0]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = model.code_lengths(data, np.cumsum([0, *map(len, texts)]))
    for t, row in zip(texts, got):
        for name, bits in zip(names, row):
            assert abs(plain_code_length(counts[name], t) - bits) < 0.002 * (len(t) + 1), (t, name)


def test_languages_without_bytes_are_left_out(spark):
    rows = [(i, "plain words of one tongue", "en", "s", 0) for i in range(20)] + [(100 + i, "" if i % 2 else None, "xx", "s", 0) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.train(docs)
    assert model.languages == ["en"]
    cyrillic = spark.createDataFrame([(1, "Съешь же ещё этих мягких французских булок", None, "s", 0)], docs.schema)
    assert langid.identify(cyrillic, model).first()["lang_pred"] == "en"


def test_trees_of_many_languages_stay_small():
    """Uniform runs of 200 byte values in 100 languages: trees are as large as the counts, whatever the alphabet."""
    import pickle
    import tracemalloc

    rng = np.random.default_rng(4)
    n = 200_000
    grams = sum(rng.integers(40, 240, n) << s for s in (24, 16, 8, 0))
    tracemalloc.start()
    model = langid.build([f"l{i:03}" for i in range(100)], rng.integers(0, 100, n), grams, np.ones(n, np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.languages) == 100 and peak < 100 << 20 and len(pickle.dumps(model)) < 50 << 20
    text = rng.integers(40, 240, 3000).astype(np.uint8)
    assert model.code_lengths(text, np.array([0, 1000, 3000])).shape == (2, 100)


def test_worker_tables_do_not_change_costs(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(word(rng, k) for _ in range(30)).encode() for k in SYLLABLES for _ in range(4)]
    grams, ks = [], []
    for i, t in enumerate(texts):
        data = b"\n\n\n" + t
        grams += [int.from_bytes(data[j - 3 : j + 1], "big") for j in range(3, len(data))]
        ks += [i // 4] * (len(data) - 3)
    pairs, n = np.unique(np.stack([ks, grams]), axis=1, return_counts=True)
    model = langid.build(sorted(SYLLABLES), pairs[0], pairs[1], n)
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = model.code_lengths(data, offsets)
    assert (model.code_lengths(data, offsets) == whole).all()
    monkeypatch.setattr(langid, "MOST_CELLS", 10)
    model._forget()
    parts = [model.code_lengths(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts]
    assert (np.concatenate(parts) == whole).all()


def test_language_edges(spark):
    docs = edge_docs(spark, {"score": "x", "lang_pred": 1})
    got = {}
    for r in langid.identify(docs, langid.train(docs)).collect():
        got.setdefault(r["doc_id"], r)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5, 6)) and got[7]["lang_pred"] != "und"
    empty = no_docs(spark)
    assert langid.train(empty) is None and langid.identify(empty, None).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


INSULTS = ["moron", "wretch", "blockhead", "numpty"]


def insulted(n, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [word(rng, "en") for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words) + ".", "en", "s", 0))
        labels.append((i, 1, toxic))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_toxicity_and_gaps(spark):
    rows, labels = insulted(700)
    docs, known = frames(spark, rows, labels)
    model = toxicity.train(docs, known)
    truth = {i: t for i, _, t in labels}
    got = [r for r in toxicity.score_documents(docs, model).collect() if held_out(r["doc_id"])]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got) >= 0.97 * len(got)
    odd = [(i, t, "en", "s", 0) for i, t in enumerate(["what a m o r o n", "you m-o-r-o-n!", "b.l.o.c.k.h.e.a.d", "a WRETCH", "blockxhead", "thering onst"])]
    scores = [r["score"] for r in sorted(toxicity.score_documents(frames(spark, odd, labels)[0], model).collect())]
    assert all(s >= 0.5 for s in scores[:5]) and scores[5] < 0.5


def test_folded_weights_equal_the_kernel_machine():
    """The table's window sum is the sum over landmarks of weights and kernel values, worked out by definition."""
    rng = np.random.default_rng(1)
    marks = [bytes(rng.integers(1, 40, 9).astype(np.uint8)) for _ in range(6)]
    alpha = rng.normal(size=6)
    known, dense = toxicity._landmark_features(marks)
    folded = dense @ alpha
    tables, low = {}, 0
    for n in toxicity.SPAN:
        part = (known >= low) & (known < low + toxicity.CLASSES**n)
        tables[n] = np.zeros(toxicity.CLASSES**n, np.float32)
        tables[n][known[part] - low] = folded[part] * np.sqrt(toxicity.SHARE[n])
        low += toxicity.CLASSES**n
    word = bytes(np.concatenate([np.frombuffer(marks[0], np.uint8)[2:], rng.integers(1, 40, 4).astype(np.uint8)]))

    def features(s):
        out = {}
        import itertools

        for n, span in toxicity.SPAN.items():
            for start in range(min(len(s), toxicity.WINDOW)):
                for rest in itertools.combinations(range(start + 1, min(len(s), start + span)), n - 1):
                    u = (n, bytes([s[start], *[s[k] for k in rest]]))
                    out[u] = out.get(u, 0) + toxicity.DECAY ** (rest[-1] - start + 1) * np.sqrt(toxicity.SHARE[n])
        return out

    f = features(word)
    want = sum(a * sum(f.get(u, 0) * v for u, v in features(m).items()) for a, m in zip(alpha, marks))
    got = toxicity.window_sums(np.frombuffer(word + b"\0", np.uint8), tables)[0]
    assert got == pytest.approx(want, rel=1e-4, abs=1e-5)


def test_one_wrong_label_loses_no_insult(spark):
    rows, labels = insulted(700)
    wrong = next(i for i, text, *_ in rows if "wretch" in text and not held_out(i))
    labels = [(i, q, 0 if i == wrong else t) for i, q, t in labels]
    model = toxicity.train(*frames(spark, rows, labels))
    docs = frames(spark, [(1, "you are a wretch", "en", "s", 0), (2, "thering onst", "en", "s", 0)], labels)[0]
    assert [r["predicted"] for r in sorted(toxicity.score_documents(docs, model).collect())] == [1, 0]


def test_fit_is_the_same_with_repeated_rows_in_any_order(spark):
    rows, labels = insulted(300)
    docs, known = frames(spark, rows, labels)
    one = toxicity.train(docs, known)
    two = toxicity.train(docs.unionByName(docs).repartition(5), known.unionByName(known).unionByName(known).repartition(3))
    assert (one.slope, one.shift) == (two.slope, two.shift) and all((one.values[n] == two.values[n]).all() for n in one.values)


def test_newton_steps_reach_the_dense_kernel_machine():
    """The primal machine on whitened landmark values against the dual of the same kernel matrix, solved by coordinates."""
    rng = np.random.default_rng(5)
    windows = [bytes(rng.integers(1, 12, 8).astype(np.uint8)) for _ in range(40)]
    y = np.where(rng.random(40) < 0.5, 1.0, -1.0)
    known, dense = toxicity._landmark_features(windows)
    gram = (dense.T @ dense).astype(np.float64)
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-6 * values.max()
    x = gram @ (vectors[:, keep] / np.sqrt(values[keep]))
    w = toxicity._svm(x, y, np.ones(40), 60)
    # Squared hinge, ridge 1 on weights and 1e-3 on the bias: the dual's kernel is the gram matrix + 1000 and 1 on its
    # diagonal. Its solution on the violated set, which must hold to all conditions of the dual, is the machine's.
    got = x @ w[:-1] + w[-1]
    inside = y * got < 1
    q = (gram + 1e3 + np.eye(40)) * y[:, None] * y[None, :]
    alpha = np.zeros(40)
    alpha[inside] = np.linalg.solve(q[np.ix_(inside, inside)], np.ones(inside.sum()))
    want = (gram + 1e3) @ (alpha * y)
    assert (alpha[inside] > 0).all() and (y[~inside] * want[~inside] >= 1 - 1e-6).all()
    assert np.abs(got - want).max() < 1e-3


def test_toxicity_edges(spark):
    rows, labels = insulted(300)
    model = toxicity.train(*frames(spark, rows, labels))
    docs = edge_docs(spark, {"score": "x", "predicted": "y"})
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == 12 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (3, 4, 5, 6))
    assert toxicity.score_documents(no_docs(spark), model).count() == 0
    one = [(i, 1, 1) for i in range(20)] + [(None, 1, 0), (30, None, None)]
    same = toxicity.train(*frames(spark, rows, one))
    assert {r["score"] for r in toxicity.score_documents(docs, same).collect()} == {1.0}
    none = toxicity.train(frames(spark, rows, labels)[0], frames(spark, rows, labels)[1].limit(0))
    assert {r["score"] for r in toxicity.score_documents(docs, none).collect()} == {0.0}
