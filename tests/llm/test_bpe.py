import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import bpe

from .fixtures import edge_docs, no_docs

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def got_ids(df):
    return sorted(((r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in df.collect()), key=str)


def want_ids(rows):
    return sorted(((i, plain_ids(t)) for i, t in rows), key=str)


def passages():
    rng = random.Random(3)
    words = ["The", "quick", "brown", "Füchse,", "don't", "3,5", "été.", "naïve", "L'été", "x" * 40, "日本語", "<|endoftext|>", "é", "H̱a", "U.S.A.", "a_b", "“q”", " ", "　z"]
    shared = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(4)]
    docs = [(0, shared[0]), (1, shared[0]), (1, shared[0]), (2, shared[0] + " tail"), (3, "head" + shared[0]), (4, shared[1] + shared[2]), (5, shared[2].replace(" ", "")), (6, shared[2].replace(" ", "") + "!")]
    docs += [(7, "ab" * 30_000), (8, "ab" * 30_000 + " c"), (9, "\t\x0b\x0c\r\n" * 500), (10, shared[3][:777]), (11, shared[3][333:]), (12, shared[1] + "\n" + shared[0])]
    return docs + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(60)]


def test_ids_are_the_librarys(spark):
    docs = passages()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got_ids(bpe.encode(df, PATH)) == want_ids(docs)
    # A bitmap that takes nearly every chunk for a repeated one changes nothing.
    assert got_ids(bpe.encode(df, PATH, bits=4)) == want_ids(docs)


def test_digests_and_decoding(spark):
    docs = passages()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = []
    for i, t in docs:
        ids = plain_ids(t)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(PLAIN.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode(df, PATH, finish=bpe.Digests(PATH)).collect())) == sorted(want)
    decoded = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert all(r["decoded"] == PLAIN.decode(np.frombuffer(bytes(r["ids"]), "<u4").tolist(), skip_special_tokens=False) for r in decoded)


def test_repeated_chunks_are_encoded_once(spark, monkeypatch):
    rng = random.Random(8)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(600))
    docs = [(i, f"{i} own words {passage} end {i}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    seen = {(r["a"], r["b"]) for r in bpe.repeated_chunks(df.select("text")).collect()}
    inner = {bpe.digest(c) for c in bpe._chunks(passage.encode(), np.frombuffer(passage.encode(), np.uint8))}
    found = {np.array([a, b], "<i8").tobytes() for a, b in seen}
    assert len(found) >= 3 and len(found & inner) >= len(found) - 3
    bits = bpe.bitmap(bpe.repeated_chunks(df.select("text")), 16)
    assert int(np.unpackbits(bits).sum()) <= len(found) and all(bits[(a & 65535) >> 3] >> (a & 7) & 1 for a, _ in seen)
    assert got_ids(bpe.encode(df, PATH)) == want_ids(docs)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300), st.lists(st.integers(0, 900), max_size=6))
def test_any_cut_is_repaired(text, places):
    raw = text.encode("utf-8")
    table = bpe._words(PATH, bpe.CACHE_WORDS)
    ends = sorted({min(p, len(raw)) for p in places} | {len(raw)})
    pieces = []
    for a, b in zip([0, *ends], ends):
        head, middle, tail, spaced = bpe.open_ends(raw[a:b])
        pieces.append((head, table.ids(middle), tail, spaced))
    assert np.frombuffer(bpe.join_pieces(iter(pieces), table), "<u4").tolist() == plain_ids(text)


def test_cuts_depend_on_content():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 60_000, np.uint8)
    a = bpe.cuts(data)
    b = [e - 777 for e in bpe.cuts(np.concatenate([rng.integers(0, 256, 777, np.uint8), data]))]
    assert a[-1] == len(data) and len(set(a) & set(b)) > 0.9 * len(a)
    assert max(np.diff([0, *a])) <= bpe.MOST and bpe.cuts(np.zeros(100_000, np.uint8))[-1] == 100_000
    assert bpe.cuts(np.zeros(0, np.uint8)) == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_a_tokenizer_that_keeps_white_space_encodes_whole_texts(spark, name):
    path = public_tokenizers.path(name)
    other = Tokenizer.from_file(path)
    docs = [(1, "a  b\n c" * 200), (2, "a  b\n c" * 200), (3, " lead")]
    got = got_ids(bpe.encode(spark.createDataFrame(docs, "doc_id long, text string"), path))
    assert got == [(i, other.encode(t, add_special_tokens=False).ids) for i, t in docs]


def test_edges(spark):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs(spark).collect()]
    extra = {"ids": 1, "kind": "x", "whole": "y", "head": 2}
    assert got_ids(bpe.encode(edge_docs(spark, extra), PATH)) == want_ids(rows)
    assert bpe.encode(no_docs(spark), PATH).count() == 0
    assert bpe.decode(bpe.encode(no_docs(spark), PATH), PATH).columns == ["doc_id", "ids", "decoded"]
