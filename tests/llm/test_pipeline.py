"""Each stage against what it promises, and the registered queries against their SQL."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from shelfmark.llm import mixing
from shelfmark.llm.queries import ORACLES, QUERIES

from ..test_queries import rows_of, tables  # noqa: F401
from .fixtures import edge_docs, no_docs
from .test_jaccard import brute
from .test_mixing import targets


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, tables):  # noqa: F811
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    assert got
    if name in ORACLES:
        want = tables.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert rows_of(df.columns, got) == rows_of(want.columns, want.fetchall())


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_one_document_of_each_group_stays(spark, sf_dir):
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base[: 50 + i % 9]), "a") for i in range(20)] + [(100 + i, f"quite other text number {i} of its own kind", "b") for i in range(5)]
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs(spark, rows), sf_dir).collect()}
    want = {c for _, _, c, _ in brute([(i, t) for i, t, _ in rows], 5, 8, 10)}
    assert got == want


def test_mixture_repeats_documents(spark, sf_dir):
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 4 == 0]) for i in range(200)]
    df = docs(spark, rows)
    got = Counter(r["doc_id"] for r in corpus_pipeline.mixture(spark, df, sf_dir).collect())
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(df).collect()}
    assert got == Counter({k: v for k, v in want.items() if v})
    words = defaultdict(int)
    for i, n in got.items():
        words[rows[i][2]] += n * (1 + i % 5)
    goal = targets([(s, sum(1 + i % 5 for i, _, x in rows if x == s)) for s in "ab"])
    assert all(abs(words[s] - goal[s]) <= 5 for s in "ab")


def test_stages_keep_columns_and_take_edges(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near-duplicates", "mixture", "packing"]
    for frame in (edge_docs(spark), no_docs(spark)):
        out = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, sf_dir)
            if name != "packing":
                assert out.columns == list(corpus_pipeline.COLUMNS) and out.dtypes == frame.dtypes
            out = spark.createDataFrame(out.collect(), out.schema)
    assert "sequence_id" in out.columns


def test_clean_documents_stay(spark, sf_dir):
    all_docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = corpus_pipeline.language(spark, all_docs, sf_dir)
    assert kept.count() >= 0.99 * all_docs.count()
    clean = labels.filter("toxic = 0").select("doc_id")
    after = corpus_pipeline.toxic(spark, all_docs, sf_dir)
    assert after.join(clean, "doc_id", "left_semi").count() >= 0.97 * all_docs.join(clean, "doc_id", "left_semi").count()


def test_rows_that_share_an_id_lose_no_text(spark, sf_dir):
    rows = [(1, "first text of this very id with words", "b"), (1, "first text of this very id with words", "a"), (1, "another text altogether under the same id", "a")]
    rows += [(None, "nameless words that repeat again and again", "a")] * 2 + [(None, None, "a"), (2, None, None), (2, None, None)]
    got = corpus_pipeline.near_duplicates(spark, docs(spark, [(i, t, s) for i, t, s in rows if t]).unionByName(spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows if not t], "doc_id long, text string, lang string, source string, n_chars long")), sf_dir)
    assert sorted(((r["doc_id"], r["text"], r["source"]) for r in got.collect()), key=str) == sorted(
        [(1, rows[0][1], "a"), (1, rows[2][1], "a"), (None, rows[3][1], "a"), (None, None, "a"), (2, None, None)], key=str
    )
