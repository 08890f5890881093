"""The corpus pipeline: language, toxicity, near-duplicates, mixture and packing, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the shared folder and
gives what it reads back to the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import jaccard, langid, mixing, packing, toxicity
from shelfmark.llm.common import read, write_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document stays if the language model gives its best language at least this share.
LANGUAGE_SCORE = 0.5
TOKENIZER = "word_bpe_49k.json"
#: Workers have run other stages before and keep some of their memory, so the last stage keeps fewer words.
CACHE_WORDS = 250_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and a language that the models tell apart stay; rejected are `und` and unsure ones."""
    told = langid.identify(docs, langid.train(docs))
    return told.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)).select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).filter(F.col("predicted") == 0).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are connected by links of five-word shingles and a similarity of 0.8 or more, that with the
    smallest id stays; documents without words stay. Ids name documents: where rows share an id that stays, each of
    their different texts stays once. Rows without an id stay, each of their texts once. Of rows that are equal in id
    and text that with the least other columns stays."""
    joined = jaccard.jaccard_join(docs, 5, 8, 10)
    kept = joined.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # Ids of kept documents grow with the corpus, so nothing here is broadcast by hand; texts move once.
    stay = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").unionByName(docs.select(*COLUMNS).filter(F.col("doc_id").isNull()))
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    once = stay.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("least"))
    return once.select("doc_id", "text", "least.*").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their targets: a document goes out as often as the mixture takes it, up to three times. Documents
    without words go out once; a null source is a source; no documents give none."""
    mixed = mixing.mix(docs, texts=True)
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1).cast("int")
    repeated = mixed.withColumn("_times", times).filter("_times > 0")
    return repeated.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences; a document that the mixture repeats is packed as often. A null or empty text is a piece
    of the end id alone, a null id is kept, and no documents give no pieces."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), cache_words=CACHE_WORDS)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near-duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packed),
]

#: No SQL has the language model, the string kernel or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
