"""Rows that every operator must take."""

LONG = "Wort " * 30_000
EDGES = [
    (1, "The quick brown fox jumps over the lazy dog and runs away again.", "en", "a", 0),
    (2, "The quick brown fox jumps over the lazy dog and runs away again.", "en", "a", 0),
    (2, "The quick brown fox jumps over the lazy dog and runs away again.", "en", "a", 0),
    (3, None, None, None, None),
    (None, "no id here but words", "en", "b", 1),
    (None, None, None, None, None),
    (4, "", "en", "b", 2),
    (5, " \t\n ", None, "b", 2),
    (6, "12345 67890 !!! ...", "en", "é", 3),
    (7, LONG, "de", "é", 3),
    (8, "one two", "en", None, 3),
    (9, "Ünïcödé ‱   text 😀 <|im_end|> %3C %25", "fr", "a", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_docs(spark, extra: dict[str, object] | None = None):
    df = spark.createDataFrame(EDGES, SCHEMA)
    from pyspark.sql import functions as F

    for name, value in (extra or {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
