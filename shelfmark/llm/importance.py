"""Importance resampling towards a target: hashed n-grams counted by DuckDB in each partition, merged and scored by Spark.

A task hands its texts, batch by batch, to a DuckDB of its own: SQL splits them into words, unnests them, forms n-grams by
a window over each text, and a registered function gives each n-gram's CRC. The buckets of each text and the partition's
count of each bucket are spilled to Parquet in the shared folder. Spark merges the counts of the corpus and of the target,
of which there are as many as buckets, gets from them a gain for each bucket, and adds up the gains of a text's n-grams
from the spilled buckets, so texts are read once. A hash of the id gives each document its Gumbel noise; the documents with
the highest sums are drawn without replacement. Ranks are counted within ranges of scores and on from range to range.

Defined cases: a null text has no words; words are parted at all ASCII characters but letters and digits; a null id counts
as the empty text in the noise and comes first of equal scores; rows that repeat take ranks of their own; an empty corpus
gives an empty result and an empty target has counts of zero; texts beyond PIECE_BYTES go to SQL in pieces that end where
words do, with the next words beside them; columns of the input other than the two that are named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_task, small_batches, text_chunks, write_table

#: Fixed values of the contract.
BUCKETS = 10_000
ORDER = 3
LEAST_WORDS = 20
#: Bytes of a text that SQL takes at a time, and memory of a task's DuckDB.
PIECE_BYTES = 1 << 20
DUCKDB_MEMORY = "600MB"
#: Rows that one list is unrolled to at a time, where rows repeat.
UNROLL = 4096

_PARTED = rb"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_GAP = re.compile(b"[" + _PARTED + b"]")
_WORD = re.compile(b"[^" + _PARTED + b"]+")


def _crc32(column) -> pa.Array:
    """zlib's CRC of the UTF-8 bytes of each string."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = bytes(column.buffers()[2] or b"")
    crc = zlib.crc32
    return pa.array([crc(data[a:b]) for a, b in zip(offsets, offsets[1:])], pa.int64())


def _sql(order: int, buckets: int) -> str:
    """A row a word: the text's place and the buckets of the n-grams that begin there, null beyond the text's end."""
    grams, gram = [], "w"
    for n in range(1, order + 1):
        grams.append(f"coalesce(crc32({gram}) % {buckets}, -1)::INTEGER AS b{n}")
        gram += f" || ' ' || lead(w, {n}) OVER p"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(column: str) -> str:
        return rf"regexp_split_to_array(translate({column}, '{upper}', '{lower}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

    return f"""
        WITH lists AS (SELECT i, {words("own")} AS own, {words("ahead")} AS ahead FROM pieces),
        every AS (SELECT i, len(own) AS mine, unnest(own || ahead) AS w, generate_subscripts(own || ahead, 1) AS k FROM lists),
        grams AS (SELECT i, k <= mine AS begins, {", ".join(grams)} FROM every WHERE w <> '' WINDOW p AS (PARTITION BY i ORDER BY k))
        SELECT i, {", ".join(f"b{n}" for n in range(1, order + 1))} FROM grams WHERE begins
    """


def _pieces(text: bytes, order: int) -> list[tuple[str, str]]:
    """The text, or runs of about PIECE_BYTES that end where words do, each with the words that follow it."""
    out, at = [], 0
    while len(text) - at > PIECE_BYTES:
        gap = _GAP.search(text, at + PIECE_BYTES)
        if gap is None:
            break
        ahead = [m.group() for m, _ in zip(_WORD.finditer(text, gap.end()), range(order - 1))]
        out.append((text[at : gap.end()].decode("utf-8", "replace"), b" ".join(ahead).decode("utf-8", "replace")))
        at = gap.end()
    out.append((text[at:].decode("utf-8", "replace"), ""))
    return out


def _batches(column: pa.Array, order: int) -> Iterator[tuple[int, list[int], list[tuple[str, str]]]]:
    """(first row, texts' places, pieces) of about PIECE_BYTES; all pieces of a text are in one."""
    for first, end, data, offsets in text_chunks(column, PIECE_BYTES):
        raw = data.tobytes()
        places, pieces = [], []
        for k, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
            cut = _pieces(raw[a:b], order)
            places += [k] * len(cut)
            pieces += cut
        yield first, places, pieces


def bucketed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """Written: a row a document (doc_id, n_words, n_features, buckets: little-endian 16-bit numbers, one a feature) and rows
    of the partitions' counts (bucket, n), the other columns null."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be from 1 to 65536")
    small_batches(docs.sparkSession)

    @arrow_task("importance")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        total = np.zeros(buckets, np.int64)
        with duckdb.connect(":memory:", config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""}) as con:
            con.create_function("crc32", _crc32, ["VARCHAR"], "BIGINT", type="arrow")
            for batch in batches:
                for first, places, pieces in _batches(batch.column(1), order):
                    rows = places[-1] + 1
                    parts: list[list[tuple[np.ndarray, np.ndarray]]] = []
                    # A long text's pieces are queried one after the other, so that SQL holds one of them.
                    at = 0
                    while at < len(pieces):
                        end, size = at, 0
                        while end < len(pieces) and (end == at or size + len(pieces[end][0]) <= PIECE_BYTES):
                            size += len(pieces[end][0])
                            end += 1
                        table = pa.table({"i": pa.array(range(at, end), pa.int64()), "own": pa.array([p[0] for p in pieces[at:end]], pa.string()), "ahead": pa.array([p[1] for p in pieces[at:end]], pa.string())})
                        con.register("pieces", table)
                        found = con.execute(_sql(order, buckets)).fetchnumpy()
                        con.unregister("pieces")
                        parts.append([(np.asarray(found["i"]), np.asarray(found[f"b{n}"])) for n in range(1, order + 1)])
                        at = end
                    place = np.array(places, np.int64)
                    owner = place[np.concatenate([i for p in parts for i, _ in p])]
                    bucket = np.concatenate([b for p in parts for _, b in p])
                    words = np.bincount(place[np.concatenate([p[0][0] for p in parts])], minlength=rows)
                    owner, bucket = owner[bucket >= 0], bucket[bucket >= 0]
                    packed = bucket[np.argsort(owner, kind="stable")].astype("<u2")
                    features = np.bincount(owner, minlength=rows)
                    total += np.bincount(bucket, minlength=buckets)
                    ends = np.append(0, np.cumsum(2 * features)).astype(np.int64)
                    lists = pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(packed.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, rows), pa.array(words, pa.int64()), pa.array(features, pa.int64()), lists, pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64())], names=names
                    )
                kind_of = batch.column(0).type
        seen = np.flatnonzero(total)
        if len(seen):
            none = pa.nulls(len(seen), kind_of)
            yield pa.RecordBatch.from_arrays([none, pa.nulls(len(seen), pa.int64()), pa.nulls(len(seen), pa.int64()), pa.nulls(len(seen), pa.binary()), pa.array(seen, pa.int32()), pa.array(total[seen])], names=names)

    names = ["doc_id", "n_words", "n_features", "buckets", "bucket", "n"]
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return write_table(picked.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, buckets binary, bucket int, n long"), "buckets", compression="zstd")


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, s, t, gain of every bucket: the logarithm of the ratio of smoothed shares, in thousandths."""
    spark = corpus.sparkSession

    def counted(table: DataFrame, name: str) -> DataFrame:
        return table.filter("bucket is not null").groupBy("bucket").agg(F.sum("n").alias(name))

    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    merged = every.join(counted(corpus, "s"), "bucket", "left").join(counted(target, "t"), "bucket", "left").fillna(0, ["s", "t"])
    # One partition of as many rows as buckets: the sums stand beside each row.
    whole = Window.partitionBy(F.lit(0))
    s, t = (F.col(c).cast("double") for c in "st")
    total_s, total_t = (F.sum(c).over(whole).cast("double") for c in "st")
    ratio = (t + 1) * (total_s + float(buckets)) / ((s + 1) * (total_t + float(buckets)))
    return merged.withColumn("gain", F.floor(1000.0 * F.log(ratio)).cast("long"))


def noise(id_col: str = "doc_id", seed: str = "42"):
    """Gumbel noise of the id, in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(spilled: DataFrame, gain: DataFrame) -> DataFrame:
    """doc_id, n_words, n_features, weight of each document. The gains, one number a bucket, go to the workers."""
    rows = gain.select("bucket", "gain").collect()
    table = np.zeros(len(rows), np.int64)
    table[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    sent = spilled.sparkSession.sparkContext.broadcast(table)

    @arrow_task("importance")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = sent.value
        for batch in batches:
            sums = [int(each[np.frombuffer(b, "<u2")].sum()) for b in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    small_batches(spilled.sparkSession)
    kind = spilled.schema["doc_id"].dataType.simpleString()
    docs = spilled.filter("n_features is not null").select("doc_id", "n_words", "n_features", "buckets")
    return docs.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, share: tuple[int, int] = (5, 100), least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds rank: 1, 2, 3... of the floor(share * N) highest scores of the N documents with enough words; null for all others.

    Equal rows are counted first, so no range holds more than its share; a range's rows are numbered from where the ranges
    before it end."""
    scored = write_table(scored, "scored")
    fit = scored.filter(F.col("n_words") >= least_words)
    names = scored.columns
    by = [F.col("score").desc(), F.col("doc_id").asc(), *[F.col(c).asc() for c in names if c not in ("score", "doc_id")]]
    ranged = fit.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies")).repartitionByRange(*by).withColumn("_part", F.spark_partition_id())
    ranged = write_table(ranged, "score-ranges")
    before, offsets = 0, {}
    for r in ranged.groupBy("_part").agg(F.sum("_copies").alias("n")).orderBy("_part").collect():  # as many rows as ranges
        offsets[r["_part"]], before = before, before + r["n"]
    drawn = share[0] * before // share[1]
    offset = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])[F.col("_part")] if offsets else F.lit(0)
    upto = F.sum("_copies").over(Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = ranged.withColumn("_first", offset + upto - F.col("_copies"))
    parts = placed.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {UNROLL}"))))
    each = parts.withColumn("_copy", F.explode(F.sequence(F.col("_run") * UNROLL, F.least(F.col("_run") * UNROLL + UNROLL, F.col("_copies")) - 1)))
    rank = F.col("_first") + F.col("_copy") + 1
    numbered = each.withColumn("rank", F.when(rank <= drawn, rank).cast("long")).select(*names, "rank")
    rest = scored.filter(~F.coalesce(F.col("n_words") >= least_words, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return numbered.unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", share: tuple[int, int] = (5, 100), seed: str = "42"
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document; the drawn ones have a rank."""
    spilled = bucketed(docs, id_col, text_col)
    wanted = bucketed(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")))
    scored = weighed(spilled, gains(spilled, wanted)).withColumn("score", F.col("weight") + noise("doc_id", seed))
    return ranked(scored, share)
