"""Looks of one item across sources: order-stable clusters of its pictures, by vectors or by hashes, and what they tell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The cosine from which two pictures show one look, the bits by which two hashes of one may differ, and the
#: sources that it takes to say anything.
COSINE, BITS, SOURCES = 0.76, 10, 3


class _Vectors:
    """Leaders as rows of a matrix. A vector of zeros, or one that holds no numbers, is near to nothing."""

    def __init__(self, least: float):
        self.least, self.rows = least, np.zeros((0, 0))

    def place(self, value: list[float]) -> int:
        v = np.array([np.nan if x is None else x for x in value], float)
        norm = np.sqrt(v @ v) if len(v) and np.isfinite(v).all() else 0.0
        if norm and self.rows.shape[1] == len(v) and len(self.rows):
            near = self.rows @ (v / norm)
            best = int(np.argmax(near))
            if near[best] >= self.least:
                return best
        if self.rows.shape[1] != len(v):
            if len(self.rows):
                raise ValueError("an item's vectors must have one length")
            self.rows = np.zeros((0, len(v)))
        self.rows = np.vstack([self.rows, v / norm if norm else np.zeros(len(v))])
        return len(self.rows) - 1


class _Hashes:
    def __init__(self, most: int):
        self.most, self.held = most, np.zeros(0, np.uint64)

    def place(self, value: int) -> int:
        h = np.uint64(value & (1 << 64) - 1)
        if len(self.held):
            apart = np.bitwise_count(self.held ^ h)
            best = int(np.argmin(apart))
            if apart[best] <= self.most:
                return best
        self.held = np.append(self.held, h)
        return len(self.held) - 1


def greedy_clusters(rows: DataFrame, item: str, order: str, value: str, hashes: bool = False, least: float = COSINE, most: int = BITS) -> DataFrame:
    """Adds cluster (from 0, an item's own) to item and order: in the order of `order` a picture joins the nearest leader that is
    near enough, the first of equally near ones, or leads a cluster of its own. Rows without a value take no part.

    The outcome depends on the order, so an item's pictures are walked one after the other; rows come sorted and only the
    leaders are held, so an item of very many pictures takes time and no memory."""
    names = (item, order, "cluster")
    kept = rows.filter(F.col(value).isNotNull() & F.col(item).isNotNull()).select(item, order, value)
    kinds = dict(kept.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leaders = None, None
        for batch in batches:
            found = []
            for key, v in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if leaders is None or key != now:
                    now, leaders = key, _Hashes(most) if hashes else _Vectors(least)
                found.append(leaders.place(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int32())], names=list(names))

    return kept.repartition(item).sortWithinPartitions(item, order, value).mapInArrow(run, f"`{item}` {kinds[item]}, `{order}` {kinds[order]}, cluster int")


def divergence(rows: DataFrame, item: str, cluster: str, source: str, hashes: bool = False, sources: int = SOURCES) -> DataFrame:
    """item, cluster, rank, n_clusters, n_sources (of the cluster), total_sources, share, verdict. Looks are ranked by how many
    sources show them, which tells what the trade runs, and then by their number.

    One look is `aligned`; several by vectors are `divergent`, and by hashes only `divergent_unconfirmed`, as one pack in
    another picture hashes apart too. An item of fewer sources says nothing: one row `insufficient_data` without a look."""
    per = rows.groupBy(item, cluster).agg(F.count_distinct(source).alias("n_sources"))
    whole = rows.groupBy(item).agg(F.count_distinct(source).alias("total_sources"), F.count_distinct(cluster).alias("n_clusters"))
    told = whole.filter(F.col("total_sources") >= sources)
    place = F.row_number().over(Window.partitionBy(item).orderBy(F.col("n_sources").desc(), F.col(cluster).cast("string"))) - 1
    verdict = F.when(F.col("n_clusters") == 1, "aligned").otherwise("divergent_unconfirmed" if hashes else "divergent")
    looks = per.join(told, item).select(item, cluster, place.alias("rank"), "n_clusters", "n_sources", "total_sources", F.round(F.col("n_sources") / F.col("total_sources"), 3).alias("share"), verdict.alias("verdict"))
    none = lambda kind: F.lit(None).cast(kind)
    few = whole.filter(F.col("total_sources") < sources).select(
        item, none("int").alias(cluster), none("int").alias("rank"), none("long").alias("n_clusters"), F.col("total_sources").alias("n_sources"), "total_sources", none("double").alias("share"), F.lit("insufficient_data").alias("verdict")
    )
    return looks.unionByName(few)


def sign_hash(vector: Column, bits: int = 64) -> Column:
    """A hash of a vector's first components' signs, as a long."""
    text = F.array_join(F.transform(F.slice(vector, 1, bits), lambda x: F.when(x > 0, "1").otherwise("0")), "")
    return F.conv(text, 2, -10).cast("long")
