"""Exact top-k search by the threshold algorithm over sorted lists of each dimension.

Vectors are integers: floor(scale * x). Every candidate lies in one block, which sorts its vectors in every dimension
once; the queries of a span stream through it, so a task holds one block and a batch of queries. Before that, a first
pass searches one pilot block of bounded size for every query: its k-th score is a floor that no result falls below.

For a query the lists are read from the end that its sign favours, a growing step at a time and those first whose
next entries lower the bound most: query weight times the drop in value. What turns up is scored in full. No unseen
vector can score more than the query times the values at the depths reached, so reading stops when that bound is
below the floor or the k-th score so far; at equality it goes on, as ties go to the smaller id. Blocks' results meet
in a window by query that keeps k rows a task before it shuffles.

How early reading stops is up to the vectors. Where some dimensions weigh more it stops after a few entries; where all
of many dimensions weigh alike, each vector stands near the top of some list and all of them are scored.

Of equal vectors only the k + 1 smallest ids can be among any query's k best, so the rest leave before blocks are
made, however many there are; a query of that vector still runs.

Defined cases: vectors that are null, empty or hold a null or non-finite component, or one whose integer overflows a
long, and rows without an id take no part; a pair whose score overflows a long is an error, never left out; vectors of different lengths do not meet; rows that repeat id and vector count once; a
candidate with the query's id is never its result; fewer candidates than k give fewer rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

#: Vectors of a block, of the pilot block, and queries that stream through a block in one task.
BLOCK = 8192
PILOT = 4096
QUERY_SPAN = 65_536
#: The first step is this share of a list, later ones grow by the factor.
FIRST_SHARE, GROWTH = 64, 4


def quantize(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, v (array of long) of the vectors that take part, without repeated rows."""
    v = F.transform(F.col(vec_col), lambda x: F.lit(scale) * x.cast("double"))
    fine = F.forall("w", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(2.0**63)), F.lit(False)))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("w"))
        .filter(F.col("vec_id").isNotNull() & (F.size("w") > 0) & fine)
        .select("vec_id", F.transform("w", lambda x: F.floor(x)).alias("v"))
        .distinct()
    )


class SortedBlock:
    """A block's vectors, each dimension's order, and the values in that order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.ints = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.ints, axis=0, kind="stable").T.astype(np.int32)  # ascending, one row a dimension
        self.values = np.take_along_axis(self.ints.T, self.order, 1)
        self.largest = int(np.abs(self.ints).max(initial=0))
        self.copies: dict[type, tuple[np.ndarray, np.ndarray]] = {}

    def _as(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and sorted values in a type of number."""
        if kind not in self.copies:
            self.copies[kind] = self.ints.astype(kind), self.values.astype(kind)
        return self.copies[kind]

    def search(self, query: np.ndarray, own_id: int, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Places and scores of the k best that reach the floor, entries read of all lists, and vectors scored."""
        n = len(self.ids)
        # Sums are exact in floats below 2 ** 24 and 2 ** 53, and in integers of any size beyond a long.
        most = self.largest * sum(map(abs, query.tolist()))
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
        data, values = self._as(kind)
        q = query.astype(kind)
        lists = np.flatnonzero(query)
        rising = query[lists] < 0  # such lists are read from their least value
        weight = np.abs(q[lists])
        depth = np.zeros(len(lists), np.int64)
        unseen = self.ids != own_id
        best, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        scored, step = 0, max(1, n // FIRST_SHARE)

        def at(places: np.ndarray) -> np.ndarray:
            """What the lists' entries at these depths add to a score."""
            places = np.minimum(places, n - 1)
            return q[lists] * values[lists, np.where(rising, places, n - 1 - places)]

        following = at(depth)
        while True:
            ahead = at(depth + step)
            gain = following - ahead
            chosen = np.flatnonzero(gain >= gain.mean()) if len(lists) else lists
            found = np.zeros(n, bool)
            for j in chosen.tolist():
                end = min(n, depth[j] + step)
                row = self.order[lists[j]]
                found[row[depth[j] : end] if rising[j] else row[n - end : n - depth[j]]] = True
                depth[j] = end
            following[chosen] = ahead[chosen]
            whole = not len(lists) or bool((depth == n).any())
            new = np.flatnonzero(unseen if whole else found & unseen)
            if len(new):
                unseen[new] = False
                scored += len(new)
                got = (data @ q)[new] if len(new) * 4 > n else data[new] @ q
                if most >= 1 << 63 and max(map(abs, got)) >= 1 << 63:
                    raise OverflowError(f"vector {own_id}: a score overflows a long")
                got = got.astype(np.int64)
                bar = max([*score[k - 1 : k].tolist(), *([] if floor is None else [floor])], default=None)
                if bar is not None:
                    near = got >= bar
                    new, got = new[near], got[near]
                best, score = np.append(best, new), np.append(score, got)
                if len(best) > 1:
                    top = np.lexsort((self.ids[best], -score))[:k]
                    best, score = best[top], score[top]
            if whole:
                break
            bound = int(following.sum(dtype=None if kind is object else np.float64))
            if (len(score) == k and score[-1] > bound) or (floor is not None and floor > bound):
                break
            step = min(n, step * GROWTH)
        return best, score, int(depth.sum()), scored


_FOUND = "query_id long, vec_id long, score long, entries long, scored long, candidates long"


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _stream(k: int):
    """Rows (b, vec_id, asks, v, floor), a block's candidates before the queries that stream through it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        block: SortedBlock | None = None
        current = None
        for batch in batches:
            key = batch.column(0).to_numpy()
            asks = batch.column(2).to_numpy(zero_copy_only=False)
            change = np.flatnonzero((key[1:] != key[:-1]) | (asks[1:] != asks[:-1])) + 1
            out: list[tuple] = []
            for a, e in zip([0, *change.tolist()], [*change.tolist(), len(key)]):
                if e == a:
                    continue
                if key[a] != current:
                    current, held, block = key[a], [], None
                ids, v = batch.column(1).slice(a, e - a).to_numpy(), _vectors(batch.column(3).slice(a, e - a))
                if not asks[a]:
                    held.append((ids, v))
                    continue
                if block is None and held:
                    block = SortedBlock(np.concatenate([i for i, _ in held]), np.concatenate([x for _, x in held]))
                    held = []
                if block is None:
                    continue
                for own, query, floor in zip(ids.tolist(), v, batch.column(4).slice(a, e - a).to_pylist()):
                    best, score, entries, scored = block.search(query, own, k, floor)
                    out += [(own, i, s, entries, scored, len(block.ids)) for i, s in zip(block.ids[best].tolist(), score.tolist())]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split(" ")[0] for f in _FOUND.split(", ")])

    return run


def _search(candidates: DataFrame, queries: DataFrame, k: int, tasks: int) -> DataFrame:
    """Candidates (b, vec_id, v) and queries (b, vec_id, v, floor) that meet in blocks b."""
    rows = candidates.select("b", "vec_id", F.lit(False).alias("asks"), "v", F.lit(None).cast("long").alias("floor")).unionByName(
        queries.select("b", "vec_id", F.lit(True).alias("asks"), "v", "floor")
    )
    return rows.repartition(tasks, "b").sortWithinPartitions("b", "asks").mapInArrow(_stream(k), _FOUND)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, span: int = QUERY_SPAN, pilot: int = PILOT, effort: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best. Both inputs as `quantize` makes them. With effort also, of
    the block in which a result was found: entries (read), scored and candidates."""
    w = Window.partitionBy("v").orderBy("vec_id")
    few = vectors.withColumn("copy", F.row_number().over(w)).filter(F.col("copy") <= k + 1).drop("copy")
    few = write_table(few.withColumn("n", F.size("v")), "topk-vectors")
    asks = write_table(queries.withColumn("n", F.size("v")), "topk-queries")
    lengths = {r["n"]: r["count"] for r in few.groupBy("n").count().orderBy(F.desc("count")).collect()}
    blocks = {n: max(1, -(-count // block)) for n, count in lengths.items()}
    spans = max(1, -(-asks.count() // span))
    if not lengths:
        return _ranked(asks.select(F.col("vec_id").alias("query_id"), "vec_id", *[F.lit(0).cast("long").alias(c) for c in ("score", "entries", "scored", "candidates")]).limit(0), k, effort)
    # Blocks of one length of vectors are numbered on; lengths are few, and rows of other lengths do not meet.
    first, total = {}, 0
    for n, count in blocks.items():
        first[n], total = total, total + count
    table = lambda d: F.create_map(*[F.lit(int(x)) for kv in d.items() for x in kv])[F.col("n")]
    mark = F.xxhash64("vec_id")
    lead = table({n: max(1, -(-count // pilot)) for n, count in lengths.items()})
    sample = few.filter(F.pmod(F.xxhash64("vec_id", F.lit(1)), lead) == 0)
    parts = few.sparkSession.sparkContext.defaultParallelism
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = table({n: i for i, n in enumerate(first)})
    # The pilot block goes to as many tasks as there are parts of the queries.
    piloted = _search(
        sample.withColumn("part", upto(parts)).select((F.col("part") * F.lit(len(first)) + place).cast("int").alias("b"), "vec_id", "v"),
        asks.select((F.pmod(mark, F.lit(parts)) * F.lit(len(first)) + place).cast("int").alias("b"), "vec_id", "v", F.lit(None).cast("long").alias("floor")),
        k,
        parts,
    )
    floors = piloted.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    floored = asks.distinct().join(floors, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "v", "n", "floor")
    number = (table(first) + F.pmod(mark, table(blocks))) * F.lit(spans)
    candidates = few.withColumn("_span", upto(spans)).select((number + F.col("_span")).cast("int").alias("b"), "vec_id", "v")
    met = floored.withColumn("_block", F.explode(F.sequence(table(first), table(first) + table(blocks) - 1)))
    streamed = met.select((F.col("_block") * F.lit(spans) + F.pmod(mark, F.lit(spans))).cast("int").alias("b"), "vec_id", "v", "floor")
    return _ranked(_search(candidates, streamed, k, total * spans), k, effort)


def _ranked(found: DataFrame, k: int, effort: bool) -> DataFrame:
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score", *(["entries", "scored", "candidates"] if effort else []))
