"""How the sources of a language diverge: which use other words, and which words make them stand out.

Each task counts its terms into byte tries, one a language, whose leaves hold a counter for each source: occurrences and
documents. A trie is kept flat, as a walk of it would meet its leaves: their paths in the order of bytes, the depth at which
each leaves the path before it, and their counters in one run of numbers, so that tries are built, merged and walked by
whole columns. A trie that is full is emitted, leaf by leaf, and a new one begun. Leaves are dealt by ranges of language and
path, so that all that share a prefix meet, and each range merges them into one trie a language. A term that is common
everywhere arrives once from each task, with a counter a source, not once an occurrence. Terms in enough documents of the
language are kept, and sums over them give each source's smoothed shares. Then each range is walked in the order of UTF-8, a
run of leaves at a time: the walk adds up the differences of every two sources, and as it meets equal values in the order of
terms, the first ten of them are the candidates that ties call for. Spark adds the ranges' sums and ranks.

Sources are told apart by a hash of 64 bits of their names on the way.

Defined cases: null text, language and source are empty; a group without terms takes part with counts of zero; a language
without kept terms gives pairs of value 0; repeated rows are documents of their own; an empty table gives an empty result;
columns of the input other than the named ones are not read. The sources of one language must fit in a matrix of their
pairs, which are as many as the result's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_task, hold, small_batches, text_chunks, write_table

#: Fixed values of the contract.
LEAST_DOCS = 10
SCALE = 1_000_000_000
SMOOTH = 2
RANKS = 10
#: Counters that a task gathers before it emits its tries, how many of these may stand unmerged, and leaves of a range.
FULL = 1_000_000
LOOSE = 1_500_000
RANGE_ROWS = 250_000
#: Numbers of a block of terms by sources.
BLOCK = 1 << 20

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_letter = np.zeros(256, bool)
_letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_COUNTER = np.dtype([("source", "<i8"), ("n", "<i8"), ("docs", "<i8")])


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of large binaries."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Terms (runs of letters and of bytes beyond ASCII, A to Z lower-cased) of texts that lie one after the other, and the text of each."""
    word = np.append(_letter[data], False)
    before = np.append(False, word[:-1])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(word & (~before | edge))
    end = np.flatnonzero(before & (~word | edge))
    return _binary(_fold[data[word[:-1]]], end - start), np.searchsorted(offsets, start, "right") - 1


class Trie:
    """A radix trie over bytes with counters of several columns at its leaves, kept flat: paths (distinct, in the order of a walk),
    first (where each leaf's counters begin) and counters, in the order of their source."""

    def __init__(self, paths: pa.Array, first: np.ndarray, counters: np.ndarray):
        self.paths, self.first, self.counters = paths, first, counters

    @classmethod
    def of(cls, paths: pa.Array, counters: np.ndarray) -> Trie:
        """From one path a counter; counters of equal path and source are added."""
        if not len(paths):
            return cls(pa.array([], pa.large_binary()), np.zeros(1, np.int64), counters[:0])
        coded = paths.dictionary_encode()
        words = coded.dictionary
        order = pc.sort_indices(words).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sources = pa.array(np.ascontiguousarray(counters["source"])).dictionary_encode()
        rank = np.argsort(np.argsort(sources.dictionary.to_numpy()))
        # One number for leaf and source: there are fewer than 2 ** 31 of either in a task.
        key = place[coded.indices.to_numpy()] * len(rank) + rank[sources.indices.to_numpy()]
        by = np.argsort(key)
        key, held = key[by], counters[by]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        leaf = key // len(rank)
        out = held[new]
        for name in ("n", "docs"):
            out[name] = np.add.reduceat(held[name], new)
        return cls(words.take(pa.array(order)), np.append(np.flatnonzero(np.append(True, np.diff(leaf[new]) > 0)), len(new)), out)

    def spread(self) -> pa.Array:
        """The path of each counter."""
        return self.paths.take(pa.array(np.repeat(np.arange(len(self.paths)), np.diff(self.first))))

    @classmethod
    def merged(cls, tries: list[Trie]) -> Trie:
        if len(tries) == 1:
            return tries[0]
        return cls.of(pa.concat_arrays([t.spread() for t in tries]), np.concatenate([t.counters for t in tries]))

    def depths(self) -> np.ndarray:
        """Of each leaf the bytes that its path shares with the one before it: where its branch leaves that one's."""
        data, offsets = _bytes_of(self.paths)
        n = len(self.paths)
        out = np.zeros(n, np.int64)
        alive = np.arange(1, n)
        length = np.diff(offsets)
        depth = 0
        while len(alive):
            alive = alive[(length[alive] > depth) & (length[alive - 1] > depth)]
            alive = alive[data[offsets[alive] + depth] == data[offsets[alive - 1] + depth]]
            depth += 1
            out[alive] = depth
        return out

    def sums(self, name: str) -> np.ndarray:
        return np.add.reduceat(self.counters[name], self.first[:-1]) if len(self.paths) else np.zeros(0, np.int64)

    def kept(self, keep: np.ndarray) -> Trie:
        """The trie of some leaves."""
        size = np.diff(self.first)
        return Trie(self.paths.filter(pa.array(keep)), np.append(0, np.cumsum(size[keep])), self.counters[np.repeat(keep, size)])

    def runs(self, most: int) -> Iterator[tuple[int, int]]:
        """Places of runs of about `most` leaves that end where a walk is back near the root: of the last leaves of a run that
        after which the next branch begins highest ends it."""
        depth, n, at = self.depths(), len(self.paths), 0
        while at < n:
            end = min(n, at + most)
            if end < n and most > 8:
                back = max(at + 1, end - most // 4)
                end = back + int(np.argmin(depth[back : end + 1]))
            yield at, end
            at = end


def _named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _emitted(lang: str, trie: Trie, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Leaves as rows: a counter is three numbers of 64 bits."""
    width = _COUNTER.itemsize
    for a in range(0, len(trie.paths), size):
        b = min(len(trie.paths), a + size)
        first = trie.first[a : b + 1]
        packed = _binary(trie.counters[first[0] : first[-1]].view(np.uint8), np.diff(first) * width)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * (b - a), pa.string()), trie.paths.slice(a, b - a).cast(pa.binary()), packed.cast(pa.binary())], names=["lang", "term", "counters"])


def _leaves(terms: pa.Array, counters: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """A path a counter, and the counters, of rows as _emitted gives them."""
    data, offsets = _bytes_of(counters.cast(pa.large_binary()))
    each = np.diff(offsets) // _COUNTER.itemsize
    held = np.ascontiguousarray(data[offsets[0] : offsets[-1]]).view(_COUNTER)
    return terms.cast(pa.large_binary()).take(pa.array(np.repeat(np.arange(len(terms)), each))), held


def count_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, term (bytes), counters (source's hash, occurrences and documents): leaves of the tasks' tries; a term may come from several tasks."""
    small_batches(docs.sparkSession)

    @arrow_task("divergence")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loose: dict[str, list[Trie]] = {}
        held = 0

        def merge() -> int:
            for lang, tries in loose.items():
                loose[lang] = [Trie.merged(tries)]
            return sum(len(t[0].counters) for t in loose.values())

        for batch in batches:
            langs, sources = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
            names, lang_of = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for first, end, data, offsets in text_chunks(batch.column(0)):
                terms, text = terms_of(data, offsets)
                if not len(terms):
                    continue
                coded = terms.dictionary_encode()
                v = len(coded.dictionary)
                # Occurrences by text and term; a text's terms are counted once as documents.
                pair, n = np.unique(text * v + coded.indices.to_numpy(), return_counts=True)
                of, term = pair // v + first, pair % v
                for k in np.unique(lang_of[first:end]).tolist():
                    mine = lang_of[of] == k
                    if not mine.any():
                        continue
                    counters = np.empty(int(mine.sum()), _COUNTER)
                    counters["source"], counters["n"], counters["docs"] = sources[of[mine]], n[mine], 1
                    trie = Trie.of(coded.dictionary.take(pa.array(term[mine])), counters)
                    loose.setdefault(names[k], []).append(trie)
                    held += len(trie.counters)
                if held > LOOSE:
                    held = merge()
                    if held > FULL:
                        for lang, tries in loose.items():
                            yield from _emitted(lang, tries[0])
                        loose.clear()
                        held = 0
        merge()
        for lang, tries in loose.items():
            yield from _emitted(lang, tries[0])

    picked = docs.select(F.col(text_col).cast("string").alias("text"), _named(lang_col).alias("lang"), F.xxhash64(_named(source_col)).alias("source"))
    return picked.mapInArrow(run, "lang string, term binary, counters binary")


def kept_terms(leaves: DataFrame, least_docs: int = LEAST_DOCS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """range, lang, term, counters of terms in at least so many documents of the language, with their occurrences n and the range
    that merged them. leaves is a written table."""
    ranges = max(1, -(-leaves.count() // range_rows))

    @arrow_task("divergence")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            for k, lang in enumerate(coded.dictionary.to_pylist()):
                mine = pc.equal(coded.indices, k)
                found.setdefault(lang, []).append(_leaves(batch.column(1).filter(mine), batch.column(2).filter(mine)))
        for lang, parts in found.items():
            trie = Trie.of(pa.concat_arrays([p for p, _ in parts]), np.concatenate([c for _, c in parts]))
            yield from _emitted(lang, trie.kept(trie.sums("docs") >= least_docs))

    dealt = leaves.repartitionByRange(ranges, "lang", "term")
    merged = dealt.mapInArrow(run, "lang string, term binary, counters binary").withColumn("range", F.spark_partition_id())
    return write_table(merged, "kept-terms", compression="zstd")


def source_counts(kept: DataFrame) -> DataFrame:
    """lang, source (hash), n of each range's kept terms, and lang, terms and n of each language: counters are added up by tasks first."""

    @arrow_task("divergence")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            for k, lang in enumerate(coded.dictionary.to_pylist()):
                mine = pc.equal(coded.indices, k)
                terms = batch.column(1).filter(mine)
                _, counters = _leaves(terms, batch.column(2).filter(mine))
                sources, at = np.unique(counters["source"], return_inverse=True)
                n = np.zeros(len(sources), np.int64)
                np.add.at(n, at, counters["n"])
                size = len(sources)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.string()), pa.array(sources), pa.array(n), pa.array([len(terms)] + [0] * (size - 1), pa.int64())], names=["lang", "sid", "n", "terms"])

    return kept.select("lang", "term", "counters").mapInArrow(run, "lang string, sid long, n long, terms long")


def _shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / total), exact at any size."""
    if counts.size and (int(counts.max()) + SMOOTH) * SCALE >= 1 << 63:
        return ((counts.astype(object) + SMOOTH) * SCALE // np.asarray(total, object) + 1).astype(np.int64)
    return (counts + SMOOTH) * SCALE // total + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A share is at most SCALE + 1, so its square stays below 2 ** 63."""
    d = p - q
    return d * d // (p + q)


def _walker(ranks: int, block: int):
    def run(key: tuple, kept: pa.Table, totals: pa.Table) -> pa.Table:
        hold("divergence")
        known: dict[str, list[tuple]] = {}
        for lang, source, sid, n, lang_n, terms in zip(*[totals.column(c).to_pylist() for c in ("lang", "source", "sid", "group_n", "lang_n", "terms")]):
            known.setdefault(lang, []).append((source, sid, n, lang_n, terms))
        coded = kept.column("lang").combine_chunks().dictionary_encode()
        terms_of_all, counters_of_all = (kept.column(c).combine_chunks() for c in ("term", "counters"))
        columns: list[list] = [[] for _ in range(5)]

        def add(lang: str, source: str, part: str, items: list, values: list) -> None:
            for column, values_of in zip(columns, ([lang] * len(items), [source] * len(items), [part] * len(items), items, values)):
                column += values_of

        for k, lang in enumerate(coded.dictionary.to_pylist()):
            mine = pc.equal(coded.indices, k)
            trie = Trie.of(*_leaves(terms_of_all.filter(mine), counters_of_all.filter(mine)))
            groups = sorted(known[lang])
            sids = np.array([g[1] for g in groups], np.int64)
            order = np.argsort(sids)
            column = order[np.searchsorted(sids[order], trie.counters["source"])]
            whole = np.array([g[2] + SMOOTH * g[4] for g in groups], np.int64)
            lang_whole = groups[0][3] + SMOOTH * groups[0][4]
            sums = np.zeros((len(groups), len(groups)), np.int64)
            row = np.repeat(np.arange(len(trie.paths)), np.diff(trie.first))
            for at, end in trie.runs(max(1, block // len(groups))):
                counts = np.zeros((end - at, len(groups)), np.int64)
                own = slice(trie.first[at], trie.first[end])
                counts[row[own] - at, column[own]] = trie.counters["n"][own]
                p = _shares(counts, whole)
                q = _shares(counts.sum(axis=1), lang_whole)
                for g, group in enumerate(groups):
                    sums[g] += _apart(p[:, g : g + 1], p).sum(axis=0)
                    above = np.flatnonzero((counts[:, g] > 0) & (p[:, g] > q))
                    value = _apart(p[above, g], q[above])
                    best = np.argsort(-value, kind="stable")[:ranks]
                    items = trie.paths.take(pa.array(at + above[best])).to_pylist()
                    add(lang, group[0], "term", [t.decode("utf-8", "replace") for t in items], value[best].tolist())
            for g, group in enumerate(groups):
                others = [j for j in range(len(groups)) if j != g]
                add(lang, group[0], "pair", [groups[j][0] for j in others], sums[g, others].tolist())
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(),) * 4 + (pa.int64(),))], names=["lang", "source", "part", "item", "value"])

    return run


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, ranks: int = RANKS, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """lang, source, part, item, value, rank: `pair` rows for each other source of the language, `term` rows for the terms that
    a source uses more than the language does."""
    groups = write_table(docs.select(_named(lang_col).alias("lang"), _named(source_col).alias("source")).distinct().withColumn("sid", F.xxhash64("source")), "groups")
    leaves = write_table(count_terms(docs, text_col, lang_col, source_col), "leaves", compression="zstd")
    kept = kept_terms(leaves, least_docs, range_rows)
    counts = write_table(source_counts(kept), "source-counts")
    by_group = counts.groupBy("lang", "sid").agg(F.sum("n").alias("group_n"))
    by_lang = counts.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("terms").alias("terms"))
    totals = groups.join(by_group, ["lang", "sid"], "left").fillna(0, ["group_n"]).join(by_lang, "lang")
    told = kept.select("range", "lang").distinct().join(totals, "lang").select("range", "lang", "source", "sid", "group_n", "lang_n", "terms")
    told = told.toDF(*told.columns)  # columns of their own, as both sides come from the kept terms
    walked = kept.groupBy("range").cogroup(told.groupBy("range")).applyInArrow(_walker(ranks, BLOCK), "lang string, source string, part string, item string, value long")
    walked = write_table(walked, "walked")
    others = groups.alias("g").join(groups.alias("o"), (F.col("g.lang") == F.col("o.lang")) & (F.col("g.source") != F.col("o.source"))).select("g.lang", "g.source", F.lit("pair").alias("part"), F.col("o.source").alias("item"))
    sums = walked.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = others.join(sums, ["lang", "source", "part", "item"], "left").fillna(0, ["value"])
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").asc())
    every = pairs.unionByName(walked.filter("part = 'term'")).withColumn("rank", F.row_number().over(order))
    return every.filter((F.col("part") == "pair") | (F.col("rank") <= ranks)).select("lang", "source", "part", "item", "value", "rank")
