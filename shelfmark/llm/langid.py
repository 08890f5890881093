"""Language identification by prediction by partial matching with frozen statistics.

Each language has a tree of byte contexts of up to three bytes, with the counts of the bytes that followed. A text's
code length under a language is the sum over its bytes of the exact cost in the longest context that the tree holds:
a byte that followed there costs by its count, another pays the escape (method C: distinct followers against all)
and is looked up in the context shortened by a byte, down to a uniform choice of 256. There is no exclusion and no
updating, so a byte's cost depends on it and its three predecessors alone. The trees hold the contexts that were seen
and nothing else; a worker works out the cost of a run of four bytes when a text first has it, and from then on reads
one entry a byte and language. The language of the shortest code wins; the score is its share of 2^-length over all
languages.

The fit reads about SAMPLE_DOCS whole labelled documents a language at most, fewer if they make more than about
SAMPLE_BYTES, chosen by a hash of the id; their contexts are counted on the executors, and the driver takes the counts
of distinct runs: at most SAMPLE_BYTES a language, some ten thousand in prose. Scoring reads every whole text.

Defined cases: a null text, or one without a letter, is `und` with score 0; without labelled texts every document is
`und`; equal code lengths go to the language that sorts first; a null or held-out language, or one whose labelled texts
are all null or empty, is not learned; an empty
table gives an empty result; columns of the input are kept and, if they clash with the result's, replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_task, crc_fold, small_batches, text_chunks

SAMPLE_DOCS = 600
ORDER = 3
SAMPLE_BYTES = 4 << 20
#: Costs are stored in units of 1/1024 bit.
UNIT = 1024
_EMPTY = 65535
#: Cells of two bytes that a worker's tables keep, of all languages.
MOST_CELLS = 40_000_000
UNKNOWN = "und"
_START = b"\n" * ORDER

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32


def joined_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Case-folded texts, each after ORDER line ends; where each begins and ends."""
    raw = _fold[data].tobytes()
    parts = [raw[a:b] for a, b in zip(offsets, offsets[1:])]
    joined = np.frombuffer(_START + _START.join(parts) + _START, np.uint8)
    begin = offsets[:-1] + ORDER * (np.arange(len(parts)) + 1)
    return joined, begin, begin + np.diff(offsets)


def _grams(joined: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each byte of each text and the three before it."""
    code = joined.astype(np.int64)
    four = (code[:-3] << 24) | (code[1:-2] << 16) | (code[2:-1] << 8) | code[3:]
    inside = np.zeros(len(joined) + 1, np.int8)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end, -1)
    return four[np.cumsum(inside[:-1])[3:] > 0]


#: One order of a tree: contexts (sorted) and the bits of an escape from them; runs of a context and a byte that
#: followed it (sorted), and the bits of that byte.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class LanguageModel:
    """Trees of the contexts that were seen, of each language by order; nothing grows with the alphabet's powers but the
    numbers of runs. A worker tables the costs of what it meets, see code_lengths."""

    def __init__(self, languages: list[str], class_of: np.ndarray, trees: list[list[Tree]]):
        self.languages, self.class_of, self.trees = languages, class_of, trees
        self.size = int(class_of.max(initial=0)) + 1
        self._forget()

    def _forget(self) -> None:
        self._row_of: np.ndarray | None = None
        self._contexts = np.zeros(0, np.int64)
        self._kept: dict[int, np.ndarray] = {}

    def __getstate__(self) -> tuple:
        return self.languages, self.class_of, self.trees

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def bits(self, k: int, runs: np.ndarray) -> np.ndarray:
        """Cost under language k of the last class of each run of four."""
        out = np.zeros(len(runs))
        left = np.arange(len(runs))
        for order in range(ORDER, -1, -1):
            contexts, escape, followed, cost = self.trees[k][order]
            run = runs[left] % self.size ** (order + 1)
            at = np.minimum(np.searchsorted(followed, run), len(followed) - 1)
            hit = followed[at] == run
            out[left[hit]] += cost[at[hit]]
            left, context = left[~hit], run[~hit] // self.size
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            known = contexts[at] == context
            out[left[known]] += escape[at[known]]
        out[left] += 8.0
        return out

    def _costs(self, k: int, entry: np.ndarray) -> np.ndarray:
        """Units by entry (a context's row and a class); those that no text had before are worked out once."""
        table = self._kept.get(k, np.zeros(0, np.uint16))
        cells = len(self._contexts) * self.size
        if len(table) < cells:
            table = np.append(table, np.full(cells - len(table), _EMPTY, np.uint16))
        got = table[entry]
        missing = np.flatnonzero(got == _EMPTY)
        if len(missing):
            new = np.unique(entry[missing])
            runs = self._contexts[new // self.size] * self.size + new % self.size
            table[new] = np.minimum(np.rint(self.bits(k, runs) * UNIT), _EMPTY - 1).astype(np.uint16)
            got[missing] = table[entry[missing]]
        if cells * len(self.languages) <= MOST_CELLS:
            self._kept[k] = table
        return got

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) under each language. Tables of costs stay for the next call while they are small;
        beyond that one language's table is there at a time."""
        joined, begin, end = joined_bytes(data, offsets)
        c = self.class_of[joined].astype(np.int64)
        context = (c[:-3] * self.size + c[1:-2]) * self.size + c[2:-1]
        if self._row_of is None or len(self._contexts) * self.size * len(self.languages) > MOST_CELLS:
            self._forget()
            self._row_of = np.full(self.size**3, -1, np.int32)
        new = np.unique(context[self._row_of[context] < 0])
        self._row_of[new] = np.arange(len(new)) + len(self._contexts)
        self._contexts = np.append(self._contexts, new)
        entry = self._row_of[context].astype(np.int64) * self.size + c[3:]
        cuts = np.stack([begin, end], 1).ravel() - ORDER  # texts and, between them, the line ends
        out = np.zeros((len(begin), len(self.languages)))
        for k in range(len(self.languages)):
            sums = np.add.reduceat(np.append(self._costs(k, entry), np.uint16(0)), cuts, dtype=np.int64)[::2]
            out[:, k] = np.where(end > begin, sums, 0)
        return out / UNIT


def build(languages: list[str], language: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> LanguageModel | None:
    """Trees from counts of four-byte runs by language; languages without a run are left out."""
    if not len(grams):
        return None
    sym = np.stack([(grams >> s) & 255 for s in (24, 16, 8, 0)], 1)
    seen = np.unique(sym)
    class_of = np.zeros(256, np.uint16)
    class_of[seen] = np.arange(1, len(seen) + 1)
    a = len(seen) + 1
    s = class_of[sym].astype(np.int64)
    code = ((s[:, 0] * a + s[:, 1]) * a + s[:, 2]) * a + s[:, 3]
    learned, trees = [], []
    for k, name in enumerate(languages):
        own, n = code[language == k], counts[language == k]
        if not len(own):
            continue
        orders = []
        for order in range(ORDER + 1):
            runs, place = np.unique(own % a ** (order + 1), return_inverse=True)
            times = np.bincount(place, n)
            contexts, of = np.unique(runs // a, return_inverse=True)
            total, distinct = np.bincount(of, times), np.bincount(of)
            orders.append((contexts, np.log2((total + distinct) / distinct), runs, np.log2((total + distinct)[of] / times)))
        learned.append(name)
        trees.append(orders)
    return LanguageModel(learned, class_of, trees)


def train(docs: DataFrame, lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> LanguageModel | None:
    """Counts contexts in about sample_docs documents a language outside the held-out fold; None if there are none."""
    small_batches(docs.sparkSession)
    known = docs.select("doc_id", F.col(lang_col).cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter(
        F.col("lang").isNotNull() & (crc_fold("doc_id") != 0)
    )
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
    totals = {r["lang"]: (r["n"], r["bytes"]) for r in sizes.collect()}
    if not totals:
        return None
    languages = sorted(totals)
    steps = 1 << 20
    rate = {k: min(steps, -(-steps * sample_docs // n), -(-steps * sample_bytes // max(1, size))) for k, (n, size) in totals.items()}
    table = F.create_map(*[F.lit(x) for k in languages for x in (k, rate[k])])
    number = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < table[F.col("lang")]).select(number[F.col("lang")].alias("k"), "text")

    @arrow_task("langid")
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which = batch.column(0).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in text_chunks(batch.column(1)):
                joined, begin, stop = joined_bytes(data, offsets)
                for k in np.unique(which[first:end]):
                    own = which[first:end] == k
                    codes, n = np.unique(_grams(joined, begin[own], stop[own]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), k, np.int32)), pa.array(codes), pa.array(n)], names=["k", "gram", "n"])

    got = drawn.mapInArrow(count, "k int, gram long, n long").groupBy("k", "gram").agg(F.sum("n").alias("n")).orderBy("k", "gram").toArrow()
    return build(languages, got["k"].to_numpy(), got["gram"].to_numpy(), got["n"].to_numpy())


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """All columns, then lang_pred, score and bits_per_byte."""
    new = ("lang_pred", "score", "bits_per_byte")
    small_batches(docs.sparkSession)
    kept = docs.drop(*[c for c in new if c in docs.columns])
    letters = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "bits_per_byte": F.lit(None).cast("double")})
    names = kept.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_task("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        tags = pa.array([*m.languages, UNKNOWN])
        for batch in batches:
            lettered = batch.column(len(names)).to_numpy(zero_copy_only=False)
            best, score, rate = (np.zeros(batch.num_rows, t) for t in (np.int64, np.float64, np.float64))
            for first, end, data, offsets in text_chunks(batch.column(at)):
                bits = m.code_lengths(data, offsets)
                k = bits.argmin(1)
                low = bits[np.arange(len(k)), k]
                best[first:end] = k
                score[first:end] = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(1)
                rate[first:end] = low / np.maximum(1, np.diff(offsets))
            best[~lettered] = len(m.languages)
            score[~lettered] = 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tags.take(pa.array(best)), pa.array(score), pa.array(rate)], names=[*names, *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.withColumn("_lettered", letters).mapInArrow(run, f"{schema}, lang_pred string, score double, bits_per_byte double")
