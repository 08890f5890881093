"""Best-two-fit packing of tokenized documents into sequences of a fixed length.

A document is its ids and an end id; only longer ones are cut. Full pieces are sequences of their own. The others
are packed in groups of some thousand: a bin is filled greedily, the longest piece that fits coming first, and then
its smallest piece gives way to the two unpacked pieces that fill the widened gap best, if they fill it more
tightly. Bins that stay loose, the last ones of a group, are opened again and packed in groups of their own, until
one group is left or a turn leaves nine in ten of its pieces loose: of lengths that do not fill a bin no turn makes
better ones. Which pieces share a group does not depend on their content, so no text, however frequent, makes
a large group. Packing moves rows of a few numbers; ids stay where they were made.

Defined cases: a null text is empty and a document of the end id alone; a null id is kept; repeated rows are packed
once each; an empty table gives an empty result; columns of the input other than the two that are named are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_task, small_batches, text_chunks, write_table

LENGTH = 4096
END_ID = 1
#: Pieces packed together, and the gap beyond which a bin is opened again.
GROUP = 8192
SLACK = 16
#: Share of a turn's pieces that may stay loose for another turn to be worth it.
STALLED = 0.9
#: Words whose ids a worker keeps, about 170 bytes each; it forgets all of them beyond.
CACHE_WORDS = 1_200_000
#: Stands between words that are encoded together; a word that holds it is encoded alone.
_MARK = b"\x01"


class _Words:
    """A tokenizer and the ids, as bytes, of words it has seen."""

    def __init__(self, path: str, most: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.most = most
        mark = self._alone(_MARK)
        self.mark = int.from_bytes(mark, "little") if len(mark) == 4 else None  # else no word is encoded with others
        # Cutting at white space, folding case and parting stops must not change this tokenizer's ids.
        probe = b"The QUICK, brown\n\tfox.  Jumped \x01 over, a1, (b) c-d. E"
        whole = self._alone(probe)
        self.learn(set(_cut(probe)))
        self.by_word = self.mark is not None and whole == b"".join(self.known[w] for w in _cut(probe))

    def _alone(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, words: list[bytes]) -> None:
        """Many words in one call, parted by a mark that is always one token of its own."""
        known = self.known
        for first in range(0, len(words), 4000):
            part = words[first : first + 4000]
            text = (b" " + _MARK + b" ").join(part).decode("utf-8", "replace")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(part) - 1:
                for w in part:
                    known[w] = self._alone(w)
                continue
            raw = ids.tobytes()
            known.update(zip(part, [raw[x:y] for x, y in zip([0, *(4 * cut + 4).tolist()], [*(4 * cut).tolist(), len(raw)])]))

    def learn(self, words: set[bytes]) -> None:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.most:
            known.clear()
            new = list(words)
        self._encode([w for w in new if _MARK not in w])
        for w in new:
            if w not in known:
                known[w] = self._alone(w)


#: A full stop or comma right behind a letter and before white space or the end.
_STOP = re.compile(rb"(?<=[a-z])([.,])(?=[\s]|\Z)")


def _cut(text: bytes) -> list[bytes]:
    """Words of a text, in lower case. Such a stop is a word of its own to the tokenizer too."""
    return _STOP.sub(rb" \1", text.lower()).split()


@lru_cache(maxsize=2)
def _words(path: str, most: int) -> _Words:
    """One in each worker."""
    return _Words(path, most)


def tokenize(texts: list[bytes], path: str, cache_words: int = CACHE_WORDS) -> list[bytes]:
    """Little-endian 32-bit ids of each text. The tokenizer drops white space and never joins across it, so texts are
    cut there and each distinct word is encoded once. A tokenizer for which that does not hold encodes whole texts."""
    table = _words(path, cache_words)
    if not table.by_word:
        return [table._alone(t) for t in texts]
    words = [_cut(t) for t in texts]
    table.learn(set(itertools.chain.from_iterable(words)))
    return [b"".join(map(table.known.__getitem__, ws)) for ws in words]


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False, cache_words: int = CACHE_WORDS
) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32-bit)."""
    end = np.array([end_id], "<u4").tobytes()
    small_batches(docs.sparkSession)

    @arrow_task("packing", _words.cache_clear)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in text_chunks(batch.column(1), 1 << 20):
                raw = data.tobytes()
                rows, cuts = [], []
                for k, ids in enumerate(tokenize([raw[a:b] for a, b in zip(offsets, offsets[1:])], tokenizer, cache_words)):
                    ids += end
                    for at in range(0, len(ids), 4 * length):
                        part = ids[at : at + 4 * length]
                        rows.append(first + k)
                        cuts.append((at // (4 * length), at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
                columns = list(zip(*cuts))
                out = [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(columns[i], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    out.append(pa.array(columns[4], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {dict(picked.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return picked.mapInArrow(run, schema)


def best_two_fit(lengths: np.ndarray, size: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Pieces must not be longer than size."""
    order = np.argsort(lengths, kind="stable")
    count = np.bincount(lengths, minlength=size + 1)
    upto = np.cumsum(count)  # the pieces of length n are order[upto[n] - count[n] : upto[n]], used from the end
    left = count.copy()
    used_bin, used_offset = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    present = np.where(left > 0, np.arange(size + 1), 0)
    present[0] = 0
    fits = np.maximum.accumulate(present)  # the longest unpacked length of at most n

    def take(n: int) -> None:
        left[n] -= 1
        if not left[n]:
            fits[n:][fits[n:] == n] = fits[n - 1]

    def put_back(n: int) -> None:
        left[n] += 1
        if left[n] == 1:
            fits[n:] = np.maximum(fits[n:], n)

    packed, number = 0, 0
    while packed < len(lengths):
        gap, held = size, []
        while gap and (n := int(fits[gap])):
            held.append(n)
            take(n)
            gap -= n
        if gap and len(held) > 1:
            smallest = held[-1]
            room = gap + smallest
            first = np.arange(1, room // 2 + 1)
            second = fits[room - first]
            good = (left[first] > 0) & (second > 0) & ((second != first) | (left[first] > 1))
            sums = np.where(good, first + second, 0)
            if len(sums) and (best := int(sums.max())) > smallest:
                a = int(first[int(sums.argmax())])
                b = best - a
                take(a)
                take(b)
                put_back(smallest)
                held[-1:] = [a, b]
        offset = 0
        for n in held:
            # Of equal pieces, whichever was not used yet.
            i = order[upto[n] - 1]
            upto[n] -= 1
            used_bin[i], used_offset[i] = number, offset
            offset += n
        packed += len(held)
        number += 1
    return used_bin, used_offset


def _packer(size: int, slack: int, base: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_two_fit(frame["length"].to_numpy(np.int64), size)
        filled = np.bincount(bins, frame["length"])
        frame["sequence_id"] = base + (int(key[0]) << 32) + bins
        frame["offset"] = offsets
        frame["loose"] = size - filled[bins] > slack
        return frame.drop(columns="_group")

    return run


def pack(parts: DataFrame, size: int = LENGTH, group: int = GROUP, slack: int = SLACK, stalled: float = STALLED) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns, with length from 1 to size)."""
    kept = parts.drop(*[c for c in ("sequence_id", "offset") if c in parts.columns])
    names = kept.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    # Full pieces first in a numbering of their own; Spark's row numbers stay below 2 ** 63.
    done = [kept.filter(F.col("length") == size).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})]
    rest, base = kept.filter(F.col("length") < size), 0
    todo = rest.count()
    while todo:
        groups = max(1, round(todo / group))

        # Row numbers are those of a written table's files, so a task that runs again deals the same groups.
        dealt = rest.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        packed = write_table(dealt.groupBy("_group").applyInPandas(_packer(size, slack, base), f"{schema}, sequence_id long, offset long, loose boolean"), "packed")
        loose = packed.filter("loose").count() if groups > 1 else 0
        if loose > stalled * todo or groups == 1:
            done.append(packed.drop("loose"))
            break
        done.append(packed.filter("not loose").drop("loose"))
        rest = packed.filter("loose").select(names)
        base += groups << 32
        todo = loose
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Tokenizes, cuts and packs: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(write_table(pieces(docs, tokenizer, id_col, text_col, length, end_id, cache_words=cache_words), "pieces"), length)
