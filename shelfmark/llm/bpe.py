"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over the bytes of a text cuts it into chunks where its low bits are zero, so equal passages are cut
alike wherever they stand. Chunks are counted over all documents; one that occurs again is encoded once for all of them,
by the task to which its digest is dealt, and one that occurs once is encoded where it stands, so that texts need not
move. A cut may go through a word: an encoded chunk is its ids without its first and last word, and these two as bytes.
Chunks are joined by encoding the words around each cut again, and further over the next cuts until the window begins
and ends at white space: the tokenizer drops white space and never looks across it, so there both sides agree with the
library's ids of the whole text.

Which chunks occur again is told to tasks by a bitmap of fixed size. A chunk that it takes for a repeated one by mistake
is sent to be encoded elsewhere, which changes where work is done and no result.

Defined cases: a null text is empty and has no ids; a null id is kept; repeated rows are returned each; texts without
white space are one word and encoded whole, as are all texts by a tokenizer that looks across white space; an empty table gives an empty result; columns of the input other than the
two that are named are not read. Ids are little-endian unsigned 32-bit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_task, mix64, small_batches, text_chunks, write_table

#: Bytes that the rolling hash sees, bits of it that are zero at a cut, and the least and most bytes of a chunk.
WINDOW = 32
CUT_BITS = 9
LEAST = 128
MOST = 8192
#: Bits of the bitmap of repeated chunks; 8 MB.
BITMAP_BITS = 26
#: Words whose ids a worker keeps; it forgets all of them beyond.
CACHE_WORDS = 500_000
#: Digests of chunks that a task remembers having sent; it forgets them beyond and may send one again.
SENT = 200_000
#: Bytes of ids that are turned into text at a time.
BATCH_BYTES = 4 << 20

_gear = mix64(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def cuts(data: np.ndarray, least: int = LEAST, most: int = MOST, bits: int = CUT_BITS) -> list[int]:
    """Ends of the chunks of a text's bytes. A cut depends on the WINDOW bytes before it and on where the chunk began."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    rolled = _gear[data]
    width = 1
    while width < WINDOW:  # the sum of the last `width` values, each shifted by its distance
        rolled[width:] = rolled[width:] + (rolled[:-width] << np.uint32(width))
        width *= 2
    ends, last = [], 0
    for at in (np.flatnonzero(rolled >> np.uint32(32 - bits) == 0) + 1).tolist():
        while at - last > most:
            last += most
            ends.append(last)
        if at - last >= least:
            last = at
            ends.append(at)
    while n - last > most:
        last += most
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def digest(piece: bytes) -> bytes:
    return xxhash.xxh3_128_digest(piece)


class _Words:
    """A tokenizer and the ids of words it has seen; words are what stands between ASCII white space."""

    def __init__(self, path: str, most: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.most = most
        self.plain: dict[bytes, bytes] = {}
        self.known: dict[bytes, bytes] = {}
        self.by_word = self._by_word()

    def _by_word(self) -> bool:
        """Whether the tokenizer's own file says that it drops white space and folds case, so that words stand alone: its
        normalizer turns white space into blanks and lowers case, its splitter keeps only what its pattern matches, and
        the pattern matches no white space; nothing is put before a text."""
        import json

        own = json.loads(self.tokenizer.to_str())
        normal, parts = (own.get(k) or {} for k in ("normalizer", "pre_tokenizer"))
        steps = normal.get("normalizers", [normal])
        folds = [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
        cut = parts.get("pretokenizers", [parts])
        split = cut[0]
        drops = split.get("type") == "Split" and split.get("behavior") == "Removed" and bool(split.get("invert"))
        keeps = drops and self._no_space(split["pattern"].get("Regex", " "))
        rest = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex") for s in cut[1:])
        added = all(not a["normalized"] and not a["lstrip"] and not a["rstrip"] and not a["single_word"] and not re.search(r"\s", a["content"]) and a["content"].startswith("<|") for a in own["added_tokens"])
        return bool(folds and keeps and rest and added)

    @staticmethod
    def _no_space(pattern: str) -> bool:
        import regex

        return not any(regex.search(pattern, c, regex.V1) for c in "\t\n\x0b\x0c\r ")

    def alone(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Case of ASCII words is folded by the tokenizer, and a stop behind a letter at a word's end is a part of its
        own to it, so such words are encoded in parts; a word that may hold a control string is not touched."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            self.plain.clear()
            new = list(words)
        parts = {w: _parts(w) for w in new}
        unseen = list({p for ps in parts.values() for p in ps if p not in self.plain})
        for first in range(0, len(unseen), 2000):
            some = unseen[first : first + 2000]
            made = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
            self.plain.update(zip(some, [np.array(e.ids, "<u4").tobytes() for e in made]))
        for w, ps in parts.items():
            self.known[w] = self.plain[ps[0]] if len(ps) == 1 else b"".join(map(self.plain.__getitem__, ps))

    def ids(self, text: bytes) -> bytes:
        """Ids of a text that begins and ends where words do."""
        if not self.by_word:
            return self.alone(text)
        words = text.split()
        self.learn(set(words))
        return b"".join(map(self.known.__getitem__, words))


def _parts(word: bytes) -> list[bytes]:
    if not word.isascii() or b"<|" in word:
        return [word]
    word = word.lower()
    return [word[:-1], word[-1:]] if word[-1:] in (b".", b",") and word[-2:-1].isalpha() else [word]


@lru_cache(maxsize=2)
def _words(path: str, most: int) -> _Words:
    """One in each worker."""
    return _Words(path, most)


_EDGE = re.compile(rb"[\x20\x09-\x0D]")


def open_ends(piece: bytes) -> tuple[bytes, bytes, bytes, bool]:
    """What stands before the first white space, between, behind the last, and whether there is white space at all."""
    first = _EDGE.search(piece)
    if first is None:
        return piece, b"", b"", False
    last = max(piece.rfind(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    return piece[: first.start()], piece[first.start() : last], piece[last + 1 :], True


def join_pieces(pieces: Iterator[tuple[bytes, bytes, bytes, bool]], table: _Words) -> bytes:
    """Ids of a text from its pieces (head, ids, tail, spaced) in order: the words around each cut are encoded again,
    and the window goes on over the next cut while a piece holds no white space at which both sides agree."""
    out, window = [], []
    for head, ids, tail, spaced in pieces:
        window.append(head)
        if spaced:
            out += [table.ids(b"".join(window)), ids]
            window = [tail]
    out.append(table.ids(b"".join(window)))
    return b"".join(out)


class Digests:
    """What the query returns of a document's ids: their number, the hash of them in decimal, and that of the text that the
    tokenizer decodes them to."""

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    def __init__(self, path: str):
        self.path = path

    def __call__(self, ids: list[bytes]) -> list[pa.Array]:
        decimal, tokens, plain = _spelled(self.path)
        rows = []
        for raw in ids:
            each = np.frombuffer(raw, "<u4").tolist()
            decoded = b" ".join(map(tokens.__getitem__, each)) if plain else decode_ids(raw, self.path).encode("utf-8")
            rows.append((len(each), hashlib.sha256(b" ".join(map(decimal.__getitem__, each))).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        n, a, b = zip(*rows) if rows else ((), (), ())
        return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]


class Ids:
    """The ids themselves, little-endian unsigned 32-bit."""

    schema = "ids binary"

    def __call__(self, ids: list[bytes]) -> list[pa.Array]:
        return [pa.array(ids, pa.binary())]


@lru_cache(maxsize=2)
def _spelled(path: str) -> tuple[list[bytes], list[bytes], bool]:
    """Every id in decimal, every id's token, and whether the tokenizer has no decoder, so that tokens are joined by blanks."""
    import json

    tokenizer = _words(path, CACHE_WORDS).tokenizer
    size = max(tokenizer.get_vocab(True).values()) + 1
    tokens = [(tokenizer.id_to_token(i) or "").encode("utf-8") for i in range(size)]
    return [str(i).encode() for i in range(size)], tokens, json.loads(tokenizer.to_str()).get("decoder") is None


def decode_ids(ids: bytes, path: str) -> str:
    return _words(path, CACHE_WORDS).tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def _outcome(finish) -> list[str]:
    return [c.split()[0] for c in finish.schema.split(",")]


def _clear() -> None:
    _words.cache_clear()
    _spelled.cache_clear()


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, int, bytes, np.ndarray]]:
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column(at)):
            raw = data.tobytes()
            for k, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                yield batch, first + k, raw[a:b], data[a:b]


def _chunks(raw: bytes, data: np.ndarray) -> list[bytes]:
    ends = cuts(data)
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def repeated_chunks(texts: DataFrame) -> DataFrame:
    """digest (two longs) of each chunk that occurs more than once; texts has one column. Counts are summed within a task
    before they are shuffled; a chunk that all documents share is one row a batch."""

    @arrow_task("bpe", _clear)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest(c) for _, _, raw, data in _texts(iter([batch]), 0) for c in _chunks(raw, data)]
            if found:
                pairs = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                pairs = pairs[order]
                new = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1)))
                n = np.diff(np.append(new, len(pairs)))
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[new, 0])), pa.array(np.ascontiguousarray(pairs[new, 1])), pa.array(n)], names=["a", "b", "n"])

    return texts.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 1").select("a", "b")


def bitmap(repeated: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """2 ** bits bits, set at the low bits of the digests: at most 2 ** (bits - 15) rows of 4 KB come to the driver, however
    many digests there are."""
    at = F.col("a").bitwiseAND(F.lit((1 << bits) - 1)) + 1  # Spark's buckets count from 1
    rows = repeated.select(at.alias("at")).groupBy(F.expr("bitmap_bucket_number(at)").alias("n")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("map"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows.collect():
        first = (r["n"] - 1) * 4096
        part = np.frombuffer(bytes(r["map"]), np.uint8)
        out[first : first + 4096] |= part[: len(out) - first]
    return out


def encode(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    finish=None,
    cache_words: int = CACHE_WORDS,
    bits: int = BITMAP_BITS,
) -> DataFrame:
    """doc_id and what finish makes of a document's ids (by default `ids`), a row for each row of docs.

    One pass counts chunks. A second one writes, for a document without repeated chunks, its finished row, and for others the
    pieces that occur once, encoded, and the digests of those that do not. Pieces meet by the digest of the whole text.
    """
    finish = finish or Ids()
    spark = docs.sparkSession
    small_batches(spark)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = _Shared(spark, bitmap(repeated_chunks(picked.select("text")), bits), bits)
    id_type = dict(picked.dtypes)["doc_id"]
    written = write_table(picked.mapInArrow(_cutter(tokenizer, shared, finish, cache_words), f"kind int, doc_id {id_type}, whole binary, seq long, digest binary, head binary, middle binary, tail binary, spaced boolean, {finish.schema}"), "bpe", compression="zstd")
    outcome = _outcome(finish)
    done = written.filter(f"kind = {_DONE}").select("doc_id", *outcome)
    # One text of each digest; texts of equal digests are equal.
    chunks = written.filter(f"kind = {_CHUNK}").groupBy("digest").agg(F.first("head").alias("text"))
    encoded = chunks.mapInArrow(_encoder(tokenizer, cache_words), "digest binary, head binary, middle binary, tail binary, spaced boolean")
    refs = written.filter(f"kind = {_REF}").select("whole", "seq", "digest").join(encoded, "digest").select("whole", "seq", "head", "middle", "tail", "spaced")
    own = written.filter(f"kind = {_OWN}").select("whole", "seq", "head", "middle", "tail", "spaced")
    pieces = own.unionByName(refs).repartition("whole").sortWithinPartitions("whole", "seq")
    joined = pieces.mapInArrow(_joiner(tokenizer, finish, cache_words), f"whole binary, {finish.schema}")
    waiting = written.filter(f"kind = {_WAITS}").select("doc_id", "whole").join(joined, "whole").select("doc_id", *outcome)
    return done.unionByName(waiting)


_DONE, _WAITS, _OWN, _REF, _CHUNK = range(5)


class _Shared:
    """The bitmap, sent to workers once."""

    def __init__(self, spark: SparkSession, bits: np.ndarray, width: int):
        self.sent = spark.sparkContext.broadcast(bits)
        self.mask = (1 << width) - 1

    def __contains__(self, key: bytes) -> bool:
        at = int.from_bytes(key[:8], "little") & self.mask
        return bool(self.sent.value[at >> 3] >> (at & 7) & 1)


def _cutter(path: str, shared: _Shared, finish, cache_words: int) -> Callable:
    @arrow_task("bpe", _clear)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, finisher = _words(path, cache_words), finish
        sent: set[bytes] = set()
        cut: set[bytes] = set()
        for batch in batches:
            done_at, done_ids, waits_at, waits = [], [], [], []
            rows: list[tuple] = []
            for _, at, raw, data in _texts(iter([batch]), 1):
                parts = _chunks(raw, data)
                keys = [digest(p) for p in parts]
                known = [k in shared for k in keys] if table.by_word else []
                if not any(known):
                    done_at.append(at)
                    done_ids.append(table.ids(raw))
                    continue
                whole = digest(raw)
                waits_at.append(at)
                waits.append(whole)
                if whole in cut:  # a copy in this task has sent the pieces
                    continue
                if len(cut) > SENT:
                    cut.clear()
                cut.add(whole)
                run_of: list[bytes] = []
                for seq, (part, key, again) in enumerate(zip(parts, keys, known)):
                    if not again:
                        run_of.append(part)
                    if run_of and (again or seq == len(parts) - 1):
                        head, middle, tail, spaced = open_ends(b"".join(run_of))
                        rows.append((_OWN, whole, 2 * seq, None, head, table.ids(middle), tail, spaced))
                        run_of = []
                    if again:
                        rows.append((_REF, whole, 2 * seq + 1, key, None, None, None, None))
                        if key not in sent:
                            if len(sent) > SENT:
                                sent.clear()
                            sent.add(key)
                            rows.append((_CHUNK, None, None, key, part, None, None, None))
            ids = batch.column(0)
            yield _rows(ids, finisher, done=(done_at, done_ids))
            yield _rows(ids, finisher, waits=(waits_at, waits))
            for first in range(0, len(rows), 5000):
                yield _rows(ids, finisher, rows=rows[first : first + 5000])

    return run


_NAMES = ("kind", "doc_id", "whole", "seq", "digest", "head", "middle", "tail", "spaced")
_TYPES = (pa.int32(), None, pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.bool_())


def _rows(ids: pa.Array, finish, done=None, waits=None, rows=None) -> pa.RecordBatch:
    """One batch of the written table's rows of one sort."""
    n = len((done or waits or (rows,))[0])
    columns = {name: pa.nulls(n, t or ids.type) for name, t in zip(_NAMES, _TYPES)}
    made = finish([])
    outcome = [pa.nulls(n, c.type) for c in made]
    if done is not None:
        columns |= {"kind": pa.array([_DONE] * n, pa.int32()), "doc_id": ids.take(pa.array(done[0], pa.int64()))}
        outcome = finish(done[1])
    elif waits is not None:
        columns |= {"kind": pa.array([_WAITS] * n, pa.int32()), "doc_id": ids.take(pa.array(waits[0], pa.int64())), "whole": pa.array(waits[1], pa.binary())}
    elif rows:
        turned = list(zip(*rows))
        kept = [i for i in range(len(_NAMES)) if _NAMES[i] != "doc_id"]
        columns |= {_NAMES[i]: pa.array(turned[k], _TYPES[i]) for k, i in enumerate(kept)}
    return pa.RecordBatch.from_arrays([*columns.values(), *outcome], names=[*columns, *_outcome(finish)])


def _encoder(path: str, cache_words: int) -> Callable:
    @arrow_task("bpe", _clear)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _words(path, cache_words)
        for batch in batches:
            ends = [open_ends(p) for p in batch.column(1).to_pylist()]
            made = [[e[0] for e in ends], [table.ids(e[1]) for e in ends], [e[2] for e in ends]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.binary()) for c in made], pa.array([e[3] for e in ends], pa.bool_())], names=["digest", "head", "middle", "tail", "spaced"]
            )

    return run


def _joiner(path: str, finish, cache_words: int) -> Callable:
    """Pieces come sorted by text and place, and only one text's are held. Copies in several tasks send a piece again."""

    @arrow_task("bpe", _clear)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _words(path, cache_words)
        names = ["whole", *_outcome(finish)]
        now, place, pieces = None, None, []
        wholes: list[bytes] = []
        made: list[bytes] = []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(wholes, pa.binary()), *finish(made)], names=names)
            wholes.clear()
            made.clear()
            return out

        size = 0
        for batch in batches:
            for whole, seq, *piece in zip(*[c.to_pylist() for c in batch.columns]):
                if whole != now:
                    if now is not None:
                        wholes.append(now)
                        made.append(join_pieces(iter(pieces), table))
                        size += len(made[-1])
                        if size > BATCH_BYTES:
                            yield flush()
                            size = 0
                    now, place, pieces = whole, None, []
                if seq != place:
                    pieces.append(tuple(piece))
                    place = seq
        if now is not None:
            wholes.append(now)
            made.append(join_pieces(iter(pieces), table))
        yield flush()

    return run


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the text that the tokenizer decodes ids to; null ids give null."""
    names = [c for c in encoded.columns if c != out_col]
    kept = encoded.select(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + f", `{out_col}` string"

    @arrow_task("bpe", _clear)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if raw is None else decode_ids(raw, tokenizer) for raw in batch.column(names.index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out_col])

    return kept.mapInArrow(run, schema)
