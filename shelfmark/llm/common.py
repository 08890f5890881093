"""What the operators share: working tables, text buffers, workers' memory, hashing.

Defined cases: `text_chunks` takes null for the empty text and gives nothing for an empty column, and a text above the
limit is a chunk of its own; `crc_fold` takes a null id for the empty text.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import attach
from ..sources.working import forget, shared_dir, write_table

#: Pattern of a word, as the contracts give it: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns into numpy arrays at a time.
CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 20_000
#: Rows of an Arrow batch of texts; a session that asks for fewer keeps its number.
ROWS_PER_BATCH = 2000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    attach(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_fold(column: str, folds: int = 5):
    """crc32 of the id as text, modulo folds. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


_owner: str | None = None
_clear: list = []


def hold(owner: str, clear=None) -> None:
    """Tables that a Python worker keeps between tasks belong to one operator at a time. Workers outlive stages, so the
    first task of another operator frees them; clear is how."""
    global _owner
    if owner != _owner:
        for free in _clear:
            free()
        _clear.clear()
        _owner = owner
        if clear is not None:
            _clear.append(clear)


def release() -> None:
    """Gives memory that a task is done with back to the system: workers wait between stages, and an executor's memory
    is shared by all of them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def arrow_task(owner: str, clear: Callable[[], None] | None = None):
    """Decorates functions for mapInArrow: tables of other operators are freed first, and working memory at the end."""

    def wrap(function):
        @functools.wraps(function)
        def run(batches):
            hold(owner, clear)
            try:
                yield from function(batches)
            finally:
                release()

        return run

    return wrap


def arrow_group(owner: str):
    """The same for functions of applyInArrow."""

    def wrap(function):
        @functools.wraps(function)
        def run(key: tuple, table: pa.Table) -> pa.Table:
            hold(owner)
            out = function(key, table)
            del table
            if out.nbytes > 1 << 20:
                release()
            return out

        return run

    return wrap


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts: at most ROWS_PER_BATCH rows, which Spark and Python both hold. A lower setting stays."""
    attach(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets) of runs of whole texts of about limit bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, first + CHUNK_ROWS, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


__all__ = ["CHUNK_BYTES", "WORD", "arrow_group", "arrow_task", "crc_fold", "forget", "mix64", "read", "shared_dir", "small_batches", "text_chunks", "write_table"]
