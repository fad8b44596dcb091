"""Shared pieces of the operators: input columns, staged tables, bounded caches, hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.session import staged

__all__ = ["Cache", "documents", "frugal", "int64", "marked", "mix", "portions", "read", "sliced", "staged", "word_cache", "word_hashes"]

#: bits of the bitmaps that `marked` broadcasts, 8 MB, and of each of them
_BITS, _BLOCK_BITS = 26, 15


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator uses, so other columns can neither clash nor be read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def marked(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """Adds `name`, false only where a row's 64-bit hash `__id` is not among the hashes `id` of `ids`.

    Bitmaps of a fixed size are broadcast, so rows that a join would drop, or need not see, are told before they travel. More
    than some ten million ids fill them, and more rows are taken for known; none is ever missed.
    """

    def place(column: str) -> tuple[Column, Column]:
        at = F.pmod(F.col(column), F.lit(1 << _BITS))
        return F.shiftright(at, _BLOCK_BITS), F.pmod(at, F.lit(1 << _BLOCK_BITS))

    block, bit = place("id")
    maps = ids.select(block.alias("__block"), bit.alias("bit")).groupBy("__block").agg(F.bitmap_construct_agg("bit").alias("__bits"))
    block, bit = place("__id")
    byte = F.conv(F.hex(F.substr("__bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
    found = rows.withColumn("__block", block).join(F.broadcast(maps), "__block", "left")
    return found.withColumn(name, known).drop("__block", "__bits")


def int64(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as the signed numbers of a Spark long."""
    return values.view(np.int64)


class Cache(dict):
    """Remembers a function's values for as many keys as `limit`; a full cache starts anew."""

    def __init__(self, function: Callable, limit: int = 500_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


def word_cache() -> Cache:
    """The hashes of words met so far; one that a task makes goes with it, while a worker lives on."""
    return Cache(lambda word: xxhash.xxh3_64_intdigest(word))


_WORDS = word_cache()


def word_hashes(words: list, known: Cache = _WORDS) -> np.ndarray:
    """A 64-bit hash of each word (str or bytes), the same in every task."""
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def _known() -> int:
    return len(_WORDS)


def _give_back(known: int) -> None:
    """Empties this process's cache of all words but the `known` first ones, and returns what is free to the system.

    Called by name: a function made in another one carries its own copy of a module's variables to its task.
    """
    while len(_WORDS) > known:
        _WORDS.popitem()
    pa.default_memory_pool().release_unused()
    if hasattr(system := ctypes.CDLL(None), "malloc_trim"):  # of glibc only
        system.malloc_trim(0)


def frugal(function: Callable) -> Callable:
    """The same function of batches; the words its task met go with it, and what it leaves free goes back to the system.

    A Python worker lives on between tasks, and Arrow and the C library keep what was freed, beside the JVM's heap.
    """

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known()
        try:
            yield from function(batches)
        finally:
            _give_back(known)

    return run


def sliced(batches: Iterator[pa.RecordBatch], chars: int = 8_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `chars` bytes of text, at least one row each."""
    for batch in batches:
        sizes = np.cumsum([0, *(len(x) if (x := v.as_py()) else 0 for v in batch.column(column))])
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + chars, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def portions(batches: Iterator[pa.RecordBatch], size: int = 8_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes of a text column, at least one row each, without decoding them."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        sizes = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + size, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
