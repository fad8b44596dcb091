"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Method: large-item matching. Pieces above a third of the capacity share a sequence at most in
pairs, matched greedily; smaller pieces go to the tightest gap that holds them.

The matching depends on the lengths only, of which there are at most `capacity`. So it is computed on
the number of pieces of each length (a table whose size the capacity bounds, whatever the corpus)
and says, for runs of ranks within a length, which sequences they fill. Pieces then find their
place by their rank: a count per (length, hash bucket), running sums over the buckets, and a row number
within a bucket. No row passes through the driver, and no task sees a whole length.

Defined cases: a null text is an empty one and gives the single end token; a text longer than the
capacity is cut so that only its first piece is shorter; repeated rows are packed as often as they
occur; a null doc_id is kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import Cache, documents, frugal, staged

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: buckets over which the pieces of one length are ranked
BUCKETS = 256


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


#: runs of white space that the vocabulary's pre-tokeniser may join across a space or a line end
_RUNS = re.compile(r"\s{3}|\s\s(?:\Z|<)")
#: white space other than single spaces and line ends, without which few strings can begin such a run
_ODD = re.compile(r"[^\S \n]")
_PAIRS = ("  ", "\n\n", " \n", "\n ")


class Encoder:
    """Token ids of a text as 32-bit numbers.

    The vocabulary's pre-tokeniser joins characters across a space or a line end only in runs of
    white space, and puts a space at the start of what follows. So a text is encoded as its lines and their
    parts between spaces, each part once while the cache holds it; texts with such runs are
    encoded whole. A part of letters is one pre-token, and a mark after it is another one. The
    ids of this vocabulary are its merge order, so its words can be merged by rank, which is quicker.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        byte_of = {chr(mark): code for code, mark in enumerate(self._marks())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(byte_of.__getitem__, token)): rank for token, rank in vocabulary.items() if byte_of.keys() >= set(token)}
        self.words = tiktoken.Encoding("words", pat_str=r" ?\p{L}+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.parts = Cache(lambda part: self._part(" ", part), 700_000)
        self.heads = Cache(lambda part: self._part("", part), 100_000)
        self.line_end = self._ids("\n")
        self.marks = {mark: self._ids(mark) for mark in ".,;:!?"}

    @staticmethod
    def _marks() -> list[int]:
        """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        return [code if code in shown else next(hidden) for code in range(256)]

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, before: str, part: str) -> bytes:
        if part.isalpha():
            return array("I", self.words(before + part)).tobytes()
        word, mark = part[:-1], part[-1:]
        if mark in self.marks and word.isalpha():
            return (self.parts if before else self.heads)[word] + self.marks[mark]
        return self._ids(before + part)

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        return self.heads[first] + b"".join(map(self.parts.__getitem__, rest))

    def forget(self) -> None:
        """Drops the caches; their functions hold the encoder, which would outlive its task until a collection of cycles."""
        del self.parts, self.heads

    def encode(self, text: str) -> bytes:
        if (any(pair in text for pair in _PAIRS) or _ODD.search(text)) and _RUNS.search(text):
            return self._ids(text)
        return self.line_end.join(map(self._line, text.split("\n")))


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of each piece."""
    first = tokens % capacity or capacity
    return [(0, min(first, tokens)), *((at, at + capacity) for at in range(first, tokens, capacity))]


def tokenised(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece; with_ids adds its token ids."""
    path = path or tokenizer_path()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(path)
        try:
            for whole in batches:
                for batch in (whole.slice(at, 1000) for at in range(0, whole.num_rows, 1000)):
                    texts = [text or "" for text in batch.column("text").to_pylist()]
                    rows, columns, ids = [], ([], [], [], []), []
                    for row, text in enumerate(texts):
                        code = encoder.encode(text) + bytes(4)  # END_ID
                        for piece, (start, end) in enumerate(_cut(len(code) // 4, capacity)):
                            part = code[4 * start : 4 * end]
                            rows.append(row)
                            for column, value in zip(columns, (piece, start, end - start, zlib.crc32(part)), strict=True):
                                column.append(value)
                            if with_ids:
                                ids.append(np.frombuffer(part, "<i4"))
                    out = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
                    out += [pa.array(column, kind) for column, kind in zip(columns, (pa.int32(), *[pa.int64()] * 3), strict=True)]
                    if with_ids:
                        out.append(pa.array(ids, pa.list_(pa.int32())))
                    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(out)]
                    yield pa.RecordBatch.from_arrays(out, names)
        finally:
            encoder.forget()

    return documents(docs).mapInArrow(frugal(pieces), PIECES + (", ids array<int>" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, ranks, first sequence, pieces per sequence, offset).

    Sequences with equal gaps are kept as ranges of numbers, so the work depends on the number of
    lengths and not on the number of pieces.
    """
    left = {length: count for length, count in counts.items() if count}
    done: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    sizes: list[int] = []
    opened = 0

    def put(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        runs.append((length, done[length], pieces, first, each, offset))
        done[length] += pieces
        left[length] -= pieces

    def keep(gap: int, first: int, count: int) -> None:
        if count and gap:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((first, count))

    def open_(count: int, *lengths: int) -> None:
        """New sequences that hold one piece of each length."""
        nonlocal opened
        offset = 0
        for length in lengths:
            put(length, count, opened, 1, offset)
            offset += length
        keep(capacity - offset, opened, count)
        opened += count

    middle = sorted(length for length in left if capacity < 3 * length and 2 * length <= capacity)
    for length in sorted((length for length in left if 2 * length > capacity), reverse=True):
        while left[length] and (at := bisect_left(middle, capacity - length + 1)):
            other = middle[at - 1]
            open_(min(left[length], left[other]), length, other)
            if not left[other]:
                middle.remove(other)
        if left[length]:
            open_(left[length], length)
    while middle:
        length = middle[-1]
        if left[length] > 1:
            pairs = left[length] // 2
            put(length, 2 * pairs, opened, 2, 0)
            keep(capacity - 2 * length, opened, pairs)
            opened += pairs
        if left[length]:
            open_(1, length, *middle[-2:-1])
        middle = [other for other in middle if left[other]]
    for length in sorted((length for length in left if 3 * length <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                count = max(1, left[length] // each)
                each = min(each, left[length])
                put(length, count * each, opened, each, 0)
                keep(capacity - each * length, opened, count)
                opened += count
                continue
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                sizes.pop(at)
            each = gap // length
            used = min(count, max(1, left[length] // each))
            each = min(each, left[length])
            put(length, used * each, first, each, capacity - gap)
            keep(gap, first + used, count - used)
            keep(gap - each * length, first, used)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, start, length and ids_crc32.

    `pieces` is read three times and should be a written table.
    """
    spark = pieces.sparkSession
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    counted = dealt.groupBy("length", "bucket").agg(F.count("*").alias("pieces"))
    lengths = counted.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()  # at most `capacity` rows
    runs = plan({row["length"]: row["pieces"] for row in lengths}, capacity)
    names = ["run_length", "first_rank", "ranks", "first_sequence", "each", "run_offset"]
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("length", "bucket", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("row", F.row_number().over(order))
        .join(F.broadcast(starts), ["length", "bucket"])  # at most capacity * buckets rows
        .withColumn("rank", F.col("before") + F.col("row") - 1)
    )
    # as an Arrow table: a list of rows would be read by Python workers, which stay idle beside the others
    columns = [pa.array(column, pa.int64()) for column in np.array(runs, np.int64).reshape(-1, len(names)).T]
    runs = F.broadcast(spark.createDataFrame(pa.Table.from_arrays(columns, names)))
    inside = (F.col("length") == F.col("run_length")) & F.col("rank").between(
        F.col("first_rank"), F.col("first_rank") + F.col("ranks") - 1
    )
    at = F.col("rank") - F.col("first_rank")
    each = F.col("each")
    return ranked.join(runs, inside).select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(at / each)).alias("sequence_id"),
        (F.col("run_offset") + at % each * F.col("length")).alias("offset"),
    )


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(staged(tokenised(docs, capacity, path), "pieces"), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id, doc_ids and token ids, at most `capacity` each."""
    placed = pack(staged(tokenised(docs, capacity, path, with_ids=True), "pieces"), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most `capacity` tokens
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.flatten("parts.ids").alias("ids")
    )
