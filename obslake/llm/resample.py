"""Importance resampling of documents towards a target distribution, with features counted by segment.

Method: segment deduplication. Newlines, which no word can hold, cut texts into lines. Equal lines are brought
together with their number of occurrences, and the features (runs of one and two words, hashed to buckets) of each
distinct line are counted once and multiplied by it. Runs that cross a line end are counted apart, from each document. The
sum is the count over all documents, however often lines repeat. A bucket's gain compares the target's
share with the corpus's; a document's weight is the mean gain of its features, and documents with the highest
weight plus Gumbel noise (a hash of the key) are drawn, which is sampling without replacement in proportion to exp(weight).

At scale: lines are combined within each task before they travel, so a line that a third of all documents hold
travels once a task; a task adds its features to one array of `buckets` numbers. The driver gets `buckets` sums and
a row number per partition. Ranks come from a range-partitioned sort of numbers (no text), with the row's place as last
key, so neither a score nor a repeated doc_id can fill a task. No lineage is needed after the two small staged tables.

Defined cases: a null text has no words; a document without words has weight 0; a null doc_id has no noise, so its score and
rank are null and it is not among the N documents; repeated rows are documents of their own and rank by their place in the
input; an empty corpus or target counts as 0 features; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import documents, portions, staged

BUCKETS = 10_000
#: documents with fewer words are not drawn
LEAST_WORDS = 20
#: the share of them that is drawn, in per cent
PERCENT = 25
SEED = 7

_SPACE, _LINE_END = 0x20, 0x0A
_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES)
#: digits, a to z, and every byte of a character outside ASCII
_IN_WORD = ((_BYTES >= ord("0")) & (_BYTES <= ord("9"))) | ((_BYTES >= ord("a")) & (_BYTES <= ord("z"))) | (_BYTES >= 0x80)
#: longer words are checksummed one by one
_LONG = 64


def _checksum_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _checksum_table()


def _extended(states: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 states after the bytes of data[start:end] too, for all spans at once."""
    length = end - start
    order = np.argsort(-length, kind="stable")
    states, start, falling = states[order], start[order], length[order]
    long = int(np.searchsorted(-falling, -_LONG))  # so many longer ones
    for at in range(long):
        text = data[start[at] : start[at] + falling[at]].tobytes()
        states[at] = zlib.crc32(text, int(states[at]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for at in range(int(falling[long]) if long < len(falling) else 0):
        active = slice(long, int(np.searchsorted(-falling, -at)))  # those with a byte at this place
        state = states[active]
        states[active] = _TABLE[(state ^ data[start[active] + at]) & 0xFF] ^ (state >> np.uint32(8))
    result = np.empty_like(states)
    result[order] = states
    return result


class Words:
    """The words of a column of texts, and the buckets of their runs of one and two."""

    def __init__(self, texts: pa.Array, buckets: int = BUCKETS):
        texts = texts.cast(pa.large_string()).fill_null("")
        self.rows = len(texts)
        self.buckets = buckets
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + self.rows + 1]
        content = texts.buffers()[2]
        data = np.frombuffer(content, np.uint8) if content else np.empty(0, np.uint8)
        self.data = _LOWER[data[offsets[0] : offsets[-1]]]
        offsets = offsets - offsets[0]
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = _IN_WORD[self.data]
        opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(self.data))]
        opens[edges] |= inside[1:-1][edges]  # a word ends with its text
        closes[edges - 1] |= inside[1:-1][edges - 1]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.row = np.searchsorted(offsets[1:], self.start, "right")
        #: numbers of the words that have a next word in their text
        self.paired = np.flatnonzero(self.row[:-1] == self.row[1:]) if len(self.row) else np.empty(0, np.int64)

    def _states(self, words: np.ndarray | slice) -> np.ndarray:
        start = self.start[words]
        return _extended(np.full(len(start), 0xFFFFFFFF, np.uint32), self.data, start, self.end[words])

    def _bucket(self, states: np.ndarray) -> np.ndarray:
        return (states ^ np.uint32(0xFFFFFFFF)) % np.uint32(self.buckets)

    def _joined(self, states: np.ndarray, following: np.ndarray) -> np.ndarray:
        states = _TABLE[(states ^ np.uint32(_SPACE)) & 0xFF] ^ (states >> np.uint32(8))
        return self._bucket(_extended(states, self.data, self.start[following], self.end[following]))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and bucket of every feature."""
        states = self._states(slice(None))
        pairs = self._joined(states[self.paired], self.paired + 1)
        return np.concatenate([self.row, self.row[self.paired]]), np.concatenate([self._bucket(states), pairs])

    def crossing(self) -> np.ndarray:
        """Buckets of the runs of two words with a line end between them."""
        lines = np.cumsum(self.data == _LINE_END)
        first = self.paired[lines[self.end[self.paired] - 1] < lines[self.start[self.paired + 1]]] if len(self.paired) else self.paired
        return self._joined(self._states(first), first + 1)


_COUNTED = "bucket int, found long"


def _totals(found: np.ndarray) -> pa.RecordBatch:
    kept = np.flatnonzero(found)
    return pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(found[kept], pa.int64())], ["bucket", "found"])


def feature_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket and found: how often all texts of the column `text` hold a feature of the bucket."""

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in portions(batches, column="line"):
            row, bucket = Words(batch.column("line"), buckets).features()
            np.add.at(found, bucket, batch.column("times").to_numpy()[row])
        yield _totals(found)

    def of_line_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in portions(batches):
            found += np.bincount(Words(batch.column("text"), buckets).crossing(), minlength=buckets)
        yield _totals(found)

    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text") != "")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line") != "")
    lines = lines.groupBy("line").agg(F.count("*").alias("times"))
    parts = lines.mapInArrow(of_lines, _COUNTED).unionAll(texts.mapInArrow(of_line_ends, _COUNTED))
    return parts.groupBy("bucket").agg(F.sum("found").alias("found"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths of a nat; the driver gets two numbers a bucket."""
    both = feature_counts(docs, buckets).select("bucket", "found", F.lit(0).alias("side"))
    both = both.unionAll(feature_counts(target, buckets).select("bucket", "found", F.lit(1).alias("side")))
    found = np.zeros((2, buckets), np.int64)
    for row in both.collect():  # 2 * buckets rows at most
        found[row["side"], row["bucket"]] = row["found"]
    corpus, wanted = (side.sum() for side in found)
    gain = [
        math.floor(1000 * math.log((float(t) + 1) * (float(corpus) + buckets) / ((float(s) + 1) * (float(wanted) + buckets))))
        for s, t in found.T
    ]
    return np.array(gain, np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            words = Words(batch.column("text"), len(gain))
            row, bucket = words.features()
            features = np.bincount(row, minlength=words.rows)
            total = np.zeros(words.rows, np.int64)
            np.add.at(total, row, gain[bucket])
            columns = [np.bincount(words.row, minlength=words.rows), features, total // np.maximum(features, 1)]
            arrays = [batch.column("doc_id"), *(pa.array(column, pa.int64()) for column in columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_features", "weight"])

    return documents(docs).mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def _noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the key's hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn) of every document."""
    found = weighted(docs, gains(docs, target, buckets))
    found = found.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
    found = staged(found.withColumn("place", F.monotonically_increasing_id()), "weights")
    may = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    order = [F.col("score").desc(), "doc_id", "place"]
    ranked = found.where(may).repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = ranked.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    ranked = staged(ranked, "ranks")
    sizes = sorted(tuple(row) for row in ranked.groupBy("part").count().collect())  # a row per partition
    starts, total = [], 0
    for part, size in sizes:
        starts.append((part, total))
        total += size
    starts = F.broadcast(docs.sparkSession.createDataFrame(starts, "part int, before long"))
    rank = F.col("before") + F.col("at") + 1
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = ranked.join(starts, "part").select(*columns, F.when(rank <= percent * total // 100, rank).alias("rank"))
    return ranked.unionAll(found.where(~F.coalesce(may, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The drawn documents themselves, with all their columns: rows whose doc_id was drawn."""
    chosen = resampled(docs, target, **options).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(chosen, docs["doc_id"].cast("long") == chosen["__drawn"], "left_semi")
