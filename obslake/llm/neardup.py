"""Near-duplicate documents by Order MinHash.

Method: a document is its sequence of K-word shingles, each labelled with the number of its occurrence.
Each of BANDS * ROWS hash functions keeps the MINIMA labelled shingles that it maps lowest and joins
them in their text order, so a sketch is equal only if the same shingles stand in the same order.
Documents that agree in a band of ROWS sketches are candidates (99.8 % of pairs at similarity 0.8,
practically all above 0.85). A candidate pair is verified by banded alignment of the two sequences.

Similarity is L / (n + m - L) with L matched shingles of an alignment, n and m the lengths: the Jaccard
similarity of the shingles where their order agrees. One minus it is a metric (a Steinhaus
transform of the insertion-deletion distance), which lets graph.bucket_links connect a bucket without all
its pairs. Equal texts are one node from the start.

Defined cases: a null text is an empty one; words are lower-case and white space separates them; a text with
fewer words than K is one shingle, texts without words are one class; a class is named by its
smallest doc_id (null if it has none), ties between equal texts go to the smaller doc_id; repeated rows are in one class and
deduplicated() keeps one of them; an empty table gives no row; other columns pass through deduplicated() unread.
Texts are told apart by a 64-bit hash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import frugal, int64, marked, mix, sliced, staged, word_hashes
from obslake.llm.graph import bucket_links, components

K, SIMILARITY = 5, 0.8
BANDS, ROWS, MINIMA = 20, 3, 2
#: the only key of a text without words
WORDLESS = np.array([-1], np.int64)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: labelled shingles that are hashed at once, which bounds a task's memory whatever a text's length
BLOCK = 50_000

#: 64-bit words of a text's short parities
PARITIES = 8

_PARITIES = [f"p{i}" for i in range(PARITIES)]
_DRAWS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * _GOLD)
_FACTORS, _SHIFTS = _DRAWS[::2, None] | np.uint64(1), _DRAWS[1::2, None]


def labelled_shingles(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each K-word shingle and the number of its occurrence, in text order."""
    size = max(1, len(words) - K + 1) if len(words) else 0
    shingles = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for step in range(min(K, len(words))):
            shingles = mix(shingles * np.uint64(3) + words[step : step + size])
        order = np.argsort(shingles, kind="stable")
        ordered = shingles[order]
        same = np.concatenate([[False], ordered[1:] == ordered[:-1]])
        if same.any():
            place = np.arange(size)
            label = np.empty(size, np.uint64)
            label[order] = place - np.maximum.accumulate(np.where(same, 0, place))
            shingles = mix(shingles + label * _GOLD)
    return shingles


def bands(shingles: np.ndarray) -> np.ndarray:
    """The BANDS keys of a document."""
    functions = np.arange(len(_FACTORS))
    least = np.empty((len(_FACTORS), 0), np.uint64)
    where = np.empty((len(_FACTORS), 0), np.int64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), BLOCK):
            values = shingles[start : start + BLOCK] * _FACTORS + _SHIFTS
            for _ in range(min(MINIMA, values.shape[1])):
                at = values.argmin(axis=1)
                least = np.column_stack([least, values[functions, at]])
                where = np.column_stack([where, at + start])
                values[functions, at] = np.uint64(2**64 - 1)
        if where.shape[1] > MINIMA:
            best = np.argsort(least, axis=1, kind="stable")[:, :MINIMA]
            where = np.take_along_axis(where, best, axis=1)
        where.sort(axis=1)  # text order
        sketches = np.zeros(len(_FACTORS), np.uint64)
        for column in where.T:
            sketches = mix(sketches * np.uint64(3) + shingles[column])
        keys = np.arange(1, BANDS + 1, dtype=np.uint64)
        for column in sketches.reshape(BANDS, ROWS).T:
            keys = mix(keys * np.uint64(3) + column)
    return keys


def parities(shingles: np.ndarray, size: int = PARITIES) -> np.ndarray:
    """For each of 64 * size bins (a power of two) whether an odd number of the labelled shingles falls into it.

    Each shingle that only one of two texts has changes one bin, so they differ in as many at least as the bins do. The two halves
    of a text's parities, one XOR the other, are its parities in half as many bins.
    """
    bins = (shingles & np.uint64(64 * size - 1)).astype(np.int64)
    odd = np.bincount(bins, minlength=64 * size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _size(shingles: int) -> int:
    """Words of parities that hold four bins a shingle or more, so that few of a text's differences share one."""
    return max(PARITIES, 1 << (shingles // 16).bit_length())


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Aligned similarity of two labelled sequences; below `least` only an upper bound of it.

    Labelled shingles are unique in a document, so a longest common subsequence is a longest
    increasing run of their positions. Positions farther apart than the band cannot be matched in
    an alignment of at least that similarity.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    if n == m and np.array_equal(a, b):
        return 1.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    matched = len(i)
    bound = matched / (n + m - matched)
    if bound < least:
        return bound
    band = (n + m) * (1 - least) / (1 + least)
    inside = np.abs(i - j) <= band
    i, j = i[inside], j[inside]
    j = j[np.argsort(i)]
    if not (j[1:] > j[:-1]).all():
        run: list[int] = []
        for position in j.tolist():
            at = bisect_left(run, position)
            run[at : at + 1] = [position]
        matched = len(run)
    else:
        matched = len(j)
    return matched / (n + m - matched)


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _hashes(text: str) -> np.ndarray:
    return word_hashes(text.lower().split()).astype(np.uint32)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, id of the text and its band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2_000_000):
            keys = []
            for text in batch.column("text").to_pylist():
                hashes = _hashes(text)
                keys.append(int64(bands(labelled_shingles(hashes.astype(np.uint64)))) if len(hashes) else WORDLESS)
            columns = [batch.column("doc_id"), batch.column("id"), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "id", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"), F.xxhash64(_text()).alias("id"))
    return rows.mapInArrow(frugal(sketch), "doc_id long, id long, bands array<long>")


def _words(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id and 32-bit hashes of the words of each text with one of the ids; other texts are dropped before they travel."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2_000_000):
            words = [_hashes(text).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.binary())], ["id", "words"])

    texts = marked(docs.select(_text().alias("text"), F.xxhash64(_text()).alias("__id")), ids, "known").where("known")
    texts = texts.select(F.col("__id").alias("id"), "text").dropDuplicates(["id"])
    return texts.join(ids, "id", "left_semi").mapInArrow(frugal(code), "id long, words binary")


def _hints(words: DataFrame) -> DataFrame:
    """id, number of shingles, and the parities, short ones in columns and long ones in an array, of each text."""

    def hint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2_000_000, "words"):
            sizes, odd, more = [], [], []
            for code in batch.column("words"):
                shingles = labelled_shingles(np.frombuffer(code.as_py(), np.uint32).astype(np.uint64))
                sizes.append(len(shingles))
                odd.append(parities(shingles))
                more.append(parities(shingles, _size(len(shingles))))
            columns = [batch.column("id"), pa.array(sizes, pa.int32()), pa.array(more, pa.list_(pa.int64()))]
            columns += map(pa.array, np.array(odd).reshape(-1, PARITIES).T)
            yield pa.RecordBatch.from_arrays(columns, ["id", "shingles", "parities", *_PARITIES])

    more = ", ".join(f"{name} long" for name in _PARITIES)
    return words.mapInArrow(frugal(hint), f"id long, shingles int, parities array<long>, {more}")


def _unlike(x: Column, y: Column) -> Column:
    """Bins in which two texts' long parities differ; of two lengths, the longer is folded once."""

    def folded(one: Column, other: Column) -> Column:
        half = F.floor(F.size(one) / 2).cast("int")
        fold = F.zip_with(F.slice(one, 1, half), F.slice(one, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(one) > F.size(other), fold).otherwise(one)

    bits = F.zip_with(folded(x, y), folded(y, x), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(bits, F.lit(0), lambda n, of: n + of)


def _measured(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def shingles(node: int, code: bytes) -> np.ndarray:
            if node not in kept:
                if len(kept) > 200:
                    kept.clear()
                kept[node] = labelled_shingles(np.frombuffer(code, np.uint32).astype(np.uint64))
            return kept[node]

        for batch in batches:
            a, b, x, y = (batch.column(name) for name in ("a", "b", "x", "y"))
            found = []
            for row in range(batch.num_rows):
                one = shingles(a[row].as_py(), x[row].as_py())
                other = labelled_shingles(np.frombuffer(y[row].as_py(), np.uint32).astype(np.uint64))
                found.append(1 - similarity(one, other, least))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(found, pa.float64())], ["a", "b", "d"])

    left = words.select(F.col("id").alias("a"), F.col("words").alias("x"))
    right = words.select(F.col("id").alias("b"), F.col("words").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(frugal(measure), "a long, b long, d double")


def near_links(sketches: DataFrame, docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between ids of texts that connect all near texts; `sketches` is a written table of the docs."""
    members = staged(sketches.select("id", F.explode("bands").alias("key")).distinct(), "bands")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    candidates = staged(members.join(shared, "key"), "candidates")
    words = staged(_words(docs, candidates.select("id").distinct()), "words")
    # the round-off of a distance must not part a pair at the threshold
    radius = 1 - similar + 1e-9

    def hints(ids: DataFrame) -> DataFrame:
        return _hints(words.join(ids, "id", "left_semi"))

    def possible(x: str, y: str) -> Column:
        """At the threshold, texts of n and m shingles differ in at most (n + m) * radius / (2 - radius) of them."""
        one, other = ([F.col(f"{side}.{name}") for name in ("shingles", "parities", *_PARITIES)] for side in (x, y))
        most = (one[0] + other[0]) * (radius / (2 - radius)) + 1e-6
        short = [F.bit_count(a.bitwiseXOR(b)) for a, b in zip(one[2:], other[2:], strict=True)]
        return (F.abs(one[0] - other[0]) <= most) & (sum(short[1:], short[0]) <= most) & (_unlike(one[1], other[1]) <= most)

    def distance(pairs: DataFrame) -> DataFrame:
        return _measured(pairs, words, 1 - 2 * radius)

    return bucket_links(candidates, distance, radius, hints, possible)


def _classes(docs: DataFrame, similar: float) -> DataFrame:
    """doc_id, id and class of every row."""
    sketches = staged(sketched(docs), "sketches")
    found = components(near_links(sketches, docs, similar))
    rows = sketches.select("doc_id", "id")
    return rows.join(found, rows["id"] == found["node"], "left").select("doc_id", "id", F.coalesce("class", "id").alias("class"))


def near_classes(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its near duplicates) and class_size of every row."""
    rows = staged(_classes(docs, similar), "classes")
    names = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(names, "class").select("doc_id", "class_id", "class_size")


def deduplicated(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """One row, with all its columns, of each class: the one with the smallest doc_id.

    Rows that are a class of their own stay where they are; only the others' texts travel.
    """
    rows = staged(_classes(docs, similar), "classes")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("row")
    kept = staged(rows.groupBy("class").agg(least, F.count("*").alias("n")), "kept")
    several = rows.join(kept.where("n > 1").select("class"), "class", "left_semi").select("id").distinct()
    kept = kept.select(F.xxhash64("row.doc_id", "row.id").alias("__row"), F.col("row.id").alias("__id"))
    named = docs.withColumn("__id", F.xxhash64(_text())).withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), "__id"))
    named = marked(named, several, "__several")
    chosen = named.where("__several").join(kept, ["__row", "__id"], "left_semi").dropDuplicates(["__row", "__id"])
    return named.where("NOT __several").unionByName(chosen).drop("__row", "__id", "__several")
