"""Document fingerprints: SimHash with block tables.

Method: the terms of a text are its runs of SHINGLE lower-case words, weighted with their characters.
The hash of each term votes with its weight for or against each of BITS bits; the fingerprint is the
signs. All pairs of fingerprints within a Hamming radius r agree in at least one of r + 1 blocks, so r + 1
tables, each with another block in front, find them all; within a block's bucket, links are
found through pivots (graph.bucket_links), so a group of many near fingerprints gives no quadratic output.

Defined cases: a null text is an empty one; texts with fewer words than SHINGLE are one term, a text without
words has the fingerprint of zeros; equal texts have equal fingerprints; the next document is the one with the
next doc_id (nulls first; rows with one doc_id in the order of their text's hash), after the last the first,
so a single document is its own next; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import documents, mix, staged, word_hashes
from obslake.llm.graph import bucket_links, components

SHINGLE, BITS = 3, 128
RADIUS = 3
#: what is fingerprinted at once
CHARS, TEXTS = 2_000_000, 400

_SIGNS = 2.0 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) - 1


def fingerprints(texts: list[str]) -> np.ndarray:
    """BITS / 8 bytes for each text."""
    words = [text.lower().split() for text in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = [word for w in words for word in w]
    if not flat:
        return np.zeros((len(texts), BITS // 8), np.uint8)
    hashes = word_hashes(flat)
    weights = np.fromiter(map(len, flat), np.float64, len(flat))
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    terms, strength = mix(hashes), weights.copy()
    for step in range(1, SHINGLE):
        inside = np.repeat(sizes, sizes) > at + step
        reach = np.flatnonzero(inside)
        terms[reach] = mix(terms[reach] ^ (hashes[reach + step] + np.uint64(step)))
        strength[reach] += weights[reach + step]
    whole = at + SHINGLE <= np.repeat(sizes, sizes)
    whole |= (at == 0) & np.repeat(sizes < SHINGLE, sizes)
    terms, strength, owner = terms[whole], strength[whole], owner[whole]
    votes = np.zeros((len(texts), BITS))
    for lane in range(BITS // 64):
        parts = mix(terms + np.uint64(lane + 1)).view(np.uint8).reshape(-1, 8).astype(np.int64)
        parts += owner[:, None] * 2048 + np.arange(8) * 256
        tally = np.bincount(parts.ravel(), np.repeat(strength, 8), len(texts) * 2048).reshape(-1, 8, 256)
        votes[:, lane * 64 : lane * 64 + 64] = (tally @ _SIGNS).reshape(-1, 64)
    return np.packbits(votes > 0, axis=1)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the first characters of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of each two fingerprints."""
    return 1 - np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS


_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_PARTS = f"{_COLUMNS}, part int, first string, last string"


def _table(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    changed = [edited(text, after) for text, after in zip(texts, following, strict=True)]
    own, other, after = fingerprints(texts), fingerprints(changed), fingerprints(following)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(text) for text in texts], pa.int64()),
        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changed]),
        pa.array([x.tobytes().hex() for x in own], pa.string()),
        pa.array([x.tobytes().hex() for x in other], pa.string()),
        pa.array(likeness(own, other)),
        pa.array(likeness(own, after)),
    ]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted part, each with its next; the part's first and last text for its neighbours."""
    part = TaskContext.get().partitionId()
    names = [field.split()[0] for field in _PARTS.split(", ")]

    def batch(ids, texts, first=None, last=None, known=True):
        columns = _table(ids, texts[: len(ids)], texts[1 : len(ids) + 1]) if known else [
            pa.array(ids, pa.int64()), *[pa.nulls(len(ids), kind) for kind in (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)]
        ]
        more = [pa.array([value] * len(ids), kind) for value, kind in ((part, pa.int32()), (first, pa.string()), (last, pa.string()))]
        return pa.RecordBatch.from_arrays([*columns, *more], names)

    ids, texts, size, first = [], [], 0, None
    for rows in batches:
        for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
            text = text or ""
            first = text if first is None else first
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if len(ids) > 1 and (size > CHARS or len(ids) > TEXTS):
                yield batch(ids[:-1], texts)
                ids, texts, size = ids[-1:], texts[-1:], len(text)
    if ids:
        if len(ids) > 1:
            yield batch(ids[:-1], texts)
        yield batch(ids[-1:], texts[-1:], first, texts[-1], known=False)


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness (see the module).

    One range shuffle of the texts; a part's last row meets the next part's first text afterwards.
    """
    rows = documents(docs).withColumn("hash", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash")
    parts = staged(ordered.select("doc_id", "text").mapInArrow(_in_order, _PARTS), "fingerprints")
    ends = parts.where(F.col("last").isNotNull()).select("doc_id", "part", "first", "last")
    # one row per partition
    order = Window.orderBy("part")
    opening = F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("doc_id", "last", F.coalesce(F.lead("first").over(order), opening).alias("next"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _table(*(batch.column(name).to_pylist() for name in ("doc_id", "last", "next")))
            yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in _COLUMNS.split(", ")])

    inner = parts.where(F.col("last").isNull()).drop("part", "first", "last")
    return inner.unionByName(ends.mapInArrow(close, _COLUMNS))


def near_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fingerprint and fingerprint_class: equal for fingerprints linked through distances up to `radius`.

    prints: distinct fingerprints (hex). A fingerprint without a neighbour is its own class.
    """
    prints = staged(
        prints.select("fingerprint", F.monotonically_increasing_id().alias("id")), "prints"
    )  # written, so that ids stay what they are
    digits = BITS // 4
    blocks = radius + 1
    cuts = [digits * i // blocks for i in range(blocks + 1)]
    keys = [
        F.concat(F.lit(f"{i}:"), F.substring("fingerprint", cuts[i] + 1, cuts[i + 1] - cuts[i])) for i in range(blocks)
    ]
    members = prints.select("id", F.explode(F.array(*keys)).alias("key"))

    def distance(pairs: DataFrame) -> DataFrame:
        left = prints.select(F.col("id").alias("a"), F.col("fingerprint").alias("x"))
        right = prints.select(F.col("id").alias("b"), F.col("fingerprint").alias("y"))
        words = [
            F.bit_count(
                F.conv(F.substring("x", i + 1, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("y", i + 1, 8), 16, 10).cast("long"))
            )
            for i in range(0, digits, 8)
        ]
        return pairs.join(left, "a").join(right, "b").select("a", "b", sum(words[1:], words[0]).cast("double").alias("d"))

    found = components(bucket_links(members, distance, radius))
    smallest = prints.join(found, prints["id"] == found["node"], "left").select("fingerprint", F.coalesce("class", "id").alias("class"))
    names = smallest.groupBy("class").agg(F.min("fingerprint").alias("fingerprint_class"))
    return smallest.join(names, "class").select("fingerprint", "fingerprint_class")


def fingerprinted(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """with_next, and the class of each fingerprint among those within the radius of another."""
    rows = staged(with_next(docs), "fingerprinted")
    classes = near_classes(rows.select("fingerprint").distinct(), radius)
    return rows.join(classes, "fingerprint").select(*rows.columns, "fingerprint_class")
