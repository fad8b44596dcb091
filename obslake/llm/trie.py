"""Prefix trie of conversations: every distinct beginning, who shares it, and what sharing it saves.

Method: whole-sequence collapse. Identical conversations are one weighted sequence with the list of those that end there.
Sequences that are a proper prefix of another one are found by a join with all proper prefixes; the rest are the leaves, and
every node lies on a leaf. Prefixes are then aggregated with the weights of all sequences.

A turn is its 256-bit digest from the first step on, so texts do not travel; a node is named by the 128-bit hash of
its turns. One shuffle by block brings the conversations that share turns together, and tasks read them as a
sorted stream. Equal conversations are sorted by a range partitioning of (sequence, conv_id), so a sequence of a third of
all conversations spreads over tasks; it goes on as lists of up to 4096 ids, of which one task hashes the list of ends
(a SHA-256 has to see its bytes in order). Sums over a subtree take no walk over the tree: each node is
counted by one leaf below it, its owner; a leaf adds what it owns from each depth on, and a node sums that over its leaves. So
the work is one row per leaf and turn, whatever the depth. Nodes that many leaves share are joined by broadcast; a
node is such if it has over 1/10,000 of these rows, so there are fewer than 10,000.

Defined cases: null roles and texts are empty; turns are ordered by number (null first), equal ones by their digest; rows without
conv_id are no conversation; repeated rows are turns of their own; a conversation without turns left ends at the root; an
empty table has no node, not even a root; other columns are ignored. A conversation is one row of 24 bytes a turn, so it has to fit in a task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import staged

#: conversations c and c - c % BLOCK share up to SHARED - 1 turns
BLOCK, SHARED = 5, 9
#: ids in one part of a list of ends
ENDS = 4096
#: nodes with more than one in so many rows are broadcast
HOT = 10_000

ROOT = hashlib.blake2b(digest_size=16).digest()
PATHS = "conv_id long, sequence binary, keys array<binary>, sizes array<long>"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest and size (UTF-8 bytes of the text) of every turn."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )


def paths(conversations: DataFrame, block: int = 1, shared: int = SHARED) -> DataFrame:
    """Each conversation as the keys of its prefixes and the sizes of its turns.

    With block > 1 a conversation c is rebuilt: its first h turns, h = crc32(c) % shared, are those of conversation
    c - c % block.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list[tuple[bytes, int]] = []  # the first turns of the block's first conversation
        base = current = None
        skip, place, state = 0, 0, hashlib.blake2b(digest_size=16)
        keys: list[bytes] = []
        sizes: list[int] = []
        done: list[tuple] = []
        held = 0

        def add(digest: bytes, size: int) -> None:
            state.update(digest)
            keys.append(state.copy().digest())
            sizes.append(size)

        for batch in batches:
            for block_of, conv_id, digest, size in zip(*(batch.column(n).to_pylist() for n in ("base", "conv_id", "digest", "size")), strict=True):
                if conv_id != current:
                    if current is not None:
                        done.append((current, state.digest(), keys, sizes))
                        held += len(keys) + 1
                    if held > 50_000:
                        yield _rows(done, PATH_TYPES)
                        done, held = [], 0
                    if block_of != base:
                        base, head = block_of, []
                    current, place, state, keys, sizes = conv_id, 0, hashlib.blake2b(digest_size=16), [], []
                    skip = 0 if conv_id == base else zlib.crc32(str(conv_id).encode()) % shared
                    for turn in head[:skip]:
                        add(*turn)
                if place >= skip:
                    add(digest, size)
                if conv_id == base and place < shared - 1:
                    head.append((digest, size))
                place += 1
        if current is not None:
            done.append((current, state.digest(), keys, sizes))
        yield _rows(done, PATH_TYPES)

    said = turns(conversations).withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "digest"]
    said = said.repartition("base").sortWithinPartitions(*order)
    return said.select("base", "conv_id", "digest", "size").mapInArrow(follow, PATHS)


PATH_TYPES = [pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]


def _rows(rows: list[tuple], types: list[pa.DataType], names: tuple[str, ...] = ("conv_id", "sequence", "keys", "sizes")) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], list(names))


def sequences(conversations: DataFrame) -> DataFrame:
    """Distinct conversations of `paths`: sequence, first (smallest conv_id), weight, ends_sha256, keys and sizes."""
    listed = "sequence binary, first long, weight long, ends string, keys array<binary>, sizes array<long>"
    names = ("sequence", "first", "weight", "ends", "keys", "sizes")
    types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), *PATH_TYPES[2:]]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of one sequence, up to ENDS of them in a row."""
        sequence, ids, path = None, [], None
        for batch in batches:
            done = []
            conv_ids, found = batch.column("conv_id").to_pylist(), batch.column("sequence").to_pylist()
            for row, (conv_id, key) in enumerate(zip(conv_ids, found, strict=True)):
                if key != sequence or len(ids) == ENDS:
                    if ids:
                        done.append((sequence, ids[0], len(ids), ",".join(map(str, ids)), *path))
                    sequence, ids = key, []
                    path = batch.column("keys")[row].as_py(), batch.column("sizes")[row].as_py()
                ids.append(conv_id)
            yield _rows(done, types, names)
        if ids:
            yield _rows([(sequence, ids[0], len(ids), ",".join(map(str, ids)), *path)], types, names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a sequence's list of ends one after the other, as one hash."""
        sequence = first = path = None
        weight, state = 0, hashlib.sha256()
        for batch in batches:
            done = []
            columns = (batch.column(name).to_pylist() for name in names[:4])
            for row, (key, first_id, count, ends) in enumerate(zip(*columns, strict=True)):
                if key == sequence:
                    state.update(b",")
                else:
                    if sequence is not None:
                        done.append((sequence, first, weight, state.hexdigest(), *path))
                    sequence, first, weight, state = key, first_id, 0, hashlib.sha256()
                    path = batch.column("keys")[row].as_py(), batch.column("sizes")[row].as_py()
                weight += count
                state.update(ends.encode())
            yield _rows(done, types, names)
        if sequence is not None:
            yield _rows([(sequence, first, weight, state.hexdigest(), *path)], types, names)

    parts = conversations.repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id").mapInArrow(lists, listed)
    whole = parts.repartition("sequence").sortWithinPartitions("sequence", "first").mapInArrow(hashed, listed)
    return whole.withColumnRenamed("ends", "ends_sha256")


def _prefixes(found: DataFrame, *columns: str) -> DataFrame:
    """A row per prefix of each sequence, the root and the whole one included: key, depth and the size of its last turn."""
    found = found.select(*columns, "sizes", F.posexplode(F.concat(F.array(F.lit(ROOT)), "keys")).alias("depth", "key"))
    size = F.when(F.col("depth") > 0, F.get("sizes", F.col("depth") - 1)).otherwise(0)
    return found.select(*columns, "key", F.col("depth").cast("long").alias("depth"), size.alias("size"))


def nodes(found: DataFrame) -> DataFrame:
    """The nodes of the trie of `sequences`, which are read several times and should be a written table."""
    inner = F.slice(F.concat(F.array(F.lit(ROOT)), "keys"), F.lit(1), F.size("keys"))
    proper = found.select(F.explode(inner).alias("key")).distinct().withColumn("inner", F.lit(True))
    # the anti-join with proper prefixes as a mark: those that it drops still give their weight
    marked = found.join(proper, F.col("sequence") == F.col("key"), "left").withColumn("leaf", F.col("inner").isNull()).drop("key", "inner")
    known = (
        _prefixes(marked, "first", "weight", "leaf")
        .groupBy("key")
        .agg(
            F.sum("weight").alias("n_convs"),
            F.min("first").alias("conv_id"),
            F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
            F.min(F.when(F.col("leaf"), F.col("first"))).alias("owner"),
        )
    )
    known = staged(known, "nodes")
    rows = known.agg(F.sum("n_leaves")).first()[0] or 0
    hot = known.where(F.col("n_leaves") * HOT > rows)  # fewer than HOT of them
    on_leaves = _prefixes(marked.where("leaf"), "first")
    of_hot = on_leaves.join(F.broadcast(hot), "key")
    of_rest = on_leaves.join(F.broadcast(hot.select("key")), "key", "left_anti").join(known.where(F.col("n_leaves") * HOT <= rows), "key")
    down = Window.partitionBy("first").orderBy("depth")
    owned = F.when(F.col("owner") == F.col("first"), (F.col("n_convs") - 1) * F.col("size")).otherwise(0)
    before = F.coalesce(F.sum(owned).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = of_hot.unionByName(of_rest).select(
        "key", "depth", "conv_id", "n_convs", "n_leaves",
        F.lag("conv_id").over(down).alias("parent_conv_id"),
        (F.lead("owner").over(down) == F.col("first")).cast("long").alias("child"),
        (F.sum(owned).over(Window.partitionBy("first")) - before).alias("below"),
    )
    same = [F.max(name).alias(name) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_leaves")]
    summed = placed.groupBy("key").agg(*same, F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"), F.sum("below").alias("saved_tokens"))
    ends = found.select(F.col("sequence").alias("key"), "ends_sha256")
    none = F.lit(hashlib.sha256().hexdigest())
    return summed.join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, block: int = 1, shared: int = SHARED) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    found = staged(paths(conversations, block, shared), "paths")
    return nodes(staged(sequences(found), "sequences"))
