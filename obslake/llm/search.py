"""Exact top-k search by inner product with a pivot-distance index.

Method: vectors are keyed by their nearest pivot and their distance to it, and sorted by that key into blocks,
each an annulus around one pivot. A query expands the annuli in the order of their smallest possible
distance and stops where the triangle inequality rules out any better vector. Largest inner product is
nearest distance once every vector gets one more component that makes all lengths equal (and a query gets 0).

The k-th score within a query's own block bounds its radius before it travels. Queries go in groups to slots of
blocks: a task holds the blocks of one slot, bounded by SLOT vectors, streams the groups, and returns at most k rows
per query and slot. Pivots are a bounded sample; a group of equal vectors is split over blocks like any others.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without vec_id, take no
part; shorter vectors count as padded with zeros; of several vectors with one vec_id the smallest in array order
takes part; ties go to the smaller vec_id; fewer than k candidates give fewer rows; an empty table gives none;
other columns are ignored. Components saturate at the range of a 32-bit number; sums are exact 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import staged

SCALE, NEAREST = 256, 5
PIVOTS = 64
#: vectors of a block, of a slot, and queries of a group
BLOCK, SLOT, GROUP = 2048, 65_536, 256
#: room for rounding in distances
SLACK = 1e-6


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (floor(SCALE * x) of each component x as double) of the rows that take part."""
    parts = F.col("embedding").cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bound = float(2**31 - 1)
    whole = F.transform(parts, lambda x: F.greatest(F.lit(-bound), F.least(F.lit(bound), F.floor(SCALE * x).cast("double"))).cast("int"))
    rows = vectors.where(F.col("vec_id").isNotNull() & parts.isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")).groupBy("vec_id").agg(F.min("vector").alias("vector"))


class Space:
    """Pivots and distances among vectors of equal length."""

    def __init__(self, width: int, longest: float, pivots: list[list[int]]):
        self.width, self.longest = width, longest
        self.pivots = self.padded(pivots)
        self.extra = self.lifted(self.pivots)
        # sums stay below 2**53, where doubles are exact
        self.kind = np.float64 if longest < 2**52 else np.int64

    def padded(self, rows: list) -> np.ndarray:
        out = np.zeros((len(rows), self.width))
        for row, values in enumerate(rows):
            out[row, : len(values)] = values
        return out

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0))

    def to_pivots(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Distance of each row to each pivot."""
        extra = 0 if query else self.lifted(x)[:, None] * self.extra
        square = ((x * x).sum(axis=1)[:, None] if query else self.longest) + self.longest
        return np.sqrt(np.maximum(square - 2 * (x @ self.pivots.T + extra), 0))

    def radius(self, x: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Distance within which a vector must be to score at least `least` with each query row."""
        square = (x * x).sum(axis=1) + self.longest - 2 * least
        return np.sqrt(np.maximum(square, 0)) * (1 + SLACK) + SLACK * np.sqrt(self.longest + 1)


def _merged(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


class Search:
    """The best candidates of a group of queries so far."""

    def __init__(self, space: Space, ids: np.ndarray, x: np.ndarray, k: int, least: np.ndarray | None = None):
        self.space, self.ids, self.x, self.k = space, ids, x, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), -1, np.int64)
        self.least = np.full(len(ids), -np.inf) if least is None else least.copy()

    def visit(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Scores the queries `rows` against a block whose ids ascend."""
        if self.space.kind is np.float64:
            scores = self.x[rows] @ vectors.T
        else:
            scores = (self.x[rows].astype(np.int64) @ vectors.astype(np.int64).T).astype(np.float64)
        scores[ids[None, :] == self.ids[rows][:, None]] = -np.inf
        best = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        scores, found = np.take_along_axis(scores, best, axis=1), ids[best]
        self.scores[rows], self.found[rows] = _merged(
            np.column_stack([self.scores[rows], scores]), np.column_stack([self.found[rows], found]), self.k
        )
        self.least = np.maximum(self.least, self.scores[:, -1])

    def expand(self, blocks: list[tuple]) -> None:
        """Visits the annuli (pivot, nearest, farthest, ids, vectors) that can still hold a better vector."""
        distances = self.space.to_pivots(self.x, query=True)
        pivot, near, far = (np.array([block[i] for block in blocks]) for i in range(3))
        gap = np.maximum(np.maximum(distances[:, pivot] - far, near - distances[:, pivot]), 0)
        for number in np.argsort(gap.min(axis=0), kind="stable"):
            rows = np.flatnonzero(gap[:, number] <= self.space.radius(self.x, self.least))
            if len(rows):
                self.visit(rows, blocks[number][3], blocks[number][4])


_INDEXED = "kind int, slot int, pivot int, near double, far double, ids binary, vectors binary, least binary"
_ROWS = "query_id long, vec_id long, score long"


def _blocks(space: Space, k: int, every: int, slots: int):
    """Blocks (kind 0) and query groups (kind 1) of a sorted part."""
    names = [field.split()[0] for field in _INDEXED.split(", ")]

    def row(kind, pivot, near, far, ids, vectors, least, slot=0):
        values = (kind, slot, pivot, near, far, ids.tobytes(), vectors.astype(np.int32).tobytes(), least.tobytes())
        return pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))], schema=_SCHEMA)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        queries: list[tuple] = []

        def block():
            ids = np.array([w[2] for w in waiting], np.int64)
            distance = np.array([w[1] for w in waiting])
            x = space.padded([w[3] for w in waiting])
            order = np.argsort(ids)
            asked = np.flatnonzero(ids % every == 0)
            if len(asked):
                own = Search(space, ids[asked], x[asked], k)
                own.visit(np.arange(len(asked)), ids[order], x[order])
                queries.append((ids[asked], x[asked], own.least))
            slot = int(ids[0] * 2654435761 % slots)
            return row(0, waiting[0][0], distance.min(), distance.max(), ids[order], x[order], np.zeros(0), slot)

        def groups(at_least: int):
            while queries and sum(len(q[0]) for q in queries) >= at_least:
                ids, x, least = (np.concatenate([q[i] for q in queries]) for i in range(3))
                queries.clear()
                if len(ids) > GROUP:
                    queries.append((ids[GROUP:], x[GROUP:], least[GROUP:]))
                yield row(1, -1, 0.0, 0.0, ids[:GROUP], x[:GROUP], least[:GROUP])

        for batch in batches:
            for one in zip(*(batch.column(name).to_pylist() for name in ("pivot", "distance", "vec_id", "vector")), strict=True):
                if waiting and (waiting[0][0] != one[0] or len(waiting) == BLOCK):
                    yield block()
                    waiting = []
                    yield from groups(GROUP)
                waiting.append(one)
        if waiting:
            yield block()
        yield from groups(1)

    return build


_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("slot", pa.int32()), ("pivot", pa.int32()), ("near", pa.float64()), ("far", pa.float64())]
    + [(name, pa.binary()) for name in ("ids", "vectors", "least")]
)


def nearest(vectors: DataFrame, k: int = NEAREST, every: int = 50, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each vec_id divisible by `every`."""
    spark = vectors.sparkSession
    rows = staged(quantised(vectors), "quantised")
    square = F.aggregate(F.col("vector"), F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    known = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.max(square).alias("longest")).first()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vector").limit(pivots).collect()  # bounded
    space = Space(known["width"] or 0, known["longest"] or 0.0, [row["vector"] for row in sample])
    shared = spark.sparkContext.broadcast(space)
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-known["n"] // SLOT))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distances = shared.value.to_pivots(shared.value.padded(batch.column("vector").to_pylist()), query=False)
            pivot = distances.argmin(axis=1).astype(np.int32)
            columns = [pa.array(pivot), pa.array(distances[np.arange(len(pivot)), pivot]), batch.column("vec_id"), batch.column("vector")]
            yield pa.RecordBatch.from_arrays(columns, ["pivot", "distance", "vec_id", "vector"])

    if not known["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    keyed = rows.mapInArrow(key, "pivot int, distance double, vec_id long, vector array<int>")
    order = ("pivot", "distance", "vec_id")
    index = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    index = staged(index.mapInArrow(_blocks(space, k, every, slots), _INDEXED), "index")
    groups = index.where("kind = 1").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    dealt = index.where("kind = 0").unionByName(groups).repartition(slots, "slot").sortWithinPartitions("slot", "kind")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, blocks = None, []
        for batch in batches:
            for one in batch.to_pylist():
                if one["slot"] != slot:
                    slot, blocks = one["slot"], []
                ids = np.frombuffer(one["ids"], np.int64)
                x = np.frombuffer(one["vectors"], np.int32).reshape(len(ids), -1).astype(np.float64)
                if one["kind"] == 0:
                    blocks.append((one["pivot"], one["near"], one["far"], ids, x))
                elif blocks:
                    group = Search(shared.value, ids, x, k, least := np.frombuffer(one["least"]))
                    group.expand(blocks)
                    row, column = np.nonzero((group.scores > -np.inf) & (group.scores >= least[:, None]))
                    scores = group.scores[row, column].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(group.found[row, column]), pa.array(scores)], ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = dealt.mapInArrow(search, _ROWS).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
